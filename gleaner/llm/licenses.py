"""Operator 10 [native]: license scans by sparse TF-IDF cosine, then nearest-ancestor inheritance by path joins.

Every line of a file that speaks of a licence is a passage, and all such lines together are one more.  Words of other
kinds on the same line, or a notice that breaks between lines, must not count against a notice: so every window of as
many words as a template has, over the whole text and around each word that speaks of a licence, is a passage too.
Only windows of templates that the words around can reach the threshold with are made: the matched terms' part of a
template's squared norm bounds the squared cosine, so nothing is lost.  An SPDX identifier is read as it stands.
Passages of equal words are counted once.  Terms get the inverse document frequency over the texts of all files and the
templates; a passage takes the template of the largest cosine, if that reaches
the threshold, and a file its best passage.  The licence files of a directory (LICENSE, LICENCE, COPYING, UNLICENSE,
with any extension) rule that directory; a file without a licence of its own inherits from its nearest ancestor
directory that has one, found by joining each distinct directory's ancestors with the ruling directories.

Built-in functions only: no Python runs on the executors.

Defined results.  Null and empty texts have no licence of their own but may inherit.  A null path has no directory and
inherits nothing.  Ties between templates go to the licence that sorts first, between passages to the higher score and
then the licence that sorts first; two licence files in one directory: the higher score, then the licence, rules.
Repeated rows keep one row each.  An empty table gives no rows.  Extra columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import stored

THRESHOLD = 0.55
#: Common licence notices by SPDX identifier, short and long forms.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights: CC0 1.0 Universal public domain dedication license"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]
CUE = r"(?i)licen[cs]|redistribut|permission[^a-z0-9]+is[^a-z0-9]+hereby|public[^a-z0-9]+domain|spdx"
#: Licence identifiers behind an SPDX tag, up to the end of the line.
SPDX = r"(?i)spdx-license-identifier:[ \t]*([^\r\n]*)"
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|unlicense)([.\-].*)?$"


def terms(text: Column) -> Column:
    """Lower-cased words, with the points and digits of version numbers."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z]+|[0-9]+(?:\.[0-9]+)*"), F.lit(0))


def directory(path: Column) -> Column:
    """Everything before the last slash; '' for a file at the top."""
    return F.when(path.contains("/"), F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.when(path.isNotNull(), F.lit("")))


def ancestors(folder: Column) -> Column:
    """The folder and all above it, the top '' last, as (folder, depth)."""
    names = F.split(folder, "/")
    whole = F.transform(F.sequence(F.lit(1), F.size(names)), lambda n: F.struct(F.array_join(F.slice(names, 1, n), "/").alias("folder"), n.alias("depth")))
    top = F.array(F.struct(F.lit("").alias("folder"), F.lit(0).alias("depth")))
    return F.when(folder == "", top).otherwise(F.concat(whole, top))


def passages(files: DataFrame, key: str, text: str) -> DataFrame:
    """(key, terms): each licence line of a file, and all of them together where there are several."""
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike(CUE))
    # The cheap test comes first: most files never split their text.
    found = files.where(F.col(text).rlike(CUE)).select(key, lines.alias("lines"))
    whole = F.when(F.size("lines") > 1, F.array(F.array_join("lines", " "))).otherwise(F.array().cast("array<string>"))
    each = found.select(key, F.explode(F.concat("lines", whole)).alias("line")).select(key, F.array_join(terms(F.col("line")), " ").alias("terms"))
    return each.where("terms <> ''")


def surroundings(files: DataFrame, key: str, text: str, reach: int) -> DataFrame:
    """(key, words, at): each word that speaks of a licence, at place `at` of it and the words up to `reach` around it."""
    found = files.where(F.col(text).rlike(CUE)).select(key, terms(F.col(text)).alias("all"))

    def cue(w: Column, i: Column) -> Column:
        after = lambda k, x: F.coalesce(F.get("all", i + k) == x, F.lit(False))
        return w.rlike("licen[cs]|redistribut|spdx") | ((w == "permission") & after(1, "is") & after(2, "hereby")) | ((w == "public") & after(1, "domain"))

    places = F.filter(F.transform("all", lambda w, i: F.when(cue(w, i), i)), lambda i: i.isNotNull())
    each = found.select(key, "all", F.explode(places).alias("i")).withColumn("low", F.greatest(F.col("i") - reach, F.lit(0)))
    words = F.array_join(F.slice("all", F.col("low") + 1, F.col("i") - F.col("low") + reach + 1), " ")
    return each.select(key, words.alias("words"), (F.col("i") - F.col("low")).alias("at"))


def windows(around: DataFrame, weights: DataFrame, threshold: float) -> DataFrame:
    """(words, at, terms): the windows over each word of licences, in the length of each template that they may match."""
    # Scores are rounded to six places, so the bound is a little lower than the threshold.
    least = max(threshold - 1e-6, 0.0) ** 2
    held = around.select("words", "at", F.explode(F.array_distinct(F.split("words", " "))).alias("term")).join(F.broadcast(weights), "term")
    lengths = held.groupBy("words", "at", "template", "length").agg(F.sum(F.col("tw") * F.col("tw")).alias("part")).where(F.col("part") >= least).select("words", "at", "length").distinct()
    words = F.split("words", " ")
    low = F.greatest(F.col("at") - F.col("length") + 1, F.lit(0))
    high = F.greatest(F.least(F.col("at"), F.size(words) - F.col("length")), low)
    starts = lengths.select("words", "at", "length", F.explode(F.sequence(low, high)).alias("start"))
    return starts.select("words", "at", F.array_join(F.slice(words, F.col("start") + 1, F.col("length")), " ").alias("terms")).distinct()


def tagged(files: DataFrame, key: str, text: str, templates: list[tuple[str, str]]) -> DataFrame:
    """(key, license): the templates' licences that stand behind an SPDX tag."""
    known = files.sparkSession.createDataFrame([(x.lower(), x) for x in sorted({a for a, _ in templates})], "name string, license string")
    said = F.flatten(F.transform(F.regexp_extract_all(F.lower(text), F.lit(SPDX), F.lit(1)), lambda x: F.regexp_extract_all(x, F.lit(r"[a-z0-9.\-]*[a-z0-9]"), F.lit(0))))
    names = files.where(F.col(text).rlike(SPDX)).select(key, F.explode(said).alias("name")).select(key, F.regexp_replace("name", "-(only|or-later)$", "").alias("name"))
    return names.join(F.broadcast(known), "name").select(key, "license").distinct()


def weighted(texts: DataFrame, templates: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """(term, idf) over all texts (text, n rows of it) and templates, and (term, template, license, length, tw) with unit norms."""
    spark = texts.sparkSession
    fixed = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(templates)], "template int, license string, text string").withColumn("words", terms(F.col("text")))
    total = texts.count() + len(templates)
    seen = texts.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term")).unionByName(fixed.select(F.explode(F.array_distinct("words")).alias("term"))).groupBy("term").agg(F.count("*").alias("df"))
    idf = stored(seen.select("term", (F.log(F.lit(float(total + 1)) / (F.col("df") + 1)) + 1).alias("idf")), "license-idf")
    bag = fixed.select("template", "license", F.size("words").alias("length"), F.explode("words").alias("term")).groupBy("template", "license", "length", "term").agg(F.count("*").alias("tf"))
    theirs = bag.join(idf, "term").withColumn("w", (1 + F.log("tf")) * F.col("idf"))
    norms = theirs.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    # Templates are few and fixed, so their terms are broadcast.
    return idf, stored(theirs.join(norms, "template").select("term", "template", "license", "length", (F.col("w") / F.col("norm")).alias("tw")), "license-templates")


def matches(distinct: DataFrame, idf: DataFrame, weights: DataFrame, threshold: float) -> DataFrame:
    """(terms, license, score) for distinct passages (terms) that reach the threshold."""
    own = distinct.select("terms", F.explode(F.split("terms", " ")).alias("term")).groupBy("terms", "term").agg(F.count("*").alias("tf"))
    # Passages meet the idf table in a join of distinct terms.
    own = stored(own.join(idf, "term").select("terms", "term", ((1 + F.log("tf")) * F.col("idf")).alias("w")), "license-terms")
    size = own.groupBy("terms").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = own.join(F.broadcast(weights), "term").groupBy("terms", "template", "license").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    scored = dots.join(size, "terms").select("terms", "license", F.round(F.least(F.col("dot") / F.col("norm"), F.lit(1.0)), 6).alias("score")).where(F.col("score") >= threshold)
    best = scored.groupBy("terms").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("best"))
    return best.select("terms", F.col("best.license").alias("license"), (-F.col("best.s")).alias("score"))


def scan(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, path_col: str = "path", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, path, own_license, score, license, origin, from_folder) of every row.

    origin is 'own', 'inherited' or 'none'; from_folder is the directory whose licence file rules.
    """
    rows = files.select(F.col(id_col).alias("doc_id"), F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))
    # A row's passages are tied to its path and the checksum of its text, so repeated rows share one result.
    keyed = rows.withColumn("file", F.sha2(F.concat_ws("\n", F.coalesce("path", F.lit("")), F.coalesce("text", F.lit(""))), 256))
    idf, weights = weighted(rows.where("text is not null").select("text"), templates)
    # A place and the words around it are one passage of many windows; a line is one of itself.
    reach = (weights.agg(F.max("length")).first()[0] or 1) - 1
    around = surroundings(keyed, "file", "text", reach)
    found = stored(passages(keyed, "file", "text").select("file", F.col("terms").alias("words"), F.lit(-1).alias("at")).unionByName(around).distinct(), "license-passages")
    distinct = found.select("words", "at").distinct()
    cut = windows(distinct.where("at >= 0"), weights, threshold).unionByName(distinct.where("at < 0").withColumn("terms", F.col("words")))
    cut = stored(cut, "license-windows")
    each = cut.join(matches(cut.select("terms").distinct(), idf, weights, threshold), "terms").groupBy("words", "at").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("best"))
    each = found.join(each, ["words", "at"]).select("file", "best").unionByName(tagged(keyed, "file", "text", templates).select("file", F.struct(F.lit(-1.0).alias("s"), "license").alias("best")))
    best = each.groupBy("file").agg(F.min("best").alias("best"))
    best = best.select("file", F.col("best.license").alias("own_license"), (-F.col("best.s")).alias("score"))
    named = stored(keyed.drop("text").join(best, "file", "left").withColumn("folder", directory(F.col("path"))), "license-files")
    is_license = F.regexp_replace("path", r"^.*/", "").rlike(LICENSE_FILE) & F.col("own_license").isNotNull()
    ruling = named.where(is_license).groupBy("folder").agg(F.min(F.struct((-F.col("score")).alias("s"), "own_license")).alias("rule"))
    ruling = ruling.select(F.col("folder").alias("from_folder"), F.col("rule.own_license").alias("ruled"))
    # Directories, not files, meet their ancestors.
    above = named.select("folder").where("folder is not null").distinct().select("folder", F.explode(ancestors(F.col("folder"))).alias("up")).select("folder", F.col("up.folder").alias("from_folder"), F.col("up.depth").alias("depth"))
    nearest = above.join(ruling, "from_folder").groupBy("folder").agg(F.max(F.struct("depth", "ruled", "from_folder")).alias("near"))
    nearest = nearest.select("folder", F.col("near.ruled").alias("ruled"), F.col("near.from_folder").alias("from_folder"))
    out = named.join(nearest, "folder", "left")
    own = F.col("own_license").isNotNull()
    return out.select(
        "doc_id", "path", "own_license", "score", F.coalesce("own_license", "ruled").alias("license"),
        F.when(own, "own").when(F.col("ruled").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~own, F.col("from_folder")).alias("from_folder"),
    )


def document_path() -> Column:
    """A path for the documents table, which has none: docs / thousand / ten / name; the first of each ten is LICENSE."""
    n = F.col("doc_id")
    name = F.when(n % 10 == 0, F.lit("LICENSE")).otherwise(F.concat(n.cast("string"), F.lit(".txt")))
    thousand, ten = (F.floor(n / k).cast("string") for k in (1000, 10))
    folder = F.when(n % 1000 == 0, F.concat_ws("/", F.lit("docs"), thousand)).otherwise(F.concat_ws("/", F.lit("docs"), thousand, ten))
    return F.when(n.isNotNull(), F.concat_ws("/", folder, name))


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scan(documents.withColumn("path", document_path()))


QUERIES = {"op10_license_scan": op10_license_scan}
