"""Operator 12: how quality filters interact, by a Walsh-Hadamard audit.

Every document gets a mask: bit k is set if it fails filter k.  For each part and label one aggregation keeps 32 signed
parity sums, W[S] = sum over documents of (-1)^|S & mask|; they merge like any sum.  The transform is its own inverse up
to the factor 32, so the counts of all 32 masks follow exactly.  From these cells every one of the 120 orders of the
filters is evaluated without another look at the documents: what a step removes, what it would have removed but for an
earlier step, and each filter's Shapley share, in closed form: a document that fails k filters is removed first by each
of them in 120 / k of the orders.

The duplicate filter needs other rows of the same text.  Rows are counted per (id, digest of the text) first, then per
digest; so a text that a third of all rows share is a handful of counts when its smallest id is sought.

Defined results.  A null text is empty, a null part is the empty string.  Null ids carry no label, neither are nor have
smaller ids.  Repeated rows count each; rows of one id and text are no duplicates of each other.  Several label rows of
a document: it is good (toxic) if any of them says so.  A part without documents has no rows, so an empty table gives
none.  Extra columns are not read.  Texts are whole and stay in the JVM, one row at a time.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_WORDS, MIN_DISTINCT_PCT, MAX_CAPITAL_PCT = 200, 50, 3
#: Characters that end a word, and characters of markup.
_SPACE, _MARKUP = r"[\x20\x09-\x0D]+", r"[#$%&*|]"


def text_rules(df: DataFrame, text: str) -> tuple[DataFrame, dict[str, Column]]:
    """(df with helper columns, failure condition of each filter): few words, few distinct words, capitals, markup."""
    words = F.array_remove(F.split(text, _SPACE), "")
    counted = df.withColumn("__words", words).select(*df.columns, F.size("__words").cast("long").alias("__n"), F.size(F.array_distinct("__words")).cast("long").alias("__d"))
    n, capitals = F.col("__n"), F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    return counted, {
        "A": n < MIN_WORDS, "B": 100 * F.col("__d") < MIN_DISTINCT_PCT * n,
        "C": 100 * capitals > MAX_CAPITAL_PCT * F.char_length(text).cast("long"), "D": F.col(text).rlike(_MARKUP),
    }


def mask_of(conditions: Mapping[str, Column]) -> Column:
    """Bit k is set if the k-th condition holds; an unknown condition does not."""
    mask = F.lit(0)
    for k, c in enumerate(conditions.values()):
        mask = mask.bitwiseOR(F.when(c, F.lit(1 << k)).otherwise(F.lit(0)))
    return mask


def flags(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, good, toxic) of the labelled documents that are either."""
    each = labels.select(F.col(id_col).alias("doc_id"), (F.col("quality") == 1).alias("g"), (F.col("toxic") == 1).alias("t")).where("doc_id is not null and (g or t)")
    return each.groupBy("doc_id").agg(F.coalesce(F.bool_or("g"), F.lit(False)).alias("good"), F.coalesce(F.bool_or("t"), F.lit(False)).alias("toxic"))


def with_duplicates(masked: DataFrame, labels: DataFrame, bit: int) -> DataFrame:
    """(part, good, toxic, mask, n) with the duplicate filter's bit added; masked: doc_id, digest, part, mask.

    Counts per id and text come first; so no key gathers rows.  The join with labels and the search for a text's
    smallest id then see counts only, a text's mask and all that depends on it being the same in all its rows.
    """
    rows = masked.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    # Null ids meet no label; their text's digest deals them out.
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("~"), "digest"))
    own = flags(labels).select(F.col("doc_id").cast("string").alias("key"), "good", "toxic")
    labelled = rows.withColumn("key", key).join(own, "key", "left").select("digest", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "doc_id", "n")
    known = F.col("doc_id").isNotNull()
    texts = labelled.groupBy("digest", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.sum(F.when(~known, F.col("n")).otherwise(F.lit(0))).alias("unnamed"), F.min(F.when(known, F.struct("doc_id", "n"))).alias("low"))
    first = F.min("low.doc_id").over(Window.partitionBy("digest"))
    apart = texts.withColumn("own", F.col("unnamed") + F.when(F.col("low.doc_id") == first, F.col("low.n")).otherwise(F.lit(0)))
    both = F.explode(F.array(F.struct(F.col("mask"), F.col("own").alias("n")), F.struct(F.col("mask").bitwiseOR(F.lit(bit)).alias("mask"), (F.col("n") - F.col("own")).alias("n"))))
    return apart.select("part", "good", "toxic", both.alias("c")).select("part", "good", "toxic", "c.mask", "c.n").where("n > 0")


def sign(subset: Column, mask: Column) -> Column:
    """(-1)^|subset & mask|."""
    return F.lit(1) - F.lit(2) * F.bit_count(subset.bitwiseAND(mask)).bitwiseAND(F.lit(1))


def parity_sums(counts: DataFrame, filters: int, *keys: str) -> DataFrame:
    """keys and `sums`, the signed parity sums of all subsets of the filters; counts: keys, mask, n."""
    sums = [F.sum(F.col("n") * sign(F.lit(s), F.col("mask"))) for s in range(1 << filters)]
    return counts.groupBy(*keys).agg(F.array(*sums).alias("sums"))


def mask_cells(sums: DataFrame, filters: int, *keys: str) -> DataFrame:
    """keys, mask, n: the transform again, divided by its size, which leaves no remainder."""
    signed = lambda m: F.aggregate(F.transform("sums", lambda w, s: w * sign(s, m)), F.lit(0).cast("long"), lambda a, x: a + x)
    cells = F.transform(F.sequence(F.lit(0), F.lit((1 << filters) - 1)), lambda m: F.shiftright(signed(m), filters))
    return sums.select(*keys, F.posexplode(cells).alias("mask", "n"))


def orders(filters: str) -> list[dict]:
    """Each step of each order: the filters before it and its own, as bits."""
    out = []
    for order in permutations(filters):
        before = 0
        for step, f in enumerate(order, 1):
            own = 1 << filters.index(f)
            out.append({"filter_order": "".join(order), "step": step, "before": before, "own": own})
            before |= own
    return out


def evaluated(cells: DataFrame, filters: str) -> DataFrame:
    """One row per part, order and step; cells: part, good, toxic, mask, n, a bounded number of rows per part."""
    steps = F.from_json(F.lit(json.dumps(orders(filters))), "array<struct<filter_order:string,step:int,before:int,own:int>>")
    each = cells.withColumn("s", F.explode(steps)).select("part", "good", "toxic", "mask", "n", "s.*")
    fails, met = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda condition, n=F.col("n"): F.sum(F.when(condition, n).otherwise(F.lit(0))).cast("long")
    share = F.expr(f"n * {factorial(len(filters))} div greatest(bit_count(mask), 1)")
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~met).alias("kept"), total(fails & ~met).alias("removed"), total(fails & met).alias("redundant"), total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(fails & ~met & F.col("good")).alias("good_lost"), total(fails & ~met & F.col("toxic")).alias("toxic_lost"), total(fails, share).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The audit of the text rules and the duplicate filter (the last letter) for every part of docs."""
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"))
    ruled, conditions = text_rules(texts, "text")
    masked = ruled.select("doc_id", "part", F.md5("text").alias("digest"), mask_of(conditions).alias("mask"))
    filters = "".join(conditions) + "E"
    keys = ("part", "good", "toxic")
    sums = parity_sums(with_duplicates(masked, labels, 1 << len(conditions)), len(filters), *keys)
    return evaluated(mask_cells(sums, len(filters), *keys), filters)


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return audit(docs, labels)


_BIT = "(1 << (ascii({0}) - 65))"
_ORDERS = "SELECT a.c || b.c || c.c || d.c || e.c AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5"
ORACLE_SQL = {
    "op12_filter_audit": rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
 w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM t),
 m AS (SELECT part, (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, FALSE)::INT AS mask,
  doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic FROM w),
 n AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM m GROUP BY 1, 2),
 x(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')), p AS ({_ORDERS}),
 s AS (SELECT o, k AS step, {_BIT.format("o[k]")} AS own, coalesce(list_sum(list_transform(range(1, k), lambda i: {_BIT.format("o[i]")})), 0)::BIGINT AS before FROM p, (SELECT unnest(range(1, 6)) AS k))
 SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(sum(n) FILTER ((mask & (own | before)) = 0), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER ((mask & own) <> 0 AND (mask & before) = 0), 0) AS BIGINT) AS removed, CAST(coalesce(sum(n) FILTER ((mask & own) <> 0 AND (mask & before) <> 0), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (mask = own), 0) AS BIGINT) AS unique_fails, CAST(coalesce(sum(g) FILTER ((mask & own) <> 0 AND (mask & before) = 0), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(x) FILTER ((mask & own) <> 0 AND (mask & before) = 0), 0) AS BIGINT) AS toxic_lost, CAST(coalesce(sum(n * 120 // greatest(bit_count(CAST(mask AS BIGINT)), 1)) FILTER ((mask & own) <> 0), 0) AS BIGINT) AS shapley
 FROM n, s GROUP BY 1, 2, 3"""
}
QUERIES = {"op12_filter_audit": op12_filter_audit}
