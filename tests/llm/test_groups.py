"""Near duplicates, fingerprints, sharding, neighbours and licences against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import bagminhash, licenses, neighbours, orderminhash, sharding
from gleaner.llm.graph import components

VOCAB = [f"w{i}" for i in range(300)]


def bag(text):
    w = text.split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def likeness(a, b):
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


def corpus(seed=1):
    """Texts with exact and near copies in groups of several sizes, repeated lines, short and empty texts."""
    rng, out = random.Random(seed), [None, "", "  \n", "one", "one", "two words"]
    for size in (1, 2, 5, 40):
        base = [rng.choice(VOCAB) for _ in range(120)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(VOCAB)
            out.append(" ".join(own))
    out += [" ".join(rng.choice(VOCAB) for _ in range(rng.randint(3, 200))) for _ in range(60)]
    out += ["line of words here now\n" * n for n in (40, 45, 60, 100)]
    return out + out[10:20]


def brute_classes(texts):
    bags, parent = [bag(t or "") for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if bags[i] and bags[j] and likeness(bags[i], bags[j]) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "n", "r", "k") for i, t in enumerate(texts)], "doc_id long, text string, node string, root string, key string").repartition(5)


def test_classes_equal_brute_force(spark):
    texts = corpus()
    got = {r.doc_id: r.class_id for r in bagminhash.classes(frame(spark, texts)).collect()}
    assert got == dict(enumerate(brute_classes(texts)))


def test_keep_one_leaves_clashing_columns_alone(spark):
    rows = [(1, "a b c d e f", "x", "y", 5), (2, "a b c d e f", "p", "q", 6), (3, "other words stand in this one", None, "z", 7), (4, None, "n", "n", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __own string, __DIGEST string, __keep_id long")
    assert sorted(map(tuple, bagminhash.keep_one(df).collect())) == [rows[0], rows[2], rows[3]]


def test_keep_one(spark):
    texts = corpus(2)
    df = frame(spark, texts)
    rows = df.unionByName(df.where("doc_id in (3, 12)")).unionByName(spark.createDataFrame([(None, "null id words that stand alone here", None, None, None)], df.schema))
    kept = bagminhash.keep_one(rows)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(brute_classes(texts))) and ids.count(None) == 1
    assert bagminhash.classes(df.limit(0)).count() == 0 and bagminhash.keep_one(df.limit(0)).count() == 0


def test_signatures_are_unbiased():
    rng, error = random.Random(3), []
    for trial in range(30):
        a = [rng.choice(VOCAB) for _ in range(rng.choice([6, 30, 200, 1000]))]
        a += a[:10] * rng.randint(0, 30) if trial % 3 == 0 else []
        b = list(a)
        for _ in range(rng.randint(0, max(1, len(a) // 12))):
            b[rng.randrange(len(b))] = rng.choice(VOCAB)
        raw = [" ".join(x).encode() for x in (a, b)]
        offsets = np.cumsum([0, *map(len, raw)])
        t, h, w = bagminhash.bags(np.frombuffer(b"".join(raw), np.uint8), offsets)
        s = bagminhash.signatures(t, h, w, 2, 2000)
        error.append((s[0] == s[1]).mean() - likeness(bag(" ".join(a)), bag(" ".join(b))))
    assert abs(np.mean(error)) < 0.008 and np.abs(error).max() < 0.05


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{k: 100 for k in range(100, 140)}}


def test_order_minhash(spark, tmp_path):
    texts = [t for t in corpus(4)] + ["x" * 500, "日本語のテキスト" * 30, "é" * 3]
    spark.createDataFrame([(3 * i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, sketch string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in orderminhash.op4_order_minhash(spark, str(tmp_path)).collect()}
    by_text = defaultdict(set)
    for i, t in enumerate(texts):
        t, n = t or "", texts[(i + 1) % len(texts)] or ""
        r, half = rows[3 * i], len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text[t].add(r.fingerprint)
        if edited == t:
            assert r.near_edited == 1
        if t == n:
            assert r.near_next == 1
    assert all(len(f) == 1 for f in by_text.values())
    assert len(rows) == len(texts)


def test_order_matters(spark):
    rng = random.Random(5)
    a = [rng.choice(VOCAB) for _ in range(400)]
    small, moved = list(a), a[200:] + a[:200]
    small[10] = "other"
    texts = [" ".join(x) for x in (a, small, moved, [rng.choice(VOCAB) for _ in range(400)], list(reversed(a)))]
    df = orderminhash.fingerprints(frame(spark, texts)).select("doc_id", "sketch")
    base = df.where("doc_id = 0").select(F.col("sketch").alias("base"))
    near = {r.doc_id: r.n for r in df.crossJoin(base).select("doc_id", orderminhash.likeness(F.col("sketch"), F.col("base")).alias("n")).collect()}
    assert near[0] == 1 and near[1] > 0.9 and 0.3 < near[2] < 0.9 and near[3] < 0.05 and near[4] < 0.05


def test_repeats_are_numbered(spark):
    few, many = "a b c d e " * 10, "a b c d e " * 200
    df = orderminhash.fingerprints(frame(spark, [few, many])).collect()
    sizes = {r.doc_id: len(r.sketch) for r in df}
    assert sizes[1] > 60 > sizes[0] > 5 + 10


@pytest.mark.parametrize("shards", [3, 24])
def test_sharding(spark, shards):
    texts = corpus(6) * 3 + ["hot copy of one text"] * 120
    rows = sharding.assign(frame(spark, texts), shards).collect()
    assert len(rows) == len(texts)
    per = defaultdict(list)
    for r in rows:
        t = (texts[r.doc_id] or "").encode()
        assert r.size == len(t) + 8 and r.text_crc32 == zlib.crc32(t)
        per[r.shard].append(r)
    total, largest = sum(r.size for r in rows), max(r.size for r in rows)
    for s, rs in per.items():
        assert 0 <= s < shards and sorted(r.slot for r in rs) == list(range(len(rs)))
        assert abs(sum(r.size for r in rs) - total / shards) <= largest + 1
    assert sharding.assign(frame(spark, texts).limit(0)).count() == 0


def test_ranges_follow_the_rows(spark, monkeypatch):
    asked, plain = [], sharding.sample_splitters
    monkeypatch.setattr(sharding, "sample_splitters", lambda rows, ranges: asked.append(ranges) or plain(rows, ranges))
    df = frame(spark, [f"text {i}" for i in range(300)])
    assert sharding.assign(df, 3, rows_a_range=4).count() == 300 == sharding.assign(df, 3).count()
    assert asked == [75, 48]


def test_neighbours(spark):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((12, 16))
    v = centres[rng.integers(0, 12, 1500)] + 0.4 * rng.standard_normal((1500, 16))
    v[100:400] = v[100]  # a hot vector
    rows = [(i, [float(x) for x in v[i]], "q", 1) for i in range(1500)]
    rows += [(2000, None, "q", 1), (2050, [0.0] * 16, "q", 1), (2100, [float("nan")] * 16, "q", 1), (None, [1.0] * 16, "q", 1), (50, rows[50][1], "q", 1), (2150, [1.0, 2.0], "q", 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string, part int")
    got = neighbours.search(df, F.col("id") % 50 == 0, part_count=8).collect()
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    per = defaultdict(list)
    for r in sorted(got, key=lambda r: r.rank):
        per[r.query_id].append(r)
    assert set(per) == set(range(0, 1500, 50))
    hit = 0
    for q, rs in per.items():
        assert [r.rank for r in rs] == [1, 2, 3, 4, 5]
        s = np.round(u @ u[q], 12)
        s[q] = -9
        best = np.lexsort((np.arange(1500), -s))[:5]
        hit += len({r.vec_id for r in rs} & set(best.tolist()))
        assert all(abs(r.score - u[q] @ u[r.vec_id]) < 1e-12 for r in rs)
        assert [(-r.score, r.vec_id) for r in rs] == sorted((-r.score, r.vec_id) for r in rs)
        if 100 <= q < 400:  # ties go to the smaller ids
            assert [r.vec_id for r in rs] == [i for i in range(100, 107) if i != q][:5]
    assert hit / (5 * len(per)) >= 0.95
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.rank) for r in neighbours.search(few, F.col("id") == 0).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert neighbours.search(few.limit(0), F.col("id") == 0).count() == 0


def test_balanced_parts():
    rng = np.random.default_rng(8)
    x = neighbours.unit_rows(rng.standard_normal((512, 8)))
    part = neighbours.partition(neighbours.nearest(x, x, 8, skip_same=True), 8, rng)
    assert np.bincount(part).tolist() == [64] * 8


def test_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the Software), to deal\nin the Software without restriction"
    rows = [
        (1, "a/LICENSE", mit, "x"), (2, "a/b/c/x.py", "code\n", "x"), (3, "a/b/y.py", "# Licensed under the Apache License, Version 2.0\ncode", "x"), (4, "z.py", "code", "x"),
        (5, "a/b/COPYING.txt", "This work is licensed under the GNU General Public License, version 3.", "x"), (6, None, None, "x"), (7, "a/q.py", None, "x"), (8, "ab/q.py", "", "x"),
        (9, "d/LICENSE", "nothing of the kind", "x"), (10, "d/x.py", "a license to thrill and other unrelated stories about nothing much at all", "x"), (1, "a/LICENSE", mit, "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string, license string")
    got = sorted((r.doc_id, r.own_license, r.license, r.origin, r.from_folder) for r in licenses.scan(df).collect() if r.doc_id != 6)
    assert got == [
        (1, "MIT", "MIT", "own", None), (1, "MIT", "MIT", "own", None), (2, None, "GPL-3.0", "inherited", "a/b"), (3, "Apache-2.0", "Apache-2.0", "own", None), (4, None, None, "none", None),
        (5, "GPL-3.0", "GPL-3.0", "own", None), (7, None, "MIT", "inherited", "a"), (8, None, None, "none", None), (9, None, None, "none", None), (10, None, None, "none", None),
    ]
    assert licenses.scan(df.limit(0)).count() == 0


def test_licenses_among_other_words_and_over_lines(spark):
    # Many notices of the short kinds: what stands around them is rare and must not count against them.
    common = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0."]
    rows = [(100 + i, f"p/{i}.txt", f"words of file number {i}\n{common[i % 3]}\nthe end of it") for i in range(240)]
    apache = "Copyright 2019 The Acme Authors. All rights reserved. Licensed under the Apache License, Version 2.0 (the License);"
    minified = "/*! frobnicate 3.1.2 | (c) 2014 Jane Roe and Richard Miles | https://frob.example.org | Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction */ !function(a,b){var c=a.frob||{},d=b.length;return c[d]=quux(zork)}(window,document);"
    mozilla = "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"
    said = [
        ("Copyright (c) 2020 Jane Roe. Released under the MIT License.", "MIT"), (apache, "Apache-2.0"), ("// SPDX-License-Identifier: MIT", "MIT"), (minified, "MIT"), (mozilla, "MPL-2.0"),
        ("# SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"), ("# SPDX-License-Identifier: ISC", None), ("Copyright (c) 2020 Jane Roe. Released under the ISC License.", None),
        ("The bar was licensed in 1901 and the owner redistributed all of its chairs to the poor.", None),
    ]
    df = spark.createDataFrame(rows + [(i, f"q/{i}.txt", t) for i, (t, _) in enumerate(said)], "doc_id long, path string, text string")
    got = {r.doc_id: r.own_license for r in licenses.scan(df).collect()}
    assert [got[i] for i in range(len(said))] == [x for _, x in said]
    assert all(got[100 + i] == ("MIT", "Apache-2.0", "CC-BY-NC-4.0")[i % 3] for i in range(240))


def test_order_minhash_cuts_long_words_by_themselves(spark):
    rng = np.random.default_rng(5)
    spaceless = "".join(chr(c) for c in rng.integers(0x4E00, 0x9000, 600))
    prose = " ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(60))
    df = spark.createDataFrame([(spaceless, spaceless[:300] + prose, "ab " + spaceless[:30])], "a string, b string, c string")
    row = df.select(orderminhash.likeness(orderminhash.sketch(F.col("a")), orderminhash.sketch(F.col("b"))).alias("near"), orderminhash.tokens(F.col("c")).alias("words")).first()
    assert row.near > 0.1
    assert row.words == ["ab", *spaceless[:30]]
