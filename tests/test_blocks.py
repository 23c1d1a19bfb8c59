"""Blocks and ordered folds against plain Python, on chains, crowded blocks and random relations."""

import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators import blocks


def plain_fold(rows, order, same):
    leaders, out = [], {}
    for row in sorted(rows, key=order):
        lead = next((x for x in leaders if same(row, x)), None)
        if lead is None:
            leaders.append(row)
            lead = row
        out[row["pos"]] = lead["pos"]
    return out


def test_a_long_chain_is_one_block(spark):
    n = 10_000
    rng = random.Random(1)
    at = list(range(n))
    rng.shuffle(at)  # positions do not follow the chain
    df = spark.createDataFrame([(at[i], [f"k{i}", f"k{i + 1}"]) for i in range(n)], "pos long, keys array<string>")
    found = blocks.block_ids(df, "pos", F.col("keys")).groupBy("block").count().collect()
    assert [tuple(r) for r in found] == [(0, n)]


def test_unsettled_blocks_raise(spark):
    df = spark.createDataFrame([(i, [f"k{i}", f"k{i + 1}"]) for i in range(200)], "pos long, keys array<string>")
    with pytest.raises(RuntimeError, match="settle"):
        blocks.block_ids(df, "pos", F.col("keys"), max_rounds=2)


def test_random_blocks_and_links(spark):
    rng = random.Random(2)
    rows = [(i, [f"k{rng.randrange(90)}" for _ in range(rng.choice([0, 1, 1, 2]))] + [None]) for i in range(120)]
    extra = [(rng.randrange(120), rng.randrange(120)) for _ in range(8)]
    top = list(range(120))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    by_key = {}
    for i, keys in rows:
        for k in filter(None, keys):
            by_key.setdefault(k, []).append(i)
    for a, b in [*extra, *((x[0], y) for x in by_key.values() for y in x)]:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    df = spark.createDataFrame(rows, "pos long, keys array<string>")
    links = spark.createDataFrame(extra, "a long, b long")
    got = {r.pos: r.block for r in blocks.block_ids(df, "pos", F.col("keys"), links).collect()}
    assert got == {i: find(i) for i in range(120)}
    assert blocks.block_ids(df.limit(0), "pos", F.col("keys")).collect() == []


@pytest.mark.parametrize("crowded", [False, True])
def test_folds_over_random_chains(spark, crowded):
    """A relation that is not transitive, over rows whose keys chain them into long blocks."""
    rng = random.Random(3)
    rows = [{"pos": i, "x": rng.randrange(400), "w": rng.choice([None, *range(50)])} for i in range(500)]
    for r in rows:
        r["keys"] = [f"{r['x'] // 4}", f"{r['x'] // 4 + 1}"]
    same = lambda left, right: abs(left["x"] - right["x"]) <= 3
    df = spark.createDataFrame([(r["pos"], r["x"], r["w"], r["keys"]) for r in rows], "pos long, x int, w int, keys array<string>")
    options = {"most": 20, "step": 60} if crowded else {}
    got = {r.pos: r.leader for r in blocks.fold(df, "pos", F.col("keys"), ["w"], same, **options).collect()}
    assert got == plain_fold(rows, lambda r: (r["w"] is None, r["w"] or 0, r["pos"]), same)


def test_one_key_of_many_rows_runs_on_several_tasks(spark, monkeypatch):
    """One block of 20,000 rows: the same groups as a plain fold, though no task folds more than a chunk of them."""
    rng = random.Random(4)
    rows = [{"pos": i, "x": rng.randrange(5_000)} for i in range(20_000)]
    same = lambda left, right: abs(left["x"] - right["x"]) <= 100
    df = spark.createDataFrame([(r["pos"], r["x"], "buyer") for r in rows], "pos long, x int, k string")
    seen, plain = [], blocks.stored

    def stored(frame, name):
        out = plain(frame, name)
        if name == "crowded-ranks":
            seen.append(out.groupBy(F.floor((F.col("__rank") - 1) / 3000)).count().collect())
        return out

    monkeypatch.setattr(blocks, "stored", stored)
    got = {r.pos: r.leader for r in blocks.fold(df, "pos", F.array("k"), ["pos"], same, most=5000, step=3000).collect()}
    assert got == plain_fold(rows, lambda r: r["pos"], same)
    assert len(seen[0]) == 7 and max(r["count"] for r in seen[0]) == 3000
