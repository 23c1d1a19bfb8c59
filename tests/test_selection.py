"""Selection end to end on small made-up candidates."""

import random

import pytest
from pyspark.sql import functions as F

from gleaner.functions import lexicon as lx
from gleaner.operators import select
from gleaner.operators.blocks import fold

NOW = "2026-07-22T09:30:00+08:00"
SCHEMA = "input_pos long, title string, url string, summary string, category_hint string, discovery_source string, p string"


def candidates(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA).withColumn("published_at", F.to_timestamp("p")).drop("p")


def test_funnel_and_order(spark):
    day = lambda d: f"2026-07-{d:02d}T00:00:00+08:00"
    comm = "激光通信终端采购项目"
    rows = [
        (f"{comm}招标公告甲", "https://a.cn/1?utm_source=q", "项目招标", None, "search", day(21)),
        (f"{comm}招标公告甲", "https://a.cn/1", "项目招标", None, "search", day(22)),
        (f"{comm}招标公告乙", "https://b.cn/2", "项目招标", "laser_communication", "search", day(20)),
        (f"{comm}招标公告乙", "https://c.cn/3", "项目招标", "laser_communication", "search", day(19)),
        ("激光打印机采购", "https://d.cn/4", "激光通信采购", None, "search", day(22)),
        ("光电吊舱中标公告", "https://e.cn/5", "成交", None, "official:x", None),
        (" ", "https://e.cn/6", "成交", None, "search", None),
        (f"{comm}招标公告丙", "https://f.cn/7", "招标", None, "search", "2026-07-01T00:00:00+08:00"),
    ]
    chosen, extra, counts = select.select_candidates(candidates(spark, rows), F.to_timestamp(F.lit(NOW)), minimum=4, maximum=6)
    assert [r.url for r in chosen.orderBy("place").collect()] == ["https://a.cn/1", "https://b.cn/2", "https://f.cn/7", "https://e.cn/5"]
    assert [r.url for r in extra.collect()] == ["https://c.cn/3"]
    c = counts.first()
    assert (c.raw, c.valid, c.relevant, c.rejected, c.recent, c.fallback, c.unknown, c.duplicates) == (8, 7, 6, 1, 2, 1, 1, 1)


def test_financing_events_are_one_within_two_weeks(spark):
    rows = [
        ("天穹火箭完成A轮融资", "https://a.cn/1", "商业航天企业融资", None, "search", "2026-07-20T00:00:00+08:00"),
        ("商业航天企业天穹火箭获得A轮投资", "https://b.cn/2", "商业航天融资", None, "search", "2026-07-10T00:00:00+08:00"),
        ("星海卫星完成B轮融资", "https://c.cn/3", "商业航天企业融资", None, "search", "2026-07-19T00:00:00+08:00"),
    ]
    chosen, extra, _ = select.select_candidates(candidates(spark, rows), F.to_timestamp(F.lit(NOW)))
    assert [r.url for r in chosen.orderBy("place").collect()] == ["https://a.cn/1", "https://c.cn/3"]
    assert [r.url for r in extra.collect()] == ["https://b.cn/2"]


def test_fold_is_greedy_not_transitive(spark):
    near = lambda left, right: abs(left["x"] - right["x"]) <= 1
    df = spark.createDataFrame([(i, i, "k") for i in range(5)], "pos long, x int, k string")
    for parts in (1, 3):
        got = {r.pos: r.leader for r in fold(df.repartition(parts), "pos", F.array("k"), ["pos"], near).collect()}
        assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4}


def test_backfill_takes_older_then_undated_rows_up_to_the_minimum(spark):
    rows = [(i, b) for i, b in enumerate(["recent"] * 2 + ["fallback"] * 3 + ["unknown"] * 4 + [None])]
    df = spark.createDataFrame(rows, "x int, bucket string")
    shown = lambda **k: [r.x for r in select.backfill(df, [F.asc("x")], **k).orderBy("place").collect()]
    assert shown(minimum=4, maximum=9) == [0, 1, 2, 3]
    assert shown(minimum=8, maximum=9) == [0, 1, 2, 3, 4, 5, 6]
    assert shown(minimum=1, maximum=1) == [0]


def test_empty_input(spark):
    chosen, extra, counts = select.select_candidates(candidates(spark, []), F.to_timestamp(F.lit(NOW)))
    assert chosen.count() == 0 and extra.count() == 0 and counts.first().raw == 0

EVENTS = "pos long, category string, company string, rounds array<string>, code string, stage string, title_key string, published_us long"


def test_financings_of_one_title_are_blocks_of_their_companies(spark, monkeypatch):
    """300 companies share stage and title: no block is crowded, as none of them can be another's."""
    import functools

    from gleaner.operators import blocks

    monkeypatch.setattr(select, "fold", functools.partial(fold, most=20))
    monkeypatch.setattr(blocks, "fold_crowded", lambda *a, **k: pytest.fail("a crowded block"))
    df = spark.createDataFrame([(i, lx.FINANCING, f"c{i % 300}", ["a"], None, "s", "", None) for i in range(900)], EVENTS)
    assert {r.pos: r.leader for r in select.group_events(df, "pos", ["pos"]).collect()} == {i: i % 300 for i in range(900)}


@pytest.mark.parametrize("mixed", [False, True])
def test_event_groups_against_one_pass(spark, mixed):
    """Financings without company or round meet the others by code or title; random rows, all held against all."""
    rng = random.Random(5)
    rows = []
    for i in range(300):
        whole = not mixed or rng.random() < 0.8
        category = lx.FINANCING if rng.random() < 0.7 else "c"
        rows.append((i, category, rng.choice("ab") if whole else rng.choice([None, ""]), rng.choice([["a"], ["b"], ["a", "b"]] + [[]] * mixed), rng.choice([None, None, "", "n1", "n2"]), rng.choice("st"), rng.choice("xyz"), rng.choice([None, *range(0, 60 * 86_400_000_000, 86_400_000_000)])))
    names = [x.split(" ")[0] for x in EVENTS.split(", ")]
    leaders, want = [], {}
    for row in (dict(zip(names, r, strict=True)) for r in rows):
        lead = next((x for x in leaders if select.same_event(row, x)), None)
        if lead is None:
            leaders.append(lead := row)
        want[row["pos"]] = lead["pos"]
    assert {r.pos: r.leader for r in select.group_events(spark.createDataFrame(rows, EVENTS), "pos", ["pos"]).collect()} == want


def test_texts_stay_out_of_the_fold(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(select, "fold", lambda df, *a, **k: seen.extend(df.columns))
    df = spark.createDataFrame([(0, "c", None, [], None, "s", "t", None)], EVENTS).withColumn("summary", F.lit("a whole text"))
    select.group_events(df, "pos", ["pos"])
    assert "title_key" in seen and "summary" not in seen
