"""Search planning, pools, upgrades, size limits and safe URLs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleaner.functions import clock, urls
from gleaner.operators import plan, report, state

D = dt.datetime


def test_plan_keeps_priority_and_budget(spark):
    projects = spark.createDataFrame([(0, "p1", "n1", "o1", "c", "open", True), (1, "p2", "n2", "o2", "c", "Closed", True), (2, "p3", "n3", "o3", "d", "open", None)], "pos long, project_id string, name string, organization string, category string, status string, late boolean")
    fixed = spark.createDataFrame([(0, 0, "procurement_open", "q", "c")], "pos long, n int, kind string, text string, category string")
    rows = plan.planned([fixed, plan.project_queries(projects, F.col("late"))], 5).orderBy("place").collect()
    assert [(r.place, r.kind) for r in rows] == [(1, "procurement_open"), (2, "project_followup"), (3, "rolling_recheck"), (4, "overdue_result"), (5, "project_followup")]
    assert rows[1].text == "n1 o1 p1 采购 招标 中标 中国境内" and rows[0].text == "q 中国境内"


@pytest.mark.parametrize(
    ("name", "arguments", "want"),
    [("search_web", '{"query":"q","category":"c","intent":"i"}', None), ("other", "{}", "unsupported_tool"), (None, "{}", "unsupported_tool"), ("search_web", '{"query":1,"category":"c","intent":"i"}', "invalid_arguments"), ("search_web", '{"query":"q","category":"x","intent":"i"}', "invalid_arguments"), ("search_web", "{", "invalid_arguments"), ("search_web", None, "invalid_arguments")],
)
def test_tool_calls(spark, name, arguments, want):
    r = spark.createDataFrame([(name, arguments)], "n string, a string").select(plan.tool_call(F.col("n"), F.col("a"), ["c"], ["i"]).alias("t")).first().t
    assert r.failure == want and (r["query"] == "q") == (want is None)


def test_checked_queries(spark):
    rows = [("  a \n b ", "c", "seed", None), ("", "c", "i", "length"), ("x" * 301, "c", "i", "length"), ("q", None, "i", "category"), ("激光打印机 x", "c", "i", "out_of_scope_topic"), ("q", "c", "z", "intent")]
    df = spark.createDataFrame(rows, "q string, c string, i string, want string")
    got = df.select(plan.checked_query(F.col("q"), F.col("c"), F.col("i"), ["c"], ["i"], ["激光打印机"], "2026年").alias("r"), "want").collect()
    assert [r.r.failure for r in got] == [r.want for r in got] and got[0].r.text == "a b 2026年 中国境内"


def test_windows(spark):
    now = F.lit(D(2026, 5, 31, 8))
    r = spark.range(1).select(clock.rolling_start(now).alias("a"), clock.daily_window(now)[0].alias("b"), *[plan.in_window(F.lit(t).cast("timestamp"), now, "daily").alias(f"c{i}") for i, t in enumerate([None, D(2026, 5, 1, 8), D(2026, 5, 1, 7), D(2026, 6, 1, 8), D(2026, 6, 1, 9)])]).first()
    assert (r.a, r.b, r.c0, r.c1, r.c2, r.c3, r.c4) == (D(2026, 2, 28, 8), D(2026, 5, 30, 8), True, True, False, True, False)


def test_pool_and_new_urls(spark):
    schema = "title string, source_url string, summary string, discovered_at timestamp, category_hint string, source_published_at timestamp, reason string"
    rows = [("a", "u", "s", D(2026, 5, 1), None, D(2026, 5, 20), "r"), ("b", "v", "s", D(2026, 5, 30), None, D(2026, 1, 1), "r"), ("c", "w", "s", D(2026, 5, 30), None, None, "r"), ("d", "x", "s", D(2026, 5, 30), None, None, "z")]
    got = state.pending_pool(spark.createDataFrame(rows, schema), ["r"], F.lit(D(2026, 5, 31)), 90).collect()
    assert sorted(r.url for r in got) == ["u", "w"]
    urls_ = spark.createDataFrame([("a",), ("a",), ("b",)], "url string")
    assert [r.url for r in plan.new_urls(urls_, urls_.where("url = 'b'")).collect()] == ["a"]


def test_upgrades(spark):
    events = spark.createDataFrame([("tender", "o", D(2026, 1, 1), "http://a/1", "t", None, None, None, None, None), ("tender", "o", D(2026, 1, 1), "http://a/1", "t", "h", "v", D(2026, 1, 2), D(2026, 1, 3), D(2026, 1, 4))], "event_type string, organization string, published_at timestamp, source_url string, title string, content_hash string, content_version_id string, discovered_at timestamp, first_seen_at timestamp, updated_at timestamp")
    old, new = state.upgraded_events(events).collect()
    assert len(old.content_hash) == len(old.content_version_id) == 64 and old.first_seen_at == old.updated_at == D(2026, 1, 1)
    assert (new.content_hash, new.content_version_id, new.updated_at) == ("h", "v", D(2026, 1, 4))
    fin = spark.createDataFrame([(D(2026, 1, 1), "c", "A", "u", "h", None, {"u": "kept", "w": "x"}, ["z"], None, None, None)], "announced_at timestamp, company string, round_name string, source_url string, content_hash string, content_version_id string, source_content_hashes map<string,string>, source_content_version_ids array<string>, discovered_at timestamp, first_seen_at timestamp, updated_at timestamp")
    f = state.upgraded_financings(fin).first()
    assert f.source_content_hashes == {"u": "kept", "w": "x"} and len(f.source_content_version_ids) == 2 and f.updated_at == D(2026, 1, 1)
    p = state.upgraded_projects(spark.createDataFrame([(None, None, D(2026, 1, 5), None)], "first_seen_at timestamp, first_published_at timestamp, latest_event_at timestamp, updated_at timestamp")).first()
    assert p.first_seen_at == p.updated_at == D(2026, 1, 5)


def test_reports_shrink_until_they_fit(spark):
    lines = spark.createDataFrame([(0, i, f"line {i}", "s" * 100) for i in range(5)], "section int, pos int, line string, summary string")
    assert report.shortest_attempt(lines, ["A", "B"], 10_000).first().asDict() | {"markdown": ""} == {"markdown": "", "items": 3, "chars": 80}
    small = report.shortest_attempt(lines, ["A", "B"], 80).first()
    assert small["items"] == 1 and small.markdown == "## A\n- line 0\n  " + "s" * 39 + "…\n\n## B\n（无）"
    with pytest.raises(Exception, match="does not fit"):
        report.shortest_attempt(lines, ["A", "B"], 10).collect()
    entries = spark.createDataFrame([("a", D(2026, 1, 1), True, 50), ("b", D(2026, 1, 2), True, 50), ("c", D(2026, 1, 3), True, 50), ("o", D(2025, 1, 1), False, 50)], "project_id string, latest_at timestamp, completed boolean, size int")
    assert sorted(r.project_id for r in report.within_limit(entries, 10, 120).collect()) == ["c", "o"]
    assert report.within_limit(entries, 10, 210).count() == 4


def test_coverage(spark):
    a = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    r = spark.range(1).select(report.coverage(F.lit(True), a("x", "x"), a("b.cn", "a.cn"), F.lit(True)).alias("a"), report.coverage(F.lit(False), a(), a(), F.lit(False)).alias("b")).first()
    assert tuple(r) == ("降级（搜索（x；官方来源访问失败：a.cn、b.cn）、AI）", "正常")


def test_fetchable(spark):
    rows = [("http://a.cn/", ["8.8.8.8"], True), ("http://a.cn/", ["8.8.8.8", "10.0.0.1"], False), ("http://a.cn/", [], False), ("http://a.cn/", None, False), ("ftp://a.cn/", ["8.8.8.8"], False), ("http://127.0.0.1/", None, False), ("http://8.8.8.8:80/", None, True), ("http://[::1]/", ["8.8.8.8"], False), ("http://a.cn:99999/", ["8.8.8.8"], False), (None, None, False)]
    df = spark.createDataFrame(rows, "u string, r array<string>, want boolean")
    assert df.select(F.coalesce(urls.fetchable(F.col("u"), F.col("r")), F.lit(False)).alias("got"), "want").where("got <> want").count() == 0
