"""Extraction, sources, state commits, streaming, follow-ups, rendering."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleaner.functions import extract
from gleaner.operators import followup, report, state as ops, verify
from gleaner.sources import html, search, state
from gleaner.streaming import incremental

NOTICE = "激光通信终端采购项目中标公告\n采购人：某某研究院\n中标供应商：星光科技有限公司 中标金额：120万元\n中标金额：120万元\n发布时间 2026/07/01，2026-07-02\n投标截止时间：2026-07-20 09:30\n开标时间：2026年7月21日"
MONEY = "天穹火箭完成 Pre-A+ 轮融资，金额近3亿元人民币。商业航天企业。"


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("x")).first().x


def test_notice_fields(spark):
    a = one(spark, NOTICE, extract.analysis)
    assert (a.category, a.event_type, a.organization.value, a.supplier.value, a.award_amount.value) == ("laser_communication", "award", "某某研究院", "星光科技有限公司", "120万元")
    assert a.published.value == dt.date(2026, 7, 2) and a.published.quote == "2026-07-02"
    assert {k: (v.value, v.precision) for k, v in a.deadlines.items()} == {"bid_submission": (dt.datetime(2026, 7, 20, 9, 30), "minute"), "opening": (dt.datetime(2026, 7, 21), "date")}
    assert a.title_line == "激光通信终端采购项目中标公告" and not a.excluded


def test_financing_fields(spark):
    a = one(spark, MONEY, extract.analysis)
    assert (a.category, a.event_type, a.financing_round.value, a.financing_amount.value, a.financing_amount.disclosed) == ("commercial_space_financing", "financing", "Pre-A+轮", "近3亿元人民币", True)
    assert one(spark, "融资金额未披露", extract.financing_amount).disclosed is False
    assert one(spark, "2026-02-31 2026年3月1日", extract.date).value == dt.date(2026, 3, 1)
    assert one(spark, "中标供应商：***", extract.supplier) is None and one(spark, None, extract.organization) is None
    assert one(spark, "2026-03-05 00:00:00", lambda c: extract.date_forms(F.to_timestamp(c)))[3] == "2026年3月5日"


def test_decision_cascade(spark):
    base = {"in_china": True, "in_scope": True, "title": "t", "organization": "o", "published_at": "p", "category": "laser_weapon", "event_type": "tender", "url_matches": True, "grounded": True, "http_status": 200, "grade": "A", "class_failure": None, "deadline_failure": None, "tender_evidence": True, "tender_claims": True, "financing_failure": None, "corroborated": False, "corroboration_reason": None}
    fin = {"category": "commercial_space_financing", "event_type": "financing"}
    cases = [
        ({}, "verified_tender"), ({"in_scope": False, "title": None}, "out_of_scope"), ({"title": " ", "category": None}, "missing_required_fields:title,category"), ({"http_status": 404}, "source_unavailable"),
        ({"grade": "B"}, "tender_requires_grade_a"), ({"tender_claims": False}, "evidence_not_grounded"), ({"event_type": "financing"}, "category_event_type_mismatch"), (fin, "verified_financing_official_source"),
        (fin | {"grade": "B"}, "financing_requires_official_or_two_independent_b_sources"), (fin | {"grade": "B", "corroborated": True}, "verified_financing_two_independent_sources"),
        (fin | {"grade": "C"}, "financing_requires_official_or_two_independent_b_sources"), (fin | {"financing_failure": "amount"}, "amount"), ({"deadline_failure": "deadline_evidence_missing"}, "deadline_evidence_missing"),
    ]
    kinds = ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'int' if isinstance(v, int) else 'string'}" for k, v in base.items())
    df = spark.createDataFrame([tuple({**base, **c}.values()) for c, _ in cases], kinds)
    _, reason = verify.decision({k: F.col(k) for k in base})
    assert [r[0] for r in df.select(reason).collect()] == [want for _, want in cases]


def test_search_payloads(spark):
    item = '{"name":"n","url":"https://a.cn","summary":"","snippet":"s","datePublished":"2026-07-01T10:00:00+08:00"}'
    rows = [(1, '{"data":{"webPages":{"value":[%s,{"name":"x"}]}}}' % item, None), (2, '{"webPages":{"value":[%s]}}' % item, "eo"), (3, '{"code":429,"msg":"no"}', None), (4, "junk", None)]
    got = search.candidates(spark.createDataFrame(rows, "request long, payload string, category_hint string")).orderBy("input_pos").collect()
    assert [(r.input_pos, r.summary, r.category_hint, str(r.published_at)) for r in got] == [(1000, "s", None, "2026-07-01 02:00:00"), (2000, "s", "eo", "2026-07-01 02:00:00")]
    assert one(spark, "2026-07-01T10:00:00", search.published_at) is None


def test_html(spark):
    page = '<html><head><title> A  b</title><script type="application/ld+json">{"x":[{"datePublished":"2026-07-01"}]}</script></head><body><nav>no</nav><a href="/x?y">Link  text</a><a href="mailto:q">m</a><p>发布时间：2026-06-30</p></body></html>'
    df = spark.createDataFrame([(1, page, "https://h.cn/l/"), (2, None, None), (3, "<meta property='article:published_time' content='2026-05-01T00:00:00Z'><p>x", "u")], "id long, html string, base string")
    rows = {r.id: r for r in html.page_rows(df, "id", "html").collect()}
    assert (rows[1].title, rows[1].published, rows[1].evidence, rows[2].published, rows[3].evidence) == ("A b", "2026-07-01", "json-ld", None, "meta:article:published_time")
    assert [(r.url, r.title) for r in html.page_links(df, "id", "base", "html").collect()] == [("https://h.cn/x?y", "Link text")]


def test_state_versions_and_stream(spark, tmp_path):
    schema = "event_id string, fingerprint string, published_at timestamp, verification string"
    root = f"file://{tmp_path}/state"
    assert state.load(spark, root, "events", schema).count() == 0
    day = dt.datetime(2026, 7, 1)
    source = f"{tmp_path}/in"
    spark.createDataFrame([("a", "f1", day, "verified"), ("b", "f1", day, "verified"), ("c", "f2", day, "verified")], schema).write.parquet(source)
    for run in (1, 2):  # the same input twice leaves the same state
        incremental.keep_events(spark.readStream.schema(schema).parquet(source), root, f"{tmp_path}/c{run}", schema).awaitTermination()
        assert sorted(r.event_id for r in state.load(spark, root, "events", schema).collect()) == ["a", "c"]
    bad = spark.createDataFrame([("d", "f3", day, "pending")], schema)
    with pytest.raises(Exception, match="must be verified"):
        state.append_events(state.load(spark, root, "events", schema), bad).collect()
    lines = f"file://{tmp_path}/lines"
    state.write_lines(state.load(spark, root, "events", schema), lines, "event_id")
    assert [r.event_id for r in state.read_lines(spark, lines, schema).collect()] == ["a", "c"]
    with pytest.raises(ValueError, match="schema version"):
        state.commit(spark, root, {}, 3)


def test_pending_and_rollup_status(spark):
    e = spark.createDataFrame([("p", 1, "a", "tender"), ("p", 2, "b", "change"), ("q", 1, "c", "award"), ("r", 1, "d", "extension")], "k string, t int, e string, s string")
    got = {r.k: (r.status, r.latest_stage, r.recheck) for r in ops.rollup(e, "k", "t", "e", "s").collect()}
    assert got == {"p": ("open", "change", True), "q": ("awarded", "award", False), "r": ("open", "extension", True)}


def test_followups_and_delivery(spark):
    targets = spark.createDataFrame([("g", "t1", ["a", "b"], 1), ("g", "t2", ["c"], 2), ("h", "t3", ["d", "e"], 3)], "group_key string, target string, queries array<string>, r int")
    tried = spark.createDataFrame([("a",)], "query string")
    got = followup.plan(targets, tried, 3, [F.asc("r")]).orderBy("place").collect()
    assert [r.query for r in got] == ["b", "d", "c"] or [r.query for r in got] == ["b", "c", "d"]
    runs = spark.createDataFrame([("live", "success", dt.datetime(2026, 7, 1, 3))], "title string, status string, started_at timestamp")
    assert [followup.may_deliver(runs, F.lit(d).cast("date"), ["live"]).first().deliver for d in ("2026-07-01", "2026-07-02")] == [False, True]
    assert spark.range(1).select(followup.ask(F.lit("甲"), F.lit("乙"), F.array(F.lit("amount")))).first()[0] == ["甲 金额", "甲 乙"]


def test_rendered_sections(spark):
    lines = spark.createDataFrame([(0, i, f"l*{i}") for i in range(12)] + [(1, 0, "x")], "section int, pos int, line string")
    got = {r.section: r.markdown for r in report.rendered(lines, ["A", "B"], most=2).collect()}
    assert got == {0: "## A\n- l\\*0\n- l\\*1\n- … 10", 1: "## B\n- x"}
