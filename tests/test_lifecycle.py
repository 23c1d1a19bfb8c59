"""Domestic subjects, summaries, enrichment, lead groups, state rows and report lines on small made-up rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleaner.functions import extract, ids, text
from gleaner.operators import aliases, enrich, followup, report, resolve, state

D = dt.datetime
EV = "array<struct<field:string,quote:string,source_url:string>>"


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("title", "lead", "approved", "want"),
    [
        ("北京天穹科技有限公司采购激光通信终端", "", False, True), ("美国国防部采购激光武器", "北京天穹科技有限公司采购", False, False), ("采购公告", "上海市浦东公安局招标公告", False, True),
        ("公告", "美军招标", True, False), ("公告", "国内项目说明", False, True), ("公告", "说明", False, False), ("公告", "说明", True, True), ("公告", "日本的说明", True, False), (None, None, False, False),
    ],
)
def test_domestic_subject(spark, title, lead, approved, want):
    got = spark.createDataFrame([(title, lead, approved)], "t string, l string, a boolean").select(extract.domestic_subject(F.coalesce("t", F.lit("")), F.coalesce("l", F.lit("")), F.col("a")).alias("x")).first().x
    assert got is want


def test_subject_quote_prefers_companies_then_short_names(spark):
    said = F.lit("上海交通大学与北京航天研究院、西安光机科技有限公司、成都光电有限公司签约")
    assert one(spark, extract.subject_quote(said)) == "成都光电有限公司"
    assert one(spark, extract.subject_quote(F.lit("某大学"))) is None
    assert one(spark, extract.first_domestic_line(F.lit("美国公司\n \n中国某企业招标\n国内项目"))) == "中国某企业招标"


def test_exclusions_and_parts(spark):
    assert [one(spark, extract.excluded(F.lit(t))) for t in ("获银行 提供贷款", "上市公司拟再融资", "完成A轮融资", "可转债")] == [True, True, False, True]
    assert [one(spark, extract.parent_purpose(F.lit(t), "laser_weapon")) for t in ("用于 激光武器 的转台", "激光武器配套跟瞄", "转台")] == [True, True, False]
    assert [one(spark, extract.approved_source(F.lit(h))) for h in ("www.ccgp.gov.cn", "gov.cn.example.com", "a.mil.cn")] == [True, False, True]
    assert one(spark, extract.page_date(F.lit("2026-07-02 发布"), F.lit("2020-01-01")))["value"] == dt.date(2026, 7, 2)


def test_summaries(spark):
    n = F.lit(None).cast("string")
    fin = extract.composed_summary(F.lit("commercial_space_financing"), F.lit("t"), F.lit("天穹"), F.lit("financing"), F.lit("1亿元"), F.lit("A轮"), F.array(*map(F.lit, "甲乙丙丁")), F.lit("火箭"), n, n)
    buy = extract.composed_summary(F.lit("eo_turret"), F.lit("某项目"), n, F.lit("award"), F.lit("9万元"), n, F.lit(None).cast("array<string>"), n, F.lit("光机"), F.lit("8万元"))
    assert one(spark, fin) == "天穹完成A轮，披露金额1亿元，投资方包括甲、乙、丙，资金及业务聚焦火箭"
    assert one(spark, buy) == "某项目公布中标结果，中标供应商为光机，中标金额8万元"
    assert one(spark, extract.brief_summary(F.lit(" 本报讯 某公司， "), F.lit("本报讯  某公司今日宣布"), F.lit("c"))) == "c"
    assert one(spark, extract.brief_summary(F.lit("自己的话。"), F.lit("本报讯"), F.lit("c"))) == "自己的话"
    assert one(spark, extract.brief_summary(n, n, F.lit("c"))) == "c"


def test_enrichment(spark):
    schema = f"source_url string, in_china boolean, in_scope boolean, category string, event_type string, organization string, published_at timestamp, amount string, amount_disclosed boolean, evidence {EV}"
    e = lambda *fs: [(f, f"q{f}", "u") for f in fs]
    model = spark.createDataFrame([("a", True, True, "c", "tender", None, D(2026, 1, 1), None, None, e("title")), ("b", True, True, "c", "tender", None, None, None, None, e()), ("d", True, True, "c", "award", "o", D(2026, 1, 1), "1元", True, e("amount"))], schema)
    rules = spark.createDataFrame([("a", True, True, "c", "tender", "甲", D(2026, 1, 2), "5元", True, e("organization", "amount", "category", "other")), ("b", True, True, "x", "tender", "乙", None, None, None, e("organization")), ("r", True, True, "c", "tender", "丙", None, None, None, e("title")), ("d", False, True, "c", "award", "p", D(2026, 1, 1), "2元", True, e("published_at"))], schema).withColumn("page_date", F.when(F.col("source_url") == "a", F.lit(D(2026, 1, 3))))
    got = {r.source_url: r for r in enrich.enriched(model, rules).collect()}
    a = got["a"]
    assert (a.organization, a.published_at, a.amount, a.amount_disclosed, a.degraded) == ("甲", D(2026, 1, 3), "5元", True, True)
    assert [x.field for x in a.evidence] == ["title", "organization", "amount", "category"]
    assert (got["b"].organization, got["b"].degraded, got["r"].organization, got["r"].degraded) == (None, False, "丙", True)
    assert (got["d"].organization, got["d"].amount, [x.field for x in got["d"].evidence]) == ("o", "1元", ["amount", "published_at"])
    out = enrich.without_excluded(spark.createDataFrame([("commercial_space_financing", "financing", "A轮", True, ["x"], "银行授信"), ("c", "tender", None, True, [], "银行授信")], "category string, event_type string, financing_round string, in_scope boolean, investors array<string>, page string"), "page").collect()
    assert [(r.category, r.event_type, r.financing_round, r.in_scope, r.investors) for r in out] == [(None, None, None, False, []), ("c", "tender", None, True, [])]


def test_aliases_and_lead_groups(spark):
    assert followup.plain_aliases("商业航天企业 北京天穹科技股份有限公司") == ["北京天穹科技", "北京天穹科技股份有限公司", "天穹", "天穹科技"]
    assert followup.plain_aliases("天穹 激光通信") == ["天穹"] and followup.plain_aliases(None) == []
    schema = "pos long, category string, event_type string, aliases array<string>, day long, rounds array<string>, amount string, investors array<string>, title_key string"
    f = "commercial_space_financing"
    rows = [(0, f, "financing", ["t", "tq"], 100, ["a"], "1", ["x"], "k"), (1, f, "financing", ["tq"], 125, ["a"], None, [], "z"), (2, f, "financing", ["tq"], 125, ["a"], "2", [], "z"), (3, f, "financing", ["tq"], 105, [], None, [], "k"), (4, f, "financing", ["other"], 100, ["a"], None, [], "k"), (5, f, "financing", ["tq"], None, ["a"], None, [], "k")]
    leads = spark.createDataFrame(rows, schema)
    groups = followup.group_targets(leads, "pos", ["pos"])
    assert {r.pos: r.leader for r in groups.collect()} == {0: 0, 1: 0, 2: 2, 3: 0, 4: 4, 5: 5}
    keys = {r.leader: r.target_key for r in followup.group_keys(leads, groups, "pos").collect()}
    assert keys[0] == f"t|{f}|financing|a|1970-04-11" and keys[5].endswith("date:unknown")


def test_clues_and_queries(spark):
    none = F.lit(None).cast("array<string>")
    leads = spark.createDataFrame([(7, "北京天穹有限公司", ["红杉资本"], "高瓴领投", "标题")], "lead_id long, organization string, investors array<string>, evidence string, candidate string")
    registry = spark.createDataFrame([("company", 0, "tq.cn", "天穹"), ("company", 0, "tq.cn", "北京天穹"), ("investor", 0, "hs.cn", "红杉"), ("investor", 1, "gl.cn", "高瓴")], "kind string, place int, domain string, alias string")
    (c,) = aliases.official_clues(leads, registry).collect()
    assert (c.domains, c.aliases, c.layers) == (["tq.cn", "hs.cn", "gl.cn"], ["北京天穹", "红杉", "高瓴"], ["structured", "evidence"])
    q = followup.queries_for(F.lit("commercial_space_financing"), F.lit("天穹"), F.lit("t"), F.lit("A轮"), none, F.array(F.lit("amount")), F.array(F.lit("tq.cn")), F.array(F.lit("a.cn")), ["a.cn", "b.cn"])
    got = one(spark, q)
    assert len(got) == 5 and got[0] == "天穹 A轮 融资 融资金额 金额未披露 具体金额 官网 投资机构 官方披露 site:tq.cn 最近90天 中国境内" and "site:b.cn" in got[1]
    assert one(spark, followup.queries_for(F.lit("eo_turret"), F.lit('甲"乙'), F.lit("项目"), F.lit(None), none, F.array().cast("array<string>"), F.array().cast("array<string>"), F.array().cast("array<string>"), []))[1] == "甲 乙 项目 项目编号 最近90天 中国境内"
    assert one(spark, followup.first_registered(F.lit("x.b.cn"), ["a.cn", "b.cn", "x.b.cn"])) == "b.cn"


def test_state_rows(spark):
    assert one(spark, ids.amount_text(F.lit(150000000.0))) == "150000000" and one(spark, ids.amount_text(F.lit(0.1))) == "0.1"
    ev = [("bid_submission_deadline", "q1", "u"), ("bid_submission_deadline", "q2", "u"), ("title", "t", "u")]
    df = spark.createDataFrame([({"bid_submission": D(2026, 1, 1), "odd": D(2026, 1, 1)}, {"bid_submission": "date"}, ev)], f"d map<string,timestamp>, p map<string,string>, e {EV}")
    s = df.select(state.deadline_state(F.col("d"), F.col("p"), F.col("e")).alias("s")).first().s
    assert list(s.deadlines) == ["bid_submission"] and s.evidence["bid_submission"].quote == "q2" and s.precision == {"bid_submission": "date"}
    notices = spark.createDataFrame([("tender", D(2026, 1, 1), "http://a.cn/1?utm_x=1", "某项目招标公告", "AB", D(2026, 1, 2), "甲公司", "eo_turret", ["X-1", "x1"], None)], "event_type string, published_at timestamp, source_url string, title string, content_hash string, discovered_at timestamp, organization string, category string, project_codes array<string>, amount string")
    events = state.event_rows(notices)
    again = state.event_rows(notices.withColumn("source_url", F.lit("http://a.cn/1")).withColumn("content_hash", F.lit("ab")))
    assert events.first().event_id == again.first().event_id
    p = state.new_projects(events).first()
    assert (p.status, p.needs_recheck, p.year, p.current_stage, len(p.event_ids)) == ("open", True, 2026, "tender", 1)
    same = one(spark, ids.project_id(F.lit("甲公司"), F.array(F.lit("x1")), F.lit("某项目中标公告")))
    assert p.project_id == same
    reports = spark.createDataFrame([("天穹", D(2026, 1, 1), "1亿元", None, ["乙", "甲"], "A轮", None, "http://a.cn/1", "AA", D(2026, 1, 2), [("http://b.cn/2", D(2026, 1, 5), "BB"), ("http://a.cn/1", D(2026, 1, 4), "AA")])], "organization string, published_at timestamp, amount string, amount_disclosed boolean, investors array<string>, financing_round string, financing_subtype string, source_url string, content_hash string, discovered_at timestamp, records array<struct<source_url:string,published_at:timestamp,content_hash:string>>")
    f = state.financing_rows(reports).withColumn("latest", state.latest_known(F.col("published_at"), F.col("source_published_at"))).first()
    assert (f.amount_cny, f.amount_disclosed, f.source_urls, f.latest, len(f.content_version_ids)) == (1e8, True, ["http://a.cn/1", "http://b.cn/2"], D(2026, 1, 5), 2)
    assert f.source_published_at["http://a.cn/1"] == D(2026, 1, 4)
    assert one(spark, state.overlaid(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(3), F.lit("c"), F.lit(4)))) == {"a": 1, "b": 3, "c": 4}
    us = lambda *x: int(D(*x, tzinfo=dt.UTC).timestamp()) * 1_000_000
    assert resolve.months_after(us(2024, 8, 31), 18) == us(2026, 2, 28) and resolve.months_after(us(2024, 1, 1, 5), 18) == us(2025, 7, 1, 5)


def test_procurement_groups(spark):
    now = F.lit(D(2026, 7, 10, 12))
    rows = [("tender", None, D(2026, 7, 20), "date", True, "opportunities"), ("tender", None, D(2026, 7, 20), "date", False, "confirmation"), ("tender", None, D(2026, 7, 10, 9), "date", True, "opportunities"), ("tender", None, D(2026, 7, 10, 9), "minute", True, "results"),
            ("award", "open", None, None, False, "results"), ("change", "awarded", None, None, False, "results"), (None, "open", None, None, False, "confirmation"), (None, None, None, None, False, "results"), ("procurement_intention", None, None, None, False, "results")]
    df = spark.createDataFrame(rows, "e string, s string, d timestamp, p string, q boolean, want string")
    assert df.select(report.procurement_group(*map(F.col, "esdpq"), now).alias("got"), "want").where("not got <=> want").count() == 0


def test_report_text(spark):
    assert one(spark, text.escape_markdown(F.lit("# a*b\n- c_d <x> & 1. y\n2. z|~"))) == "\\# a\\*b \\- c\\_d &lt;x&gt; &amp; 1. y 2\\. z\\|\\~"
    assert one(spark, report.link(F.lit("甲[乙]"), F.lit("http://a.cn/x (1)"))) == "[甲\\[乙\\]](http://a.cn/x%20%281%29)"
    assert one(spark, report.clean_title(F.lit("某项目_公告 - 某某招标网首页"))) == "某项目 公告"
    assert [one(spark, report.remaining(F.lit(D(2026, 7, d)), F.lit(D(2026, 7, 10, 23)))) for d in (9, 10, 12)] == ["今日截止", "今日截止", "2天"]
    ev = spark.createDataFrame([([("Company Announcement", "x", "u"), ("amount", "金额未披露", "v")],)], f"e {EV}")
    r = ev.select(report.source_label(F.col("e"), F.lit("u")).alias("a"), report.source_label(F.col("e"), F.lit("v")).alias("b"), report.told_amount(F.lit(None).cast("double"), F.lit(False), F.col("e")).alias("c"), report.told_amount(F.lit(2.5e8), F.lit(True), F.col("e")).alias("d")).first()
    assert tuple(r) == ("企业公告", "来源", "未披露", "2.50亿元")
    assert one(spark, report.reason_text(F.lit("missing_required_fields:title,x"), {}, {"title": "标题"})) == "核验字段缺失（标题、x）"
    assert one(spark, report.reason_text(F.lit("a"), {"a": "甲"}, {})) == "甲"
    counts = spark.createDataFrame([("b", 2), ("a", 1)], "category string, n long")
    assert report.trend_sentence(counts).first().summary == "统计期内共有3条已核验事件：a 1条、b 2条。"
    assert report.trend_sentence(counts.limit(0)).first().summary == "统计期内无已核验事件。"
    items = spark.createDataFrame([("eo_turret", "verified"), ("eo_turret", "candidate")], "category string, label string")
    assert [tuple(r)[1:] for r in report.trust_counts(items, "category", "label").orderBy("place").collect()][2] == ("eo_turret", 1, 0, 1)


def test_project_lines_and_rolling(spark):
    projects = spark.createDataFrame([("p", "项目", "甲", "c", "open", None, None), ("q", "无", "乙", "c", "awarded", D(2026, 1, 9), "award")], "project_id string, name string, organization string, category string, status string, latest_event_at timestamp, current_stage string")
    events = spark.createDataFrame([("p", "2", "award", D(2026, 1, 5), "http://a/2"), ("p", "1", "tender", D(2026, 1, 1), "http://a/1")], "project_id string, event_id string, event_type string, published_at timestamp, source_url string")
    got = {r.project_id: r for r in report.project_lines(projects, events, {"award": "中标"}).collect()}
    assert got["p"].chain == "[tender](http://a/1)（2026-01-01） → [中标](http://a/2)（2026-01-05）"
    assert got["p"].line == "- 2026-01-05｜c｜项目｜采购单位：甲｜状态：open｜[查看原始公告](http://a/2)" and "日期未记录" in got["q"].line
    kept = {r.project_id: r.completed for r in report.rolling(projects, events, F.lit(D(2026, 1, 2)), F.lit(D(2026, 1, 31))).collect()}
    assert kept == {"p": True, "q": True}


def test_texts_of_leads_stay_out_of_the_fold(spark, monkeypatch):
    seen = []
    for module in (report, followup):
        monkeypatch.setattr(module, "fold", lambda df, *a, **k: seen.append(df.columns))
    shared = spark.createDataFrame([(0, 1, ["a"], None, 10, "a whole text")], "pos long, newest long, rounds array<string>, amount string, day long, summary string")
    report.group_signals(shared.withColumn("subject", F.lit("s")), "pos", ["newest"])
    followup.group_targets(shared.withColumns({c: F.lit("k") for c in ("category", "event_type", "title_key")} | {c: F.array(F.lit("k")) for c in ("aliases", "investors")}), "pos", ["newest"])
    assert seen == [["pos", "newest", "subject", "rounds", "amount", "day"], ["pos", "newest", "category", "event_type", "aliases", "day", "rounds", "amount", "investors", "title_key"]]


def test_signal_groups_and_merge(spark):
    schema = "pos long, subject string, rounds array<string>, amount string, day long"
    rows = [(0, "天穹火箭", ["a"], "1亿", 10), (1, "天穹", ["a", "b"], None, 50), (2, "天穹", ["a"], "2亿", 12), (3, "天穹", [], None, 10), (4, "天穹火箭", ["a"], None, 90), (5, "天穹", ["a"], None, None)]
    groups = {r.pos: r.leader for r in report.group_signals(spark.createDataFrame(rows, schema), "pos", ["pos"]).collect()}
    assert groups == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 0}
    leads = spark.createDataFrame([(0, "长标题", "天穹", D(2026, 1, 1), "", "A轮", "s", "candidate", ["b"]), (0, "t", "天穹火箭", D(2026, 1, 3), "1亿", "A", None, "candidate", ["a", "b"]), (1, "x", "y", None, None, "", None, "candidate", ["z"])], "leader long, title string, organization string, published_at timestamp, amount string, round_name string, summary string, label string, source_urls array<string>")
    got = {r.leader: r for r in report.merged_signals(leads).collect()}
    m = got[0]
    assert (m.title, m.organization, m.round_name, m.published_at, m.amount, m.summary, m.source_urls, m.label) == ("t", "天穹火箭", "A轮", D(2026, 1, 3), "1亿", "s", ["a", "b"], "high_confidence")
    assert got[1].label == "candidate"
