"""Claims against quotes, on small notices."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleaner.operators import claims

EV = "array<struct<field:string,quote:string,source_url:string>>"
SCHEMA = f"pos int, evidence {EV}, title string, organization string, published_at timestamp, financing_round string, financing_subtype string, amount string, amount_disclosed boolean, investors array<string>, business_area string"
GOOD = {
    "organization": "天穹火箭科技有限公司宣布", "published_at": "发布于2026年7月2日", "amount": "融资１.5亿元", "financing_round": "完成 A 轮融资", "investors": "红杉、高瓴 领投",
    "event_type": "完成融资", "business_area": "聚焦液体火箭",
}


def row(pos, drop=(), quotes=None, **own):
    ev = [(f, q, "u") for f, q in (GOOD | (quotes or {})).items() if f not in drop]
    base = {"title": "t", "organization": "天穹火箭科技有限公司", "published_at": dt.datetime(2026, 7, 2), "financing_round": "A", "financing_subtype": None, "amount": "15000万元", "amount_disclosed": True, "investors": ["红杉", "高瓴"], "business_area": "液体火箭"} | own
    return (pos, ev, *base.values())


CASES = [
    (row(0), None, [], None),
    (row(1, drop=["amount"]), "financing_missing_required_evidence", ["amount"], "financing_source_amount_evidence_invalid"),
    (row(2, quotes={"published_at": "7月2日"}), "evidence_not_grounded", ["published_at"], "financing_source_publication_date_evidence_invalid"),
    (row(3, quotes={"financing_round": "完成PreA轮"}), "evidence_not_grounded", ["financing_round"], "financing_source_round_evidence_invalid"),
    (row(4, quotes={"investors": "红杉领投"}), "evidence_not_grounded", ["investors"], "financing_source_investor_evidence_invalid"),
    (row(5, amount=None, amount_disclosed=False, quotes={"amount": "金额未披露"}), None, [], None),
    (row(6, amount=None, amount_disclosed=None), "financing_missing_required_evidence", ["amount"], None),
    (row(7, quotes={"organization": "天穹火箭完成"}), "evidence_not_grounded", ["organization"], None),
    (row(8, financing_round=None, financing_subtype="strategic", quotes={"financing_subtype": "完成战略融资"}), None, [], None),
    (row(9, financing_round=None, financing_subtype=None), "financing_missing_required_evidence", ["financing_subtype"], "financing_source_event_evidence_missing"),
    (row(10, quotes={"event_type": "发布产品"}), "evidence_not_grounded", [], "financing_source_action_evidence_invalid"),
    (row(11, business_area="卫星"), "evidence_not_grounded", [], "financing_source_business_area_evidence_invalid"),
    (row(12, organization=None), "evidence_not_grounded", ["organization"], "financing_source_organization_evidence_invalid"),
    ((13, None, *[None] * 9), "financing_missing_required_evidence", ["organization", "published_at", "amount", "financing_subtype"], "financing_source_event_evidence_missing"),
]


def test_financing_checks(spark):
    df = claims.prepared(spark.createDataFrame([c[0] for c in CASES], SCHEMA))
    got = {r.pos: (r.a, r.b, r.c) for r in df.select("pos", claims.financing_failure().alias("a"), claims.financing_gaps().alias("b"), claims.source_failure().alias("c")).collect()}
    assert got == {c[0][0]: c[1:] for c in CASES}
    assert claims.prepared(spark.createDataFrame([], SCHEMA)).select(claims.financing_gaps().alias("g")).count() == 0


@pytest.mark.parametrize(("text", "key"), [("1,500.50万元", "15005000"), ("2亿", "200000000"), ("100元", "100"), ("数千万元", "数千万元"), ("０.30亿", "30000000"), ("", None), (None, None)])
def test_amount_key(spark, text, key):
    df = claims.prepared(spark.createDataFrame([row(0, amount=text)], SCHEMA))
    assert df.select(claims.amount_key(F.col("forms.amount")).alias("k")).first().k == key


def test_tender_and_deadlines(spark):
    at = dt.datetime(2026, 8, 1, 9, 30, 15)
    quotes = {"title": "采购公告：t", "bid_submission_deadline": "投标截止 2026-08-01 09:30", "opening_deadline": "开标 2026/08/01"}
    df = claims.prepared(spark.createDataFrame([row(0, quotes=quotes)], SCHEMA).withColumn("at", F.lit(at)))
    why = lambda d, p: claims.deadline_failure(F.create_map(*d), F.create_map(*p))
    bid, day, minute, second = F.lit("bid_submission"), F.lit("date"), F.lit("minute"), F.lit("second")
    r = df.select(
        claims.tender_supported().alias("tender"), why([bid, "at"], [bid, minute]).alias("fits"), why([bid, "at"], [bid, second]).alias("too_fine"), why([F.lit("registration"), "at"], [F.lit("registration"), day]).alias("no_quote"),
        why([F.lit("opening"), "at"], [F.lit("opening"), day, F.lit("other"), day]).alias("unknown"), why([F.lit("opening"), "at"], [F.lit("opening"), day]).alias("day"),
    ).first()
    assert (r.tender, r.fits, r.too_fine, r.no_quote, r.unknown, r.day) == (True, None, "deadline_evidence_invalid", "deadline_evidence_missing", "deadline_evidence_invalid", None)


def test_conflicts_of_two_sources(spark):
    make = lambda **k: spark.createDataFrame([row(0, **k)], SCHEMA)
    side = lambda df, n: claims.prepared(df).select(F.struct("published_at", claims.subtype().alias("subtype"), F.col("forms.financing_round").alias("round"), F.col("forms.amount").alias("amount")).alias(n))
    a = side(make(), "a")
    cases = [({}, None), ({"published_at": dt.datetime(2026, 8, 17)}, "financing_corroboration_date_outside_window"), ({"published_at": None}, "financing_source_event_evidence_missing"), ({"financing_subtype": "strategic"}, "financing_corroboration_attribute_conflict"),
             ({"financing_round": "A轮、A+轮"}, None), ({"financing_round": "B轮"}, "financing_corroboration_round_conflict"), ({"amount": "1.6亿元"}, "financing_corroboration_amount_conflict"), ({"amount": "1.5亿"}, None)]
    for own, want in cases:
        assert a.crossJoin(side(make(**own), "b")).select(claims.conflict("a", "b").alias("w")).first().w == want, own


def test_graded_sources(spark):
    registry = spark.createDataFrame([("tq.cn", "company", ["天穹火箭科技有限公司"]), ("hs.cn", "investor", ["红杉"]), ("news.cn", "media", []), ("x.hs.cn", "media", [])], "domain string, kind string, aliases array<string>")
    df = claims.prepared(spark.createDataFrame([row(i) for i in range(6)], SCHEMA)).withColumn("host", F.element_at(F.array(*map(F.lit, ["www.tq.cn", "hs.cn", "news.cn", "x.hs.cn", "other.cn", "nothq.cn"])), F.col("pos") + 1))
    assert [r.grade for r in claims.grade_financing(df, registry).orderBy("pos").collect()] == ["A", "A", "B", "B", "C", "C"]
    assert claims.registries_overlap(registry.unionAll(registry.limit(1).withColumn("kind", F.lit("media")))).first().domain == "tq.cn"


def test_classification_and_page(spark):
    quotes = {"in_china": "中国商业航天企业", "in_scope": "商业航天融资", "category": "商业航天", "event_type": "完成融资"}
    own = [F.lit(True).alias("in_china"), F.lit(True).alias("in_scope"), F.lit("commercial_space_financing").alias("category"), F.lit("financing").alias("event_type")]
    rules = F.struct(*own)
    why = lambda q, drop=(), r=rules: claims.prepared(spark.createDataFrame([row(0, drop=drop, quotes=quotes | q)], SCHEMA).select("*", *own)).select(claims.classification_failure(r, F.lit("B"), F.lit("u")).alias("w")).first().w
    assert why({}) is None
    assert why({}, r=F.struct(F.lit(False).alias("in_china"), *own[1:])) == "classification_rule_disagreement"
    assert why({}, drop=["category"]) == "classification_evidence_missing"
    assert why({"in_china": "美国企业"}) == "classification_country_evidence_invalid"
    assert why({"in_scope": "x", "category": "光电吊舱", "event_type": "完成融资"}) == "classification_category_evidence_invalid"
    assert why({"in_scope": "商业航天", "event_type": "发布"}) == "classification_event_evidence_invalid"
    df = claims.prepared(spark.createDataFrame([row(0, quotes=quotes)], SCHEMA).select("*", *own))
    body = "\n".join({**GOOD, **quotes}.values())
    page = lambda text_, url="u": df.select(claims.page_failure(rules, F.lit("B"), F.lit(url), F.lit(""), F.lit(text_)).alias("w")).first().w
    assert page(body) is None and page("other") == "evidence_not_grounded" and page(body, "v") == "evidence_not_grounded"
