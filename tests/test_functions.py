"""Column functions against plain Python statements of their rules."""

import uuid
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from gleaner.functions import clock, ids, text, urls
from gleaner.operators import resolve, verify

URLS = {
    "HTTPS://WWW.Example.COM:443/A/b?b=2&a=1&utm_source=x#top": "https://www.example.com/A/b?a=1&b=2",
    "http://example.com:8080?from=x": "http://example.com:8080",
    "http://user@Example.com:80/p?flag&b=1": "http://user@example.com/p?flag&b=1",
    "http://example.com/?%73pm=1&z=%zz": "http://example.com/?z=%zz",
    "no url #x": "no url ",
    "http://[::1]:80/x": "http://[::1]/x",
}


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_normalize_url(spark):
    assert column(spark, list(URLS), urls.normalize_url) == list(URLS.values())
    assert column(spark, [None], urls.normalize_url) == [None]


def test_host_and_suffixes(spark):
    assert column(spark, ["https://A.b.CN.:81/x", "nothing"], urls.host) == ["a.b.cn", ""]
    assert column(spark, ["a.b.cn"], urls.host_suffixes) == [["a.b.cn", "b.cn", "cn"]]
    assert column(spark, ["https://u@H.cn:8/x?q#f", "x"], urls.shown_url) == ["https://h.cn:8/x", "invalid-url"]


def test_text_forms(spark):
    values = ["　Ａ＋轮，  融资 ", "a - b", "", None, "Ⅷ x！"]
    assert column(spark, values, text.normalize_nfkc) == [None if v is None else text.plain_normalize(v) for v in values]
    assert text.plain_normalize("Ａ＋轮， 融资") == "a轮 融资"
    assert column(spark, ["a -  b!", "Ａ"], text.normalize) == ["a b", "ａ"]


def test_organization(spark):
    got = column(spark, ["北京天穹火箭科技有限公司", "上海科技", "深圳公司", "无锡某某某股份有限公司"], text.organization)
    assert got == ["天穹火箭", "上海科技", "深圳", "某某某"]


def test_rounds_codes_markers(spark):
    assert column(spark, ["Pre-A+轮", "A轮和B++轮", "天使轮", "无"], text.rounds) == [["prea+"], ["a", "b++"], ["天使"], []]
    assert column(spark, ["XW-2026-001", "LW-2026-009-R2"], text.base_code) == ["xw2026001", "lw2026009"]
    got = column(spark, ["2026年 第03批 标段-2", "第一包"], text.markers)
    assert (got[0].year, got[0].batch, got[0].lot, got[1].lot) == (2026, "3", "2", "1")
    said = ["第03", "三", "03", "十二", "二十", "一百零五", "〇三", "零", "00", "第 A1", "x三", "", "两千零十", None, "第十", "3十"]
    assert column(spark, said, text.marker) == ["3", "3", "3", "12", "20", "105", "3", "0", "0", " a1", "x三", "", "2010", None, "10", "3十"]


@pytest.mark.parametrize(("said", "number"), [("十二", 12), ("三", 3), ("一百零五", 105), ("二〇二六", 2026), ("x", None), ("", None), ("千", 1000)])
def test_numeral(said, number):
    assert text.plain_numeral(said) == number


def test_core_title():
    assert text.plain_core_title("激光终端采购项目招标公告") == "激光终端采购项目"
    assert text.plain_core_title("二次元项目公告") == "二次元项目公告"
    assert text.plain_core_title("重新招标公告") == ""


def test_ids(spark):
    assert column(spark, ["x", "激光"], ids.uuid5) == [str(uuid.uuid5(uuid.NAMESPACE_URL, v)) for v in ("x", "激光")]
    import hashlib
    import json

    want = hashlib.sha256(json.dumps({"a": None, "b": '引"号'}, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert column(spark, ['引"号'], lambda v: ids.canonical_hash(b=v, a=F.lit(None).cast("string"))) == [want]


def test_clock(spark):
    now = F.expr("TIMESTAMP '2026-07-22 00:00:00'")
    ts = lambda v: F.to_timestamp(v)
    days = ["2026-07-15 00:00:00", "2026-07-14 23:59:59", "2026-07-22 23:00:00", "2026-07-24 00:00:00", None, "2026-05-01 00:00:00"]
    assert column(spark, days, lambda v: clock.bucket(ts(v), now)) == ["recent", "fallback", "recent", None, "unknown", None]
    apart = column(spark, ["2026-07-07 19:00:00"], lambda v: F.array(clock.floor_days_apart(now, ts(v)), clock.floor_days_apart(ts(v), now)))
    assert apart == [[14, 15]]


def test_cascade_order(spark):
    rules = [(F.col("v") == "a", "rejected", "first"), (F.col("v").isin("a", "b"), "pending", "second")]
    status, reason = verify.cascade(rules)
    assert column(spark, ["a", "b", "c"], lambda v: F.concat_ws("/", status, reason)) == ["rejected/first", "pending/second", "verified/verified"]


def test_match_rules():
    event = {"buyer": "b", "category": "c", "title": "激光终端项目", "codes": ["x1"], "base_codes": ["x1"], "rebid": False, "year": 2026, "year_stated": False, "batch": None, "lot": None, "us": 10}
    project = {"id": "p", "buyer": "b", "category": "c", "title": "激光终端项目", "codes": [], "base_codes": [], "year": 2026, "batch": None, "lot": None, "latest_us": 5, "span_end_us": 100}
    assert resolve.plain_match(event, [project], 1)["reason"] == "same_buyer_title"
    assert resolve.plain_match(event, [project | {"codes": ["x1"], "title": "other", "year": 2025}], 1)["reason"] == "exact_project_code"
    assert resolve.plain_match(event | {"year_stated": True}, [project | {"codes": ["x1"], "year": 2025}], 1)["reason"] == "conflicting_year"
    assert resolve.plain_match(event, [project | {"buyer": "z"}], 1)["reason"] == "buyer_mismatch"
    assert resolve.plain_match(event, [], 0)["reason"] == "no_match"
    close = resolve.plain_match(event | {"title": "激光终端项目一"}, [project], 1)
    assert close["relation"] == "same_project" and close["score"] == SequenceMatcher(None, "激光终端项目一", "激光终端项目").ratio()
    assert resolve.plain_match(event | {"title": "激光终端项目一", "us": 1}, [project], 1)["reason"] == "invalid_lifecycle_timing"
    assert resolve.plain_match(event | {"rebid": True, "codes": [], "base_codes": ["q"], "title": "激光终端项目"}, [project], 1)["reason"] == "rebid_code_unaligned"


def test_corroboration_is_exact(spark):
    import random

    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), rng.choice(["x.cn", "y.x.cn", "z.cn", "w.cn"]), rng.randint(0, 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "pos int, k string, d string, c int")
    got = {r.pos: r.corroborator for r in verify.corroboration(df, ["k"], "pos", "d", "c").collect()}
    kin = lambda p, q: p == q or p.endswith("." + q) or q.endswith("." + p)
    want = {a[0]: min((b[0] for b in rows if b[1] == a[1] and b[3] != a[3] and not kin(a[2], b[2])), default=None) for a in rows}
    assert got == want
