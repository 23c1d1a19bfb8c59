"""Report items of verified financings."""

import datetime as dt

from pyspark.sql import functions as F

from gleaner.operators import items

SCHEMA = "financing_id string, status string, company string, round_name string, subtype string, announced_at timestamp, source_dates map<string,timestamp>, source_url string, source_urls array<string>, amount_cny double, amount_disclosed boolean, investors array<string>, business_area string, brief_summary string, evidence array<struct<field:string,quote:string,source_url:string>>"


def D(day):
    return dt.datetime(2026, 7, day)


def test_items_of_verified_financings(spark):
    ev = [("企业公告", "q", "http://a/1"), ("企业公告", "q", "http://a/2"), ("amount", "金额未披露", "http://a/1")]
    rows = [
        ("f1", "verified", "北京天穹火箭有限公司", "A轮", None, D(20), {"http://a/2": D(22)}, "http://a/1", ["http://a/2", "http://a/3"], 1.5e8, True, ["乙", "甲"], "火箭", "", ev),
        ("f2", "verified", "天穹火箭", "A轮、B轮", None, D(18), {}, "http://a/2", [], None, False, [], None, "摘要 文字", []),  # the same event as f1
        ("f3", "verified", "天穹火箭", "C轮", None, D(18), {}, "http://a/2", None, None, False, None, None, None, ev),
        ("f4", "verified", "星海_卫星", None, "strategic", D(2), {}, "http://b/1", [], 2e4, True, [], None, None, []),
        ("f5", "pending", "别的", "A轮", None, D(21), {}, "http://c/1", [], None, None, [], None, None, []),
        ("f6", "verified", "旧的", "A轮", None, dt.datetime(2026, 1, 1), {}, "http://d/1", [], None, None, [], None, None, []),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    shown = items.shown(df, spark.createDataFrame([("f4",), ("f5",)], "financing_id string"), F.lit(D(1)), F.lit(D(23)))
    found = items.financing_lines(shown, F.lit(D(21)), F.lit(D(23))).orderBy("place").collect()
    assert [(r.financing_id, r.label) for r in found] == [("f4", "historical"), ("f1", "daily"), ("f3", "rolling")]
    assert found[1].lines == [
        "- **【已核实·今日新增】北京天穹火箭有限公司完成A轮**", "  - 企业：北京天穹火箭有限公司", "  - 时间：2026-07-20", "  - 轮次：A轮", "  - 金额：1.50亿元", "  - 投资方：乙、甲", "  - 业务方向：火箭",
        "  - 摘要：北京天穹火箭有限公司完成A轮，披露金额1.50亿元，投资方包括乙、甲，业务聚焦火箭", "  - 来源：[企业公告1](http://a/1)｜[企业公告2](http://a/2)",
    ]
    assert found[0].lines[0] == "- **【已核实·历史补录】星海\\_卫星完成战略融资**" and "  - 金额：2.00万元" in found[0].lines and found[0].lines[-1] == "  - 来源：[来源](http://b/1)"
    assert "  - 金额：未披露" in found[2].lines and "  - 摘要：天穹火箭完成C轮，披露金额未披露" in found[2].lines
    assert items.financing_lines(items.shown(df.limit(0), df.select("financing_id"), F.lit(D(1)), F.lit(D(23))), F.lit(D(1)), F.lit(D(2))).collect() == []


def test_companies_of_few_financings_are_not_linked(spark, monkeypatch):
    """A company is a block as it stands; none is linked over its sources."""
    from gleaner.operators import blocks

    monkeypatch.setattr(blocks, "block_ids", None)
    rows = [(f"f{i:02}", "verified", f"公司{i % 3}号", "A轮", None, D(2), {}, f"http://a/{i % 2}", [], None, None, [], None, None, []) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    shown = items.shown(df, df.limit(0).select("financing_id"), F.lit(D(1)), F.lit(D(23)))
    assert sorted(r.financing_id for r in shown.collect()) == ["f00", "f01", "f02", "f03", "f04", "f05"]
