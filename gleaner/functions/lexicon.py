"""Term lists and the operators that use them.  All lists are parameters of the operators; these are the defaults."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide results and must stay as they are.
LEGAL_SUFFIXES = ("股份有限公司", "有限责任公司", "科技有限公司", "有限公司", "公司")
CITIES = ("北京", "上海", "深圳", "广州", "杭州", "南京", "武汉", "西安", "成都", "重庆", "天津", "苏州", "无锡")
NUMERALS = {"零": 0, "〇": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
UNITS = {"十": 10, "百": 100, "千": 1000}
ROUND = r"(?i)(pre[\s-]?[a-d]\+{0,2}|[a-d]\+{0,2}|天使\+{0,2}|种子|战略投资|战略)"
LIFECYCLE = (
    "采购意向公告", "采购意向", "招标公告", "招标文件", "中标候选人公示", "中标候选人", "中标结果公告", "中标结果",
    "中标公告", "成交结果公告", "成交结果", "成交公告", "更正公告", "变更公告", "延期公告", "终止公告", "废标公告",
    "流标公告", "重新招标公告", "重新招标", "二次招标公告", "二次招标", "二次采购公告", "二次采购", "二次", "更正",
    "变更", "延期", "终止", "废标", "流标",
)
FINANCING = "commercial_space_financing"
CATEGORY_TERMS = {
    "laser_communication": ("激光通信", "空间激光通信", "星间激光通信", "激光通信终端", "光通信终端", "laser communication", "laser terminal"),
    "laser_weapon": ("激光武器", "高能激光", "定向能激光", "激光反无人机", "激光反制", "laser weapon", "directed energy laser"),
    "eo_turret": ("光电转塔", "光电吊舱", "机载光电", "舰载光电", "无人机光电载荷", "eo turret", "electro-optical turret"),
}
FINANCING_SUBJECTS = ("商业航天", "运载火箭", "火箭公司", "卫星公司", "卫星制造", "卫星运营", "commercial space")
FINANCING_EVENTS = ("融资", "股权投资", "战略投资", "增资", "天使轮", "种子轮", "pre-a轮", "a轮", "b轮", "c轮", "d轮")
FINANCING_SPECIFIC = ("运载火箭", "火箭", "卫星", "航天器", "星载", "星地激光通信", "空间激光通信", "太空服务", "太空运输", "空间基础设施", "空间科技")
FINANCING_ACTIONS = ("融资", "投资", "增资")
PROCUREMENT_EVENTS = (
    "采购意向", "采购公告", "采购项目", "采购", "招标", "询价", "比选", "竞争性谈判", "竞争性磋商", "候选人", "中标",
    "成交", "结果公告", "变更公告", "延期", "终止", "废标", "重新招标", "交付", "procurement", "tender",
    "request for proposal", "contract award",
)
RESEARCH_NOISE = ("行业研究报告", "深度研究及发展前景", "发展深度洞察", "产业发展报告", "发展前景分析报告", "市场运行动态及发展前景", "市场调研报告", "报告目录", "报告摘要", "中国行业研究网", "iim信息")
RESEARCH_DOMAINS = ("chinairn.com", "iim.net.cn")
ROUNDUP_NOISE = ("投融周报", "投融资周报", "融资周报", "投融资盘点", "融资盘点")
MARKET_NOISE = ("a股", "概念股", "板块拉涨", "板块上涨", "涨停", "高切低", "行情", "投资建议", "建议关注", "低位布局")
NEGATED_EVENTS = ("没有具体采购事件", "无具体采购事件", "没有采购事件", "无采购事件", "没有具体融资事件", "无具体融资事件")
PRODUCT_NOISE = (
    "激光打印机", "打印耗材", "硒鼓", "墨盒", "激光雕刻", "激光切割", "激光打标机", "激光美容", "激光脱毛", "激光祛斑",
    "医美", "医疗器械", "医用防护", "美容防护眼镜", "人工智能算法采购", "ai算法采购", "算力采购", "大模型采购", "软件采购",
)
STAGES = (
    ("termination", ("终止", "废标")),
    ("change", ("变更", "延期")),
    ("award", ("中标", "成交", "结果公告")),
    ("candidate", ("候选人",)),
    ("tender", ("招标", "采购公告", "询价", "比选")),
    ("intention", ("采购意向",)),
    ("delivery", ("交付",)),
    ("financing", FINANCING_EVENTS),
)
STAGE_STATUS = {
    "intention": "upcoming", "tender": "open", "inquiry": "open", "comparison": "open", "rebid": "open",
    "candidate": "evaluating", "award": "awarded", "failed": "failed", "termination": "terminated",
}
KEEP_STATUS = ("change", "extension")


def any_of(text: Column, terms: Sequence[str]) -> Column:
    """The text holds one of the terms: one alternation, so long lists stay small in generated code."""
    return text.rlike("|".join(re.escape(t.lower()) for t in terms)) if terms else F.lit(False)


def hits(text: Column, terms: Sequence[str]) -> Column:
    """How many of the terms the text holds, each counted once."""
    return F.size(F.filter(F.array(*[F.lit(t.lower()) for t in terms]), lambda t: text.contains(t)))


def matched(text: Column, terms: Sequence[str]) -> Column:
    """The terms that the text holds, in the list's order."""
    return F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: text.contains(F.lower(t)))


def first_label(text: Column, ordered: Sequence[tuple[str, Sequence[str]]], default: str | None = None) -> Column:
    """The first label one of whose terms the text holds."""
    out = F.lit(default)
    for label, terms in reversed(ordered):
        out = F.when(any_of(text, terms), F.lit(label)).otherwise(out)
    return out


def mapped(value: Column, table: Mapping[str, str], default: Column) -> Column:
    out = default
    for k, v in table.items():
        out = F.when(value == k, F.lit(v)).otherwise(out)
    return out
