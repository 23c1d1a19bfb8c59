"""Fields of a notice from its text: native regular expressions; no match gives null.

Every extraction returns a struct (value, quote), so that a claim keeps the words it rests on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as lx

# Patterns and term lists that decide results.
ORGANIZATION = r"(?i)(?:采购人|招标人|采购单位|组织机构|Organization)\s*[:：]\s*([^\r\n。；;]{2,100})"
SUPPLIER = r"(?:中标|成交)(?:供应商|单位|人)\s*[:：]\s*([^\r\n。；;]{2,100})"
AWARD_AMOUNT = r"(?:中标|成交)(?:总)?金额\s*[:：]\s*((?:人民币)?(?:近|超|逾|约|数)?\d+(?:\.\d+)?(?:亿元|万元|元|万|亿))"
ROUND = r"(?i)((?:pre[\s-]?[a-d]\+{0,2}|[a-d]\+{0,2}|天使\+{0,2}|种子|战略投资|战略)\s*轮)"
AMOUNT = r"((?:人民币)?(?:(?:近|超|逾|约|数)(?:\d+(?:\.\d+)?)?(?:亿|千万|百万|万)元|(?:\d+(?:\.\d+)?|[一二三四五六七八九十百]+)(?:亿|千万|百万|万)元|(?:亿|千万|百万|万)元级)(?:人民币)?)"
UNDISCLOSED = r"((?:具体)?(?:融资)?金额(?:暂)?未披露)"
DATES = (
    r"(20\d{2})-(1[0-2]|0?[1-9])-(3[01]|[12]\d|0?[1-9])(?!\d)",
    r"(20\d{2})/(1[0-2]|0?[1-9])/(3[01]|[12]\d|0?[1-9])(?!\d)",
    r"(20\d{2})\.(1[0-2]|0?[1-9])\.(3[01]|[12]\d|0?[1-9])(?!\d)",
    r"(20\d{2})年(1[0-2]|0?[1-9])月(3[01]|[12]\d|0?[1-9])日",
)
DEADLINES = {
    "registration": r"(?:报名截止时间|报名时间截止|报名截止|登记截止时间)",
    "bid_submission": r"(?:投标截止时间|投标截止|响应文件提交截止时间|递交截止时间)",
    "opening": r"(?:开标时间|开启时间)",
}
EVENT_TYPES = (
    ("procurement_intention", ("采购意向",)),
    ("rebid", ("重新招标", "重招", "rebid")),
    ("candidate", ("中标候选", "候选")),
    ("award", ("中标", "成交", "award")),
    ("failed", ("废标", "失败")),
    ("inquiry", ("询价",)),
    ("comparison", ("比选",)),
    ("change", ("变更",)),
    ("extension", ("延期",)),
    ("termination", ("终止",)),
    ("tender", ("招标", "采购", "tender", "procurement")),
)
CATEGORIES = (
    ("laser_communication", ("激光通信", "空间激光通信", "激光通信终端", "光通信终端", "laser communication", "laser terminal")),
    ("laser_weapon", ("激光武器", "激光反无人机", "激光反制", "高能激光武器", "定向能激光", "laser weapon")),
    ("eo_turret", ("光电吊舱", "光电转塔", "eo turret", "electro-optical turret")),
)
FINANCING_SUBJECTS = ("商业航天", "运载火箭公司", "运载火箭", "液体火箭", "卫星公司", "卫星制造", "卫星运营", "低轨卫星", "星载", "卫星激光通信", "星地激光通信", "空间激光通信", "航天企业", "commercial space")
FINANCING_TERMS = ("融资", "股权投资", "战略投资", "天使轮", "种子轮", "pre-a轮", "a轮", "b轮", "c轮", "financing", "funding round")
EXCLUSIONS = ("银行授信", "银行贷款", "信贷", "借款", "常规再融资", "上市公司再融资", "定向增发", "配股", "可转债")


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _pair(value: Column, quote: Column) -> Column:
    return F.when(value.isNotNull(), F.struct(value.alias("value"), F.trim(quote).alias("quote")))


def organization(text: Column) -> Column:
    return _pair(F.trim(_found(text, ORGANIZATION)), _found(text, ORGANIZATION, 0))


def supplier(text: Column) -> Column:
    """The awarded supplier; masked values such as *** do not count."""
    raw = F.regexp_replace(_found(text, SUPPLIER), r"\s+(?:中标|成交)金额\s*[:：].*$", "")
    value = F.regexp_replace(raw, r"^[ ，,：:]+|[ ，,：:]+$", "")
    return _pair(F.when(~value.rlike(r"^[*\-—]*$"), value), _found(text, SUPPLIER, 0))


def award_amount(text: Column) -> Column:
    return _pair(_found(text, AWARD_AMOUNT), _found(text, AWARD_AMOUNT, 0))


def financing_round(text: Column) -> Column:
    raw = _found(text, ROUND)
    return _pair(F.regexp_replace(F.regexp_replace(raw, r"(?U)\s+", ""), r"(?i)^pre-", "Pre-"), raw)


def financing_amount(text: Column) -> Column:
    """(value, disclosed, quote): disclosed is false where the text says that the amount is not told."""
    told, hidden = _found(text, AMOUNT), _found(text, UNDISCLOSED)
    return F.when(told.isNotNull(), F.struct(told.alias("value"), F.lit(True).alias("disclosed"), told.alias("quote"))).when(hidden.isNotNull(), F.struct(F.lit(None).cast("string").alias("value"), F.lit(False).alias("disclosed"), hidden.alias("quote")))


def date(text: Column) -> Column:
    """The first valid date; the order of the four spellings goes before the place in the text."""
    options = []
    for p in DATES:
        day = F.try_to_date(F.concat_ws("-", *[F.lpad(F.regexp_extract(text, p, g), 2 if g > 1 else 4, "0") for g in (1, 2, 3)]), "yyyy-MM-dd")
        options.append(_pair(F.when(_found(text, p, 0).isNotNull(), day), _found(text, p, 0)))
    return F.coalesce(*options)


def deadlines(text: Column) -> Column:
    """Map of label to (value, precision, quote) for the deadlines that a text names."""
    day = r"(20\d{2})[-/.年](1[0-2]|0?[1-9])[-/.月](3[01]|[12]\d|0?[1-9])(?!\d)日?"
    time = r"(?:\s+([01]?\d|2[0-3]):([0-5]\d)(?::([0-5]\d))?)?"
    entries = []
    for name, label in DEADLINES.items():
        p = rf"{label}\s*[:：]?\s*{day}{time}"
        g = lambda i, p=p: F.regexp_extract(text, p, i)
        two = lambda c: F.lpad(F.when(c == "", "0").otherwise(c), 2, "0")
        stamp = F.try_to_timestamp(F.concat(g(1), F.lit("-"), two(g(2)), F.lit("-"), two(g(3)), F.lit(" "), two(g(4)), F.lit(":"), two(g(5)), F.lit(":"), two(g(6))), F.lit("yyyy-MM-dd HH:mm:ss"))
        precision = F.when(g(6) != "", "second").when(g(4) != "", "minute").otherwise("date")
        value = F.struct(stamp.alias("value"), precision.alias("precision"), F.trim(g(0)).alias("quote"))
        entries.append(F.when((g(0) != "") & stamp.isNotNull(), F.struct(F.lit(name).alias("key"), value.alias("value"))))
    return F.map_from_entries(F.array_compact(F.array(*entries)))


def category(text: Column) -> Column:
    """Financing needs an event and a subject; then the procurement categories; then a bare financing subject."""
    said = F.lower(text)
    subject, event = lx.any_of(said, FINANCING_SUBJECTS), lx.any_of(said, FINANCING_TERMS)
    return F.when(subject & event, lx.FINANCING).otherwise(F.coalesce(lx.first_label(said, CATEGORIES), F.when(subject, lx.FINANCING)))


def event_type(text: Column, category_: Column) -> Column:
    return F.when(category_ == lx.FINANCING, "financing").otherwise(lx.first_label(F.lower(text), EVENT_TYPES))


def excluded_financing(text: Column) -> Column:
    return lx.any_of(F.lower(text), EXCLUSIONS)


def first_line(text: Column, *terms: str) -> Column:
    """The first line that holds one of the terms; without terms the first that is not blank."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(x))
    return F.get(F.filter(lines, (lambda x: lx.any_of(F.lower(x), terms)) if terms else (lambda x: x != "")), F.lit(0))


def lead(text: Column, sentences: int = 8, limit: int = 1800) -> Column:
    """The first distinct sentences of a text."""
    parts = F.filter(F.transform(F.split(text, r"[。！？!?\n]+"), lambda x: F.trim(x)), lambda x: x != "")
    return F.substring(F.array_join(F.slice(F.array_distinct(parts), 1, sentences), "。"), 1, limit)


def date_forms(ts: Column) -> Column:
    """Spellings of a date that count as evidence for it."""
    return F.array(*[F.date_format(ts, f) for f in ("yyyy-MM-dd", "yyyy/MM/dd", "yyyy.MM.dd", "yyyy年M月d日", "yyyy年MM月dd日")])


def analysis(text: Column) -> Column:
    """All extracted fields of a page's text as one struct."""
    kind = category(text)
    return F.struct(
        kind.alias("category"), event_type(text, kind).alias("event_type"), organization(text).alias("organization"), supplier(text).alias("supplier"), award_amount(text).alias("award_amount"),
        financing_round(text).alias("financing_round"), financing_amount(text).alias("financing_amount"), date(text).alias("published"), deadlines(text).alias("deadlines"),
        excluded_financing(text).alias("excluded"), first_line(text).alias("title_line"),
    )


# --------------------------------------------------------------------- where an event belongs
# Places, cues and markers that decide whether an event is domestic and which part it concerns.
PLACES = ("北京", "上海", "深圳", "广州", "天津", "重庆", "合肥", "西安", "成都", "武汉", "南京", "杭州", "苏州", "无锡")
DOMESTIC_CUES = ("中国境内", "我国境内", "国内项目")
SUBJECT_CUES = (*DOMESTIC_CUES, "中国商业航天企业", "国内商业航天企业")
FOREIGN_CUES = ("美国", "美军", "美国国防部", "英国", "俄罗斯", "俄军", "法国", "德国", "日本", "韩国", "印度", "以色列", "乌克兰", "北约", "欧盟", "境外", "国外")
PROCUREMENT_TERMS = ("采购意向", "采购", "招标", "询价", "比选", "变更", "延期", "终止", "候选", "中标", "废标", "重新招标", "tender", "procurement", "award")
PURPOSES = ("用于", "应用于", "面向", "服务于", "配套")
SUBSYSTEMS = ("跟瞄", "捕获跟踪", "转台", "指向机构", "激光器", "探测器", "光机组件")
_PLACED = rf"(?:{'|'.join(PLACES)})(?:市)?[\x{{4e00}}-\x{{9fff}}A-Za-z0-9·]{{2,40}}"
_ENTITY = rf"{_PLACED}?(?:股份有限公司|有限责任公司|有限公司|公安局|部队|单位|研究院|研究所|中心|大学)"


def _has(text: Column, terms) -> Column:
    return F.coalesce(text.rlike("|".join(terms)), F.lit(False))


def approved_source(host: Column) -> Column:
    return F.coalesce(host.rlike(r"\.(?:gov|mil)\.cn$"), F.lit(False))


def domestic_signal(text: Column) -> Column:
    patterns = (*DOMESTIC_CUES, r"(?:中国|我国|国内).{0,8}(?:企业|机构|单位|政府|军队|项目)", rf"{_PLACED}(?:有限公司|研究院|研究所|公安局|大学|中心)")
    return _has(text, patterns)


def foreign_signal(text: Column) -> Column:
    return _has(text, FOREIGN_CUES)


def event_action(text: Column) -> Column:
    """The text speaks of a procurement or a financing."""
    return _has(F.regexp_replace(F.lower(text), r"(?U)\s+", ""), [t.replace(" ", "") for t in (*PROCUREMENT_TERMS, *FINANCING_TERMS)])


def subject_quote(text: Column) -> Column:
    """The domestic body that a text names: companies first, then offices, institutes and universities; shorter ones first."""
    ends = lambda x, *options: x.rlike(f"(?:{'|'.join(options)})$")
    rank = lambda x: F.when(ends(x, "有限公司", "有限责任公司"), 0).when(ends(x, "公安局", "部队", "单位"), 1).when(ends(x, "研究院", "研究所", "中心"), 2).otherwise(3)
    found = F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0))
    return F.array_min(F.transform(found, lambda x: F.struct(rank(x).alias("rank"), F.char_length(x).alias("n"), x.alias("quote"))))["quote"]


def strong_subject(text: Column) -> Column:
    return event_action(text) & (subject_quote(text).isNotNull() | _has(text, SUBJECT_CUES))


def domestic_subject(title: Column, lead_text: Column, approved: Column) -> Column:
    """Is the event domestic: the title decides first, then the lead, then weaker signs or an approved source."""
    foreign = lambda c: foreign_signal(c) & event_action(c)
    weak = (domestic_signal(lead_text) | approved) & ~foreign_signal(lead_text)
    return F.when(strong_subject(title), True).when(foreign(title), False).when(strong_subject(lead_text), True).when(foreign(lead_text), False).otherwise(weak)


def first_domestic_line(text: Column) -> Column:
    lines = F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(x))
    return F.get(F.filter(lines, lambda x: (x != "") & domestic_signal(x) & ~foreign_signal(x)), F.lit(0))


def excluded(text: Column) -> Column:
    """No equity financing: an excluded term, bank credit, or the refinancing of a listed company."""
    said = F.lower(text)
    bank = said.contains("银行") & _has(said, ("授信", "贷款", "信贷", "借款"))
    listed = said.contains("上市公司") & _has(said, ("再融资", "定向增发", "配股", "可转债"))
    return excluded_financing(text) | bank | listed


def parent_purpose(text: Column, category_: str) -> Column:
    """A part is said to be for a system of the category."""
    parents = "|".join(t.replace(" ", "") for t in dict(CATEGORIES).get(category_, FINANCING_SUBJECTS))
    said = F.regexp_replace(F.lower(text), r"(?U)\s+", "")
    return F.coalesce(said.rlike(rf"(?:{'|'.join(PURPOSES)})(?:{parents})|(?:{parents})配套(?:{'|'.join(SUBSYSTEMS)})"), F.lit(False))


def page_date(publication_quote: Column, text: Column) -> Column:
    """The date of a page: what its metadata says, else the first date of its text."""
    return F.coalesce(date(publication_quote), date(text))


# --------------------------------------------------------------------- sentences
STAGE_PHRASES = {
    "procurement_intention": "发布采购意向", "tender": "启动招标采购", "inquiry": "启动询价采购", "comparison": "启动比选采购", "award": "公布中标结果",
    "candidate": "公布候选结果", "change": "发布采购变更", "termination": "终止采购",
}


def composed_summary(category_: Column, title: Column, organization_: Column, event_type_: Column, amount: Column, round_: Column, investors: Column, area: Column, supplier_: Column, awarded: Column, limit: int = 120) -> Column:
    """One sentence of facts about a financing or a procurement."""
    told = lambda lead_, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(lead_), c)).otherwise("")
    subject = F.trim(F.coalesce(F.nullif(organization_, F.lit("")), title))
    some = F.array_join(F.slice(F.coalesce(investors, F.array().cast("array<string>")), 1, 3), "、")
    financed = F.concat(subject, F.lit("完成"), F.coalesce(F.nullif(round_, F.lit("")), F.lit("股权融资")), told("，披露金额", amount), told("，投资方包括", some), told("，资金及业务聚焦", area))
    phrase = lx.mapped(event_type_, STAGE_PHRASES, F.lit("发布采购信息"))
    paid = F.when(F.coalesce(awarded, F.lit("")) != "", F.concat(F.lit("，中标金额"), awarded)).otherwise(told("，项目金额", amount))
    procured = F.concat(subject, phrase, told("，中标供应商为", supplier_), paid)
    return F.substring(F.when(category_ == lx.FINANCING, financed).otherwise(procured), 1, limit)


def brief_summary(summary: Column, body: Column, composed: Column, limit: int = 120) -> Column:
    """The given summary, or the composed one where it is empty or copied from the start of the body."""
    tidy = F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(summary, F.lit("")), r"(?U)\s+", " ")), r"^[ ，,。；;：:]+", ""), r"[ ，,。；;：:]+$", "")
    bare = lambda c: F.lower(F.regexp_replace(c, r"(?U)\s+", ""))
    opening = F.trim(F.regexp_replace(F.coalesce(body, F.lit("")), r"(?U)\s+", " "))
    opening = bare(F.substring(opening, F.lit(1), F.greatest(F.lit(160), F.char_length(tidy) * 2)))
    copied = opening.startswith(bare(tidy)) | ((F.char_length(bare(tidy)) >= 24) & opening.contains(bare(tidy)))
    return F.substring(F.when((tidy == "") | copied, composed).otherwise(tidy), 1, limit)
