"""Do the quotes of a notice support what it claims?  Native checks over normal forms that one Arrow pass prepares.

A notice row holds: evidence (array of field, quote, source_url), title, organization, published_at, financing_round,
financing_subtype, amount, amount_disclosed, investors (array), business_area, category, event_type.  `prepared` adds
the struct `forms`: the evidence and every claim with three normal forms each, `nfkc` (folded), `loose` (without white
space) and `claim` (without white space and punctuation).  All other functions are expressions on such rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import extract, text
from ..functions import lexicon as lx
from .verify import cascade

#: Reasons, markers and terms that decide results.
SUBTYPE_TERMS = {"strategic": ("战略融资", "战略投资"), "capital_increase": ("产业基金增资", "基金增资"), "merger_acquisition": ("并购融资", "并购投资")}
UNDISCLOSED = "未披露|未公布|未透露"
ROUND_TOKENS = r"pre-?[a-d]\+{0,2}|series-?[a-d]\+{0,2}|天使\+{0,2}|种子|(?<![a-z])[a-d]\+{0,2}(?![a-z])"
SOURCE_REASONS = {
    "organization": "financing_source_organization_evidence_invalid",
    "published_at": "financing_source_publication_date_evidence_invalid",
    "financing_round": "financing_source_round_evidence_invalid",
    "financing_subtype": "financing_source_subtype_evidence_invalid",
}
DEADLINES = ("registration", "bid_submission", "opening")
CLAIMS = ("title", "organization", "financing_round", "amount", "business_area")
_FORM = T.StructType([T.StructField(n, T.StringType()) for n in ("nfkc", "loose", "claim")])


@F.pandas_udf(T.ArrayType(_FORM))
def _forms(lists: pd.Series) -> pd.Series:
    def one(value):
        folded = unicodedata.normalize("NFKC", value or "").casefold()
        return {"nfkc": folded, "loose": text.plain_claim(value, keep_punctuation=True), "claim": text.plain_claim(value)}

    return lists.map(lambda values: [one(v) for v in values])


def prepared(df: DataFrame) -> DataFrame:
    """df with `forms`: ev (the evidence with its forms), one struct per claim, and investors (array of structs)."""
    quotes = F.transform(F.coalesce("evidence", F.array().cast("array<struct<field:string,quote:string,source_url:string>>")), lambda e: e["quote"])
    investors = F.coalesce("investors", F.array().cast("array<string>"))
    df = df.withColumn("__f", _forms(F.concat(F.array(*[F.col(c).cast("string") for c in CLAIMS]), investors, quotes)))
    at = len(CLAIMS)
    ev = F.zip_with("evidence", F.slice("__f", at + 1 + F.size(investors), F.greatest(F.size(quotes), F.lit(0))), lambda e, f: F.struct(e["field"].alias("field"), e["quote"].alias("quote"), e["source_url"].alias("source_url"), f["nfkc"].alias("nfkc"), f["loose"].alias("loose"), f["claim"].alias("claim")))
    none = F.array().cast("array<struct<field:string,quote:string,source_url:string,nfkc:string,loose:string,claim:string>>")
    forms = F.struct(F.coalesce(ev, none).alias("ev"), F.slice("__f", at + 1, F.greatest(F.size(investors), F.lit(0))).alias("investors"), *[F.get("__f", i).alias(c) for i, c in enumerate(CLAIMS)])
    return df.withColumn("forms", forms).drop("__f")


# --------------------------------------------------------------------- single tests
def some(test, *fields: str) -> Column:
    """Some quote of one of the fields passes."""
    return F.exists("forms.ev", lambda e: e["field"].isin(*fields) & test(e))


def named(*fields: str) -> Column:
    """Each field has a quote."""
    out = F.lit(True)
    for f in fields:
        out &= some(lambda e: F.lit(True), f)
    return out


def holds(field: str, claim: Column) -> Column:
    return (claim != "") & some(lambda e: e["claim"].contains(claim), field)


def organization_key(claim: Column) -> Column:
    """A company's brand: legal suffixes fall one after another, then one city if more than two characters remain."""
    for s in lx.LEGAL_SUFFIXES:
        claim = F.regexp_replace(claim, f"{s}$", "")
    return F.regexp_replace(claim, f"(?s)^(?:{'|'.join(lx.CITIES)})(?=.{{3}})", "")


def holds_organization(field: str = "organization") -> Column:
    """The company's name, or its brand of four characters at least, stands in a quote."""
    claim = F.col("forms.organization.claim")
    key = organization_key(claim)
    return (claim != "") & some(lambda e: e["claim"].contains(claim) | ((F.char_length(key) >= 4) & e["claim"].contains(key)), field)


def holds_date(field: str = "published_at", ts: str = "published_at") -> Column:
    spellings = extract.date_forms(F.col(ts))
    return F.col(ts).isNotNull() & some(lambda e: F.exists(spellings, lambda s: e["loose"].contains(s)), field)


def holds_round(*fields: str) -> Column:
    """The round stands in a quote; a single letter or digit only between other signs."""
    name = F.col("forms.financing_round.loose")
    single = name.rlike("^[a-z0-9]$")
    alone = lambda e: F.regexp_like(e["nfkc"], F.concat(F.lit("(?<![a-z0-9])"), name, F.lit("(?![a-z0-9])")))
    return (name != "") & some(lambda e: F.when(single, alone(e)).otherwise(e["loose"].contains(name)), *fields)


def subtype() -> Column:
    return F.coalesce(F.nullif("financing_subtype", F.lit("")), F.when(F.col("forms.financing_round.loose") != "", F.lit("round_equity")))


def holds_subtype() -> Column:
    out = F.lit(False)
    for name, terms in SUBTYPE_TERMS.items():
        out |= (F.col("financing_subtype") == name) & some(lambda e, t=terms: e["loose"].rlike("|".join(t)), "financing_subtype")
    return F.coalesce(out, F.lit(False))


def amount_key(form: Column) -> Column:
    """The amount in yuan as a plain decimal number; the claim form of a text without digits, null of an empty one."""
    bare = F.replace(form["nfkc"], F.lit(","), F.lit(""))
    number = F.nullif(F.regexp_extract(bare, r"(\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("decimal(28,8)")
    unit = F.when(bare.contains("亿"), F.lit(100_000_000)).when(bare.contains("万"), F.lit(10_000)).otherwise(F.lit(1))
    plain = F.regexp_replace(F.regexp_replace((number * unit).cast("decimal(38,8)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(bare != "", F.coalesce(plain, form["claim"]))


def holds_amount() -> Column:
    own = amount_key(F.col("forms.amount"))
    return (F.col("forms.amount.nfkc") != "") & ~F.coalesce(F.col("amount_disclosed") == F.lit(False), F.lit(False)) & some(lambda e: amount_key(e) == own, "amount")


def says_undisclosed() -> Column:
    return some(lambda e: e["claim"].rlike(UNDISCLOSED), "amount")


def _told() -> Column:
    return F.col("forms.amount.nfkc") != ""


def _hidden() -> Column:
    return F.coalesce(F.col("amount_disclosed") == F.lit(False), F.lit(False))


def holds_investors() -> Column:
    return F.forall("forms.investors", lambda i: (i["claim"] != "") & some(lambda e: e["claim"].contains(i["claim"]), "investors"))


def holds_action(field: str = "event_type") -> Column:
    terms = "|".join(t.replace(" ", "") for t in extract.FINANCING_TERMS)
    return some(lambda e: e["loose"].rlike(terms), field)


def _area_fails() -> Column:
    return (F.col("forms.business_area.nfkc") != "") & ~holds("business_area", F.col("forms.business_area.claim"))


def _round_equity() -> Column:
    return F.coalesce(subtype() == "round_equity", F.lit(False))


# --------------------------------------------------------------------- whole notices
def tender_supported() -> Column:
    """Title, organization and date of a tender each stand in a quote of their own."""
    return holds("title", F.col("forms.title.claim")) & holds("organization", F.col("forms.organization.claim")) & holds_date()


def financing_failure() -> Column:
    """Why the claims of an official financing source fail; null if they hold."""
    kind = F.when(_round_equity(), named("financing_round")).otherwise(named("financing_subtype"))
    required = subtype().isNotNull() & named("organization", "published_at", "amount") & kind & ((F.size("forms.investors") == 0) | named("investors"))
    ungrounded, missing = "evidence_not_grounded", "financing_missing_required_evidence"
    rules = [
        (~required, missing),
        (~holds("organization", F.col("forms.organization.claim")) | ~holds_date(), ungrounded),
        (F.when(_round_equity(), ~holds_round("financing_round")).otherwise(~holds_subtype()), ungrounded),
        (_told() & ~holds_amount(), ungrounded),
        (~_told() & ~(_hidden() & says_undisclosed()), missing),
        (~holds_investors() | _area_fails() | ~holds_action(), ungrounded),
    ]
    return cascade([(c, "", r) for c, r in rules], "", None)[1]


def financing_gaps() -> Column:
    """The fields of a financing whose evidence is missing, in fixed order."""
    amount = F.when(_told(), ~holds_amount()).otherwise(~(_hidden() & says_undisclosed()))
    gaps = [
        ("organization", ~holds("organization", F.col("forms.organization.claim"))),
        ("published_at", ~holds_date()),
        ("amount", amount),
        ("financing_round", _round_equity() & ~holds_round("financing_round")),
        ("financing_subtype", ~_round_equity() & ~holds_subtype()),
        ("investors", ~holds_investors()),
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in gaps]))


def source_failure() -> Column:
    """Why one media source of a financing fails; what it leaves out does not count against it."""
    wrong = lambda what: f"financing_source_{what}_evidence_invalid"
    rules = [
        (subtype().isNull(), "financing_source_event_evidence_missing"),
        (~named("organization"), SOURCE_REASONS["organization"]),
        (~named("published_at"), SOURCE_REASONS["published_at"]),
        (_round_equity() & ~named("financing_round"), SOURCE_REASONS["financing_round"]),
        (~_round_equity() & ~named("financing_subtype"), SOURCE_REASONS["financing_subtype"]),
        (~holds_organization(), SOURCE_REASONS["organization"]),
        (~holds_date(), SOURCE_REASONS["published_at"]),
        (_round_equity() & ~holds_round("financing_round", "title"), SOURCE_REASONS["financing_round"]),
        (~_round_equity() & ~holds_subtype(), SOURCE_REASONS["financing_subtype"]),
        ((_told() & ~holds_amount()) | (~_told() & _hidden() & ~says_undisclosed()), wrong("amount")),
        (~holds_investors(), wrong("investor")),
        (_area_fails(), wrong("business_area")),
        (~holds_action(), wrong("action")),
    ]
    return cascade([(c, "", r) for c, r in rules], "", None)[1]


def missing_fields(reason: Column) -> Column:
    """The fields that a pending reason names, or that a financing lacks."""
    prefix = "missing_required_fields:"
    listed = F.filter(F.split(F.substring(reason, len(prefix) + 1, 1_000_000), ","), lambda x: x != "")
    none = F.array().cast("array<string>")
    return F.when(reason.startswith(prefix), listed).when(reason == "financing_missing_required_evidence", financing_gaps()).otherwise(none)


def payload_valid() -> Column:
    """A notice that may enter the state: in scope, classified, with title, organization and date."""
    filled = lambda c: F.coalesce(F.col(c).rlike(r"(?U)\S"), F.lit(False))
    return F.coalesce(F.col("in_china") & F.col("in_scope"), F.lit(False)) & F.col("category").isNotNull() & F.col("event_type").isNotNull() & filled("title") & filled("organization") & F.col("published_at").isNotNull()


# --------------------------------------------------------------------- classification
def evidence_event_type(said: Column, category: Column) -> Column:
    """The event type that quotes name; a financing needs one of its own terms."""
    financing = F.coalesce(category == lx.FINANCING, F.lit(False))
    return F.when(~financing | lx.any_of(F.lower(said), extract.FINANCING_TERMS), extract.event_type(said, category))


def classification_failure(rules: Column, grade: Column, url: Column) -> Column:
    """Why a notice's classification fails: the rules disagree, or its quotes do not show country, category, event or scope.

    rules: what the rules make of the page, a struct of in_china, in_scope, category and event_type.
    """
    fields = ("in_china", "in_scope", "category", "event_type")
    differs = F.lit(False)
    for c in fields:
        differs |= ~F.col(c).eqNullSafe(rules[c])
    quotes = lambda *names: F.array_join(F.flatten(F.array(*[F.transform(F.filter("forms.ev", lambda e: e["field"] == n), lambda e: e["quote"]) for n in names])), "\n")  # noqa: E731, B023
    country = some(lambda e: ((e["quote"] == url) & (grade == "A")) | (extract.domestic_signal(e["quote"]) & ~extract.foreign_signal(e["quote"])), "in_china")
    said, scope = quotes("in_scope", "category", "event_type"), quotes("in_scope")
    terms = F.lit(False)
    for name, words in (*extract.CATEGORIES, (lx.FINANCING, extract.FINANCING_SUBJECTS)):
        terms |= F.coalesce(F.col("category") == name, F.lit(False)) & lx.any_of(F.lower(scope), words)
    is_event = lambda text_: evidence_event_type(text_, F.col("category")).eqNullSafe(F.col("event_type"))
    rules_ = [
        (differs, "classification_rule_disagreement"),
        (~named(*fields), "classification_evidence_missing"),
        (~F.coalesce(country, F.lit(False)), "classification_country_evidence_invalid"),
        (~extract.category(said).eqNullSafe(F.col("category")), "classification_category_evidence_invalid"),
        (~is_event(said), "classification_event_evidence_invalid"),
        (~(terms | is_event(scope)), "classification_scope_evidence_invalid"),
    ]
    return cascade([(c, "", r) for c, r in rules_], "", None)[1]


def page_failure(rules: Column, grade: Column, url: Column, page_title: Column, page_text: Column) -> Column:
    """Why a media page cannot corroborate a financing: scope, quotes that are not on the page, classification, or its facts."""
    scoped = payload_valid() & F.coalesce((F.col("category") == lx.FINANCING) & (F.col("event_type") == "financing"), F.lit(False))
    on_page = lambda e: page_text.contains(e["quote"]) | page_title.contains(e["quote"]) | ((e["field"] == "in_china") & (e["quote"] == url) & (grade == "A"))
    grounded = F.forall("forms.ev", lambda e: (e["source_url"] == url) & e["quote"].rlike(r"(?U)\S") & on_page(e))
    failed = F.coalesce(classification_failure(rules, grade, url), source_failure())
    return F.when(~scoped, "missing_or_out_of_scope").when(~F.coalesce(grounded, F.lit(False)), "evidence_not_grounded").otherwise(failed)


# --------------------------------------------------------------------- deadlines
def quote_supports(loose: Column, value: Column, precision: Column) -> Column:
    """A quote names the date and, as far as the precision goes, the minute and the second."""
    h, m, s = F.hour(value), F.minute(value), F.second(value)
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    minute = [F.concat(two(h), F.lit(":"), two(m)), F.concat(h.cast("string"), F.lit(":"), two(m)), F.concat(h.cast("string"), F.lit("时"), two(m), F.lit("分"))]
    second = [F.concat(minute[0], F.lit(":"), two(s)), F.concat(minute[1], F.lit(":"), two(s)), F.concat(minute[2], two(s), F.lit("秒"))]
    any_of = lambda forms: F.exists(forms, lambda f: loose.contains(f))
    return any_of(extract.date_forms(value)) & ((precision == "date") | (any_of(F.array(*minute)) & ((precision == "minute") | any_of(F.array(*second)))))


def deadline_failure(deadlines: Column, precision: Column) -> Column:
    """Why the deadlines (map of name to time) lack support at their precision (map of name to date, minute, second)."""
    unknown = F.exists(F.map_keys(precision), lambda k: ~k.isin(*DEADLINES) | deadlines[k].isNull())
    rules = [(F.coalesce(unknown, F.lit(False)), "deadline_evidence_invalid")]
    for name in DEADLINES:
        value, p = deadlines[name], precision[name]
        rules.append((value.isNotNull() & (p.isNull() | ~named(f"{name}_deadline")), "deadline_evidence_missing"))
        rules.append((value.isNotNull() & ~some(lambda e, v=value, q=p: quote_supports(e["loose"], v, q), f"{name}_deadline"), "deadline_evidence_invalid"))
    return cascade([(c, "", r) for c, r in rules], "", None)[1]


# --------------------------------------------------------------------- two sources
def round_tokens(nfkc: Column) -> Column:
    found = F.regexp_extract_all(F.regexp_replace(nfkc, r"(?U)\s+", ""), F.lit(ROUND_TOKENS), F.lit(0))
    return F.array_distinct(F.transform(found, lambda r: F.regexp_replace(F.replace(r, F.lit("-"), F.lit("")), "^series", "")))


def rounds_compatible(a: Column, b: Column) -> Column:
    """One names a subset of the other's rounds; without tokens the names must be equal.  a, b: form structs."""
    x, y = round_tokens(a["nfkc"]), round_tokens(b["nfkc"])
    bare = lambda f: F.regexp_replace(F.regexp_replace(f["claim"], "融资$", ""), "轮$", "")
    subset = (F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), bare(a) == bare(b)).otherwise(subset)


def conflict(a: str, b: str, days: int = 45) -> Column:
    """Why two sources cannot corroborate one financing; a and b name struct columns with published_at, subtype, round, amount."""
    A, B = F.col(a), F.col(b)
    rules = [
        (A["published_at"].isNull() | B["published_at"].isNull(), "financing_source_event_evidence_missing"),
        (F.abs(F.datediff(A["published_at"], B["published_at"])) > days, "financing_corroboration_date_outside_window"),
        (~A["subtype"].eqNullSafe(B["subtype"]), "financing_corroboration_attribute_conflict"),
        (~rounds_compatible(A["round"], B["round"]), "financing_corroboration_round_conflict"),
        ((A["amount"]["nfkc"] != "") & (B["amount"]["nfkc"] != "") & (amount_key(A["amount"]) != amount_key(B["amount"])), "financing_corroboration_amount_conflict"),
    ]
    return cascade([(c, "", r) for c, r in rules], "", None)[1]


def source_record(url: Column, grade: Column, content_hash: Column) -> Column:
    """One graded source, its evidence in order."""
    return F.struct(url.alias("source_url"), grade.alias("source_grade"), F.col("published_at").alias("published_at"), content_hash.alias("content_hash"), F.array_sort("evidence").alias("evidence"))


# --------------------------------------------------------------------- graded financing sources
def grade_financing(rows: DataFrame, registry: DataFrame, host: str = "host") -> DataFrame:
    """Prepared rows with `grade`: B for media; A for the site of the company itself, or of an investor that a quote names; else C.

    registry: domain, kind (company, investor, media), aliases (array of claim forms).  A dimension table.
    """
    from ..functions.urls import host_suffixes

    hosts = rows.select(host).distinct()
    found = hosts.select(host, F.explode(host_suffixes(F.col(host))).alias("domain")).join(registry, "domain")
    best = found.groupBy(host).agg(F.max_by(F.struct("kind", "aliases"), F.length("domain")).alias("__r"))
    joined = rows.join(best, host, "left")
    mine = F.array_contains("__r.aliases", F.col("forms.organization.claim"))
    invested = F.exists("forms.investors", lambda i: F.array_contains("__r.aliases", i["claim"]) & some(lambda e: e["claim"].contains(i["claim"]), "investors"))
    grade = F.when(F.col("__r.kind") == "media", "B").when((F.col("__r.kind") == "company") & mine, "A").when((F.col("__r.kind") == "investor") & invested, "A").otherwise("C")
    return joined.withColumn("grade", grade).drop("__r")


def known_company(claim: Column, aliases: Sequence[str]) -> Column:
    return claim.isin(*[text.plain_claim(a) for a in aliases])


def registries_overlap(registry: DataFrame) -> DataFrame:
    """Domains that are registered under more than one kind; a valid registry has none."""
    return registry.groupBy("domain").agg(F.count_distinct("kind").alias("kinds")).where("kinds > 1").select("domain")
