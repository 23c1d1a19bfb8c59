"""Follow-up planning: which leads to verify next, and what to ask; search traces; delivery guard."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lexicon as lx
from ..functions.extract import PLACES
from .blocks import fold

# What to ask for when a field lacks evidence.
GAP_TERMS: Mapping[str, str] = {"organization": "采购人", "published_at": "发布时间", "amount": "金额", "round": "融资轮次", "investors": "投资方", "source": "官网"}


def eligible(reason: Column, reasons: Sequence[str], attempts: Column, most: int, seen: Column, now: Column, pool_days: int) -> Column:
    """The first reason why a lead is not followed up; null if it is."""
    return (
        F.when(~F.coalesce(reason.isin(*reasons), F.lit(False)), "reason_not_eligible")
        .when(F.coalesce(attempts, F.lit(0)) >= most, "attempts_exhausted")
        .when(seen.isNotNull() & (F.timestamp_diff("MICROSECOND", seen, now) > pool_days * 86_400_000_000), "outside_pool")
    )


def plan(targets: DataFrame, tried: DataFrame, budget: int, order: Sequence[Column], group: str = "group_key", target: str = "target", queries: str = "queries") -> DataFrame:
    """The next queries within the budget: best group first, one untried query of each distinct target per round.

    targets: group, target and its queries in order of preference.  tried: query.
    """
    asked = targets.select("*", F.posexplode(queries).alias("n", "query")).join(tried.select("query").distinct(), "query", "left_anti")
    ranked = asked.withColumn("__g", F.row_number().over(Window.partitionBy(group).orderBy(*order, "n")))
    rounds = ranked.withColumn("__round", F.row_number().over(Window.partitionBy(target).orderBy("__g")))
    top = rounds.orderBy("__round", "__g", *order, target, "n").limit(budget)  # the budget is the feature
    return top.select(group, target, "query", F.row_number().over(Window.orderBy("__round", "__g", *order, target, "n")).cast("long").alias("place"))


def ask(name: Column, title: Column, gaps: Column) -> Column:
    """Queries for a target, one per gap and a general one, as an array."""
    table = F.create_map(*[F.lit(x) for kv in GAP_TERMS.items() for x in kv])
    return F.array_distinct(F.concat(F.transform(gaps, lambda g: F.concat_ws(" ", name, F.coalesce(table[g], F.lit("公告")))), F.array(F.concat_ws(" ", name, title))))


# How far a lead of each reason is from a proof; other reasons come last.
_NEAR = ("financing_requires_official_or_two_independent_b_sources", "financing_requires_independent_sources", "financing_corroboration_insufficient")
_ONE_PROOF = (
    "classification_country_evidence_invalid", "classification_category_evidence_invalid", "classification_event_evidence_invalid", "classification_scope_evidence_invalid", "financing_source_event_evidence_missing",
    "financing_source_organization_evidence_invalid", "financing_source_publication_date_evidence_invalid", "financing_source_round_evidence_invalid", "financing_source_subtype_evidence_invalid",
    "financing_source_amount_evidence_invalid", "financing_source_investor_evidence_invalid", "financing_source_business_area_evidence_invalid", "financing_source_action_evidence_invalid",
    "financing_missing_required_evidence", "missing_required_fields:published_at",
)
_UNCLASSED = ("classification_evidence_missing", "classification_evidence_invalid")
_CONFLICTS = tuple(f"financing_corroboration_{x}" for x in ("conflict", "date_outside_window", "round_conflict", "amount_conflict", "attribute_conflict"))


def distance(reason: Column) -> Column:
    """How far a pending reason is from a proof, 0 to 5."""
    out = F.lit(5)
    for rank, reasons in ((4, _CONFLICTS), (3, ("classification_rule_disagreement",)), (2, _UNCLASSED), (1, _ONE_PROOF), (0, _NEAR)):
        out = F.when(reason.isin(*reasons), rank).otherwise(out)
    return out


def priority(t: Mapping[str, Column]) -> list[Column]:
    """Order in which leads are followed up, best first.

    With an official site; only the date or at most one proof missing; fewer empty fields; nearer to a proof; grade B,
    then A, then C; fewer attempts; the latest, unknown dates as those of 1970; then by URL.
    t: official (count of sites), gaps (array), reason, organization, published_at, category, event_type, round, amount,
    grade, attempts, url.
    """
    empty = lambda c: F.when(F.coalesce(c.cast("string"), F.lit("")) == "", 1).otherwise(0)
    gap = F.when(F.coalesce(t["reason"] == "missing_required_fields:published_at", F.lit(False)), 0).when(F.coalesce(F.size(t["gaps"]), F.lit(0)) <= 1, 1).otherwise(2)
    either = F.when(F.coalesce(t["round"], F.lit("")) == "", t["amount"]).otherwise(t["round"])
    return [
        F.when(F.coalesce(t["official"], F.lit(0)) > 0, 0).otherwise(1).asc(), gap.asc(), sum((empty(t[c]) for c in ("organization", "published_at", "category", "event_type")), empty(either)).asc(),
        distance(t["reason"]).asc(), F.when(t["grade"] == "B", 0).when(t["grade"] == "A", 1).otherwise(2).asc(), F.coalesce(t["attempts"], F.lit(0)).asc(),
        F.coalesce(t["published_at"], F.timestamp_seconds(F.lit(0)).cast("timestamp_ntz")).desc(), t["url"].asc(),
    ]


def may_deliver(runs: DataFrame, day: Column, titles: Sequence[str]) -> DataFrame:
    """One row: is there no finished or running live delivery of that day yet.  runs: title, status, started_at."""
    live = runs.where(F.col("title").isin(*titles) & (F.to_date("started_at") == F.to_date(day)) & F.col("status").isin("success", "in_progress", "queued"))
    return live.agg((F.count("*") == 0).alias("deliver"))


def no_new(trace: DataFrame, search: str, step: str, url: str) -> DataFrame:
    """(search, step, n_new): URLs that a step finds first; two steps of none in a row end a search."""
    first = trace.groupBy(search, url).agg(F.min(step).alias(step)).groupBy(search, step).agg(F.count("*").alias("n"))
    return trace.select(search, step).distinct().join(first, [search, step], "left").select(search, step, F.coalesce("n", F.lit(0)).cast("long").alias("n_new"))


# --------------------------------------------------------------------- names and groups of leads
# Descriptors around company names, legal suffixes, and what to ask for per gap.
LEADING = ("商业航天企业", "商业航天公司", "星地激光通信企业", "空间激光通信企业", "激光通信企业", "火箭新锐公司", "航天新锐公司")
TRAILING = ("商业航天企业", "商业航天公司", "商业航天", "星地激光通信企业", "空间激光通信企业", "激光通信企业", "激光通信")
LEGAL = ("股份有限公司", "有限责任公司", "科技有限公司", "有限公司")
GAP_QUERIES: Mapping[str, str] = {
    "organization": "企业主体 公司全称", "published_at": "发布日期 发布时间 公告时间 官方披露", "amount": "融资金额 金额未披露 具体金额",
    "financing_round": "融资轮次 Pre-A Pre-A+", "financing_subtype": "融资类型 战略投资 增资 并购", "investors": "投资方 领投 跟投",
}


def plain_aliases(value: str | None) -> list[str]:
    """All names that a company may go by: full, without legal form, without its city, without 科技; sorted."""
    name = re.sub(r"[\s·•（）()“”\"'，,：:丨|]+", "", unicodedata.normalize("NFKC", value or "").casefold())
    name = re.sub(f"^(?:{'|'.join(LEADING)})+", "", name)
    name = re.sub(f"(?:{'|'.join(TRAILING)})+$", "", name)
    out = {name}
    legal = next((s for s in LEGAL if name.endswith(s)), None)
    if legal and (core := name.removesuffix(legal)):
        out.add(core)
        city = next((p for p in PLACES if core.startswith(p)), None)
        if city and (short := core.removeprefix(city)):
            out |= {short, short.removesuffix("科技") if len(short) > 3 else short}
    return sorted(x for x in out if x)


@F.pandas_udf(T.ArrayType(T.StringType()))
def aliases(names: pd.Series) -> pd.Series:
    return names.map(plain_aliases)


def title_key(title: Column) -> Column:
    return F.regexp_replace(F.lower(title), r"(?U)[\s*｜|_\-—:：·•（）()“”\"'，,]+", "")


def same_target(left: dict, right: dict, financing: str = lx.FINANCING) -> bool:
    """Two leads of one event: a shared alias, at most 7 days apart (30 for one round with fitting claims), same round or title."""
    if left["category"] != right["category"] or left["event_type"] != right["event_type"] or not set(left["aliases"]) & set(right["aliases"]):
        return False
    if any(x["day"] is None or x["day"] != x["day"] for x in (left, right)):
        return False
    mine, theirs = set(left["rounds"]), set(right["rounds"])
    amounts = left["amount"] and right["amount"] and left["amount"] != right["amount"]
    investors = len(left["investors"]) and len(right["investors"]) and not set(left["investors"]) & set(right["investors"])
    wide = left["category"] == financing and mine & theirs and not amounts and not investors
    if abs(int(left["day"]) - int(right["day"])) > (30 if wide else 7):
        return False
    return bool(mine & theirs) if mine and theirs else left["title_key"] == right["title_key"]


def group_targets(leads: DataFrame, pos: str, order: Sequence[str]) -> DataFrame:
    """(pos, leader): leads of one event, greedily in rank order; leads without a shared alias can never meet.

    leads: category, event_type, aliases, day (days since epoch), rounds, amount, investors (bare names), title_key; other
    columns stay behind.
    """
    needed = dict.fromkeys([pos, *order, "category", "event_type", "aliases", "day", "rounds", "amount", "investors", "title_key"])
    return fold(leads.select(*needed), pos, F.col("aliases"), order, same_target)


def group_keys(leads: DataFrame, groups: DataFrame, pos: str) -> DataFrame:
    """(leader, target_key): shortest alias, categories, event types, rounds or the first title, earliest day."""
    rows = leads.join(groups.withColumnRenamed("pos", pos), pos)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    shortest = lambda a: F.array_min(F.transform(a, lambda x: F.struct(F.char_length(x).alias("n"), x.alias("x"))))
    out = rows.groupBy("leader").agg(
        F.min(shortest(F.col("aliases"))).alias("name"), joined("category").alias("c"), joined("event_type").alias("e"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("rounds")))), ",").alias("r"),
        F.min("title_key").alias("t"), F.date_from_unix_date(F.min("day").cast("int")).alias("d"),
    )
    detail = F.when(F.col("r") != "", F.col("r")).otherwise(F.concat(F.lit("title:"), "t"))
    return out.select("leader", F.concat_ws("|", F.coalesce("name.x", F.lit("")), "c", "e", detail, F.coalesce(F.col("d").cast("string"), F.lit("date:unknown"))).alias("target_key"))


# --------------------------------------------------------------------- official sites and queries
def first_registered(host: Column, domains: Sequence[str]) -> Column:
    """The first of the domains that the host is, or is below."""
    out = F.lit(None).cast("string")
    for d in reversed(domains):
        out = F.when((host == d) | host.endswith("." + d), F.lit(d)).otherwise(out)
    return out


def gap_terms(gaps: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in GAP_QUERIES.items() for x in kv])
    return F.array_join(F.array_distinct(F.array_compact(F.transform(gaps, lambda g: table[g]))), " ")


def target_gaps(category: Column, reason: Column, financing_gaps: Column, financing: str = lx.FINANCING) -> Column:
    none = F.array().cast("array<string>")
    return F.when(reason == "missing_required_fields:published_at", F.array(F.lit("published_at"))).when((category == financing) & (reason == "financing_missing_required_evidence"), financing_gaps).otherwise(none)


def queries_for(category: Column, organization: Column, title: Column, round_: Column, investors: Column, gaps: Column, official: Column, used_domains: Column, media: Sequence[str], financing: str = lx.FINANCING) -> Column:
    """Search texts for a lead in order of preference: the official site, media not used yet, then general ones."""
    tidy = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r'(?U)["“”\s]+', " "))
    words = lambda *cs: F.array_join(F.filter(F.array(*cs), lambda x: x != ""), " ")
    event = words(tidy(organization), tidy(round_), F.lit("融资"))
    named = F.array_join(F.slice(F.filter(F.transform(F.coalesce(investors, F.array().cast("array<string>")), tidy), lambda x: x != ""), 1, 3), " ")
    asked = F.when(named != "", F.concat(named, F.lit(" 投资方"))).otherwise(F.lit("领投方 投资方"))
    terms, site = gap_terms(gaps), F.get(official, F.lit(0))
    first = F.when(site.isNotNull(), F.array(F.concat(event, F.lit(" "), terms, F.lit(" 官网 投资机构 官方披露 site:"), site))).otherwise(F.array().cast("array<string>"))
    fresh = F.filter(F.array(*[F.lit(d) for d in media]).cast("array<string>"), lambda d: ~F.array_contains(used_domains, d))
    more = F.transform(fresh, lambda d: F.concat(event, F.lit(" "), terms, F.lit(" "), asked, F.lit(" site:"), d))
    rest = F.array(*[F.concat(event, F.lit(" "), terms, F.lit(" "), t) for t in (asked, F.lit("新闻 报道"), F.lit("权威媒体 融资公告"))])
    matter = words(tidy(organization), tidy(title))
    bought = F.array(*[F.concat(matter, F.lit(t)) for t in (" 官方公告", " 项目编号", " 中标 变更 延期 终止")])
    every = F.when(category == financing, F.concat(first, more, rest)).when(category.isNotNull(), bought).otherwise(F.array().cast("array<string>"))
    return F.transform(every, lambda q: F.concat(q, F.lit(" 最近90天 中国境内")))


def query_key(query: Column) -> Column:
    """Queries that differ in white space or case only are one."""
    return F.lower(F.regexp_replace(query, r"(?U)\s+", ""))
