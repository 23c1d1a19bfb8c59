"""Report items of verified financings: one per shown event, labelled by when it was reported, as lines of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.text import escape_markdown, short_summary
from ..sources.shared import stored
from .blocks import fold
from .report import link, source_label, told_amount

#: What stands for the round of a financing that names none, by its kind.
ROUND_OF_KIND = {"strategic": "战略融资", "capital_increase": "产业基金增资", "merger_acquisition": "并购融资"}
SHOWN_DAYS = 45


def same_shown(left: dict, right: dict, days: int = SHOWN_DAYS) -> bool:
    """Verified financings that are shown as one: one company, rounds of which one set holds the other, a common source."""
    mine, theirs = set(left["rounds"]), set(right["rounds"])
    if left["identity"] != right["identity"] or not mine or not theirs or not (mine <= theirs or theirs <= mine):
        return False
    near = all(x["day"] is not None and x["day"] == x["day"] for x in (left, right)) and abs(int(left["day"]) - int(right["day"])) <= days
    return near and bool(set(left["sources"]) & set(right["sources"]))


def shown(financings: DataFrame, changed: DataFrame, start: Column, end: Column) -> DataFrame:
    """The verified financings whose latest report lies in the closed window, one for each event that is shown.

    In order: those changed in this run, then the latest, then by id; a financing that is the same as one before it that
    is shown is left out.  Only financings of one company with a common source can be the same.
    Adds latest_at, changed and place (ascending along that order, not gapless).

    financings: financing_id, status, company, round_name, subtype, announced_at, source_dates (map), source_url,
    source_urls and any other columns.  changed: financing_id.
    """
    latest = F.greatest("announced_at", F.array_max(F.map_values("source_dates")))
    touched = changed.select("financing_id").distinct().withColumn("__changed", F.lit(True))
    rows = financings.where("status = 'verified'").withColumn("latest_at", latest).where(F.col("latest_at").between(start, end)).join(touched, "financing_id", "left").withColumn("changed", F.coalesce("__changed", F.lit(False))).drop("__changed")
    sources = F.array_distinct(F.concat(F.array("source_url"), F.coalesce("source_urls", F.array().cast("array<string>"))))
    ranked = rows.orderBy(F.desc("changed"), F.desc("latest_at"), "financing_id").withColumn("place", F.monotonically_increasing_id())
    ranked = stored(ranked, "shown-financings")
    keyed = ranked.select("place", text.organization(F.col("company")).alias("identity"), text.rounds(F.col("round_name")).alias("rounds"), F.datediff("announced_at", F.lit("1970-01-01").cast("date")).cast("long").alias("day"), F.array_compact(sources).alias("sources"))
    keys = F.transform("sources", lambda s: F.concat_ws("\x01", "identity", s))
    leads = fold(stored(keyed, "shown-keys"), "place", keys, ["place"], same_shown, scope=F.coalesce("identity", F.lit("\x02"))).where("pos = leader").select(F.col("pos").alias("place"))
    return ranked.join(leads, "place", "left_semi")


def report_label(latest: Column, changed: Column, start: Column, end: Column) -> Column:
    """daily where the latest report is of the day's window, historical where the run changed an older one, else rolling."""
    return F.when(latest.between(start, end), "daily").when(changed, "historical").otherwise("rolling")


def source_links(evidence: Column, urls: Column) -> Column:
    """Links to the first two sources, labelled by kind; kinds that several sources share are numbered."""
    labels = F.transform(urls, lambda u: source_label(evidence, u))

    def named(i: int) -> Column:
        mine, url = F.get(labels, F.lit(i)), F.get(urls, F.lit(i))
        many = F.size(F.filter(labels, lambda x: x == mine)) > 1
        before = F.size(F.filter(F.slice(labels, 1, i + 1), lambda x: x == mine))
        return F.when(url.isNotNull(), link(F.when(many, F.concat(mine, before.cast("string"))).otherwise(mine), url))

    return F.array_compact(F.array(named(0), named(1)))


def structured_summary(company: Column, round_name: Column, amount: Column, investors: Column, area: Column, limit: int = 120) -> Column:
    """A sentence of the facts of a financing."""
    told = lambda lead, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(lead), c)).otherwise("")
    some = F.array_join(F.slice(F.array_sort(F.coalesce(investors, F.array().cast("array<string>"))), 1, 3), "、")
    return F.substring(F.concat(company, F.lit("完成"), F.coalesce(F.nullif(round_name, F.lit("")), F.lit("股权融资")), told("，披露金额", amount), told("，投资方包括", some), told("，业务聚焦", area)), 1, limit)


_WORDS = {"daily": "已核实·今日新增", "historical": "已核实·历史补录", "rolling": "已核实·滚动池"}


def financing_lines(items: DataFrame, start: Column, end: Column) -> DataFrame:
    """(financing_id, place, label, lines) of shown() rows; start and end bound the day's window.

    Needs besides: amount_cny, amount_disclosed, investors, business_area, brief_summary, evidence (array of field,
    quote, source_url).
    """
    label = report_label(F.col("latest_at"), F.col("changed"), start, end)
    words = F.coalesce(*[F.when(F.col("label") == k, F.lit(v)) for k, v in _WORDS.items()])
    kind = F.coalesce(*[F.when(F.col("subtype") == k, F.lit(v)) for k, v in ROUND_OF_KIND.items()], F.lit("融资"))
    round_text = escape_markdown(F.coalesce(F.nullif("round_name", F.lit("")), kind))
    amount = told_amount(F.col("amount_cny"), F.col("amount_disclosed"), F.col("evidence"))
    company, none = escape_markdown(F.col("company")), F.array().cast("array<string>")
    backers = F.array_join(F.transform(F.array_sort(F.coalesce("investors", none)), escape_markdown), "、")
    area = F.coalesce("business_area", F.lit(""))
    summary = F.coalesce(F.nullif("brief_summary", F.lit("")), structured_summary(F.col("company"), F.col("round_name"), amount, F.col("investors"), F.col("business_area")))
    urls = F.array_sort(F.array_distinct(F.array_compact(F.concat(F.array("source_url"), F.coalesce("source_urls", none)))))
    links = source_links(F.col("evidence"), urls)
    said = lambda lead, c: F.concat(F.lit(f"  - {lead}："), c)
    lines = F.array(
        F.concat(F.lit("- **【"), words, F.lit("】"), company, F.lit("完成"), round_text, F.lit("**")), said("企业", company), said("时间", F.date_format("announced_at", "yyyy-MM-dd")), said("轮次", round_text),
        said("金额", F.coalesce(amount, F.lit("未明确披露"))), F.when(backers != "", said("投资方", backers)), F.when(area != "", said("业务方向", escape_markdown(area))), said("摘要", short_summary(summary, 120)),
        F.when(F.size(links) > 0, said("来源", F.array_join(links, "｜"))),
    )
    return items.withColumn("label", label).select("financing_id", "place", "label", F.array_compact(lines).alias("lines"))


def procurements(projects: DataFrame, events: DataFrame, changed_projects: DataFrame, changed_events: DataFrame, start: Column, end: Column, day_start: Column, day_end: Column) -> DataFrame:
    """(kind, id, latest_at, changed, label, event_id, event_type): procurements to show, projects and single notices.

    A project is shown if its latest notice is verified and its latest date lies in the closed window; then none of its
    notices is shown alone.  Of the other notices those that are verified, formal and dated in the window are.  Label and
    order are those of financings; see in_order().  Notices of no project that is shown meet by an anti join on ids.

    projects: project_id, event_ids (array), latest_event_at.  events: event_id, event_type, published_at, status, formal.
    """
    own = projects.select("project_id", "latest_event_at", F.explode_outer("event_ids").alias("event_id"))
    at = F.struct("published_at", "event_id", "event_type", "status")
    last = own.join(events, "event_id", "left").groupBy("project_id").agg(F.max("latest_event_at").alias("dated"), F.max(F.when(F.col("published_at").isNotNull(), at)).alias("e"))
    latest = F.greatest("dated", F.col("e.published_at"))
    whole = last.where(F.col("e").isNotNull() & (F.col("e.status") == "verified") & latest.between(start, end)).select(F.lit("project").alias("kind"), F.col("project_id").alias("id"), latest.alias("latest_at"), "e.event_id", "e.event_type")
    covered = own.join(whole.select(F.col("id").alias("project_id")), "project_id", "left_semi").select("event_id").distinct()
    single = events.where((F.col("status") == "verified") & F.col("formal") & F.col("published_at").between(start, end)).join(covered, "event_id", "left_anti")
    single = single.select(F.lit("event").alias("kind"), F.col("event_id").alias("id"), F.col("published_at").alias("latest_at"), "event_id", "event_type")
    touched = changed_projects.select(F.lit("project").alias("kind"), F.col("project_id").alias("id")).unionByName(changed_events.select(F.lit("event").alias("kind"), F.col("event_id").alias("id"))).distinct().withColumn("__changed", F.lit(True))
    rows = whole.unionByName(single).join(touched, ["kind", "id"], "left").withColumn("changed", F.coalesce("__changed", F.lit(False)))
    return rows.select("kind", "id", "latest_at", "changed", report_label(F.col("latest_at"), F.col("changed"), day_start, day_end).alias("label"), "event_id", "event_type")


def in_order() -> list[Column]:
    """Changed in this run first, then the latest, then by id."""
    return [F.desc("changed"), F.desc("latest_at"), F.asc("id")]
