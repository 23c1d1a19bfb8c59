"""Report rows: groups, top-k per group, sections without repeated lines, rendered text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock
from ..functions import lexicon as lx
from ..functions.text import escape_markdown, money, short_summary
from ..sources.shared import stored
from .aliases import contained
from .blocks import fold


def groups(rows: DataFrame, keys: Sequence[str], url: str, rank: Column, id_col: str, strong: Column) -> DataFrame:
    """One row per signal: its rows, distinct sources, best row, and whether it is of high confidence."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_distinct(url).alias("n_urls"), F.max_by(id_col, rank).alias("representative"), ((F.count_distinct(url) >= 2) | F.bool_or(strong)).alias("high_confidence"),
    )


def top_per_group(rows: DataFrame, group: str, when: str, tie: str, ascending: Sequence[str] = (), most: int = 3) -> DataFrame:
    """The first rows of each group: earliest first in the ascending groups, latest first in the others."""
    day = F.datediff(F.col(when), F.lit("1970-01-01").cast("date"))
    order = Window.partitionBy(group).orderBy(F.when(F.col(group).isin(*ascending), day).otherwise(-day), tie)
    return rows.withColumn("place", F.row_number().over(order).cast("long")).where(F.col("place") <= most)


def first_sections(lines: DataFrame, section: str, pos: str, line: str) -> DataFrame:
    """Each distinct line once, in the first section and place it appears in."""
    first = lines.groupBy(line).agg(F.min(F.struct(section, pos)).alias("at"))
    return first.select(F.col(f"at.{section}").alias(section), F.col(f"at.{pos}").alias(pos), line)


def rendered(lines: DataFrame, titles: Sequence[str], section: str = "section", pos: str = "pos", line: str = "line", most: int = 10) -> DataFrame:
    """One row per section with its Markdown: a heading, at most `most` lines, and how many more there are."""
    ranked = lines.withColumn("__r", F.row_number().over(Window.partitionBy(section).orderBy(pos)))
    total = lines.groupBy(section).agg(F.count("*").alias("n"))
    shown = ranked.where(F.col("__r") <= most).groupBy(section).agg(F.array_sort(F.collect_list(F.struct("__r", escape_markdown(F.col(line)).alias("t")))).alias("l"))
    heading = F.element_at(F.array(*[F.lit(t) for t in titles]), F.col(section) + 1)
    more = F.when(F.col("n") > most, F.concat(F.lit("\n- … "), (F.col("n") - most).cast("string"))).otherwise("")
    body = F.array_join(F.transform("l", lambda x: F.concat(F.lit("- "), x["t"])), "\n")
    return shown.join(total, section).select(section, F.concat(F.lit("## "), heading, F.lit("\n"), body, more).alias("markdown"))


# --------------------------------------------------------------------- procurement groups and lines
# Which notices are open, which are results, and the words of the report.
ACTIONABLE = ("tender", "inquiry", "comparison", "rebid", "change", "extension")
RESULTS = ("procurement_intention", "candidate", "award", "failed", "termination")
CLOSED = ("evaluating", "awarded", "terminated", "failed", "completed", "closed")
AGGREGATORS = ("jianyu", "bidcenter", "zhaobiao", "qianlima", "chinabidding")
CATEGORY_ORDER = ("laser_communication", "laser_weapon", "eo_turret", "commercial_space_financing")


def procurement_group(event_type: Column, status: Column, deadline: Column, precision: Column, evidenced: Column, now: Column) -> Column:
    """results, opportunities or confirmation: a result or a passed deadline first, then evidenced open bids, then the other open ones.

    status is the project's, null for single events; evidenced: does a quote name the bid deadline.
    """
    dated = deadline.isNotNull() & precision.isNotNull()
    over = F.coalesce(clock.expired(deadline, precision, now), F.lit(False))
    act, done = F.coalesce(event_type.isin(*ACTIONABLE), F.lit(False)), F.coalesce(event_type.isin(*RESULTS) | status.isin(*CLOSED), event_type.isin(*RESULTS), F.lit(False))
    return (
        F.when(done | (dated & over), "results")
        .when(dated & evidenced & act, "opportunities")
        .when(act | F.coalesce(status.isin("upcoming", "open"), F.lit(False)), "confirmation")
        .otherwise("results")
    )


def remaining(deadline: Column, now: Column) -> Column:
    days = F.datediff(deadline, now)
    return F.when(days <= 0, "今日截止").otherwise(F.concat(days.cast("string"), F.lit("天")))


def clean_title(title: Column) -> Column:
    """A notice's title without the name of the site behind a dash or bar."""
    out = F.trim(F.regexp_replace(F.replace(title, F.lit("_"), F.lit(" ")), r"(?U)\s+", " "))
    out = F.regexp_replace(out, r"(?i)\s*[-｜|]\s*(?:官网[-｜|]?)?(?:[^-｜|]{0,30})?(?:招投标|招标采购|公共服务平台|招标网|采购网).*$", "")
    out = F.regexp_replace(out, r"\s*[-｜|]\s*(?:官网|公告详情|详情页).*$", "")
    return escape_markdown(F.regexp_replace(F.regexp_replace(out, r"^[ \-｜|]+", ""), r"[ \-｜|]+$", ""))


def is_aggregator(host: Column) -> Column:
    return F.coalesce(host.rlike("|".join(AGGREGATORS)), F.lit(False))


def link(label: Column, url: Column) -> Column:
    """A Markdown link; signs of the URL that would end it are percent-encoded."""
    safe = F.trim(url)
    for sign in ("%20", "%28", "%29", "%3C", "%3E"):
        safe = F.replace(safe, F.lit(bytes.fromhex(sign[1:]).decode()), F.lit(sign))
    return F.concat(F.lit("["), escape_markdown(label), F.lit("]("), safe, F.lit(")"))


def source_label(evidence: Column, url: Column) -> Column:
    """What kind of source a URL is, by the fields of its quotes."""
    said = F.lower(F.array_join(F.transform(F.filter(evidence, lambda e: e["source_url"] == url), lambda e: e["field"]), " "))
    return F.when(said.rlike("企业公告|company announcement"), "企业公告").when(said.rlike("投资方公告|investor announcement"), "投资方公告").when(said.rlike("权威媒体|authoritative media|official media"), "权威媒体报道").otherwise("来源")


def told_amount(amount: Column, disclosed: Column, evidence: Column) -> Column:
    """The amount in words; 未披露 where a quote says that it is not told; null where nothing is known."""
    hidden = F.exists(evidence, lambda e: (F.lower(e["field"]).contains("amount") | e["field"].contains("金额")) & e["quote"].rlike("未披露|未公布|未透露"))
    return F.when(F.coalesce(disclosed, F.lit(False)) & amount.isNotNull(), money(amount)).when(hidden, "未披露")


def reason_text(reason: Column, labels: Mapping[str, str], fields: Mapping[str, str]) -> Column:
    """A pending reason in words; missing fields are listed."""
    prefix = "missing_required_fields:"
    named = F.filter(F.split(F.substring(reason, len(prefix) + 1, 1_000_000), ","), lambda x: x != "")
    table = lambda m, k: F.coalesce(F.create_map(*[F.lit(x) for kv in m.items() for x in kv])[k], escape_markdown(k)) if m else escape_markdown(k)
    return F.when(reason.startswith(prefix), F.concat(F.lit("核验字段缺失（"), F.array_join(F.transform(named, lambda f: table(fields, f)), "、"), F.lit("）"))).otherwise(table(labels, reason))


def project_lines(projects: DataFrame, events: DataFrame, labels: Mapping[str, str] | None = None) -> DataFrame:
    """(project_id, line, chain): date, category, name, buyer, status and the chain of notices in order of time.

    projects: project_id, name, organization, category, status.  events: project_id, event_id, event_type,
    published_at, source_url.  Chains hold the notices of one project; the latest one gives the date and the link.
    """
    word = lx.mapped(F.col("event_type"), labels or {}, F.col("event_type"))
    day = F.date_format("published_at", "yyyy-MM-dd")
    each = events.select("project_id", F.struct("published_at", "event_id", "source_url", F.concat(link(word, F.col("source_url")), F.lit("（"), day, F.lit("）")).alias("text")).alias("e"))
    chain = each.groupBy("project_id").agg(F.max("e").alias("last"), F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["text"]), " → ").alias("chain"))
    rows = projects.join(chain, "project_id", "left")
    when = F.coalesce(F.date_format("last.published_at", "yyyy-MM-dd"), F.lit("日期未记录"))
    source = F.when(F.col("last").isNotNull(), link(F.lit("查看原始公告"), F.col("last.source_url")))
    line = F.concat_ws("｜", F.concat(F.lit("- "), when), "category", escape_markdown(F.col("name")), F.concat(F.lit("采购单位："), escape_markdown(F.col("organization"))), F.concat(F.lit("状态："), F.col("status")), source)
    return rows.select("project_id", line.alias("line"), F.coalesce("chain", F.lit("")).alias("chain"))


def rolling(projects: DataFrame, events: DataFrame, start: Column, end: Column) -> DataFrame:
    """(project_id, latest_at, completed) of the projects whose latest notice lies in the closed window."""
    last = events.groupBy("project_id").agg(F.max("published_at").alias("__at"), F.max_by("event_type", F.struct("published_at", "event_id")).alias("__type"))
    rows = projects.join(last, "project_id", "left").withColumn("latest_at", F.greatest("latest_event_at", "__at"))
    completed = F.coalesce(F.col("status").isin(*CLOSED[1:]) | F.coalesce("current_stage", "__type").isin("award", "termination", "failed"), F.lit(False))
    return rows.where(F.col("latest_at").between(start, end)).select("project_id", "latest_at", completed.alias("completed"))


def pending_order(published: Column, now: Column, item_id: Column) -> list[Column]:
    """Order of the pending pool: the last week, the last month, unknown dates, then all else; latest first, then by id."""
    label = clock.age_label(published, now)
    bucket = F.when(published.isNull(), 2).when(label == "last 7 days", 0).when(label == "8-30 days", 1).otherwise(3)
    return [bucket.asc(), F.coalesce(F.unix_micros(published.cast("timestamp")), F.lit(0)).desc(), item_id.asc()]


def by_deadline(deadlines: Column) -> list[Column]:
    """Order of open projects: the next supported deadline first, projects without one last, then by id."""
    return [F.array_min(F.map_values(deadlines)).asc_nulls_last(), F.col("project_id").asc()]


def trend_sentence(counts: DataFrame, category: str = "category", n: str = "n") -> DataFrame:
    """One row: how many verified events there are, and of which categories, in order of their names."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(category).alias("c"), F.col(n).alias("n"))))
    told = F.array_join(F.transform(pairs, lambda p: F.concat(p["c"], F.lit(" "), p["n"].cast("string"), F.lit("条"))), "、")
    total = F.coalesce(F.sum(n), F.lit(0))
    return counts.agg(F.when(total == 0, "统计期内无已核验事件。").otherwise(F.concat(F.lit("统计期内共有"), total.cast("string"), F.lit("条已核验事件："), told, F.lit("。"))).alias("summary"))


def trust_counts(items: DataFrame, category: str, label: str, categories: Sequence[str] = CATEGORY_ORDER) -> DataFrame:
    """One row per category, in order: verified, of high confidence, and candidates; categories without items count 0."""
    named = items.sparkSession.createDataFrame([(i, c) for i, c in enumerate(categories)], f"place int, {category} string")
    is_ = lambda x: F.count_if(F.col(label) == x)
    counts = items.groupBy(category).agg(is_("verified").alias("verified"), is_("high_confidence").alias("high_confidence"), is_("candidate").alias("candidate"))
    return named.join(counts, category, "left").fillna(0, ["verified", "high_confidence", "candidate"]).select("place", category, "verified", "high_confidence", "candidate")


def funnel_line(m: str = "") -> Column:
    """The collection funnel of a metrics row as one line."""
    c = lambda name: F.col(m + name).cast("string")
    return F.concat(
        F.lit("- 采集漏斗：博查原始 "), c("raw"), F.lit("；结构有效 "), c("valid"), F.lit("；主题相关 "), c("relevant"), F.lit("；近 7 天 "), c("recent"), F.lit("；补充 "), c("fallback"),
        F.lit("；日期未知补充 "), c("unknown"), F.lit("；最终候选 "), (F.col(m + "recent") + F.col(m + "fallback") + F.col(m + "unknown")).cast("string"),
    )


# --------------------------------------------------------------------- leads of one financing
def identity_text(value: Column) -> Column:
    """Letters, digits and plus signs only, lower case."""
    return F.regexp_replace(F.lower(F.coalesce(value, F.lit(""))), r"(?U)[^\w+]+", "")


def same_signal(left: dict, right: dict, days: int = 45) -> bool:
    """Leads of one financing: one name holds the other, rounds are equal or a subset, amounts and dates fit if known."""
    a, b = left["subject"], right["subject"]
    mine, theirs = set(left["rounds"]), set(right["rounds"])
    if not a or not b or not (a in b or b in a) or not mine or not theirs or not (mine <= theirs or theirs <= mine):
        return False
    if left["amount"] and right["amount"] and left["amount"] != right["amount"]:
        return False
    known = all(x["day"] is not None and x["day"] == x["day"] for x in (left, right))
    return not known or abs(int(left["day"]) - int(right["day"])) <= days


def held_subjects(leads: DataFrame, pos: str, subject: str) -> DataFrame:
    """(a, b): links of positions whose subjects hold one another, as few as connect them all."""
    names = stored(leads.where(F.col(subject) != "").groupBy(F.col(subject).alias("alias")).agg(F.min(pos).alias("first")), "subjects")
    same = leads.join(names, F.col(subject) == F.col("alias")).select(F.col("first").alias("a"), F.col(pos).alias("b"))
    found = contained(names.select(F.col("first").alias("at"), F.col("alias").alias("said")), names.select(F.col("alias").alias("name")))
    inside = found.join(names, F.col("name") == F.col("alias")).select(F.col("first").alias("a"), F.col("at").alias("b"))
    return same.unionByName(inside).where("a <> b")


def group_signals(leads: DataFrame, pos: str, order: Sequence[str]) -> DataFrame:
    """(pos, leader): leads of one financing, greedily in order; only leads whose names hold one another can meet.

    leads: subject (see identity_text), rounds, amount, day; other columns stay behind.
    """
    rows = leads.select(*dict.fromkeys([pos, *order, "subject", "rounds", "amount", "day"]))
    return fold(rows, pos, F.array().cast("array<string>"), order, same_signal, held_subjects(rows, pos, "subject"))


def merged_signals(leads: DataFrame) -> DataFrame:
    """One row per leader: sources united; the most trusted, longest named, latest lead speaks for all.

    leads: leader, title, organization, published_at, amount, round_name, summary, label, source_urls.
    """
    trusted = (F.col("label") == "high_confidence").cast("int")
    rank = F.struct(trusted.alias("t"), F.char_length("organization").alias("o"), F.coalesce("published_at", F.timestamp_seconds(F.lit(0))).alias("p"), F.char_length("title").alias("n"), F.col("title").alias("x"))
    filled = lambda c: F.max_by(c, F.when(F.coalesce(F.col(c), F.lit("")) != "", rank))
    longest = lambda c: F.max(F.struct(F.char_length(c).alias("n"), F.col(c).alias("v")))["v"]
    urls = F.array_sort(F.array_distinct(F.flatten(F.collect_set("source_urls"))))
    out = leads.groupBy("leader").agg(
        F.max_by("title", rank).alias("title"), longest("organization").alias("organization"), longest("round_name").alias("round_name"), F.max("published_at").alias("published_at"),
        filled("amount").alias("amount"), filled("summary").alias("summary"), urls.alias("source_urls"), F.max(trusted).alias("__t"),
    )
    high = (F.size("source_urls") >= 2) | (F.col("__t") == 1)
    return out.withColumn("label", F.when(high, "high_confidence").otherwise("candidate")).drop("__t")


# --------------------------------------------------------------------- size limits
def shortest_attempt(lines: DataFrame, titles: Sequence[str], limit: int, attempts: Sequence[tuple[int, int]] = ((3, 80), (2, 60), (1, 40))) -> DataFrame:
    """One row (markdown, items, chars): the report of the first attempt that fits the limit.

    lines: section (from 0), pos, line, summary.  An attempt shows so many items a section with summaries of so many
    characters.  Only the most items that any attempt shows leave their section.  Fails if no attempt fits.
    """
    most = max(n for n, _ in attempts)
    ranked = lines.withColumn("__r", F.row_number().over(Window.partitionBy("section").orderBy("pos"))).where(F.col("__r") <= most)
    shown = ranked.groupBy("section").agg(F.array_sort(F.collect_list(F.struct("__r", "line", "summary"))).alias("l"))
    one = shown.agg(F.map_from_entries(F.collect_list(F.struct("section", "l"))).alias("s"))

    def document(items: int, chars: int) -> Column:
        def section(i: int) -> Column:
            rows = F.slice(F.coalesce(F.col("s")[i], F.array().cast("array<struct<__r:int,line:string,summary:string>>")), 1, items)
            body = F.transform(rows, lambda x: F.concat(F.lit("- "), escape_markdown(x["line"]), F.when(F.coalesce(x["summary"], F.lit("")) != "", F.concat(F.lit("\n  "), escape_markdown(short_summary(x["summary"], chars)))).otherwise("")))
            return F.concat(F.lit(f"## {titles[i]}\n"), F.when(F.size(rows) == 0, F.lit("（无）")).otherwise(F.array_join(body, "\n")))

        return F.concat_ws("\n\n", *[section(i) for i in range(len(titles))])

    fitting = [F.when(F.char_length(d) <= limit, F.struct(d.alias("markdown"), F.lit(n).alias("items"), F.lit(c).alias("chars"))) for n, c in attempts for d in [document(n, c)]]
    failed = F.raise_error(F.lit("the report does not fit its limit")).cast("struct<markdown:string,items:int,chars:int>")
    return one.select(F.coalesce(*fitting, failed).alias("r")).select("r.*")


def within_limit(entries: DataFrame, fixed: int, limit: int) -> DataFrame:
    """Entries (project_id, latest_at, completed, size) without the oldest completed ones, as few as make the rest fit.

    size is the length of an entry's text and fixed that of all other text.  Open projects always stay.
    """
    total = entries.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("__total"))
    # One row per day of completed entries, then the order inside a day: no task holds all entries.
    day = F.to_date("latest_at")
    days = entries.where("completed").groupBy(day.alias("__day")).agg(F.sum("size").alias("__of_day"))
    days = days.select("__day", (F.sum("__of_day").over(Window.orderBy("__day")) - F.col("__of_day")).alias("__before"))
    inside = Window.partitionBy("completed", day).orderBy("latest_at", "project_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = entries.withColumn("__gone", F.sum("size").over(inside) - F.col("size")).join(days, day == F.col("__day"), "left").join(F.broadcast(total), how="cross")  # total is one row
    needed = F.col("completed") & (F.lit(fixed) + F.col("__total") - F.col("__before") - F.col("__gone") > limit)
    return ranked.where(~F.coalesce(needed, F.lit(False))).select(*entries.columns)


def coverage(search_degraded: Column, reasons: Column, failed_domains: Column, model_degraded: Column) -> Column:
    """What a run could not reach, in words."""
    domains = F.array_sort(F.array_distinct(failed_domains))
    details = F.concat(F.array_distinct(reasons), F.when(F.size(domains) > 0, F.array(F.concat(F.lit("官方来源访问失败："), F.array_join(F.transform(domains, escape_markdown), "、")))).otherwise(F.array().cast("array<string>")))
    search = F.when(search_degraded, F.when(F.size(details) > 0, F.concat(F.lit("搜索（"), F.array_join(details, "；"), F.lit("）"))).otherwise("搜索"))
    parts = F.array_compact(F.array(search, F.when(model_degraded, F.lit("AI"))))
    return F.when(F.size(parts) > 0, F.concat(F.lit("降级（"), F.array_join(parts, "、"), F.lit("）"))).otherwise("正常")
