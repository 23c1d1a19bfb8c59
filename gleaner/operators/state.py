"""State tables: roll-ups, merges, upserts, change sets, counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, text
from ..functions import lexicon as lx


def status_of(stage: Column, table: Mapping[str, str] = lx.STAGE_STATUS) -> Column:
    """The status that a stage sets; null for stages that keep the status before them."""
    return F.when(stage.isin(*lx.KEEP_STATUS), F.lit(None).cast("string")).otherwise(lx.mapped(stage, table, F.lit("open")))


def rollup(events: DataFrame, key: str, when: str, event: str, stage: str) -> DataFrame:
    """One row per project: count, first and latest event, latest stage, status after the whole chain.

    max_by over (time, id) pairs combines before the shuffle, so a project of very many events stays cheap.
    """
    at = F.struct(F.col(when), F.col(event))
    keeps = status_of(F.col(stage)).isNull()
    return events.groupBy(key).agg(
        F.count("*").alias("n_events"), F.min(when).alias("first_at"), F.max(when).alias("latest_at"), F.max_by(event, at).alias("latest_event"), F.max_by(stage, at).alias("latest_stage"),
        F.coalesce(F.max_by(status_of(F.col(stage)), F.when(~keeps, at)), F.lit("open")).alias("status"),
        F.max_by(F.when(stage_done(F.col(stage)), F.lit(False)).otherwise(F.lit(True)), at).alias("recheck"),
    )


def stage_done(stage: Column) -> Column:
    return stage.isin("award", "termination")


def chain(events: DataFrame, key: str, when: str, event: str, stage: str, most: int | None = None) -> DataFrame:
    """The ordered chain of a project's stages, as text; `most` keeps the latest ones only."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(when), F.col(event), F.col(stage))))
    shown = pairs if most is None else F.slice(pairs, F.greatest(F.lit(1), F.size(pairs) - most + 1), most)
    return events.groupBy(key).agg(F.array_join(F.transform(shown, lambda p: p[stage]), " → ").alias("chain"), F.count("*").alias("n_events"))


def upsert_pending(old: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """One row per url: counters carried over and raised, the newest reason wins, first-seen time is kept.

    old: url, reason, attempts, first_seen, last_seen; new: url, reason, pos.
    """
    newest = new.groupBy("url").agg(F.max_by("reason", "pos").alias("new_reason"), F.count("*").alias("more"))
    both = old.join(newest, "url", "full_outer")
    return both.select(
        "url", F.coalesce("new_reason", "reason").alias("reason"), (F.coalesce("attempts", F.lit(0)) + F.coalesce("more", F.lit(0))).cast("long").alias("attempts"),
        F.coalesce("first_seen", now).alias("first_seen"), F.when(F.col("new_reason").isNotNull(), now).otherwise(F.col("last_seen")).alias("last_seen"),
    )


def resolve_pending(pending: DataFrame, resolved: DataFrame) -> DataFrame:
    return pending.join(resolved.select("url").distinct(), "url", "left_anti")


def changed(rows: DataFrame, ids: DataFrame, start: Column, end: Column, key: str, *times: str) -> DataFrame:
    """Rows touched in this run or with one of their times in the closed window."""
    inside = F.lit(False)
    for t in times:
        inside |= F.coalesce(F.col(t).between(start, end), F.lit(False))
    marked = rows.join(ids.select(key).distinct().withColumn("__run", F.lit(True)), key, "left")
    return marked.where(F.col("__run").isNotNull() | inside).drop("__run")


def merge_financings(reports: DataFrame, key: Column, when: str, amount: str, source: str) -> DataFrame:
    """One row per financing: sources united, dates spanned, the latest known amount kept."""
    at = F.when(F.col(amount).isNotNull(), F.struct(F.col(when), F.col(source)))
    return reports.groupBy(key.alias("financing_key")).agg(
        F.min(when).alias("announced_at"), F.max(when).alias("updated_at"), F.max_by(amount, at).alias("amount_cny"),
        F.array_sort(F.collect_set(source)).alias("sources"), F.count("*").alias("reports"),
    )


def first_per(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


# --------------------------------------------------------------------- rows of the state
DEADLINES = ("registration", "bid_submission", "opening")


def deadline_state(deadlines: Column, precision: Column, evidence: Column) -> Column:
    """(deadlines, evidence, precision) maps of the known deadlines; evidence is an array of field, quote, source_url."""
    known = F.map_filter(deadlines, lambda k, v: k.isin(*DEADLINES) & v.isNotNull())
    quotes = F.map_from_entries(F.transform(F.array_distinct(F.transform(F.filter(evidence, lambda e: e["field"].endswith("_deadline")), lambda e: e["field"])), lambda f: F.struct(F.regexp_replace(f, "_deadline$", "").alias("k"), F.element_at(F.filter(evidence, lambda e: e["field"] == f), -1).alias("v"))))
    within = lambda m: F.map_filter(m, lambda k, v: F.map_contains_key(known, k))
    return F.struct(known.alias("deadlines"), within(quotes).alias("evidence"), within(precision).alias("precision"))


def supported_deadlines(deadlines: Column, evidence: Column, precision: Column) -> Column:
    return F.map_filter(deadlines, lambda k, v: k.isin(*DEADLINES) & F.map_contains_key(evidence, k) & F.map_contains_key(precision, k))


def overlaid(old: Column, new: Column) -> Column:
    """The old map with the values of the new one where that has the key."""
    return F.map_zip_with(old, new, lambda k, x, y: F.coalesce(y, x))


def event_rows(notices: DataFrame, prefix: str = "gleaner:event:") -> DataFrame:
    """Formal events of verified notices: version, fingerprint, id and seen times.

    notices: event_type, published_at, source_url, title, content_hash, discovered_at and any other columns of an event.
    """
    version = ids.version_id(F.col("source_url"), F.col("content_hash"))
    out = notices.withColumn("content_version_id", version)
    out = out.withColumn("fingerprint", ids.event_fingerprint(F.col("event_type"), F.col("published_at"), F.col("source_url"), F.col("title"), F.col("content_version_id")))
    return out.withColumn("event_id", ids.event_id(F.col("fingerprint"), prefix)).withColumn("first_seen_at", F.col("discovered_at")).withColumn("updated_at", F.col("discovered_at"))


def new_projects(events: DataFrame) -> DataFrame:
    """One project row for each event that opens a project.

    events: event_id, title, organization, category, event_type, published_at, project_codes, amount, source_url,
    first_seen_at, updated_at.
    """
    return events.select(
        ids.project_id(F.col("organization"), F.col("project_codes"), F.col("title")).alias("project_id"), F.col("title").alias("name"), "organization", "category", F.coalesce(status_of(F.col("event_type")), F.lit("open")).alias("status"),
        F.array("event_id").alias("event_ids"), "project_codes", text.normalize_nfkc(F.col("title")).alias("normalized_name"), F.col("event_type").alias("current_stage"), "amount", F.col("published_at").alias("first_published_at"),
        F.col("published_at").alias("latest_event_at"), F.col("source_url").alias("latest_source_url"), (~stage_done(F.col("event_type"))).alias("needs_recheck"), F.year("published_at").alias("year"), "first_seen_at", "updated_at",
    )


def financing_rows(reports: DataFrame, prefix: str = "gleaner:financing:") -> DataFrame:
    """Financing rows of verified reports: amount in yuan, sorted sources, their dates and versions, fingerprint and id.

    reports: organization, published_at, amount, amount_disclosed, investors, financing_round, financing_subtype,
    source_url, content_hash, discovered_at, records (array of source_url, published_at, content_hash).
    """
    yuan = text.amount_cny(F.col("amount"))
    mine = F.struct(F.col("source_url").alias("source_url"), F.col("published_at").alias("published_at"), F.lower("content_hash").alias("content_hash"))
    all_ = F.concat(F.transform("records", lambda r: F.struct(r["source_url"].alias("source_url"), r["published_at"].alias("published_at"), F.lower(r["content_hash"]).alias("content_hash"))), F.array(mine))
    out = reports.withColumn("amount_cny", yuan).withColumn("__all", all_).withColumn("source_urls", F.array_sort(F.array_distinct(F.transform("__all", lambda r: r["source_url"]))))
    first = lambda url: F.element_at(F.filter("__all", lambda r: r["source_url"] == url), 1)
    out = out.withColumn("source_published_at", F.map_from_entries(F.transform("source_urls", lambda u: F.struct(u.alias("k"), first(u)["published_at"].alias("v")))))
    versions = F.array_sort(F.array_distinct(F.transform("__all", lambda r: ids.version_id(r["source_url"], r["content_hash"]))))
    names = F.transform("investors", lambda i: text.normalize(i))
    print_ = ids.financing_fingerprint(F.col("published_at"), ids.amount_text(F.col("amount_cny")), text.normalize_nfkc(F.col("organization")), names, text.normalize_nfkc(F.coalesce("financing_round", F.lit(""))), F.col("financing_subtype"))
    out = out.withColumn("content_version_ids", versions).withColumn("fingerprint", print_).drop("__all")
    disclosed = F.coalesce("amount_disclosed", F.col("amount_cny").isNotNull())
    return out.withColumn("amount_disclosed", disclosed).withColumn("financing_id", ids.uuid5(F.concat(F.lit(prefix), "fingerprint"))).withColumn("first_seen_at", F.col("discovered_at")).withColumn("updated_at", F.col("discovered_at"))


def latest_known(announced: Column, dates: Column) -> Column:
    """The latest of a financing's announcement and its sources' dates (a map)."""
    return F.greatest(announced, F.array_max(F.map_values(dates)))


# --------------------------------------------------------------------- pool and upgrade
def pending_pool(pending: DataFrame, reasons, now: Column, days: int) -> DataFrame:
    """Pending rows with an eligible reason and a date in the last `days` days, as candidates again."""
    at = F.coalesce("source_published_at", "discovered_at")
    rows = pending.where(F.col("reason").isin(*reasons) & at.between(now - F.make_dt_interval(F.lit(days)), now))
    return rows.select("title", F.col("source_url").alias("url"), "summary", "discovered_at", F.lit("verification_pool").alias("discovery_source"), "category_hint", "source_published_at")


def upgraded_events(events: DataFrame) -> DataFrame:
    """Events of an older version with the hashes and times that they lack."""
    legacy = ids.canonical_hash(event_type=F.col("event_type"), organization=F.col("organization"), published_at=ids.utc_text(F.col("published_at")), source_url=F.col("source_url"), title=F.col("title"))
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    out = events.withColumn("content_hash", F.coalesce(filled("content_hash"), legacy)).withColumn("discovered_at", F.coalesce("discovered_at", "published_at"))
    out = out.withColumn("content_version_id", F.coalesce(filled("content_version_id"), ids.version_id(F.col("source_url"), F.col("content_hash"))))
    out = out.withColumn("first_seen_at", F.coalesce("first_seen_at", "discovered_at"))
    return out.withColumn("updated_at", F.coalesce("updated_at", "first_seen_at"))


def upgraded_projects(projects: DataFrame) -> DataFrame:
    out = projects.withColumn("first_seen_at", F.coalesce("first_seen_at", "first_published_at", "latest_event_at"))
    return out.withColumn("updated_at", F.coalesce("updated_at", "latest_event_at", "first_seen_at"))


def upgraded_financings(financings: DataFrame) -> DataFrame:
    """The same for financings; the primary source's hash and version join those of the other sources."""
    legacy = ids.canonical_hash(announced_at=ids.utc_text(F.col("announced_at")), company=F.col("company"), round_name=F.col("round_name"), source_url=F.col("source_url"))
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    out = financings.withColumn("content_hash", F.coalesce(filled("content_hash"), legacy)).withColumn("discovered_at", F.coalesce("discovered_at", "announced_at"))
    out = out.withColumn("content_version_id", F.coalesce(filled("content_version_id"), ids.version_id(F.col("source_url"), F.col("content_hash"))))
    held = F.coalesce("source_content_hashes", F.map_from_entries(F.array().cast("array<struct<k:string,v:string>>")))
    out = out.withColumn("source_content_hashes", overlaid(F.create_map("source_url", "content_hash"), held))
    versions = F.coalesce("source_content_version_ids", F.array().cast("array<string>"))
    out = out.withColumn("source_content_version_ids", F.array_sort(F.array_union(versions, F.array("content_version_id"))))
    out = out.withColumn("first_seen_at", F.coalesce("first_seen_at", "discovered_at"))
    return out.withColumn("updated_at", F.coalesce("updated_at", "first_seen_at"))
