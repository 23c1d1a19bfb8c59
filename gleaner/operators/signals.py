"""Unverified signals of a report: diagnostics, the pending pool and bare candidates, without what is verified already.

The three sources follow each other, and an address that one has shown is not shown by the next.  Leads of a verified
financing are hidden, and what is left of one financing is merged, lead after lead, into one signal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text
from ..sources.shared import stored
from .aliases import contained
from .blocks import block_ids, in_blocks
from .report import held_subjects, identity_text, same_signal

DAYS, DAY_US, ZONE_US = 45, 86_400_000_000, 8 * 3_600_000_000
_LEAD = "branch int, pos long, category string, title string, organization string, round_name string, published_us long, url string, key string, evidence_count long, grade string, amount string, summary string"
_SIGNAL = "category string, label string, title string, organization string, published_us long, amount string, round_name string, summary string, source_urls array<string>, identity string"


def local_day(us: Column) -> Column:
    """The day in China of a time in microseconds."""
    return F.floor((us + ZONE_US) / DAY_US).cast("long")


def rounds_of(round_name: Column, title: Column) -> Column:
    return text.rounds(F.when(F.coalesce(round_name, F.lit("")) != "", round_name).otherwise(title))


def overlapping(leads: DataFrame, verified: DataFrame, days: int = DAYS) -> DataFrame:
    """(lead): leads that tell of a verified financing: its company is named, a round is shared, the dates are near.

    A verified financing without rounds fits any; a lead without rounds fits only those; a lead without a date fits any
    date.  leads: lead, said (identity text), rounds, day.  verified: company (identity text), rounds, day; rows without
    a company are left out.

    Dates meet by buckets of `days` days, of which a lead asks three; a company's bucket holds each set of rounds and
    day once, so neither a much reported company nor its leads make pairs in proportion to their product.
    """
    known = stored(verified.where("company <> ''").select("company", F.coalesce("rounds", F.array().cast("array<string>")).alias("rounds"), "day").distinct(), "verified")
    leads = stored(leads, "asked-leads")
    named = contained(leads.select(F.col("lead").alias("at"), "said"), known.select(F.col("company").alias("name"))).select(F.col("at").alias("lead"), F.col("name").alias("company"))
    bucket = lambda c: F.floor(c / days)
    dated = known.where("day is not null").groupBy("company", bucket(F.col("day")).alias("bucket")).agg(F.collect_set(F.struct("rounds", "day")).alias("own"))
    ever = known.groupBy("company").agg(F.collect_set("rounds").alias("own"))
    each = stored(named.join(leads.select("lead", F.coalesce("rounds", F.array().cast("array<string>")).alias("mine"), "day"), "lead"), "named-leads")
    fits = lambda theirs: (F.size(theirs) == 0) | F.arrays_overlap(theirs, F.col("mine"))
    near = each.where("day is not null").withColumn("bucket", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: bucket(F.col("day")) + k))).join(dated, ["company", "bucket"])
    near = near.where(F.exists("own", lambda o: fits(o["rounds"]) & (F.abs(o["day"] - F.col("day")) <= days)))
    any_day = each.where("day is null").join(ever, "company").where(F.exists("own", fits))
    return near.select("lead").unionByName(any_day.select("lead")).distinct()


def _leads(df: DataFrame, branch: int, **columns: Column | str) -> DataFrame:
    """df in the common form of a branch; columns that it has not are empty."""
    given = {k: F.col(c) if isinstance(c, str) else c for k, c in columns.items()} | {"branch": F.lit(branch)}
    return df.select(*[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in (x.split(" ") for x in _LEAD.split(", "))])


def _first_of_url(df: DataFrame) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy("url").orderBy("pos"))).where("__n = 1").drop("__n")


def surfaced(diagnostics: DataFrame, pending: DataFrame, candidates: DataFrame, verified: DataFrame, financing: str = lx.FINANCING) -> DataFrame:
    """The signals of the three branches before leads of one financing are merged, with branch and pos.

    diagnostics: pos, status, category, title, organization, financing_round, published_us, source_url, event_key,
    evidence_count, grade, amount, summary.  pending (in order of pos): pos, item_id, title, category, source_url,
    published_us.  candidates: pos, title, category, url, published_us.  verified: company, round_name, announced_us.
    Times are microseconds since 1970; rows without a category give no signal.

    Pending diagnostics of one event are one signal; the one with the most evidence, then of grade A or B, then of the
    last address speaks for it, and it is of high confidence with two addresses, or five proofs of grade A or B.
    """
    told = _leads(diagnostics.where("status = 'pending'"), 0, pos="pos", category="category", title="title", organization="organization", round_name="financing_round", published_us="published_us", url="source_url", key="event_key", evidence_count="evidence_count", grade="grade", amount="amount", summary="summary")
    pooled = _leads(pending, 1, pos="pos", category="category", title="title", published_us="published_us", url="source_url", key=F.concat(F.lit("pending:"), "item_id"))
    bare = _leads(candidates, 2, pos="pos", category="category", title="title", published_us="published_us", url="url", key=F.concat(F.lit("candidate:"), "url"))
    leads = stored(told.unionByName(pooled).unionByName(bare).where("category is not null").withColumn("lead", F.monotonically_increasing_id()), "leads")
    said = identity_text(F.concat_ws(" ", F.coalesce("organization", F.lit("")), "title"))
    asked = leads.where(F.col("category") == financing).select("lead", said.alias("said"), rounds_of(F.col("round_name"), F.col("title")).alias("rounds"), local_day(F.col("published_us")).alias("day"))
    done = verified.select(identity_text(F.col("company")).alias("company"), text.rounds(F.coalesce("round_name", F.lit(""))).alias("rounds"), local_day(F.col("announced_us")).alias("day"))
    left = stored(leads.join(overlapping(asked, done), "lead", "left_anti"), "open-leads")

    blank = lambda c: F.coalesce(c, F.lit(""))
    key = F.when(blank(F.col("key")) != "", F.col("key")).otherwise(F.concat_ws("|", blank(F.col("category")), blank(F.col("organization")), blank(F.col("round_name")), blank(F.col("title"))))
    graded = F.coalesce(F.col("grade").isin("A", "B"), F.lit(False))
    speaker = F.struct(F.coalesce("evidence_count", F.lit(0)).alias("n"), graded.alias("g"), blank(F.col("url")).alias("u"), (-F.col("pos")).alias("p"))
    shown = ("category", "title", "organization", "published_us", "amount", "round_name", "summary")
    groups = left.where("branch = 0").groupBy(key.alias("identity")).agg(
        F.min("pos").alias("pos"), F.max_by(F.struct(*shown), speaker).alias("s"), F.array_sort(F.collect_set("url")).alias("source_urls"), F.bool_or(graded & (F.coalesce("evidence_count", F.lit(0)) >= 5)).alias("strong"),
    )
    label = F.when((F.size("source_urls") >= 2) | F.col("strong"), "high_confidence").otherwise("candidate")
    first = stored(groups.select(F.lit(0).alias("branch"), "pos", "s.*", label.alias("label"), "source_urls", "identity"), "told-signals")

    seen = first.select(F.explode("source_urls").alias("url"))
    one = lambda df: _first_of_url(df).select("branch", "pos", *shown, F.lit("candidate").alias("label"), F.array("url").alias("source_urls"), F.col("key").alias("identity"))
    second = one(left.where("branch = 1").join(seen.distinct(), "url", "left_anti"))
    pool = seen.unionByName(pending.select(F.col("source_url").alias("url"))).distinct()  # all that is pending, shown or not
    third = one(left.where("branch = 2").join(pool, "url", "left_anti"))
    every = first.unionByName(second).unionByName(third)
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("organization", "amount", "round_name", "summary")]
    return every.select("branch", "pos", "category", "label", "title", "published_us", *texts, "source_urls", "identity")


# --------------------------------------------------------------------- one signal per financing
def _known(row: dict) -> dict:
    return row | {"published_us": None if row["published_us"] != row["published_us"] or row["published_us"] is None else int(row["published_us"]), "source_urls": list(row["source_urls"])}


def combined(left: dict, right: dict) -> dict:
    """Two signals of one financing as one; the more trusted, longer named, later, longer titled one speaks, else the left.

    subject, rounds, title_rounds, amount_text and day follow the texts that they come from.
    """
    rank = lambda s: (s["label"] == "high_confidence", len(s["organization"]), s["published_us"] or 0, len(s["title"]))
    speaker = right if rank(right) > rank(left) else left
    urls = sorted({*left["source_urls"], *right["source_urls"]})
    longer = lambda c: right if len(right[c]) > len(left[c]) else left
    dates = [s["published_us"] for s in (left, right) if s["published_us"] is not None]
    trusted = len(urls) >= 2 or "high_confidence" in (left["label"], right["label"])
    amount = next((s for s in (speaker, left, right) if s["amount"]), speaker)
    out = speaker | {
        "label": "high_confidence" if trusted else "candidate", "organization": longer("organization")["organization"], "published_us": max(dates, default=None), "amount": amount["amount"], "amount_text": amount["amount_text"],
        "round_name": longer("round_name")["round_name"], "round_rounds": longer("round_name")["round_rounds"], "summary": speaker["summary"] or left["summary"] or right["summary"], "source_urls": urls, "identity": f"{left['identity']}||{right['identity']}",
    }
    return out | {"org_subject": longer("organization")["org_subject"]}


def _as_lead(s: dict) -> dict:
    """What same_signal compares."""
    return {
        "subject": s["org_subject"] if s["organization"] else s["title_subject"], "rounds": s["round_rounds"] if s["round_name"] else s["title_rounds"], "amount": "=" + s["amount_text"] if s["amount"] else None,
        "day": None if s["published_us"] is None else (s["published_us"] + ZONE_US) // DAY_US,
    }


def merged(signals: DataFrame, financing: str = lx.FINANCING) -> DataFrame:
    """surfaced() with the signals of one financing combined, in order of branch and pos; other categories stay.

    A signal joins the first one before it that is, as combined so far, of the same financing.  A combined name is one of
    its members' names, so signals whose names hold one another, directly or over others, are a lossless block; one task
    folds a block, as every merge changes what the next one meets.
    """
    rows = signals.where(F.col("category") == financing).withColumn("org_subject", identity_text(F.col("organization"))).withColumn("title_subject", identity_text(F.col("title")))
    rows = rows.withColumn("round_rounds", text.rounds(F.col("round_name"))).withColumn("title_rounds", text.rounds(F.col("title"))).withColumn("amount_text", identity_text(F.col("amount")))
    rows = stored(rows.withColumn("at", F.monotonically_increasing_id()).withColumn("subject", F.when(F.col("organization") != "", F.col("org_subject")).otherwise(F.col("title_subject"))), "financing-signals")
    blocks = block_ids(rows, "at", F.array().cast("array<string>"), held_subjects(rows, "at", "subject"))
    names = [x.split(" ")[0] for x in _SIGNAL.split(", ")]

    def work(leads: list[dict]) -> list[tuple]:
        kept: list[dict] = []
        for row in map(_known, leads):
            at = next((i for i, s in enumerate(kept) if same_signal(_as_lead(s), _as_lead(row), DAYS)), None)
            if at is None:
                kept.append(row)
            else:
                kept[at] = combined(kept[at], row)
        return [tuple(s[c] for c in names) for s in kept]

    blocked = rows.join(blocks, rows["at"] == blocks["pos"]).select("block", rows["pos"], *[c for c in rows.columns if c != "pos"])
    found = in_blocks(blocked, ["branch", "pos"], work, _SIGNAL)
    return signals.where(F.col("category") != financing).select(*names).unionByName(found)


def in_order() -> list[Column]:
    """High confidence first, then the latest, unknown dates as the oldest, then by identity."""
    return [F.when(F.col("label") == "high_confidence", 0).otherwise(1).asc(), F.coalesce("published_us", F.lit(0)).desc(), F.col("identity").asc()]


def unverified(diagnostics: DataFrame, pending: DataFrame, candidates: DataFrame, verified: DataFrame, financing: str = lx.FINANCING) -> DataFrame:
    """The signals of a report; see surfaced(), merged() and in_order()."""
    return merged(stored(surfaced(diagnostics, pending, candidates, verified, financing), "signals"), financing)
