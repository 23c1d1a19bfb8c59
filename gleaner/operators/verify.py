"""Evidence checks: graded domains, grounding, decision cascades, independent corroboration, deadlines."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock, urls
from .aliases import found_names


def graded(df: DataFrame, url: str, registry: DataFrame, default: str = "C") -> DataFrame:
    """df with host, registered domain and grade: the longest registered suffix of the host counts.

    registry: domain, grade.  It is a dimension table; Spark broadcasts it while it is small.
    """
    hosts = df.select(urls.host(F.col(url)).alias("host")).distinct()
    found = hosts.select("host", F.explode(urls.host_suffixes(F.col("host"))).alias("domain")).join(registry, "domain")
    best = found.groupBy("host").agg(F.max_by(F.struct("domain", "grade"), F.length("domain")).alias("best")).select("host", F.col("best.domain").alias("domain"), F.col("best.grade").alias("grade"))
    return df.withColumn("host", urls.host(F.col(url))).join(best, "host", "left").withColumn("grade", F.coalesce("grade", F.lit(default)))


def grounded(quote: Column, body: Column, title: Column | None = None) -> Column:
    """A quote that is not blank and stands in the body or the title."""
    q = F.coalesce(quote, F.lit(""))
    inside = F.coalesce(body.contains(q), F.lit(False))
    if title is not None:
        inside |= F.coalesce(title.contains(q), F.lit(False))
    return q.rlike(r"(?U)\S") & inside


def groundings(docs: DataFrame, quotes: DataFrame, doc_id: str, body: str, quote_id: str, quote: str) -> DataFrame:
    """(doc_id, quote_id) of the documents in which a quote that is not blank stands, whatever the quote is made of.

    The quotes are the names of an automaton (see aliases), which passes once over each document; no document is held
    against the quotes one by one, and no join carries texts.  Ids are numbers; rows of one id count once.
    """
    named = quotes.where(F.col(quote).rlike(r"(?U)\S")).select(F.lit("").alias("kind"), F.lit(0).alias("place"), F.col(quote_id).cast("string").alias("domain"), F.col(quote).alias("alias"))
    probes = docs.where(F.col(body).isNotNull()).select(F.col(doc_id).cast("long").alias("probe"), F.lit(0).alias("stage"), F.lit(0).alias("sub"), F.col(body).alias("said"), F.lit(False).alias("as_name"), F.lit(None).cast("string").alias("kinds"))
    kind = {f.name: f.dataType for f in (docs.schema[doc_id], quotes.schema[quote_id])}
    found = found_names(probes, named, bare=None)
    return found.select(F.col("probe").cast(kind[doc_id]).alias(doc_id), F.col("domain").cast(kind[quote_id]).alias(quote_id))


def cascade(rules: Sequence[tuple[Column, str, str]], status: str = "verified", reason: str = "verified") -> tuple[Column, Column]:
    """(status, reason) of the first rule that holds; rules are (condition, status, reason)."""
    s, r = F.lit(status), F.lit(reason)
    for condition, own_status, own_reason in reversed(rules):
        s = F.when(condition, F.lit(own_status)).otherwise(s)
        r = F.when(condition, own_reason if isinstance(own_reason, Column) else F.lit(own_reason)).otherwise(r)
    return s, r


def missing(**fields: Column) -> Column:
    """Comma list of the fields that are null or blank, in the given order; '' if none."""
    gaps = [F.when(c.isNull() | ~c.cast("string").rlike(r"(?U)\S"), F.lit(name)) for name, c in fields.items()]
    return F.array_join(F.array_compact(F.array(*gaps)), ",")


def decision(a: dict[str, Column]) -> tuple[Column, Column]:
    """The verification cascade over a row of named columns, in order; the first rule that holds decides.

    a: in_china, in_scope, title, organization, published_at, category, event_type, url_matches, grounded, http_status,
    grade, class_failure, deadline_failure, tender_evidence, tender_claims, financing_failure, corroborated,
    corroboration_reason.
    """
    gaps = missing(title=a["title"], organization=a["organization"], published_at=a["published_at"], category=a["category"], event_type=a["event_type"])
    is_fin, is_fin_event = a["category"].contains("financing"), a["event_type"] == "financing"
    a_b = a["grade"].isin("A", "B")
    rules = [
        (~(a["in_china"] & a["in_scope"]), "rejected", "out_of_scope"),
        (gaps != "", "pending", F.concat(F.lit("missing_required_fields:"), gaps)),
        (~a["url_matches"], "pending", "source_url_mismatch"),
        (~a["grounded"], "pending", "evidence_not_grounded"),
        (is_fin != is_fin_event, "pending", "category_event_type_mismatch"),
        (~a["http_status"].between(200, 299), "pending", "source_unavailable"),
        (~is_fin & (a["grade"] != "A"), "pending", "tender_requires_grade_a"),
        (~is_fin & a["class_failure"].isNotNull(), "pending", a["class_failure"]),
        (~is_fin & a["deadline_failure"].isNotNull(), "pending", a["deadline_failure"]),
        (~is_fin & ~a["tender_evidence"], "pending", "tender_missing_required_evidence"),
        (~is_fin & ~a["tender_claims"], "pending", "evidence_not_grounded"),
        (~is_fin, "verified", "verified_tender"),
        (a_b & a["class_failure"].isNotNull(), "pending", a["class_failure"]),
        (a_b & a["financing_failure"].isNotNull(), "pending", a["financing_failure"]),
        (a["grade"] == "A", "verified", "verified_financing_official_source"),
        ((a["grade"] == "B") & a["corroborated"], "verified", "verified_financing_two_independent_sources"),
        (a["grade"] == "B", "pending", F.coalesce(a["corroboration_reason"], F.lit("financing_requires_official_or_two_independent_b_sources"))),
    ]
    return cascade(rules, "pending", "financing_requires_official_or_two_independent_b_sources")


def related(a: str, b: str) -> bool:
    """Equal domains, or one below the other."""
    return a == b or a.endswith("." + b) or b.endswith("." + a)


def first_strangers(rows: list[tuple]) -> list[tuple]:
    """Of rows (pos, domain, content) in order, those that are the first unrelated row of some domain.

    The domains for which all kept rows are related ones are known by one name: while the kept domains lie below each
    other, those above or below the lowest of them; once two of them fork, those at or above the fork.
    """
    kept, name, forked = [], None, False
    for row in rows:
        domain = row[1]
        if name is None:
            kept, name = [row], domain
        elif not forked and domain.endswith("." + name):
            kept.append(row)
            name = domain
        elif not related(domain, name):
            kept.append(row)
            a, b = name.split("."), domain.split(".")
            n = next((i for i in range(1, min(len(a), len(b)) + 1) if a[-i] != b[-i]), min(len(a), len(b)) + 1) - 1
            if not n:
                break  # no domain is related to both
            name, forked = ".".join(a[-n:]), True
    return kept


def summary(rows: list[tuple]) -> list[tuple]:
    """The rows (pos, domain, content) that can be a row's first partner: of another, unrelated domain and content.

    For contents that no first stranger has, the first strangers suffice; for each content that one has, the first
    strangers among rows of other contents.  Their number is bounded by the depth of domain names, squared, however many
    rows there are, and the summary of joined summaries is the summary of all their rows.
    """
    rows = sorted(set(rows))
    lead = first_strangers(rows)
    kept = set(lead)
    for content in {r[2] for r in lead}:
        kept.update(first_strangers([r for r in rows if r[2] != content]))
    return sorted(kept)


#: Rows of one key, and keys, that a task holds before it summarises and gives them on.
_HELD_ROWS, _HELD_KEYS = 512, 20_000


def corroboration(rows: DataFrame, key: Sequence[str], pos: str, domain: str, content: str) -> DataFrame:
    """(pos, corroborator): the first other row of the key from an independent domain with different content.

    Never all pairs of a key, and never all its rows in one place: each task summarises its own rows of a key, the
    summaries of a key are summarised once more, and each row meets that bounded list.  Rows with a null key have no
    result; a row without a domain or content has no partner and is none.
    """
    keys = list(key)
    names = [*keys, "__p", "__d", "__c"]
    usable = rows.select(*keys, F.col(pos).alias("__p"), F.col(domain).alias("__d"), F.col(content).alias("__c")).dropna()
    schema = usable.schema

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}

        def given() -> pd.DataFrame:
            return pd.DataFrame([(*k, *r) for k, own in held.items() for r in summary(own)], columns=names)

        for part in batches:
            for row in part.itertuples(index=False, name=None):
                own = held.setdefault(row[:-3], [])
                own.append(row[-3:])
                if len(own) >= _HELD_ROWS:
                    held[row[:-3]] = summary(own)
            if len(held) > _HELD_KEYS:
                yield given()
                held.clear()
        yield given()

    def joined(part: pd.DataFrame) -> pd.DataFrame:
        own = summary(list(part[["__p", "__d", "__c"]].itertuples(index=False, name=None)))
        return pd.DataFrame([(*part.iloc[0][keys], *r) for r in own], columns=names)

    # Two levels: the summaries of many tasks do not meet in one task at once.
    some = usable.mapInPandas(partial, schema).withColumn("__salt", F.pmod(F.xxhash64("__p"), F.lit(32)))
    some = some.groupBy(*keys, "__salt").applyInPandas(joined, schema).groupBy(*keys).applyInPandas(joined, schema)
    few = some.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("__p").alias("p2"), F.col("__d").alias("d2"), F.col("__c").alias("c2")))).alias("__list"))
    own = rows.select(*keys, pos, domain, content).join(few, keys, "left").dropna(subset=keys)
    akin = lambda x: (x == F.col(domain)) | x.endswith(F.concat(F.lit("."), F.col(domain))) | F.col(domain).endswith(F.concat(F.lit("."), x))
    found = F.filter("__list", lambda o: ~akin(o["d2"]) & (o["c2"] != F.col(content)))
    return own.select(pos, F.get(found, F.lit(0))["p2"].alias("corroborator"))


def overdue(deadlines: Column, precision: Column, evidence: Column, now: Column) -> Column:
    """Supported bid and opening deadlines exist and every one of them has passed; the three columns are maps."""
    known = F.map_filter(deadlines, lambda k, v: F.map_contains_key(precision, k) & F.map_contains_key(evidence, k))
    entries = F.map_entries(known)
    return (F.size(entries) > 0) & F.forall(entries, lambda e: clock.expired(e["value"], precision[e["key"]], now))
