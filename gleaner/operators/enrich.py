"""Two analyses of one page made one: a model's, completed by the rules', without contradicting it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import extract
from ..functions import lexicon as lx

#: Fields that the rules may fill where the model has none.
FILLED = ("category", "event_type", "organization", "published_at", "awarded_supplier", "awarded_amount", "financing_round", "financing_subtype", "registration_deadline", "bid_submission_deadline", "opening_deadline")
CLASSIFIED = ("in_china", "in_scope", "category", "event_type")


def enriched(model: DataFrame, rules: DataFrame, key: str = "source_url", fields: Sequence[str] = FILLED) -> DataFrame:
    """Rows of the model completed from the rules; pages that the model does not have come from the rules whole.

    Both hold key, in_china, in_scope, the fields, amount, amount_disclosed, evidence (array of field, quote,
    source_url); `rules` also holds page_date, the date of the page's own metadata, which outranks every other.
    Nothing is filled where either is out of scope or they differ in category or event type.  `degraded` tells
    rows that the rules changed.
    """
    fields = [f for f in fields if f in model.columns]
    columns = [c for c in model.columns if c != key]
    both = model.select(key, F.struct(*columns).alias("m")).join(rules.select(key, F.struct(*columns, *[c for c in ("page_date",) if c in rules.columns]).alias("r")), key, "full_outer")
    differs = lambda c: F.coalesce(F.col(f"m.{c}") != F.col(f"r.{c}"), F.lit(False))
    same = lambda c: F.col(f"m.{c}").eqNullSafe(F.col(f"r.{c}"))
    fits = F.coalesce(F.col("m.in_china") & F.col("m.in_scope") & F.col("r.in_scope"), F.lit(False)) & ~differs("category") & ~differs("event_type")
    own_date = F.col("r.page_date") if "page_date" in rules.columns else F.lit(None).cast("timestamp")
    filled, values = [], {}
    for f in fields:
        gap = fits & F.col(f"m.{f}").isNull() & F.col(f"r.{f}").isNotNull()
        values[f] = F.when(gap, F.col(f"r.{f}")).otherwise(F.col(f"m.{f}"))
        filled.append(F.when(gap, F.lit(f)))
    dated = fits & own_date.isNotNull()
    if "published_at" in fields:
        values["published_at"] = F.when(dated, own_date).otherwise(values["published_at"])
        same_day = fits & (F.to_date("m.published_at") == F.to_date("r.published_at"))
        filled.append(F.when(dated | F.coalesce(same_day, F.lit(False)), F.lit("published_at")))
    amount = fits & F.col("m.amount").isNull() & F.col("m.amount_disclosed").isNull() & (F.col("r.amount").isNotNull() | F.col("r.amount_disclosed").isNotNull())
    for f in ("amount", "amount_disclosed"):
        values[f] = F.when(amount, F.col(f"r.{f}")).otherwise(F.col(f"m.{f}"))
    filled.append(F.when(amount, F.lit("amount")))
    agreed = fits
    for c in CLASSIFIED:
        agreed &= same(c)
    filled += [F.when(agreed, F.lit(c)) for c in CLASSIFIED]
    names = F.array_compact(F.array(*filled))
    added = F.filter("r.evidence", lambda e: F.array_contains(names, e["field"]) & ~F.array_contains("m.evidence", e))
    values["evidence"] = F.when(fits, F.concat("m.evidence", F.array_distinct(added))).otherwise(F.col("m.evidence"))
    changed = fits & (F.size("m.evidence") != F.size(values["evidence"]))
    for f in (*fields, "amount", "amount_disclosed"):
        changed |= ~values[f].eqNullSafe(F.col(f"m.{f}"))
    absent = F.col("m").isNull()
    pick = lambda c: F.when(absent, F.col(f"r.{c}")).otherwise(values.get(c, F.col(f"m.{c}")))
    return both.select(key, *[pick(c).alias(c) for c in columns], (absent | changed).alias("degraded"))


def without_excluded(df: DataFrame, page_text: str, financing: str = lx.FINANCING) -> DataFrame:
    """Financings that are bank credit or the refinancing of a listed company leave the scope, with their fields."""
    out = F.coalesce(((F.col("category") == financing) | (F.col("event_type") == "financing")) & extract.excluded(F.col(page_text)), F.lit(False))
    for c in ("category", "event_type", "financing_round"):
        df = df.withColumn(f"__{c}", F.when(~out, F.col(c)))
    df = df.withColumn("in_scope", F.col("in_scope") & ~out).withColumn("investors", F.when(out, F.array().cast("array<string>")).otherwise(F.col("investors")))
    for c in ("category", "event_type", "financing_round"):
        df = df.withColumn(c, F.col(f"__{c}")).drop(f"__{c}")
    return df
