"""Stable identities: canonical JSON hashes and name-based UUIDs, built-in functions only."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text
from .urls import normalize_url


def canonical_hash(**fields: Column) -> Column:
    """SHA-256 of the compact JSON object of the fields, keys sorted, nulls kept."""
    return F.sha2(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"}), 256)


def uuid5(name: Column, namespace: uuid.UUID = uuid.NAMESPACE_URL) -> Column:
    """The version 5 UUID of a name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex((F.conv(F.substring(digest, 17, 2), 16, 10).cast("int").bitwiseAND(0x3F)).bitwiseOR(0x80)))
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 19, 2)), F.substring(digest, 21, 12))


def version_id(url: Column, content_hash: Column) -> Column:
    return canonical_hash(source_url=normalize_url(url), content_hash=F.lower(content_hash))


def utc_text(ts: Column) -> Column:
    """Microsecond timestamp text; the session's zone must be UTC for zoned columns."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def event_fingerprint(event_type: Column, published: Column, url: Column, title: Column, version: Column) -> Column:
    return canonical_hash(event_type=event_type, published_at=utc_text(published), source_url=normalize_url(url), title=text.normalize_nfkc(title), content_version_id=F.nullif(version, F.lit("")))


def financing_fingerprint(announced: Column, amount: Column, company: Column, investors: Column, round_name: Column, subtype: Column) -> Column:
    """Equal for reports of one financing; the date is local, the amount text."""
    return canonical_hash(announced_at=F.date_format(announced, "yyyy-MM-dd"), amount_cny=amount, company=company, investors=F.array_sort(investors), round_name=round_name, financing_subtype=F.coalesce(subtype, F.lit("")))


def event_id(fingerprint: Column, prefix: str = "gleaner:event:") -> Column:
    return uuid5(F.concat(F.lit(prefix), fingerprint))


def pending_id(url: Column, reason: Column, prefix: str = "gleaner:pending:") -> Column:
    return uuid5(F.concat(F.lit(prefix), normalize_url(url), F.lit(":"), reason))


@F.pandas_udf(T.StringType())
def amount_text(amount: pd.Series) -> pd.Series:
    """A number with fifteen significant digits, without closing zeros."""
    return amount.map(lambda x: None if x is None or x != x else format(x, ".15g"))


def project_id(organization: Column, codes: Column, title: Column, prefix: str = "gleaner:project:") -> Column:
    """From the normal forms of organization and core title and the sorted project codes."""
    clean = F.array_sort(F.array_distinct(F.transform(F.filter(F.coalesce(codes, F.array().cast("array<string>")), lambda c: c != ""), text.code)))
    payload = F.struct(text.normalize_nfkc(organization).alias("organization"), clean.alias("project_codes"), text.core_title(title).alias("title"))
    return uuid5(F.concat(F.lit(prefix), F.to_json(payload, {"ignoreNullFields": "false"})))
