"""Search results that were landed as JSON: one payload per row, wrapped in `data` or bare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ITEM = "array<struct<name:string,url:string,snippet:string,summary:string,datePublished:string,siteName:string>>"
_SCHEMA = f"code int, msg string, webPages struct<value:{_ITEM}>, data struct<webPages:struct<value:{_ITEM}>>"


def error_of(code: Column) -> Column:
    """The kind of failure that a business code stands for; null for success."""
    return F.when(code.isNull() | (code == 200), F.lit(None).cast("string")).when(code.isin(401, 403), "authentication").when(code == 429, "quota").otherwise("service")


def published_at(text: Column) -> Column:
    """ISO time with an offset, else null: a time without a zone is not trusted."""
    t = F.trim(text)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([Zz]|[+-]\d{2}:?\d{2})$"), F.try_to_timestamp(F.upper(t)))


def candidates(payloads: DataFrame, column: str = "payload", source: str = "search") -> DataFrame:
    """(input_pos, title, url, summary, category_hint, discovery_source, published_at) of all items; malformed ones are left out.

    payloads: request (long), payload (string), category_hint (string).
    """
    parsed = payloads.withColumn("p", F.from_json(column, _SCHEMA)).where(error_of(F.col("p.code")).isNull())
    items = parsed.select("request", "category_hint", F.posexplode(F.coalesce("p.webPages.value", "p.data.webPages.value")).alias("i", "item"))
    good = items.where("item.name is not null and item.url is not null")
    return good.select(
        (F.col("request") * 1000 + F.col("i")).alias("input_pos"), F.col("item.name").alias("title"), F.col("item.url").alias("url"),
        F.coalesce(F.nullif("item.summary", F.lit("")), "item.snippet", F.lit("")).alias("summary"), "category_hint", F.lit(source).alias("discovery_source"), published_at(F.col("item.datePublished")).alias("published_at"),
    )
