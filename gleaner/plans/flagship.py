"""The flagship plan: candidate selection, from raw rows to a ranked, de-duplicated top list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import select

#: The selection's term lists are Chinese; these take their place on the synthetic Latin texts.
SYNTHETIC = select.Lexicon(
    categories={"english": (" the ", " of "), "french": (" les ", " des "), "german": (" der ", " und ")},
    events=("that", "with", "dans", "que", "ein", "die"),
    financing="none",
    financing_subjects=("commercial space",),
    financing_events=("round",),
    financing_specific=("rocket",),
    financing_actions=("round",),
    noise=("all rights reserved",),
    title_noise=("weekly",),
    blocked_domains=("spam-farm.example.org",),
    stages=(("notice", ("license",)), ("other", (" ",))),
)


def select_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages joined with the document of their id, as candidates of January 2024, fifteen of them at most."""
    pages, docs = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("pages", "documents"))
    rows = pages.select("page_id", "url").join(docs.select(F.col("doc_id").alias("page_id"), "text", "source"), "page_id")
    published = F.expr("TIMESTAMP '2024-01-30 00:00:00'") - F.make_dt_interval(F.col("page_id").cast("int") % 40)
    rows = rows.select(
        F.col("page_id").alias("input_pos"), F.substring("text", 1, 80).alias("title"), "url", F.col("text").alias("summary"), F.lit(None).cast("string").alias("category_hint"),
        F.when(F.col("page_id") % 10 == 0, "official:list").otherwise("search").alias("discovery_source"), F.when(F.col("page_id") % 7 != 0, published).alias("published_at"),
    )
    chosen, _, _ = select.select_candidates(rows, F.expr("TIMESTAMP '2024-01-31 00:00:00'"), minimum=12, maximum=15, lexicon=SYNTHETIC)
    return chosen.select("place", F.col("input_pos").alias("page_id"), "url", "category", "score", "bucket", "stage")
