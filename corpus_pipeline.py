"""The corpus pipeline: language ID, toxicity, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of documents.  run() applies them to the documents table, each stage's rows written to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import bagminhash, language, packing, toxicity
from gleaner.llm._common import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from the stage's own training fold."""
    return language.reject(docs, language.fit(language.training_rows(docs)))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; labels of documents that are gone serve no longer."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, toxicity.fit(docs, toxicity.training_labels(labels)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return bagminhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents in windows of tokens: one row per piece."""
    return packing.pack_documents(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES = [("language_id", language_id), ("toxicity", toxicity_filter), ("near_dedup", near_dedup), ("packing", pack)]
#: Language models, classifiers and packing are beyond SQL: tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
