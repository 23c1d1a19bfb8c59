"""State tables on disk: strict JSON in, versioned directories out.

A commit writes a new version directory and then its name to a one-row pointer table; readers follow the pointer, so a
failed commit leaves the version before it in force.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSIONS = (1, 2)


def read_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with a fixed schema; a corrupt line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON array in a file."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", True).json(path)


def unknown_fields(spark: SparkSession, path: str, known: T.StructType) -> list[str]:
    """Fields of a JSON file that the schema does not have."""
    return sorted(set(spark.read.json(path).columns) - set(known.names))


def write_lines(df: DataFrame, path: str, *order: str) -> None:
    """JSON lines in a stated order, range-partitioned, so the files in name order are the whole order; times keep microseconds."""
    times = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    (df.orderBy(*order) if order else df).write.mode("overwrite").options(ignoreNullFields=False, **times).json(path)


def _pointer(spark: SparkSession, root: str) -> tuple[int, str] | None:
    try:
        row = spark.read.schema("seq long, version string").json(f"{root}/current").orderBy(F.desc("seq")).first()
    except AnalysisException:
        return None
    return (row.seq, row.version) if row else None


def commit(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], schema_version: int = 2) -> str:
    """Write all tables of a state, then point to them."""
    if schema_version not in VERSIONS:
        raise ValueError(f"unknown schema version {schema_version}")
    before, version = _pointer(spark, root), uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{root}/{version}/{name}")
    spark.createDataFrame([(before[0] + 1 if before else 1, version)], "seq long, version string").coalesce(1).write.mode("append").json(f"{root}/current")
    return version


def load(spark: SparkSession, root: str, name: str, schema: T.StructType | str) -> DataFrame:
    """A table of the current version; an empty one before the first commit."""
    now = _pointer(spark, root)
    if now is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{now[1]}/{name}")


def append_events(old: DataFrame, new: DataFrame) -> DataFrame:
    """Formal events must be verified; one row per fingerprint, the earliest stays."""
    checked = new.withColumn("verification", F.when(F.col("verification") == "verified", F.col("verification")).otherwise(F.raise_error(F.lit("a formal event must be verified"))))
    both = old.withColumn("__new", F.lit(0)).unionByName(checked.withColumn("__new", F.lit(1)))
    first = both.groupBy("fingerprint").agg(F.min_by(F.struct(*old.columns), F.struct("published_at", "__new", "event_id")).alias("r"))
    return first.select("r.*")


def upgrade(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill what rows of an older version lack."""
    out = df
    for name, value in defaults.items():
        value = value if not isinstance(value, (str, int, float, bool)) else F.lit(value)
        out = out.withColumn(name, F.coalesce(F.col(name), value) if name in df.columns else value)
    return out
