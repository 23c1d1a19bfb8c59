"""Operator 6: sharding by sampled splitters.  Law `bytes`: the shards' sizes are near equal.

Records are ordered by (md5 of their text, id), so equal texts stand together.  A size-weighted sample of these keys
gives splitters at equal quantiles, many fine ranges per shard, and each record finds its range by binary search.
Ranges are exact in size once summed; the running sum of bytes places each record, and a range that is overfull, or
that a shard boundary crosses, is subdivided record by record.  So a shard holds the total divided by the number of
shards, up to one document's size, whatever the skew; a large group of equal texts is cut only at shard boundaries.

Defined results.  A null text has no bytes and the checksum of none.  Null ids sort first; identical rows are
interchangeable and each keeps its own row.  An empty table has no rows.  Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import parts, stored, with_text

SHARDS = 24
#: Fine ranges per shard at least, and sample keys per fine range; a range holds about ROWS_A_RANGE rows at most, as one
#: task sorts it, so ranges (and what the driver holds of them) grow with the table.
RANGES_A_SHARD, KEYS_A_RANGE, ROWS_A_RANGE = 16, 16, 500_000
ROW_BYTES = 8


def records(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, key, tie) of each row; key is the text's md5."""
    docs = with_text(df, id_col, text_col)
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    low = F.lit(-(1 << 63))
    return docs.select("doc_id", (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.md5(raw).alias("key"), F.coalesce(F.col("doc_id").cast("long"), low).alias("tie"))


def sample_splitters(rows: DataFrame, ranges: int, keys_a_range: int = KEYS_A_RANGE) -> list[tuple[str, int]]:
    """At most `ranges` - 1 ascending keys at the quantiles of a size-weighted sample."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    rate = ranges * keys_a_range / total
    draw = F.pmod(F.xxhash64(F.lit(6), "key", "tie"), F.lit(1 << 40)) / float(1 << 40)
    # A record is drawn with a chance in proportion to its size; one larger than the sampling step is always drawn.
    drawn = rows.where(draw < F.col("size") * rate).select("key", "tie", F.greatest(F.col("size") * rate, F.lit(1.0)).alias("w")).toPandas()
    if drawn.empty:
        return []
    drawn = drawn.sort_values(["key", "tie"], kind="stable")
    sums = drawn["w"].cumsum().to_numpy()
    at = np.searchsorted(sums, np.arange(1, ranges) * sums[-1] / ranges)
    keys = list(zip(drawn["key"].to_numpy()[np.minimum(at, len(sums) - 1)].tolist(), drawn["tie"].to_numpy()[np.minimum(at, len(sums) - 1)].tolist(), strict=True))
    return sorted(set(keys))


def with_range(rows: DataFrame, cuts: list[tuple[str, int]]) -> DataFrame:
    """Each record with the number of splitters that are at most its key."""
    keys = np.array([c[0] for c in cuts], "S32")
    ties = np.array([c[1] for c in cuts], np.int64)
    names = rows.columns

    def run(batches):
        for batch in batches:
            own = np.array(batch.column("key").to_pylist(), "S32")
            tie = batch.column("tie").to_numpy(zero_copy_only=False)
            low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            for i in np.flatnonzero(low < high):  # equal texts: the id decides
                low[i] += np.searchsorted(ties[low[i] : high[i]], tie[i], "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(low.astype(np.int32))], [*names, "range"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("range", T.IntegerType())]))


def assign(df: DataFrame, shards: int = SHARDS, ranges_a_shard: int = RANGES_A_SHARD, id_col: str = "doc_id", text_col: str = "text", rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row."""
    spark = df.sparkSession
    rows = stored(records(df, id_col, text_col), "shard-records")
    ranges = max(shards * ranges_a_shard, -(-rows.count() // rows_a_range))
    ranged = stored(with_range(rows, sample_splitters(rows, ranges)), "shard-ranges")
    # One row per fine range.
    sums = ranged.groupBy("range").agg(F.sum("size").alias("bytes"))
    bounded = Window.orderBy("range")
    sums = sums.select("range", (F.sum("bytes").over(bounded) - F.col("bytes")).alias("before"), F.sum("bytes").over(bounded.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    order = Window.partitionBy("range").orderBy("key", "tie", "size")
    at = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    spread = ranged.repartition(parts(spark), "range").join(F.broadcast(sums), "range")
    placed = spread.withColumn("at", at).withColumn("shard", F.least(F.expr(f"cast(at * {shards} div total as int)"), F.lit(shards - 1)))
    placed = stored(placed.select("doc_id", "size", "text_crc32", "key", "tie", "range", "at", "shard"), "shard-placed")
    # Slots: rows of the shard in earlier ranges, plus the place inside this range.
    counts = placed.groupBy("shard", "range").agg(F.count("*").alias("n"))
    earlier = counts.select("shard", "range", (F.sum("n").over(Window.partitionBy("shard").orderBy("range")) - F.col("n")).alias("earlier"))
    place = F.row_number().over(Window.partitionBy("range", "shard").orderBy("key", "tie", "at")) - 1
    return placed.join(F.broadcast(earlier), ["shard", "range"]).select("doc_id", "size", "text_crc32", "shard", (F.col("earlier") + place).cast("long").alias("slot"))


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    out = assign(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op6_sharding": op6_sharding}
