"""Helpers shared by the operators: shared storage, text batches, vector hashes, range splitters."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one vectorised step holds (each byte costs some tens of bytes of scratch arrays).
STEP_BYTES = 1 << 18
#: Bytes of one batch between Spark and Python: 10,000 long texts would else be held together on both sides.
BATCH_BYTES = 8 << 20


# --------------------------------------------------------------------- shared storage
def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset, an own one, but only if all of Spark runs on this machine (tests).
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gleaner-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of a batch in this session, unless it already has a lower bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = (spark.conf.get(key, None) or "").rstrip("b")
    if not held.isdigit() or int(held) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def with_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that an operator reads, under fixed names; other columns cannot clash."""
    small_batches(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


# --------------------------------------------------------------------- Arrow batches
def steps(batches: Iterator[pa.RecordBatch], column: str = "text", step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slice batches so that one step holds about step_bytes of text (a longer single text stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < len(sizes):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + step_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def strings(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of the texts); a null text is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, offsets of the texts)."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), offsets


def owners(offsets: np.ndarray) -> np.ndarray:
    """For each element the index of the document that holds it."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def groups(texts: list[str], chars: int = 1 << 18) -> Iterator[list[int]]:
    """Places of the texts in order, about `chars` characters of them at a time."""
    held, size = [], 0
    for i, t in enumerate(texts):
        held.append(i)
        size += len(t)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def give_back() -> None:
    """Return what a fit has freed to the system, where the C library can."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


# --------------------------------------------------------------------- vector hashes
def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes to doubles in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


# --------------------------------------------------------------------- ranges of a key
def splitters(df: DataFrame, key: str, ranges: int) -> list[int]:
    """Ascending values of a long key that cut it into at most `ranges` like-sized ranges; the first is its minimum.

    One mergeable quantile sketch over all rows; the driver gets `ranges` numbers.  Each value occurs in the data.
    """
    points = [i / ranges for i in range(ranges)]
    row = df.agg(F.percentile_approx(key, points, max(10_000, 4 * ranges)).alias("q"), F.min(key).alias("low")).first()
    return sorted({row["low"], *(row["q"] or [])}) if row and row["low"] is not None else []


def range_of(key: Column, cuts: list[int]) -> Column:
    """Index of the last cut that is at most key: a binary search inside one expression, built-in functions only."""
    if len(cuts) <= 1:
        return F.lit(0)
    table = F.array(*[F.lit(c).cast("long") for c in cuts]) if len(cuts) <= 64 else F.from_json(F.lit(str(list(cuts)).replace(" ", "")), "array<bigint>")
    rounds = max(1, int(np.ceil(np.log2(len(cuts)))) + 1)

    def halve(span: Column, _: Column) -> Column:
        low, high = span["low"], span["high"]
        mid = ((low + high + 1) / 2).cast("int")
        right = F.element_at(table, mid + 1) <= key
        return F.struct(F.when(right, mid).otherwise(low).alias("low"), F.when(right, high).otherwise(mid - 1).cast("int").alias("high"))

    span = F.struct(F.lit(0).alias("low"), F.lit(len(cuts) - 1).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), span, lambda s, i: F.when(s["low"] < s["high"], halve(s, i)).otherwise(s), lambda s: s["low"])
