"""State tables in hash buckets: a merge rewrites only the buckets that it touches, and one of two writers loses.

A state is a folder of immutable bucket folders and of numbered manifests.  A manifest names, for each table, its key,
its number of buckets and the folder of each bucket that has rows.  A commit writes new bucket folders, then puts the
manifest of the next number in place by a rename that fails if that number is taken: whoever read an older state gets
Conflict, and nothing that readers see has changed.  Readers keep the state whose manifest they have read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .state import VERSIONS

BUCKETS = 64
Merge = Callable[[DataFrame, DataFrame], DataFrame]


class Conflict(RuntimeError):
    """Another writer has committed since the state was read."""


@dataclass(frozen=True)
class Version:
    """A committed state: its number and, by table, {"key", "n", "buckets": {bucket: folder below the root}}."""

    seq: int = 0
    tables: dict = field(default_factory=dict)


# --------------------------------------------------------------------- files that only Spark needs to reach
def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _put_new(spark: SparkSession, path: str, content: str) -> bool:
    """Put a small file in place whole, unless the name is taken; False if it is."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    draft, fs = _files(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(content.encode()))
    out.close()
    target = hadoop.Path(path)
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(target.toUri(), conf).rename(fs.makeQualified(draft), fs.makeQualified(target), plain)
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    return True


def _manifest(root: str, seq: int) -> str:
    return f"{root.rstrip('/')}/manifests/{seq:020d}.json"


def current(spark: SparkSession, root: str) -> Version:
    """The latest committed version; an empty one before the first commit."""
    where, fs = _files(spark, f"{root.rstrip('/')}/manifests")
    if not fs.exists(where):
        return Version()
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    seqs = [int(n[:20]) for n in names if n.endswith(".json")]
    if not seqs:
        return Version()
    rows = spark.read.text(_manifest(root, max(seqs)), wholetext=True).collect()  # one small file
    held = json.loads(rows[0].value)
    if held["schema_version"] not in VERSIONS:
        raise ValueError(f"unknown schema version {held['schema_version']}")
    return Version(held["seq"], held["tables"])


# --------------------------------------------------------------------- tables
def bucket_of(key: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")


def load(spark: SparkSession, root: str, version: Version, name: str, schema: T.StructType | str, buckets: Sequence[int] | None = None) -> DataFrame:
    """A table of a version, or some of its buckets."""
    held = version.tables.get(name, {"buckets": {}})["buckets"]
    folders = [f"{root.rstrip('/')}/{f}" for b, f in sorted(held.items()) if buckets is None or int(b) in buckets]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def staged(spark: SparkSession, root: str, version: Version, name: str, new: DataFrame, key: Sequence[str], merge: Merge, buckets: int = BUCKETS) -> dict:
    """The table's manifest entry after a merge of new rows; only the buckets of their keys are read and written.

    merge(old, new) gets the old rows of these buckets and all new rows and returns the buckets' new rows; it must not
    move a row to another key.  Nothing is visible before commit().
    """
    entry = version.tables.get(name, {"key": list(key), "n": buckets, "buckets": {}})
    if entry["key"] != list(key):
        raise ValueError(f"table {name} is kept by {entry['key']}")
    bucket = bucket_of(key, entry["n"])
    touched = sorted(r[0] for r in new.select(bucket.alias("b")).distinct().collect())  # at most n numbers
    if not touched:
        return entry
    rows = merge(load(spark, root, version, name, new.schema, touched), new).withColumn("__bucket", bucket)
    folder = f"{name}/{uuid.uuid4().hex}"
    rows.write.partitionBy("__bucket").parquet(f"{root.rstrip('/')}/{folder}")
    where, fs = _files(spark, f"{root.rstrip('/')}/{folder}")
    written = {s.getPath().getName().removeprefix("__bucket=") for s in fs.listStatus(where) if s.isDirectory() and s.getPath().getName().startswith("__bucket=")}
    if not written <= {str(b) for b in touched}:
        raise ValueError("the merge moved rows to other keys")
    kept = {b: f for b, f in entry["buckets"].items() if int(b) not in touched}
    return entry | {"buckets": kept | {b: f"{folder}/__bucket={b}" for b in written}}


def commit(spark: SparkSession, root: str, version: Version, tables: dict, schema_version: int = VERSIONS[-1]) -> Version:
    """Commit the entries of staged() for some tables as the version after `version`; the others stay as they are."""
    if schema_version not in VERSIONS:
        raise ValueError(f"unknown schema version {schema_version}")
    after = Version(version.seq + 1, version.tables | tables)
    if not _put_new(spark, _manifest(root, after.seq), json.dumps({"seq": after.seq, "schema_version": schema_version, "tables": after.tables})):
        raise Conflict(f"version {after.seq} is taken")
    return after


def merge_into(spark: SparkSession, root: str, name: str, new: DataFrame, key: Sequence[str], merge: Merge, buckets: int = BUCKETS, attempts: int = 3) -> Version:
    """Merge rows into one table, again on the newer state if another writer was first."""
    for attempt in range(attempts):
        version = current(spark, root)
        try:
            return commit(spark, root, version, {name: staged(spark, root, version, name, new, key, merge, buckets)})
        except Conflict:
            if attempt == attempts - 1:
                raise
    raise AssertionError
