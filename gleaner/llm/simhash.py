"""Operator 11: near duplicates by SimHash, found through a byte-position inverted index with count filtering.

A text's words stand between ASCII white space, A-Z lower-cased; its features are its three-word shingles, repeats
included, hashed by XXH64.  Bit k of the fingerprint is set if it is set in over half the hashes.

Fingerprints link at three or fewer differing bits.  Such a pair differs in three bytes at most, so at least five of its
eight positional bytes are shared (the guaranteed minimum).  Of any 3 + l positions at least l are then shared, so an
index by every choice of l among the first 3 + l positional bytes holds each linked pair together under some key: l is
the smallest for which chance meetings stay below one a fingerprint, and grows with the table.  A pair that meets has
its shared positional bytes tallied, is retained with five or more, and verified by its differing bits.

Equal fingerprints are one node, so copies cost nothing here.  A key under which many different fingerprints meet is not
paired out: its fingerprints are compared with one of them, components are formed, and if several components are left
these fingerprints are indexed once more by five bytes, at last by nibbles (any three wrong of sixteen), under whose
keys no more than 4,096 fingerprints exist.  Keys that hold one component only need no comparison.  Every link between
different components is found, so components are exact; no pair is capped or dropped.

Defined results.  A null text, or one without words, has the fingerprint zero and is linked like any other.  A text of
fewer than three words has one feature, the whole sequence.  component_id is the smallest id that can be reached, null
if all ids in it are null.  Repeated rows share all they have.  An empty table gives no rows.  Extra columns are not
read.  Very long texts are hashed piece by piece; pieces overlap by two words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import steps, stored, utf8, with_text
from .graph import components

SHINGLE, SEED, DISTANCE, BITS = 3, 42, 3, 64
#: Fingerprints of one key that are compared all with all; keys with more are indexed again.
MOST = 64
#: Bytes of a text that are hashed at a time.
PIECE_BYTES = 1 << 20
_SPACE = b" \t\n\r\x0b\f"


# --------------------------------------------------------------------- fingerprints
def shingles(words: list[bytes], size: int = SHINGLE) -> list[bytes]:
    if len(words) < size:
        return [b" ".join(words)] if words else []
    return [b" ".join(t) for t in zip(*(words[i:] for i in range(size)), strict=False)]


def pieces(lowered: bytes, start: int, stop: int, size: int = PIECE_BYTES, overlap: int = SHINGLE - 1) -> Iterator[list[bytes]]:
    """Words of lowered[start:stop], some bytes at a time; each piece begins with the last words of the one before."""
    held: list[bytes] = []
    while start < stop:
        cut = min(start + size, stop)
        while cut < stop and lowered[cut] not in _SPACE:
            cut += 1
        words = held + lowered[start:cut].split()
        start = cut
        if len(words) <= overlap and start < stop:
            held = words
            continue
        yield words
        held = words[-overlap:]


def ones(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each run of hashes, how many of them set each of the 64 bits, the highest first."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def _hashed(texts: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(t, SEED) for t in texts), np.uint64, len(texts))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint), the fingerprint as a signed long; docs: doc_id, text."""

    def run(batches):
        for step in steps(batches):
            data, offsets = utf8(step.column("text"))
            lowered = data.tobytes().lower()  # of bytes: A-Z only
            counts, total, small, sizes = np.zeros((step.num_rows, BITS), np.int64), np.zeros(step.num_rows, np.int64), [], np.zeros(step.num_rows, np.int64)
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                if b - a <= PIECE_BYTES:
                    own = shingles(lowered[a:b].split())
                    small += own
                    sizes[i] = len(own)
                    continue
                for k, words in enumerate(pieces(lowered, a, b)):
                    own = _hashed(shingles(words) if k == 0 or len(words) >= SHINGLE else [])
                    if len(own):
                        counts[i] += ones(own, np.zeros(1, np.int64))[0]
                        total[i] += len(own)
            if small:
                full = np.flatnonzero(sizes)
                counts[full] += ones(_hashed(small), (np.cumsum(sizes) - sizes)[full])
            total += sizes
            packed = np.packbits(2 * counts > total[:, None], axis=1).view(">u8").ravel()
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), pa.array(packed.astype(np.uint64).view(np.int64))], ["doc_id", "fingerprint"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint long")


# --------------------------------------------------------------------- links
def masks(width: int, unit: int = 8, distance: int = DISTANCE) -> list[int]:
    """All choices of `width` units of bits among the first width + distance, as signed masks."""
    positions = range(min(width + distance, BITS // unit))
    chosen = (sum(((1 << unit) - 1) << (BITS - unit * (p + 1)) for p in c) for c in combinations(positions, width))
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in chosen]


def levels(n: int, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """(width, unit) of the index and of those that follow it where keys are crowded; n fingerprints."""
    widest = BITS // 8 - distance
    first = next((w for w in range(2, widest) if n * comb(w + distance, distance) <= 1 << (8 * w)), widest)
    return [*dict.fromkeys([(first, 8), (widest, 8)]), (BITS // 4 - distance, 4)]


def shared_bytes(a: Column, b: Column) -> Column:
    """How many of the eight positional bytes of two fingerprints are equal."""
    tally, x = F.lit(0), a.bitwiseXOR(b)
    for m in masks(1, distance=BITS // 8 - 1):
        tally = tally + F.when(x.bitwiseAND(F.lit(m)) == 0, F.lit(1)).otherwise(F.lit(0))
    return tally


def verified(pairs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The pairs (a, b) that share enough positional bytes and then differ in few enough bits."""
    a, b = F.col("a"), F.col("b")
    return pairs.where(shared_bytes(a, b) >= BITS // 8 - distance).where(F.bit_count(a.bitwiseXOR(b)) <= distance)


def indexed(placed: DataFrame, width: int, unit: int) -> DataFrame:
    """(mask, key, node, root, n, low) for keys under which several components meet; placed: node, root.

    n counts the key's nodes, low is the smallest of them; both combine before the shuffle.
    """
    each = placed.select("node", "root", F.explode(F.array(*[F.lit(m) for m in masks(width, unit)])).alias("mask")).select("node", "root", "mask", F.col("node").bitwiseAND(F.col("mask")).alias("key"))
    several = each.groupBy("mask", "key").agg(F.count("*").alias("n"), F.min("node").alias("low"), F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("mask", "key", "n", "low")
    return each.join(several, ["mask", "key"])


def linked(nodes: DataFrame, most: int = MOST) -> DataFrame:
    """(node, root) of every fingerprint with a link to another one; nodes: node, all different."""
    spark = nodes.sparkSession
    edges = spark.createDataFrame([], "a long, b long")
    roots = spark.createDataFrame([], "node long, root long")
    pool, plan = nodes.select("node"), levels(nodes.count())
    for at, (width, unit) in enumerate(plan):
        # At the last level a key leaves twelve bits open: its fingerprints are few whatever the table's size.
        crowd = most if at < len(plan) - 1 else 1 << 30
        placed = pool.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
        met = stored(indexed(placed, width, unit), "byte-index")
        close, crowded = met.where(F.col("n") <= crowd), met.where(F.col("n") > crowd)
        left = close.select("mask", "key", F.col("node").alias("a"), F.col("root").alias("ra"))
        right = close.select("mask", "key", F.col("node").alias("b"), F.col("root").alias("rb"))
        pairs = left.join(right, ["mask", "key"]).where("a < b and ra <> rb").select("a", "b")
        stars = crowded.where("low <> node").select(F.col("low").alias("a"), F.col("node").alias("b"))
        found = stored(verified(pairs.unionByName(stars)).distinct(), "byte-links")
        if not found.isEmpty():
            edges = edges.unionByName(found)
            roots = components(edges)
        pool = crowded.select("node").distinct()
        if at == len(plan) - 1 or pool.isEmpty():
            return roots
        pool = stored(pool, "crowded")
    return roots


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; fingerprint in sixteen hexadecimal digits."""
    own = stored(fingerprints(with_text(df, id_col, text_col)), "fingerprints")
    nodes = stored(own.groupBy(F.col("fingerprint").alias("node")).agg(F.min("doc_id").alias("low")), "fingerprint-nodes")
    placed = nodes.join(linked(nodes, most), "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    first = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stored(placed.join(first, "root").select(F.col("node").alias("fingerprint"), "component_id"), "fingerprint-components")
    return own.join(named, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op11_simhash(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op11_simhash": op11_simhash}
