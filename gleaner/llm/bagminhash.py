"""Operator 5: near duplicates by BagMinHash, banding and multiset verification.

A document is the bag of its five-word shingles (words stand between ASCII white space; a text of fewer words is one
shingle).  For every shingle of weight w the weight axis is cut at powers of two; each interval up to w carries its own
Poisson process of points in time, whose rate is the interval's length.  A point belongs to a random component of the
signature and to a random unit level of its interval, and counts if that level is at most w.  A component keeps its
earliest point, so two signatures agree in a component with a probability that is exactly the weighted Jaccard
similarity.  Points are made in order of time and only until they are later than the latest component's minimum.

Bands of the signature are the buckets.  Documents of equal bags are one node.  In each bucket a leader is compared with
the other members, by exact multiset overlap; linked nodes form components; and buckets that still hold several
components get another leader.  What is then left, documents of mixed buckets in different components, is compared by
an exact prefix join, which makes no pair that cannot reach the threshold.  Pairs inside a component need no comparison,
so groups of copies cost a number of pairs in proportion to their size.

Defined results.  Null texts and texts without words are never near duplicates: each is a class of its own.  The class
id is the smallest doc_id of the class, null if all ids in it are null.  Repeated rows fall into one class.  An empty
table gives no rows.  Extra columns are not read, except by keep_one, which returns all columns of the rows it keeps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import mix, parts, steps, stored, unit, utf8, with_text
from .graph import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 5
#: Node ids that one broadcast may hold; beyond that the same join is shuffled.
BROADCAST_NODES = 1_000_000
_BASE = 0x9E3779B97F4A7C15
_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
U = np.uint64


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        for k, x in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            grown = np.full(max(n, 1 << 20), x, np.uint64)
            grown[0] = 1
            _powers[k] = np.cumprod(grown, dtype=np.uint64)
    return [p[:n] for p in _powers]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words per text) of UTF-8 texts that stand one after another."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    solid = (data != 32) & ((data < 9) | (data > 13))
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge] = solid[edge]
    ends[edge - 1] = solid[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    up, down = powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * up[:-1], dtype=np.uint64)])
    hashed = mix((sums[end + 1] - sums[start]) * down[start] + (end - start + 1).astype(np.uint64))
    return hashed, np.diff(np.searchsorted(start, offsets))


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every shingle."""
    hashed, count = words(data, offsets)
    text = np.repeat(np.arange(len(count)), count)
    stop = np.cumsum(count)
    last, first = stop[text], (stop - count)[text]
    at = np.arange(len(hashed))
    use = (at + size <= last) | ((at == first) & (last - first < size))
    at, last, text = at[use], last[use], text[use]
    out = np.zeros(len(at), np.uint64)
    for j in range(size):
        inside = at + j < last
        out += np.where(inside, hashed[np.minimum(at + j, max(len(hashed) - 1, 0))], U(0)) * U(pow(0xD1B54A32D192ED03, j + 1, 1 << 64))
    return mix(out), text


def bags(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, weight) of the distinct shingles of each text, ordered by both."""
    h, text = shingles(data, offsets, size)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], h[at], np.diff(np.append(at, len(h)))


def signatures(text: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, size: int) -> np.ndarray:
    """BagMinHash signatures [n, size]: the earliest point of each component (inf for an empty bag)."""
    low, unit_text, unit_key, unit_w, unit_low, unit_high = 0, [], [], [], [], []
    high = 1
    while True:  # intervals (0, 1], (1, 2], (2, 4], (4, 8], ... that begin below the weight
        own = np.flatnonzero(weight > low)
        if not len(own):
            break
        unit_text.append(text[own])
        unit_key.append(mix(h[own] ^ U(high * 0x9E3779B97F4A7C15 & (2**64 - 1))))
        unit_w.append(weight[own])
        unit_low.append(np.full(len(own), low))
        unit_high.append(np.full(len(own), high))
        low, high = high, high * 2
    out = np.full(n * size, np.inf)
    if not unit_text:
        return out.reshape(n, size)
    of, key, w, lo, hi = (np.concatenate(x) for x in (unit_text, unit_key, unit_w, unit_low, unit_high))
    time, latest, step = np.zeros(len(of)), np.full(n, np.inf), 0
    while len(of):
        x = mix(key + U(step * 0xA0761D6478BD642F & (2**64 - 1)))
        time = time - np.log(unit(x)) / (hi - lo)
        y = mix(x ^ U(0xE7037ED1A0B428DB))
        component = ((y >> U(32)) * U(size) >> U(32)).astype(np.int64)
        level = lo + 1 + ((y & U(0xFFFFFFFF)) * (hi - lo).astype(np.uint64) >> U(32)).astype(np.int64)
        use = (level <= w) & (time < latest[of])
        np.minimum.at(out, of[use] * size + component[use], time[use])
        latest = out.reshape(n, size).max(1)
        alive = time < latest[of]
        of, key, w, lo, hi, time = of[alive], key[alive], w[alive], lo[alive], hi[alive], time[alive]
        step += 1
    return out.reshape(n, size)


def nodes(text: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int) -> list[bytes | None]:
    """A 128-bit name of each text's bag; None for a text without shingles."""
    found = []
    for salt in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3):
        value = mix(h ^ U(salt)) * (U(2) * weight.astype(np.uint64) + U(1))
        total = np.zeros(n, np.uint64)
        if len(text):
            first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
            total[text[first]] = np.add.reduceat(value, first)
        found.append(mix(total + U(1)).astype(">u8"))
    raw = np.stack(found, 1).tobytes()
    full = np.bincount(text, minlength=n) > 0
    return [raw[16 * i : 16 * i + 16] if full[i] else None for i in range(n)]


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    bits = mix(np.ascontiguousarray(sig).view(np.uint64)).reshape(len(sig), bands, rows)
    times = np.array([pow(_BASE, j + 1, 1 << 64) for j in range(rows)], np.uint64)
    return mix((bits * times).sum(2, dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * U(0xC2B2AE3D27D4EB4F)).view(np.int64)


def digest(text: Column) -> Column:
    """A native name of a text's very characters: rows meet again by it without another pass over the shingles."""
    return F.md5(text.cast("string"))


def signed(df: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """(doc_id, digest, node, bands) of each row; node and bands are null without words."""

    def run(batches):
        for step in steps(batches):
            data, offsets = utf8(step.column("text"))
            n = step.num_rows
            text, h, w = bags(data, offsets, size)
            keys = band_keys(signatures(text, h, w, n, bands * rows), bands, rows)
            names = nodes(text, h, w, n)
            lists = pa.array([k if x is not None else None for k, x in zip(keys.tolist(), names, strict=True)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), step.column("digest"), pa.array(names, pa.binary()), lists], ["doc_id", "digest", "node", "bands"])

    named = df.select("doc_id", "text", digest(F.col("text")).alias("digest"))
    return named.mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, digest string, node binary, bands array<long>")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted arrays of shingle hashes."""
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = np.minimum(nx[i], ny[j]).sum()
    return float(common / (len(a) + len(b) - common)) if len(a) + len(b) else 0.0


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) whose texts' bags overlap by at least the threshold."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")

    def run(batches):
        for batch in batches:
            for step in steps(iter([batch]), "left"):
                sides = []
                for c in ("left", "right"):
                    h, text = shingles(*utf8(step.column(c)), size)
                    sides.append(np.split(h, np.searchsorted(text, np.arange(1, step.num_rows))))
                keep = [similarity(x, y) >= threshold for x, y in zip(*sides, strict=True)]
                yield step.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "left", "right").mapInArrow(run, "a binary, b binary")


def star_pairs(members: DataFrame, seed: int) -> DataFrame:
    """Distinct pairs of each bucket's leader with the members of other components.

    With seed 0 the member of the largest weight leads: in a group of near copies that is the one closest to all others,
    as edits take a document out of buckets.  Otherwise a hash in four orders draws the leaders.
    """
    draw = F.xxhash64(F.lit(seed), "node", F.col("key").bitwiseAND(3)).bitwiseAND(F.lit((1 << 31) - 1))
    if seed == 0:
        draw = F.shiftleft(F.least("weight", F.lit((1 << 31) - 1)), 31).bitwiseOR(draw)
    drawn = members.withColumn("draw", draw)
    high = drawn.groupBy("key").agg(F.max("draw").alias("draw"))
    lead = drawn.join(high, ["key", "draw"]).select("key", F.col("node").alias("lead"), F.col("root").alias("lead_root"))
    found = members.join(lead, "key").where("root <> lead_root")
    return found.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()


def numbered(texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(node, n, tokens): the bag as a set of occurrence-numbered shingle hashes, n of them."""

    def run(batches):
        for step in steps(batches):
            text, h, w = bags(*utf8(step.column("text")), size)
            first = np.repeat(np.cumsum(w) - w, w)
            token = mix(np.repeat(h, w) + U(_BASE) * (np.arange(len(first)) - first).astype(np.uint64)).view(np.int64)
            per = np.bincount(text, w, step.num_rows).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()), pa.array(token))
            yield pa.RecordBatch.from_arrays([step.column("node"), pa.array(per), lists], ["node", "n", "tokens"])

    return texts.select("node", "text").mapInArrow(run, "node binary, n long, tokens array<long>")


def prefix_pairs(placed: DataFrame, texts: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """Distinct pairs across components that can reach the threshold, by exact prefix and position bounds.

    Tokens are ordered by how many documents hold them, rarest first.  If two sets overlap by at least
    need = t / (1 + t) * (n1 + n2), their first common token has `need` tokens from it on in both; so only the first
    (1 - t) n + 1 tokens of a set can be that token, and both places are checked against `need`.  A document's own edits
    are its rarest tokens: in a group of thousands of loosely alike documents they fill the prefix, and pairs that
    cannot reach the threshold are never made.
    """
    roots = placed.select("node", "root").distinct()
    sets = stored(numbered(texts.join(roots, "node", "left_semi"), size), "token-sets")
    df = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    each = sets.select("node", "n", F.explode("tokens").alias("token")).join(df, "token")
    ordered = each.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("o"))
    prefix = ordered.select("node", "n", F.slice("o", F.lit(1), F.floor(F.col("n") * (1 - threshold) + 1e-9).cast("int") + 1).alias("o"))
    prefix = prefix.select("node", "n", F.posexplode("o").alias("p", "t")).where("t.df > 1").select("node", "n", "p", F.col("t.token").alias("token"))
    prefix = stored(prefix.join(roots, "node"), "prefixes")
    other = prefix.select(*[F.col(c).alias(f"{c}2") for c in ("token", "node", "n", "p", "root")])
    need = (F.col("n") + F.col("n2")) * (threshold / (1 + threshold)) - 1e-6
    reach = (F.col("root") < F.col("root2")) & (F.col("n") - F.col("p") >= need) & (F.col("n2") - F.col("p2") >= need)
    pairs = prefix.join(other, (F.col("token") == F.col("token2")) & reach)
    return pairs.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()


def links(df: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """((doc_id, digest, node) of every row, (node, root) of every node that has a near duplicate)."""
    own = stored(signed(df, bands, rows, size), "signed")
    buckets = own.where("node is not null").select("node", "bands").dropDuplicates(["node"]).select("node", F.explode("bands").alias("key"))
    several = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(buckets.join(several, "key").select("node", "key", "n"), "buckets")
    wanted = stored(members.groupBy("node").agg(F.sum("n").alias("weight")), "candidates")
    members = members.join(wanted, "node").select("node", "key", "weight")
    # One text stands for each node; its digest finds it among all texts.
    chosen = own.select("node", "digest").join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.min("digest").alias("digest"))
    chosen = F.broadcast(chosen) if wanted.count() <= BROADCAST_NODES else chosen
    texts = df.select("text", digest(F.col("text")).alias("digest")).join(chosen, "digest").select("node", "text")
    texts = stored(texts.dropDuplicates(["node"]).repartition(parts(df.sparkSession), "node"), "candidate-texts")
    schema = "a binary, b binary"
    tested = edges = df.sparkSession.createDataFrame([], schema)
    roots = df.sparkSession.createDataFrame([], "node binary, root binary")
    for attempt in range(3):
        placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        if attempt:  # only buckets that still hold several components
            mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
            placed = placed.join(mixed, "key")
        placed = stored(placed.select("key", "node", "weight", "root"), "placed")
        pairs = star_pairs(placed, attempt) if attempt < 2 else prefix_pairs(placed, texts, threshold, size)
        pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        found = stored(verified(pairs, texts, threshold, size), "verified")
        tested = tested.unionByName(pairs)
        if found.isEmpty() and attempt:
            continue
        edges = edges.unionByName(found)
        roots = components(edges)
    return own.select("doc_id", "digest", "node"), roots


def classes(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, class_id) of every row; class_id is the smallest id among the row's near duplicates, itself included."""
    own, roots = links(with_text(df, id_col, text_col), threshold, **options)
    placed = own.join(roots, "node", "left").select("doc_id", "node", F.coalesce("root", "node").alias("root"))
    alone = placed.where("root is null").select("doc_id", F.col("doc_id").alias("class_id"))
    first = placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return placed.where("root is not null").join(first, "root").select("doc_id", "class_id").unionByName(alone)


def free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of df has it."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


def keep_one(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row of the smallest id of each class, with all its columns; rows without words all stay."""
    own, roots = links(with_text(df, id_col, text_col), threshold, **options)
    placed = own.where("node is not null").join(roots, "node", "left").select("doc_id", "digest", F.coalesce("root", "node").alias("root"))
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")).alias("low"))
    keep_digest, keep_id, mine = (free_name(df, x) for x in ("__digest", "__keep_id", "__own"))
    keepers = first.select(F.col("low.digest").alias(keep_digest), F.col("low.doc_id").alias(keep_id))
    # Rows meet their keeper by id and text, so the copies of one text do not gather in one task.
    wordless = ~F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike(r"[^ \t\n\x0B\f\r]")
    named = df.where(~wordless).withColumn(mine, digest(F.col(text_col)))
    kept = named.join(keepers, F.col(id_col).eqNullSafe(F.col(keep_id)) & (F.col(mine) == F.col(keep_digest))).dropDuplicates([id_col, mine]).select(*df.columns)
    return kept.unionByName(df.where(wordless))


def op5_bagminhash(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op5_bagminhash": op5_bagminhash}
