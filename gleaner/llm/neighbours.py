"""Operator 1: approximate nearest neighbours by learned partitions of the vector space.

A bounded, hash-drawn sample of vectors gives an exact nearest-neighbour graph.  The graph is cut into equally large
parts by recursive bisection (spectral start, then balance-keeping swaps).  A small network learns, from a vector, the
parts of its neighbours.  Every row is indexed under its most probable part; a query goes to its most probable parts,
as many as the sample needed for the wanted recall, and the rows there are reranked by their exact cosine.

Rows of a part are dealt to salted blocks and queries to blocks of their own, so no task holds more than one block of
each, however large a part grows, as when a third of all vectors are alike.

Defined results.  Vectors that are null, zero, of another length than the most common one, or that hold null or
non-finite components take no part, nor do rows without an id.  Rows that share a query's id are the query's own.
Repeated rows count once.  Ties go to the smaller id.  A query with fewer than k candidates returns all of them.
Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import parts, stored

#: Bound of the sample that is fitted.
SAMPLE = 4_096
GRAPH_DEGREE, HIDDEN, RECALL = 10, 128, 0.97
BLOCK_ROWS, BLOCK_QUERIES = 8_192, 1_024


# --------------------------------------------------------------------- the partition
def nearest(q: np.ndarray, x: np.ndarray, k: int, skip_same: bool = False) -> np.ndarray:
    """Indices of the k most similar rows of x for each unit row of q."""
    out = np.empty((len(q), min(k, len(x) - skip_same)), np.int64)
    for at in range(0, len(q), 512):
        sim = q[at : at + 512] @ x.T
        if skip_same:
            sim[np.arange(len(sim)), at + np.arange(len(sim))] = -np.inf
        out[at : at + 512] = np.argsort(-sim, axis=1, kind="stable")[:, : out.shape[1]]
    return out


def bisect(neighbours: list[np.ndarray], members: np.ndarray, rng: np.random.Generator, passes: int = 8) -> np.ndarray:
    """Which half each member belongs to; halves differ by one at most."""
    n = len(members)
    place = np.full(max(members.max() + 1, max((x.max() for x in neighbours if len(x)), default=0) + 1), -1)
    place[members] = np.arange(n)
    inner = [place[neighbours[m]] for m in members]
    row = np.repeat(np.arange(n), [len(x) for x in inner])
    col = np.concatenate(inner) if n else np.zeros(0, np.int64)
    row, col = row[col >= 0], col[col >= 0]
    degree = np.bincount(row, minlength=n) + 1.0
    v = rng.standard_normal(n)
    for _ in range(60):  # power iteration for the second eigenvector of the random walk
        v -= (v * degree).sum() / degree.sum()
        v = (np.bincount(row, v[col], n) + v) / degree
        v /= np.abs(v).max() or 1.0
    side = np.zeros(n, np.int64)
    side[np.argsort(v, kind="stable")[n // 2 :]] = 1
    for _ in range(passes):
        other = np.bincount(row, side[col] != side[row], n)
        gain = 2 * other - np.bincount(row, minlength=n)
        a, b = (np.flatnonzero(side == s) for s in (0, 1))
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        swap = np.flatnonzero(gain[a[:m]] + gain[b[:m]] > 0)[: max(1, n // 20)]
        if not len(swap):
            break
        side[a[swap]], side[b[swap]] = 1, 0
    return side


def partition(graph: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """Balanced parts of a neighbour graph, made symmetric; count is a power of two."""
    n = len(graph)
    pairs = np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()], 1)
    pairs = np.unique(np.concatenate([pairs, pairs[:, ::-1]]), axis=0)
    neighbours = np.split(pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(1, n)))
    part, groups = np.zeros(n, np.int64), [np.arange(n)]
    while len(groups) < count:
        halves = []
        for g in groups:
            side = bisect(neighbours, g, rng) if len(g) > 1 else np.zeros(len(g), np.int64)
            halves += [g[side == 0], g[side == 1]]
        groups = halves
    for p, g in enumerate(groups):
        part[g] = p
    return part


@dataclass
class Router:
    """One hidden layer; probabilities of the parts for unit vectors."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def ranked(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.probabilities(x), axis=1, kind="stable")


def train(x: np.ndarray, target: np.ndarray, rng: np.random.Generator, hidden: int = HIDDEN, epochs: int = 40, batch: int = 256, rate: float = 3e-3) -> Router:
    """Adam on the cross-entropy with soft targets."""
    shapes = [(x.shape[1], hidden), (hidden,), (hidden, target.shape[1]), (target.shape[1],)]
    p = [rng.standard_normal(s) * (2 / s[0]) ** 0.5 if len(s) == 2 else np.zeros(s) for s in shapes]
    m, v, step = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            own = order[at : at + batch]
            h = np.maximum(x[own] @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            e = np.exp(z - z.max(1, keepdims=True))
            d = (e / e.sum(1, keepdims=True) - target[own]) / len(own)
            dh = (d @ p[2].T) * (h > 0)
            step += 1
            for i, g in enumerate((x[own].T @ dh, dh.sum(0), h.T @ d, d.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - rate * (1 - epoch / epochs) * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Router(*p)


def fit(x: np.ndarray, count: int, k: int = 5, recall: float = RECALL, degree: int = GRAPH_DEGREE, seed: int = 1) -> Router:
    """A router over `count` parts for unit vectors x; probes reach `recall` of the sample's own neighbours."""
    rng = np.random.default_rng(seed)
    graph = nearest(x, x, degree, skip_same=True)
    part = partition(graph, count, rng)
    target = np.zeros((len(x), count))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1.0)
    target[np.arange(len(x)), part] += 1.0
    router = train(x, target / target.sum(1, keepdims=True), rng)
    ranked = router.ranked(x)
    home = ranked[:, 0]  # rows are indexed where the network puts them
    rank_of = np.empty_like(ranked)
    np.put_along_axis(rank_of, ranked, np.arange(count)[None, :], 1)
    need = np.take_along_axis(rank_of, home[graph[:, :k]], 1).ravel()
    # Queries outside the sample route a little worse: one more part than the sample asks for.
    router.probes = int(min(count, np.quantile(need, recall) + 2))
    return router


# --------------------------------------------------------------------- the search
def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): one row per id and vector that takes part, v as doubles."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.where(finite).dropDuplicates(["id", "v"])


def unit_rows(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64) if len(column) else np.zeros((0, 0))


def top(q_id: np.ndarray, q: np.ndarray, x_id: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, row id, score) of the k best rows of each query, ties to the smaller id; x_id ascends.

    The product only preselects: whatever comes within 1e-9 of the k-th best is scored again row by row, in one fixed
    order of additions, so equal vectors get equal scores wherever they stand.
    """
    xu, qu = unit_rows(x), unit_rows(q)
    x_norm, q_norm = np.sqrt((x * x).sum(1)), np.sqrt((q * q).sum(1))
    sim = qu @ xu.T
    sim[q_id[:, None] == x_id[None, :]] = -np.inf
    out: tuple[list, list, list] = ([], [], [])
    edge = -np.partition(-sim, min(k, sim.shape[1]) - 1, axis=1)[:, min(k, sim.shape[1]) - 1]
    for i in range(len(q)):
        at = np.flatnonzero((sim[i] >= edge[i] - 1e-9) & np.isfinite(sim[i]))
        score = (x[at] * q[i]).sum(1) / (x_norm[at] * q_norm[i])
        best = np.lexsort((x_id[at], -score))[:k]
        out[0].append(np.full(len(best), q_id[i]))
        out[1].append(x_id[at[best]])
        out[2].append(score[best])
    return tuple(np.concatenate(o) if o else np.zeros(0) for o in out)


def search(df: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE, part_count: int | None = None, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows that satisfy is_query (a condition on `id`) the k nearest found."""
    spark = df.sparkSession
    empty = "query_id long, rank int, vec_id long, score double"
    rows = usable(df, id_col, vector_col)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], empty)
    rows = rows.where(F.size("v") == sizes["d"])
    n = sizes["n"]
    draw = F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(1 << 30))
    drawn = rows.where(draw < int(min(1.0, 0.95 * sample / n if n > sample else 1.0) * (1 << 30))).orderBy("id").limit(sample).select("v").toArrow()
    x = unit_rows(matrix(drawn["v"].combine_chunks())) if drawn.num_rows else np.zeros((0, sizes["d"]))
    count = part_count or 1 << max(0, int(np.round(np.log2(max(1.0, n**0.5 / 4)))))
    count = max(1, min(count, 1 << int(np.log2(max(1, len(x) // 16)))))
    router = fit(x, count, k, recall) if count > 1 else Router(np.zeros((sizes["d"], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    shared = spark.sparkContext.broadcast(router)  # bounded by the network's size

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                best = shared.value.ranked(unit_rows(matrix(batch.column("v"))))[:, : shared.value.probes]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(list(best), pa.list_(pa.int64()))], ["id", "v", "best"])

    placed = stored(rows.mapInArrow(place, "id long, v array<double>, best array<long>"), "placed-vectors")
    index = placed.select("id", "v", F.element_at("best", 1).alias("part"))
    # One row per part: how many blocks its rows and its queries fill.
    asked = placed.where(is_query).groupBy("id").agg(F.min_by("v", F.xxhash64("v")).alias("v"), F.min_by("best", F.xxhash64("v")).alias("best"))
    queries = asked.select("id", "v", F.explode("best").alias("part"))
    blocks = index.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("row_blocks"))
    blocks = blocks.join(queries.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("query_blocks")), "part")
    blocks = F.broadcast(blocks)
    salt = lambda count_, seed: F.pmod(F.xxhash64(F.lit(seed), "id"), F.col(count_)).cast("int")
    every = lambda count_: F.explode(F.sequence(F.lit(0), F.col(count_) - 1))
    left = queries.join(blocks, "part").withColumn("qb", salt("query_blocks", 11)).withColumn("rb", every("row_blocks"))
    right = index.join(blocks, "part").withColumn("rb", salt("row_blocks", 12)).withColumn("qb", every("query_blocks"))
    cell = ["part", "qb", "rb"]

    def rerank(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        x = x.sort_values("x_id", kind="stable")
        a, b, s = top(q["q_id"].to_numpy(), np.stack(q["q_v"].to_numpy()).astype(float), x["x_id"].to_numpy(), np.stack(x["x_v"].to_numpy()).astype(float), k)
        return pd.DataFrame({"query_id": a.astype(np.int64), "vec_id": b.astype(np.int64), "score": s})

    width = max(1, min(parts(spark), count))
    left, right = (side.select(*cell, F.col("id").alias(f"{name}_id"), F.col("v").alias(f"{name}_v")).repartition(width, *cell) for side, name in ((left, "q"), (right, "x")))
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(rerank, "query_id long, vec_id long, score double")
    # A query whose parts hold too few rows is held against all rows, in blocks.
    found = stored(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), "found-neighbours")
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k).select(F.col("query_id").alias("id"))
    short = asked.join(enough, "id", "left_anti").select("id", "v")
    if not short.isEmpty():
        q_blocks, r_blocks = -(-short.count() // BLOCK_QUERIES), -(-n // BLOCK_ROWS)
        left = short.select(F.col("id").alias("q_id"), F.col("v").alias("q_v")).withColumn("qb", F.pmod(F.xxhash64(F.lit(11), "q_id"), F.lit(q_blocks)).cast("int")).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(r_blocks - 1))))
        right = placed.select(F.col("id").alias("x_id"), F.col("v").alias("x_v")).withColumn("rb", F.pmod(F.xxhash64(F.lit(12), "x_id"), F.lit(r_blocks)).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
        rest = left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInPandas(rerank, "query_id long, vec_id long, score double")
        found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(rest.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_learned_partitions(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0)


QUERIES = {"op1_learned_partitions": op1_learned_partitions}
