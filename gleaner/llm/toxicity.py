"""Operator 8: toxicity by a character n-gram linear classifier over naive Bayes log-count ratios.

Features are the presence of hashed character 3- to 5-grams of the lower-cased text, framed by spaces.  Each present
feature j has the value r_j, its naive Bayes log-count ratio between toxic and other documents; a logistic regression
over those values gives the score.

Defined results.  Null and empty texts have no features: their score is the intercept's, the prior.  Texts are read
whole.  Rows are scored one by one, so repeated rows, ties and null ids keep their rows; extra columns are not read.
Without labels of both classes every score is the share of toxic labels (0 without any labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import code_points, give_back, groups, small_batches, steps, strings, with_text

ORDERS = (3, 4, 5)
BUCKET_BITS = 20
#: Bound of the labelled sample that is fitted: so many documents of each class.
MAX_TOXIC, MAX_OTHER = 1_500, 4_000
THRESHOLD = 0.3


@dataclass
class Model:
    bucket: np.ndarray
    weight: np.ndarray
    intercept: float

    def table(self) -> np.ndarray:
        out = np.zeros(1 << BUCKET_BITS, np.float32)
        out[self.bucket] = self.weight
        return out


def grams(texts: list[str]):
    """Yields, for each order, (bucket of each position, offsets of documents); bucket 0 is kept for what crosses a text's end."""
    points, offsets = code_points([f" {t.lower()} " for t in texts])
    size, ends = len(points), offsets[1:]
    points = np.concatenate([points.astype(np.uint64), np.zeros(max(ORDERS), np.uint64)])
    code = points[:size].copy()
    for n in range(2, max(ORDERS) + 1):
        code *= np.uint64(0x100000001B3)
        code += points[n - 1 : n - 1 + size]
        if n in ORDERS:
            bucket = ((code ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
            for back in range(1, n):
                at = ends - back
                bucket[at[at >= offsets[:-1]]] = 0
            yield bucket, offsets


def present(texts: list[str], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of the distinct wanted features of each text."""
    found = []
    for bucket, offsets in grams(texts):
        at = np.flatnonzero(wanted[bucket])
        if len(at):
            found.append((np.searchsorted(offsets, at, "right") - 1) << BUCKET_BITS | bucket[at])
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs >> BUCKET_BITS, pairs & ((1 << BUCKET_BITS) - 1)


def fit_arrays(texts: list[str], toxic: np.ndarray, weight: np.ndarray, min_z: float = 5.0, ridge: float = 1e-3, rounds: int = 150) -> Model:
    """Fit on texts in memory; weight gives what each document stands for in the population."""
    prior = float((weight * toxic).sum() / weight.sum()) if len(texts) else 0.0
    if len(texts) == 0 or toxic.min() == toxic.max():
        p = min(max(prior, 1e-9), 1 - 1e-9)
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), float(np.log(p / (1 - p))))
    batches = [np.array(g) for g in groups(texts)]
    every, seen = np.ones(1 << BUCKET_BITS, bool), np.zeros((2, 1 << BUCKET_BITS))
    every[0] = False
    for g in batches:
        doc, bucket = present([texts[i] for i in g], every)
        label = toxic[g][doc]
        for c in (0, 1):
            seen[c] += np.bincount(bucket[label == c], minlength=1 << BUCKET_BITS)
    n = np.array([(toxic == 0).sum(), (toxic == 1).sum()], float)
    p = (seen + 1) / (n[:, None] + 2)
    pooled = (seen.sum(0) + 1) / (n.sum() + 2)
    z = (p[1] - p[0]) / np.sqrt(pooled * (1 - pooled) * (1 / n).sum())
    kept = np.flatnonzero((np.abs(z) >= min_z) & (seen.sum(0) >= 3) & every)
    ratio = np.log(p[1, kept] / p[0, kept])
    wanted, place = np.zeros(1 << BUCKET_BITS, bool), np.zeros(1 << BUCKET_BITS, np.int32)
    wanted[kept], place[kept] = True, np.arange(len(kept))
    # The features of a batch of documents at a time: (documents, place of the document in the batch, feature).
    held, square = [], np.zeros(len(texts))
    for g in batches:
        doc, bucket = present([texts[i] for i in g], wanted)
        held.append((g, doc.astype(np.int32), place[bucket]))
        square[g] = np.bincount(doc, ratio[place[bucket]] ** 2, len(g))
    share = weight / weight.sum()
    # Accelerated gradient steps on the weighted logistic loss with a ridge term.
    rate = 1 / (0.25 * ((share * square).sum() * 4 + 1) + ridge)
    w, b = np.zeros(len(kept)), float(np.log(prior / (1 - prior)))
    ahead, ahead_b = w.copy(), b
    for k in range(rounds):
        value, slope, slope_b = ratio * ahead, np.zeros(len(kept)), 0.0
        for g, doc, col in held:
            score = 1 / (1 + np.exp(-np.clip(np.bincount(doc, value[col], len(g)) + ahead_b, -30, 30)))
            miss = share[g] * (score - toxic[g])
            slope += np.bincount(col, miss[doc], len(kept))
            slope_b += miss.sum()
        nw = ahead - rate * (ratio * slope + ridge * ahead)
        nb = ahead_b - rate * slope_b
        push = k / (k + 3)
        ahead, ahead_b = nw + push * (nw - w), nb + push * (nb - b)
        w, b = nw, nb
    return Model(kept, (w * ratio).astype(np.float32), float(b))


def fit(documents: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_other: int = MAX_OTHER, **options) -> Model:
    """Fit on documents (doc_id, text) with known labels (doc_id, toxic), see training_labels.

    At most max_toxic and max_other documents are drawn by a hash of their id, before any text is read; the draw is so
    small that its ids are broadcast.
    """
    bound = {1: max_toxic, 0: max_other}
    count = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit(8), F.col("doc_id")), F.lit(1 << 30))
    keep = F.lit(False)
    for c, n in count.items():
        keep |= (F.col("toxic") == c) & (draw < int(min(1.0, 0.95 * bound[c] / n if n > bound[c] else 1.0) * (1 << 30)))
    drawn = labels.where(keep).limit(2 * (max_toxic + max_other))
    rows = documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    by_class = {c: [r for r in rows if r["toxic"] == c][: bound[c]] for c in (0, 1)}
    rows = by_class[0] + by_class[1]
    toxic = np.array([r["toxic"] for r in rows], int)
    weight = np.array([count[c] / len(by_class[c]) for c in toxic], float)
    model = fit_arrays([r["text"] or "" for r in rows], toxic, weight, **options)
    del rows, by_class
    give_back()
    return model


def score_texts(model: Model, table: np.ndarray, wanted: np.ndarray, texts: list[str]) -> np.ndarray:
    doc, bucket = present(texts, wanted)
    total = np.bincount(doc, table[bucket], len(texts)) + model.intercept
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def score(df: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of each row; one pass, no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most 2^20 buckets
    docs = with_text(df, id_col, text_col)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        m = shared.value
        table = m.table()
        wanted = table != 0
        for step in steps(batches):
            s = score_texts(m, table, wanted, strings(step.column("text")))
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.mapInArrow(run, f"doc_id {id_type}, score double, predicted int")


def reject(df: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of df whose score stays below the threshold, all columns kept."""
    small_batches(df.sparkSession)
    shared, names = df.sparkSession.sparkContext.broadcast(model), df.columns

    def run(batches):
        m = shared.value
        table = m.table()
        wanted = table != 0
        for step in steps(batches, names[names.index("text")]):
            s = score_texts(m, table, wanted, strings(step.column("text")))
            yield step.filter(pa.array(s < threshold))

    return df.mapInArrow(run, df.schema)


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the training fold: crc32 of the id as text, mod 4, is not 2; one row per id, toxic wins."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold != 2)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(documents, training_labels(labels))
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4) == 2
    return score(documents, model).select("doc_id", held.alias("held_out"), "score", "predicted")


QUERIES = {"op8_toxicity": op8_toxicity}
