"""Operator 2: language identification by interpolated Kneser-Ney character models in sorted hash arrays.

A text is reduced to its lower-cased letters, with every run of other characters as one space.  One Kneser-Ney model
per language gives the probability of each character after the three before it.  The models share one sorted array of
64-bit n-gram hashes per order; the row at a hash has one log probability per language, so a single binary search
serves all languages.  The language of lowest length-normalised cross-entropy wins.

Rejection is calibrated for each language on sample documents that were not used for the counts: a text is rejected
when its cross-entropy lies above the median of its predicted language by more than `slack` times a high quantile of the
length-adjusted deviations seen there.  The bound lies between half the way to and the median of what documents of the
other languages have in that language, so single junk or mislabelled documents, however long, do not move it far, and
short texts are not let through for their length.

Defined results.  Texts that are null or hold no letter: `und`, score 0, rejected.  Ties go to the language that sorts
first.  Without any training text every language is `und`.  Rows are scored one by one, whole; repeated rows and null
ids keep their rows, extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import code_points, give_back, groups, mix, small_batches, steps, strings, with_text

ORDER = 4
UNKNOWN = "und"
#: Bound of the sample that is fitted: so many documents per language, half of them for the counts.
MAX_DOCS_PER_LANGUAGE = 1_000
SLACK = 2.0
#: Share of the calibration documents whose deviations count for the bound.
SURE = 0.99
_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """For the first 2^16 code points: is it a letter."""
    global _letters
    if _letters is None:
        _letters = np.array([chr(i).isalpha() for i in range(1 << 16)])
    return _letters


def reduced(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, offsets, letters per text): letters lower-cased, each run of others one space, a space first."""
    points, offsets = code_points([t.lower() for t in texts])
    table = letter_table()
    is_letter = table[np.minimum(points, 0xFFFF)]
    high = np.flatnonzero(points > 0xFFFF)
    if len(high):
        is_letter[high] = [chr(c).isalpha() for c in points[high]]
    first = np.zeros(len(points), bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    before = np.concatenate([[False], is_letter[:-1]]) & ~first
    keep = is_letter | before
    count = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(is_letter)])
    out = np.where(is_letter, points, 32)[keep]
    return out, count[offsets], np.diff(letters[offsets])


def hashes(points: np.ndarray, offsets: np.ndarray, order: int) -> list[np.ndarray]:
    """For k = 1..order: hash of the k characters that end at each position; a text's start is padded with spaces."""
    width = order - 1
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    padded = np.full(len(points) + n * width, 32, np.uint64)
    at = np.arange(len(points)) + np.repeat((np.arange(n) + 1) * width, sizes)
    padded[at] = points
    out, code = [], np.zeros(len(points), np.uint64)
    for k in range(order):
        code = code + (padded[at - k] + np.uint64(1)) * np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64))
        out.append(mix(code ^ np.uint64(k)))
    return out


def contexts(points: np.ndarray, offsets: np.ndarray, order: int) -> list[np.ndarray]:
    """For k = 1..order: hash of the k - 1 characters before each position (a constant for k = 1)."""
    width = order - 1
    n = len(offsets) - 1
    padded = np.full(len(points) + n * width, 32, np.uint64)
    at = np.arange(len(points)) + np.repeat((np.arange(n) + 1) * width, np.diff(offsets))
    padded[at] = points
    out, code = [], np.zeros(len(points), np.uint64)
    for k in range(order):
        if k:
            code = code + (padded[at - k] + np.uint64(1)) * np.uint64(pow(0xD1B54A32D192ED03, 2 * k + 1, 1 << 64))
        out.append(mix(code ^ np.uint64(k + 77)))
    return out


@dataclass
class Model:
    languages: list[str]
    grams: list[np.ndarray] = field(default_factory=list)  # by order: sorted hashes
    logp: list[np.ndarray] = field(default_factory=list)  # by order: float32 [hashes, languages]
    heads: list[np.ndarray] = field(default_factory=list)  # by order: sorted context hashes
    backoff: list[np.ndarray] = field(default_factory=list)  # by order: float32 [contexts, languages]
    floor: float = -14.0
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None  # by language: length-adjusted deviation
    cap: np.ndarray | None = None  # by language: cross-entropy of unlike text
    sharpness: float = 0.1


def locate(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def counted(texts: list[str], order: int) -> list[dict]:
    """For k = 1..order the distinct k-grams of texts: keys, counts n, hash of the context, key of the shorter gram."""
    per: list[dict] = []
    for group in groups(texts):
        points, offsets, _ = reduced([texts[i] for i in group])
        g, c = hashes(points, offsets, order), contexts(points, offsets, order)
        for k in range(order):
            part = {"keys": g[k], "n": np.ones(len(points)), "head": c[k], "lower": g[k - 1] if k else g[k]}
            if k < len(per):
                part = {f: np.concatenate([per[k][f], part[f]]) for f in part}
            keys, first, where = np.unique(part["keys"], return_index=True, return_inverse=True)
            merged = {"keys": keys, "n": np.bincount(where, part["n"], len(keys)), "head": part["head"][first], "lower": part["lower"][first]}
            per[k : k + 1] = [merged]
    return per or [{f: np.zeros(0, float if f == "n" else np.uint64) for f in ("keys", "n", "head", "lower")} for _ in range(order)]


def estimate(texts: dict[str, list[str]], order: int = ORDER) -> Model:
    """Kneser-Ney tables of all languages from texts in memory."""
    languages = sorted(texts)
    model = Model(languages)
    seen: list[list[dict]] = []  # by language, by order
    for lang in languages:
        per = counted(texts[lang], order)
        for k in range(order - 1):  # continuation counts: distinct characters to the left
            lower, n = np.unique(per[k + 1]["lower"], return_counts=True)
            at, ok = locate(lower, per[k]["keys"]) if len(lower) else (None, np.zeros(len(per[k]["keys"]), bool))
            per[k]["n"] = np.where(ok, n[at], 1.0) if len(lower) else per[k]["n"]
        seen.append(per)
    letters = max(2, len(np.unique(np.concatenate([p[0]["keys"] for p in seen]))) + 1)  # of all languages, and one for the unknown
    for k in range(order):
        keys, first = np.unique(np.concatenate([p[k]["keys"] for p in seen]), return_index=True)
        head = np.concatenate([p[k]["head"] for p in seen])[first]
        lower = np.concatenate([p[k]["lower"] for p in seen])[first] if k else None
        heads = np.unique(head)
        prob, back = np.zeros((len(keys), len(languages))), np.ones((len(heads), len(languages)))
        for j, p in enumerate(seen):
            n = p[k]["n"]
            n1, n2 = (n == 1).sum(), (n == 2).sum()
            discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.75
            at = np.searchsorted(heads, p[k]["head"])
            total, kinds = np.bincount(at, n, len(heads)), np.bincount(at, minlength=len(heads))
            back[:, j] = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            prob[np.searchsorted(keys, p[k]["keys"]), j] = np.maximum(n - discount, 0) / total[at]
        gamma = back[np.searchsorted(heads, head)]
        if k:
            at, ok = locate(model.grams[k - 1], lower)
            prob += gamma * np.where(ok[:, None], np.exp(model.logp[k - 1][at]), 1 / letters)
        else:
            prob += gamma / letters
        model.grams.append(keys)
        model.logp.append(np.log(np.maximum(prob, 1e-12)).astype(np.float32))
        model.heads.append(heads)
        model.backoff.append(np.log(np.maximum(back, 1e-12)).astype(np.float32))
    model.floor = float(-np.log(letters))
    return model


def entropies(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(cross-entropy in nats a character [texts, languages], letters per text)."""
    points, offsets, letters = reduced(texts)
    sizes, order, width = np.diff(offsets), len(model.grams), len(model.languages)
    total = np.zeros((len(texts), width))
    if len(points):
        g = hashes(points, offsets, order)
        at, ok = locate(model.grams[-1], g[-1])
        value = model.logp[-1][at]
        missed = np.flatnonzero(~ok)
        if len(missed):
            c = [x[missed] for x in contexts(points, offsets, order)]
            left, sums = np.arange(len(missed)), np.zeros((len(missed), width), np.float32)
            for k in range(order - 1, -1, -1):
                if k < order - 1:
                    at, ok = locate(model.grams[k], g[k][missed[left]])
                    sums[left[ok]] += model.logp[k][at[ok]]
                    left = left[~ok]
                at, ok = locate(model.heads[k], c[k][left])
                sums[left[ok]] += model.backoff[k][at[ok]]
            sums[left] += model.floor
            value[missed] = sums
        full = np.flatnonzero(sizes)
        total[full] = np.add.reduceat(value, offsets[:-1][full], axis=0, dtype=np.float64)
    return -total / np.maximum(sizes, 1)[:, None], letters


def calibrate(model: Model, texts: dict[str, list[str]]) -> None:
    """Set the rejection bound and the sharpness of scores from texts of known language."""
    sure, seen = [], []
    model.mean = np.full(len(model.languages), -model.floor)
    model.spread = np.ones(len(model.languages))
    model.cap = np.full(len(model.languages), -model.floor)
    for j, lang in enumerate(model.languages):
        found = [entropies(model, [texts[lang][i] for i in group]) for group in groups(texts[lang])] or [entropies(model, [""])]
        h, n = (np.concatenate(x) for x in zip(*found, strict=True))
        h, n = h[n > 0], n[n > 0]
        seen.append(h)
        if not len(n):
            continue
        # The median by letters, and the quantile from below: the largest of two or more deviations never counts.
        order = np.argsort(h[:, j], kind="stable")
        reached = np.cumsum(n[order])
        model.mean[j] = h[order[np.searchsorted(reached, reached[-1] / 2)], j]
        model.spread[j] = np.quantile(np.maximum(h.min(1) - model.mean[j], 0) * np.sqrt(n), SURE, method="lower")
        sure.append((h, n, np.full(len(n), j)))
    for j in range(len(model.languages)):
        unlike = np.concatenate([h[:, j] for i, h in enumerate(seen) if i != j] or [np.zeros(0)])
        if len(unlike):
            model.cap[j] = np.median(unlike)
    best = None
    for sharp in (0.01, 0.03, 0.1, 0.3, 1.0):
        loss = 0.0
        for h, n, j in sure:
            p = posterior(h, n, sharp)
            loss -= np.log(np.maximum(p[np.arange(len(n)), j], 1e-12)).sum()
        if best is None or loss < best:
            best, model.sharpness = loss, sharp


def posterior(h: np.ndarray, n: np.ndarray, sharpness: float) -> np.ndarray:
    x = -(h - h.min(1, keepdims=True)) * (sharpness * n)[:, None]
    e = np.exp(np.maximum(x, -700))
    return e / e.sum(1, keepdims=True)


def predict_texts(model: Model, texts: list[str], slack: float = SLACK):
    """(language, score, cross-entropy, rejected) of each text."""
    if not model.languages:
        n = len(texts)
        return np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n), np.ones(n, bool)
    h, n = entropies(model, texts)
    best = h.argmin(1)
    score = np.where(n > 0, posterior(h, np.maximum(n, 1), model.sharpness).max(1), 0.0)
    lang = np.where(n > 0, np.array(model.languages, object)[best], UNKNOWN)
    low = h[np.arange(len(texts)), best]
    bound = model.mean[best] + slack * model.spread[best] / np.sqrt(np.maximum(n, 1))
    bound = np.clip(bound, (model.mean[best] + model.cap[best]) / 2, model.cap[best])
    bound = np.maximum(bound, model.mean[best] * 1.25)
    return lang, score, np.where(n > 0, low, 0.0), (n == 0) | (low > bound)


def fit(labelled: DataFrame, max_docs: int = MAX_DOCS_PER_LANGUAGE, order: int = ORDER) -> Model:
    """Fit on (doc_id, text, lang): at most max_docs documents per language, drawn by a hash of their id."""
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    count = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    draw, keep = F.pmod(F.xxhash64(F.lit(2), F.col("doc_id")), F.lit(1 << 30)), F.lit(False)
    for lang, n in count.items():
        keep |= (F.col("lang") == lang) & (draw < int(min(1.0, 0.9 * max_docs / n if n > max_docs else 1.0) * (1 << 30)))
    rows = labelled.where(keep).select("doc_id", "text", "lang").collect() if count else []
    rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"]))
    texts = {lang: [r["text"] for r in rows if r["lang"] == lang][:max_docs] for lang in sorted(count)}
    texts = {k: v for k, v in texts.items() if v}
    if not texts:
        return Model([])
    model = estimate({k: v[::2] for k, v in texts.items()}, order)
    calibrate(model, {k: v[1::2] or v for k, v in texts.items()})
    del rows, texts
    give_back()
    return model


def predict(df: DataFrame, model: Model, slack: float = SLACK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, rejected) of each row; one pass, no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the sample it was fitted on
    docs = with_text(df, id_col, text_col)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for step in steps(batches):
            lang, score, low, out = predict_texts(shared.value, strings(step.column("text")), slack)
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(low), pa.array(out)], ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return docs.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double, cross_entropy double, rejected boolean")


def reject(df: DataFrame, model: Model, slack: float = SLACK) -> DataFrame:
    """The rows of df that are not rejected, all columns kept."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for step in steps(batches):
            yield step.filter(pa.array(~predict_texts(shared.value, strings(step.column("text")), slack)[3]))

    return df.mapInArrow(run, df.schema)


def training_rows(documents: DataFrame) -> DataFrame:
    """Rows of the training fold with a language: crc32 of the id as text, mod 4, is not 2."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return documents.where(F.col("lang").isNotNull() & (fold != 2)).select("doc_id", "text", "lang")


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(training_rows(documents))
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4) == 2
    return predict(documents, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


QUERIES = {"op2_language_id": op2_language_id}
