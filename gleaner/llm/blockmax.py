"""Operator 13: ranked lexical search by variable-block-max WAND.

One pass cuts every text into terms and keeps, per document, its length and the terms that some query holds.  Counts of
documents, lengths and holders come from that table.  A second pass reads it in shards, runs of rows of one partition
that hold about two million postings: each shard is an inverted index of its own.  A term's postings are cut into blocks
by dynamic programming, which minimises the sum of (block maximum - posting's impact) plus a price per block, so bounds
are tight where impacts change and blocks are long where they do not.

Search is exact.  The bounds of the blocks over a document add up to its upper bound.  Documents are visited by falling
bound, in growing rounds; a round ends with a higher entry score, and the search ends when no bound reaches it.  Terms
whose bounds together stay under the entry score cannot bring a document in alone (the pivot rule): only postings of the
others name candidates, and blocks without live documents are never opened.  The entry score begins at the k-th best
contribution of a single term, which k documents reach by that term alone.  A task keeps its entry scores from shard to
shard and returns its best rows once; the best of all tasks are the result.

Queries are taken in blocks of bounded size; for each block the two passes run over all documents.

Defined results.  A null text, or one without terms, counts in neither N nor L and is never found; a query without terms
has no rows.  Texts of several rows of one item id form one query, equal rows counting once.  Repeated documents are
documents of their own; null ids come last among equal scores.  Terms that all documents hold may weigh nothing.  Empty
tables give no rows.  Extra columns are not read.  Very long texts are cut into terms piece by piece.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ._common import small_batches, steps, stored, utf8, with_text

TOP = 20
#: Queries and bytes of their text that one pass takes: bounds what the driver and each task hold of them.
QUERY_ROWS, QUERY_BYTES = 4096, 4 << 20
#: Postings of a shard, and bytes of a text that are cut into terms at a time.
SHARD_POSTINGS, PIECE_BYTES = 1 << 21, 1 << 20
#: Blocks: postings a unit, units a block at most, and the price of a block in standard deviations of a list's impacts.
UNIT, WIDEST, PRICE = 4, 32, 40.0
#: Documents that the first round of a search visits, and the growth of the rounds.
FIRST_ROUND, GROWTH = 256, 8
SCALE = 1_000_000_000
#: Bytes that belong to terms, A-Z folded to a-z; all other ASCII is a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


def pieces(folded: bytes, start: int, stop: int, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The terms of folded[start:stop], some bytes at a time, never cutting a term."""
    while start < stop:
        cut = stop if stop - start <= size else folded.find(b" ", start + size, stop)
        cut = stop if cut < 0 else cut
        yield folded[start:cut].split()
        start = cut


# --------------------------------------------------------------------- queries and postings
@dataclass
class Queries:
    """A block of queries: ids, and per query its terms' numbers and multiplicities; vocabulary: term -> number."""

    ids: list
    terms: list[np.ndarray]
    times: list[np.ndarray]
    vocabulary: dict[bytes, int]


def query_blocks(items: DataFrame, id_col: str, text_col: str, rows: int = QUERY_ROWS, size: int = QUERY_BYTES) -> Iterator[Queries]:
    """The items in blocks; the driver holds one block at a time."""
    named = with_text(items, id_col, text_col).where("text is not null").distinct()
    each = named.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list("text")), "\n").alias("text"))
    held, held_bytes = [], 0
    for row in each.orderBy("doc_id").toLocalIterator():
        held.append((row.doc_id, Counter(terms(row.text.encode("utf-8", "surrogatepass")))))
        held_bytes += len(row.text)
        if len(held) >= rows or held_bytes >= size:
            yield _queries(held)
            held, held_bytes = [], 0
    if held:
        yield _queries(held)


def _queries(held: list[tuple[object, Counter]]) -> Queries:
    held = [(k, c) for k, c in held if c]
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in held for t in c}))}
    numbers = [np.array([vocabulary[t] for t in c], np.int64) for _, c in held]
    return Queries([k for k, _ in held], numbers, [np.array(list(c.values()), np.int64) for _, c in held], vocabulary)


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): n counts all terms of the text; terms are those of the vocabulary, ascending."""
    size = len(vocabulary)

    def run(batches):
        known = {t: i + 1 for t, i in vocabulary.items()}
        for step in steps(batches):
            data, offsets = utf8(step.column("text"))
            folded, n, keys, counts = data.tobytes().translate(_FOLD), [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                own = 0
                for words in pieces(folded, a, b):
                    own += len(words)
                    found = np.array([*filter(None, map(known.get, words))], np.int64)
                    key, count = np.unique(found + (i * size - 1), return_counts=True)
                    keys.append(key)
                    counts.append(count)
                n.append(own)
            flat, sums = _summed(keys, counts)
            ends = np.searchsorted(flat, np.arange(step.num_rows + 1) * size)
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind)) for x, kind in ((flat % max(size, 1), pa.int32()), (sums, pa.int64()))]
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their counts added up; pieces of a text may repeat keys."""
    key, count = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, counts))
    flat, at = np.unique(key, return_inverse=True)
    sums = np.zeros(len(flat), np.int64)
    np.add.at(sums, at, count)
    return flat, sums


# --------------------------------------------------------------------- blocks and shards
def block_starts(impact: np.ndarray, list_starts: np.ndarray, unit: int = UNIT, widest: int = WIDEST, price: float = PRICE) -> np.ndarray:
    """Places where blocks begin, for posting lists that stand one after another, by dynamic programming.

    Boundaries lie on a grid of `unit` postings.  cost of a block = length x maximum + price of its list; the impacts'
    own sum is the same for every cut, so this minimises the bounds' error.  All lists advance one unit at a time.
    """
    sizes = np.diff(list_starts)
    units = -(-sizes // unit)
    order = np.argsort(-units, kind="stable")
    order = order[units[order] > 0]
    if not len(order):
        return np.zeros(0, np.int64)
    first = np.cumsum(units) - units
    total = int(units.sum())
    owner = np.repeat(np.arange(len(sizes)), units)
    begin = list_starts[owner] + (np.arange(total) - first[owner]) * unit
    length = np.minimum(begin + unit, list_starts[owner + 1]) - begin
    high = np.maximum.reduceat(impact, begin).astype(np.float64)
    mean = np.add.reduceat(impact.astype(np.float64), list_starts[:-1][sizes > 0]) / sizes[sizes > 0]
    square = np.add.reduceat(impact.astype(np.float64) ** 2, list_starts[:-1][sizes > 0]) / sizes[sizes > 0]
    each = np.zeros(len(sizes))
    each[sizes > 0] = price * np.sqrt(np.maximum(square - mean**2, 0)) + 1
    best = np.zeros(total + len(sizes))  # one more place per list: the cost of nothing
    at = first + np.arange(len(sizes))
    width = np.zeros(total, np.int64)
    active = units[order]
    for j in range(1, int(active[0]) + 1):
        own = order[: np.searchsorted(-active, -j, "right")]
        span = np.arange(min(j, widest))
        look = first[own, None] + (j - 1 - span)
        cost = np.maximum.accumulate(high[look], 1) * np.cumsum(length[look], 1) + best[at[own, None] + (j - 1 - span)]
        pick = cost.argmin(1)
        best[at[own] + j] = cost[np.arange(len(own)), pick] + each[own]
        width[first[own] + j - 1] = pick + 1
    starts, own, place = [], order, units[order].copy()
    while len(own):
        place = place - width[first[own] + place - 1]
        starts.append(begin[first[own] + place])
        own, place = own[place > 0], place[place > 0]
    return np.sort(np.concatenate(starts))


class Shard:
    """Inverted index of some documents: posting lists by term, in blocks with their highest impact."""

    def __init__(self, ids: np.ndarray, nulls: np.ndarray, n: np.ndarray, owner: np.ndarray, term: np.ndarray, tf: np.ndarray, vocabulary: int, documents: int, length: int):
        self.ids, self.nulls, self.size = ids, nulls, len(ids)
        norm = 12 * (75 + (25 * n * documents) // max(length, 1))
        order = np.argsort(term, kind="stable")
        self.doc = owner[order]
        self.impact = (SCALE * tf[order]) // (1000 * tf[order] + norm[self.doc])
        self.lists = np.searchsorted(term[order], np.arange(vocabulary + 1))
        self.begin = block_starts(self.impact, self.lists)
        self.end = np.append(self.begin[1:], len(self.doc))
        self.high = np.maximum.reduceat(self.impact, self.begin) if len(self.begin) else np.zeros(0, np.int64)
        self.blocks = np.searchsorted(self.begin, self.lists)
        self.kth: dict[tuple[int, int], int] = {}
        self.opened = 0  # postings read so far

    def reached(self, term: int, k: int) -> int:
        """The k-th highest impact of a list, 0 if it has fewer postings."""
        if (term, k) not in self.kth:
            own = self.impact[self.lists[term] : self.lists[term + 1]]
            self.kth[term, k] = int(np.partition(own, len(own) - k)[len(own) - k]) if len(own) >= k else 0
        return self.kth[term, k]

    def search(self, term: np.ndarray, weight: np.ndarray, k: int, best: tuple) -> tuple:
        """best: (scores, nulls, ids), the best so far, merged with this shard's; weight: of each term, times included."""
        counts = np.diff(self.blocks)[term]
        use = (weight > 0) & (counts > 0)
        term, weight, counts = term[use], weight[use], counts[use]
        if not len(term):
            return best
        place = np.arange(len(term)).repeat(counts)
        block = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + self.blocks[term][place]
        begin, end, bound = self.begin[block], self.end[block], self.high[block] * weight[place]
        # A block answers for the documents from the one behind the block before it to its last.
        last = self.doc[end - 1]
        low = np.where(block == self.blocks[term][place], 0, np.append(0, last[:-1] + 1))
        change = np.bincount(low, bound, self.size + 1)
        change -= np.bincount(last + 1, bound, self.size + 1)
        upper = np.cumsum(change)[:-1]  # whole numbers below 2^53: exact
        lists = np.maximum.reduceat(bound, np.cumsum(counts) - counts)
        rising = np.argsort(lists, kind="stable")
        reach = np.empty(len(lists), np.int64)
        reach[rising] = np.cumsum(lists[rising])
        visited, target = np.zeros(self.size, bool), FIRST_ROUND
        least = max(1, *(self.reached(t, k) * w for t, w in zip(term.tolist(), weight.tolist(), strict=True)))
        while True:
            entry = max(least, best[0][-1] if len(best[0]) >= k else 1)
            live = (upper >= entry) & ~visited
            left = int(live.sum())
            if not left:
                return best
            if left > target:
                live &= upper >= np.partition(upper[live], left - target)[left - target]
            visited |= live
            essential = reach >= entry
            rest = lists[~essential].sum()
            best = self._round(live, essential, rest, place, begin, end, low, last, weight, k, entry, best)
            target *= GROWTH

    def _round(self, live, essential, rest, place, begin, end, low, last, weight, k, entry, best) -> tuple:
        """Scores the live documents that can reach the entry score; rest: what the other terms add at most."""
        candidate, score = np.zeros(self.size, bool), np.zeros(self.size)
        for lead in (True, False):
            before = np.concatenate([[0], np.cumsum(live if lead else candidate)])
            use = (essential[place] == lead) & (before[last + 1] > before[low])
            sizes = end[use] - begin[use]
            if not sizes.sum():
                if lead:
                    return best
                continue
            at = np.arange(sizes.sum()) + np.repeat(begin[use] - (np.cumsum(sizes) - sizes), sizes)
            self.opened += len(at)
            doc = self.doc[at]
            if lead:
                candidate[doc] = True
                candidate &= live
            keep = candidate[doc]
            score += np.bincount(doc[keep], (self.impact[at] * np.repeat(weight[place[use]], sizes))[keep], self.size)
            if lead:
                candidate &= score + rest >= entry
        found = np.flatnonzero(score >= entry)
        return merged(best, (score[found].astype(np.int64), self.nulls[found], self.ids[found]), k)


def merged(a: tuple, b: tuple, k: int) -> tuple:
    """The k best of two sets of (scores, nulls, ids): highest score, then ids ascending, null ids last."""
    score, null, doc = (np.concatenate(x) for x in zip(a, b, strict=True))
    order = np.lexsort((doc, null, -score))[:k]
    return score[order], null[order], doc[order]


def nothing() -> tuple:
    return np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)


def shards(batches: Iterator[pa.RecordBatch], vocabulary: int, documents: int, length: int, most: int = SHARD_POSTINGS) -> Iterator[Shard]:
    """Shards of stored rows, of about `most` postings or documents each."""

    def built(held: list[pa.RecordBatch]) -> Shard:
        table = pa.Table.from_batches(held).combine_chunks()
        ids = table.column("doc_id").combine_chunks()
        lists = table.column("terms").combine_chunks()
        owner = np.repeat(np.arange(table.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        term, tf = (table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "tfs"))
        nulls = ids.is_null().to_numpy(zero_copy_only=False)
        return Shard(ids.fill_null(0).to_numpy(zero_copy_only=False), nulls, table.column("n").to_numpy(), owner, term, tf, vocabulary, documents, length)

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column("terms").flatten()) + batch.num_rows
        if size >= most:
            yield built(held)
            held, size = [], 0
    if held:
        yield built(held)


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each term, in doubles; no document holds a term of df 0."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def best_of_block(docs: DataFrame, queries: Queries, k: int, id_type: T.DataType, most: int = SHARD_POSTINGS) -> DataFrame:
    """(item_id, doc_id, score): the k best rows of each task for each query of a block."""
    rows = stored(postings(docs, queries.vocabulary), "postings")
    documents, length = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    df = np.zeros(len(queries.vocabulary), np.int64)
    for row in held.toLocalIterator():  # as many as a block of queries has terms
        df[row.t] = row.df
    weight = weights(df, documents)

    def run(batches):
        best = [nothing() for _ in queries.ids]
        for shard in shards((b for b in batches if b.num_rows), len(weight), documents, length, most):
            for i, (term, times) in enumerate(zip(queries.terms, queries.times, strict=True)):
                best[i] = shard.search(term, weight[term] * times, k, best[i])
        for i, (score, null, doc) in enumerate(best):
            if len(score):
                yield pa.RecordBatch.from_arrays([pa.array([queries.ids[i]] * len(score), to_arrow_type(id_type)), pa.array(doc, pa.int64(), mask=null), pa.array(score)], ["item_id", "doc_id", "score"])

    schema = T.StructType([T.StructField("item_id", id_type), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    return rows.where(F.size("terms") > 0).mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", query_rows: int = QUERY_ROWS, most: int = SHARD_POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item; ids of documents are whole numbers."""
    spark = docs.sparkSession
    small_batches(spark)
    id_type = items.schema[item_col].dataType
    found = spark.createDataFrame([], T.StructType([T.StructField("item_id", id_type), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    for block in query_blocks(items, item_col, item_text, query_rows):
        if block.vocabulary:
            found = found.unionByName(best_of_block(with_text(docs, id_col, text_col), block, k, id_type, most))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return search(docs, items)


_TERMS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE_SQL = {
    "op13_lexical_search": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format("text")} AS ts FROM documents),
 g AS (SELECT count(*) AS nn, sum(len(ts))::BIGINT AS ll FROM d WHERE len(ts) > 0), e AS (SELECT r, unnest(ts) AS t FROM d), tf AS (SELECT r, t, count(*) AS tf FROM e GROUP BY 1, 2), df AS (SELECT t, count(*) AS df FROM tf GROUP BY 1),
 q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_TERMS.format("text")}) AS t FROM benchmark) GROUP BY 1, 2),
 s AS (SELECT item_id, d.doc_id, d.r, sum(times * CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(d.ts) * nn) // ll))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN df USING (t) JOIN d ON d.r = tf.r, g GROUP BY 1, 2, 3)
 SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20"""
}
QUERIES = {"op13_lexical_search": op13_lexical_search}
