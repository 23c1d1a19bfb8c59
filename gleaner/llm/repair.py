"""Operator 9: token ids as grammar-compressed binary shards (Re-Pair) with random-access decoding.

Documents are put into ascending id order by range and encoded; every few hundred thousand ids become one shard.  In a
shard the most frequent pairs of neighbouring symbols are replaced, round by round, by nonterminals until no pair pays
for its rule, that is none occurs MIN_COUNT times, or no 16-bit symbol is left.  A pair never spans two documents.  A
shard stores its rules, the expansion length of every nonterminal, the symbol sequence and where each document starts in symbols and in ids, so any document decodes on its own.

File format: a Parquet table of one row per shard (range, block, start, doc_ids, n_ids, payload).  `start` counts the ids
of the range's earlier shards.  `payload` has a header of nine unsigned 64-bit numbers (MAGIC, base, rules, symbols,
documents, symbol width in bytes (2 or 4), ids, symbols a frame, bytes of the index), the bytes of each frame as unsigned
32-bit numbers, the index (rules, expansion lengths, each document's first symbol and first id) as one zstd frame, and
the symbols in zstd frames of their own: a document is decoded from the index and the frames that hold it.

Defined results.  A null or empty text has only its end id.  Null doc_ids come first; rows of one doc_id are ordered by
their text, repeated rows keep one row each.  An empty table gives no shard and no rows.  Extra columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from itertools import count

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import parts, range_of, shared_dir, splitters, steps, utf8, with_text
from .pieces import ENCODE_BYTES, cut_before_spaces, encoder

VOCABULARY, END_ID, BASE = "byte_bpe_50k.json", 2, 50_257
SHARD_IDS = 1 << 19
MIN_COUNT, RULES_A_ROUND, HASH_BITS = 8, 4_000, 20
MAGIC, HEAD_NUMBERS = 0x32525041_52454C47, 9
#: Symbols of one compressed frame: what is inflated to decode a short document.
FRAME_SYMBOLS = 1 << 14


# --------------------------------------------------------------------- the grammar
def frequent(left: np.ndarray, right: np.ndarray, min_count: int):
    """Yields (places of pairs, are all frequent ones among them): the fullest hash buckets first, then all full ones.

    The fullest buckets may hold only rare pairs that share a hash, so the caller may have to go on.
    """
    if len(left) <= 1 << (HASH_BITS - 3):
        yield np.arange(len(left)), True
        return
    bucket = ((left * np.uint32(0x9E3779B1)) ^ (right * np.uint32(0x85EBCA77))) >> np.uint32(32 - HASH_BITS)
    filled = np.bincount(bucket, minlength=1 << HASH_BITS)
    often = np.flatnonzero(filled >= min_count)
    often = often[np.argsort(-filled[often], kind="stable")]
    for some in (often[:RULES_A_ROUND], often) if len(often) > RULES_A_ROUND else (often,):
        wanted = np.zeros(1 << HASH_BITS, bool)
        wanted[some] = True
        yield np.flatnonzero(wanted[bucket]), len(some) == len(often)


def compress(ids: np.ndarray, doc_starts: np.ndarray, base: int, max_rules: int | None = None, min_count: int = MIN_COUNT, rounds: int | None = None):
    """(symbols, rules [n, 2], expansion lengths, symbol offset of each document) of one shard.

    Each round counts pairs by a hash, takes the most frequent exact pair of each frequent bucket and replaces its
    occurrences from left to right; where chosen pairs overlap, every second one of the run is replaced.  Only pairs
    with a symbol of the round before can have become frequent, so a round that left no frequent pair out is followed
    by one that looks at those alone; what it may have left is found by the last rounds, which count all pairs.  It goes
    on until no pair occurs min_count times; every round adds a rule, so it ends.
    """
    symbols = ids.astype(np.uint32)
    first = np.zeros(len(symbols), bool)
    first[doc_starts[doc_starts < len(symbols)]] = True
    limit = (1 << 16) - base if max_rules is None else max_rules
    rules, lengths = np.zeros((0, 2), np.uint32), np.zeros(0, np.int64)
    fresh_from: int | None = None  # the first symbol of the round before, where only those matter
    for _ in count() if rounds is None else range(rounds):
        if len(symbols) < 2 or len(rules) >= limit:
            break
        look = ~first[1:]
        if fresh_from is not None:
            fresh_symbol = symbols >= fresh_from
            look &= fresh_symbol[:-1] | fresh_symbol[1:]
        look = np.flatnonzero(look)
        left, right = symbols[look], symbols[look + 1]
        order, left_out = np.zeros(0, np.int64), False
        for some, complete in frequent(left, right, min_count):
            at, code = look[some], left[some].astype(np.uint64) << np.uint64(32) | right[some]
            pairs, n = np.unique(code, return_counts=True)
            order = np.argsort(-n, kind="stable")[: min(RULES_A_ROUND, limit - len(rules))]
            left_out = not complete or (n >= min_count).sum() > len(order)
            order = order[n[order] >= min_count]
            if len(order):
                break
        if not len(order):
            if fresh_from is None:
                break
            fresh_from = None
            continue
        chosen = np.sort(pairs[order])
        place = np.minimum(np.searchsorted(chosen, code), len(chosen) - 1)
        hit = chosen[place] == code
        at, place = at[hit], place[hit]
        # Within a run of overlapping occurrences replace the first, third, ...
        starts = np.concatenate([[True], np.diff(at) > 1])
        run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
        take = (np.arange(len(at)) - run) % 2 == 0
        at, place = at[take], place[take]
        used, place = np.unique(place, return_inverse=True)
        fresh = chosen[used]
        new = np.stack([fresh >> np.uint64(32), fresh & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        symbols[at] = base + len(rules) + place
        fresh_from = None if left_out else base + len(rules)
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, first = symbols[keep], first[keep]
        known = np.concatenate([np.ones(base, np.int64), lengths])
        lengths = np.concatenate([lengths, known[new[:, 0]] + known[new[:, 1]]])
        rules = np.concatenate([rules, new])
    return symbols, rules, lengths, np.flatnonzero(first)


def expansions(rules: np.ndarray, lengths: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all nonterminals one after another, their offsets)."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    flat = np.zeros(offsets[-1], np.uint32)
    for k, (a, b) in enumerate(rules.tolist()):
        at = offsets[k]
        for s in (a, b):
            if s < base:
                flat[at] = s
                at += 1
            else:
                n = lengths[s - base]
                flat[at : at + n] = flat[offsets[s - base] : offsets[s - base] + n]
                at += n
    return flat, offsets


def write_shard(ids: np.ndarray, doc_starts: np.ndarray, base: int = BASE, frame: int = FRAME_SYMBOLS) -> bytes:
    symbols, rules, lengths, at = compress(ids, doc_starts, base)
    width = 2 if base + len(rules) <= 1 << 16 else 4
    pack = zstandard.ZstdCompressor(level=1).compress
    index = pack(b"".join(x.astype("<u4").tobytes() for x in (rules, lengths, at, doc_starts)))
    body = [pack(symbols[i : i + frame].astype(f"<u{width}").tobytes()) for i in range(0, len(symbols), frame)]
    head = np.array([MAGIC, base, len(rules), len(symbols), len(at), width, len(ids), frame, len(index)], "<u8")
    return b"".join([head.tobytes(), np.array([len(x) for x in body], "<u4").tobytes(), index, *body])


class Shard:
    """A shard read back.  ids(i) decodes one document from its own frames and rules; documents() decodes all."""

    def __init__(self, payload: bytes):
        head = np.frombuffer(payload, "<u8", min(HEAD_NUMBERS, len(payload) // 8)).tolist()
        if len(head) < HEAD_NUMBERS or head[0] != MAGIC:
            raise ValueError("not a token shard")
        _, self.base, n_rules, self.n_symbols, n_docs, self.width, self.n_ids, self.frame, n_index = head
        frames = -(-self.n_symbols // self.frame)
        sizes = np.frombuffer(payload, "<u4", frames, 8 * HEAD_NUMBERS).astype(np.int64)
        start = 8 * HEAD_NUMBERS + 4 * frames
        self._payload, self._inflate = payload, zstandard.ZstdDecompressor().decompress
        self._frame_at = start + n_index + np.concatenate([[0], np.cumsum(sizes)])
        index = np.frombuffer(self._inflate(payload[start : start + n_index]), "<u4")
        self.rules, self.lengths, self.symbol_at, self.id_at = np.split(index, np.cumsum([2 * n_rules, n_rules, n_docs]))
        self.rules, self.lengths = self.rules.reshape(-1, 2), self.lengths.astype(np.int64)
        self.symbol_at, self.id_at = self.symbol_at.astype(np.int64), self.id_at.astype(np.int64)

    def __len__(self) -> int:
        return len(self.id_at)

    def symbols(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Symbols of a range; only the frames that hold it are inflated."""
        stop = self.n_symbols if stop is None else stop
        if start >= stop:
            return np.zeros(0, f"<u{self.width}")
        first, last = start // self.frame, (stop - 1) // self.frame
        data = b"".join(self._inflate(self._payload[self._frame_at[k] : self._frame_at[k + 1]]) for k in range(first, last + 1))
        return np.frombuffer(data, f"<u{self.width}")[start - first * self.frame : stop - first * self.frame]

    def expand_few(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of some symbols, by replacing nonterminals until none is left; only the rules in use are touched."""
        out = symbols.astype(np.uint32)
        while True:
            rule = out >= self.base
            if not rule.any():
                return out
            n = 1 + rule.astype(np.int64)
            at = np.cumsum(n) - n
            longer = np.repeat(out, n)
            pairs = self.rules[out[rule].astype(np.int64) - self.base]
            longer[at[rule]], longer[at[rule] + 1] = pairs[:, 0], pairs[:, 1]
            out = longer

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of many symbols, by the expansions of all rules."""
        flat, offsets = expansions(self.rules, self.lengths, self.base)
        symbols = symbols.astype(np.int64)
        rule = symbols - self.base
        is_rule = rule >= 0
        source = np.concatenate([flat, np.zeros(1, np.uint32)])
        n = np.ones(len(symbols), np.int64)
        n[is_rule] = self.lengths[rule[is_rule]]
        ends = np.cumsum(n)
        out = np.repeat(symbols.astype(np.uint32), n)
        begin = np.zeros(len(symbols), np.int64)
        begin[is_rule] = offsets[rule[is_rule]]
        pick = np.repeat(is_rule, n)
        index = np.arange(len(out)) - np.repeat(ends - n, n) + np.repeat(begin, n)
        out[pick] = source[index[pick]]
        return out

    def ids(self, i: int) -> np.ndarray:
        """Ids of document i alone."""
        stop = self.symbol_at[i + 1] if i + 1 < len(self.symbol_at) else self.n_symbols
        return self.expand_few(self.symbols(int(self.symbol_at[i]), int(stop)))

    def documents(self) -> list[np.ndarray]:
        return np.split(self.expand(self.symbols()), self.id_at[1:]) if len(self) else []


# --------------------------------------------------------------------- the job
def write(df: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, base: int = BASE, shard_ids: int = SHARD_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the shards of a table (long ids) to `path`, a folder that only Spark needs to reach."""
    docs = with_text(df, id_col, text_col)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    cuts = splitters(docs.select(key.alias("key")), "key", 3 * parts(df.sparkSession))
    # Neighbouring ranges go to one task, in order: the files in order of their names are the documents in order.
    tasks = parts(df.sparkSession)
    ranged = docs.withColumn("range", range_of(key, cuts).cast("int"))
    ranged = ranged.repartitionById(tasks, F.expr(f"cast(range * {tasks}L div {max(1, len(cuts))} as int)")).sortWithinPartitions("range", F.col("doc_id").asc_nulls_first(), "text")

    def run(batches):
        e = encoder(vocabulary, cut_before_spaces)
        held: list[tuple] = []
        now, block, start, count = None, 0, 0, 0

        def shard():
            nonlocal held, block, start, count
            ids = np.concatenate([h[1] for h in held])
            starts = np.concatenate([[0], np.cumsum([len(h[1]) for h in held])[:-1]])
            out = pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()), pa.array([[h[0] for h in held]], pa.list_(pa.int64())), pa.array([len(ids)], pa.int64()), pa.array([write_shard(ids, starts, base)], pa.binary())],
                ["range", "block", "start", "doc_ids", "n_ids", "payload"],
            )
            block, start, held, count = block + 1, start + len(ids), [], 0
            return out

        for step in steps(batches, step_bytes=ENCODE_BYTES):
            ids, offsets = e.encode(*utf8(step.column("text")))
            for i, (r, doc_id) in enumerate(zip(step.column("range").to_pylist(), step.column("doc_id").to_pylist(), strict=True)):
                if r != now:
                    if held:
                        yield shard()
                    now, block, start = r, 0, 0
                held.append((doc_id, np.append(ids[offsets[i] : offsets[i + 1]], np.uint32(end_id))))
                count += len(held[-1][1])
                if count >= shard_ids:
                    yield shard()
        if held:
            yield shard()

    ranged.select("range", "doc_id", "text").mapInArrow(run, "range int, block int, start long, doc_ids array<long>, n_ids long, payload binary").write.parquet(path)


def read(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shards."""
    shards = spark.read.parquet(path)
    # One row per range, of which there are three per shuffle partition: their first ids by a running sum.
    ranges = shards.groupBy("range").agg(F.sum("n_ids").alias("n"))
    first = ranges.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))

    def run(batches):
        for batch in batches:
            for before, start, doc_ids, payload in zip(*(batch.column(c).to_pylist() for c in ("before", "start", "doc_ids", "payload")), strict=True):
                s = Shard(payload)
                found = s.documents()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(s.id_at + before + start), pa.array([len(x) for x in found], pa.int64()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return shards.join(F.broadcast(first), "range").select("before", "start", "doc_ids", "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_shards(spark, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark).rstrip('/')}/token-shards-{uuid.uuid4().hex}"
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path(VOCABULARY))
    return read(spark, path)


QUERIES = {"op9_token_shards": op9_token_shards}
