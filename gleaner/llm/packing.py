"""Operator 7: hierarchical packing of tokenised documents into windows of several lengths.

The context tiers are powers of two up to the longest window.  A document longer than the longest window first gives
whole windows of that length; what is left is routed to the smallest tier that holds it.  Each tier is packed on its
own, longest first, each into the window with the least room that still takes it.  Then the gaps are filled, from the
longest tier down, with documents from shorter tiers, the last one cut to the size of the gap, so that windows of a
shorter tier come out exactly full and need no padding.  What remains of a batch moves on to the next one; at the end
of a partition it is laid into longest windows.  Windows of a tier are dealt to step groups of like token counts.

One pass over the partitions that Spark reads, without a shuffle: a window never spans two partitions, so a partition
wastes less than one longest window.  sequence_id holds the partition in its high bits; the packing depends on the
partition's rows alone, so a repeated task gives the same windows.

Defined results.  A null or empty text has only its end id.  Every row is a document of its own: repeated rows and null
ids are packed like others, ties keep their input order, extra columns are not read.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ._common import steps, utf8, with_text
from .pieces import ENCODE_BYTES, cut_at_spaces, encoder

WINDOW, SMALLEST = 2048, 256
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
#: Token count at which a batch is packed: bounds a task's memory.
BATCH_TOKENS = 1 << 21
STEP_TOKENS = 1 << 16
COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


def tiers(window: int = WINDOW, smallest: int = SMALLEST) -> list[int]:
    """Window lengths, ascending: window and its halves down to smallest."""
    out = [window]
    while out[-1] // 2 >= smallest and out[-1] % 2 == 0:
        out.append(out[-1] // 2)
    return out[::-1]


def pack(lengths: list[int], window: int = WINDOW, smallest: int = SMALLEST, last: bool = True):
    """Pack documents of the given lengths.

    Returns (windows, rest).  A window is (tier, [(document, start, length), ...]); rest holds the pieces
    (document, start, length) that did not fill a window, empty if `last`, when they are laid into longest windows.
    """
    sizes = tiers(window, smallest)
    done: list[tuple[int, list]] = []
    waiting: dict[int, list] = {t: [] for t in sizes}
    for d, n in enumerate(lengths):
        whole = n // window
        done += [(window, [(d, k * window, window)]) for k in range(whole)]
        if n % window:
            waiting[next(t for t in sizes if t >= n % window)].append((d, whole * window, n % window))
    open_: dict[int, list] = {}
    for t in sizes:  # best fit decreasing inside the tier
        rooms: dict[int, list] = {}
        free: list[int] = []
        for piece in sorted(waiting[t], key=lambda p: (-p[2], p[0])):
            fit = min((r for r in free if r >= piece[2]), default=None)
            if fit is None:
                bin_, room = [piece], t - piece[2]
            else:
                bin_, room = rooms[fit].pop(), fit - piece[2]
                if not rooms[fit]:
                    free.remove(fit)
                bin_.append(piece)
            if room == 0:
                done.append((t, bin_))
                continue
            if room not in rooms or not rooms[room]:
                rooms[room] = []
                free.append(room)
            rooms[room].append(bin_)
        open_[t] = [(room, b) for room in sorted(free) for b in rooms[room]]
    # Fill the gaps of longer windows from shorter tiers; a tier's own emptiest windows serve when no shorter one is left.
    donors: list[tuple[int, int, list]] = []  # (tier, tokens, window) whose pieces may be moved
    for t in sizes:
        for room, b in open_[t]:
            donors.append((t, t - room, b))
    donors.sort(key=lambda x: (x[0], x[1], x[2][0][0], x[2][0][1]))
    low, high = 0, len(donors) - 1
    while low <= high:
        t, used, bin_ = donors[high]
        high -= 1
        room = t - used
        while room and low <= high:
            _, amount, from_ = donors[low]
            d, s, n = from_[-1]
            take = min(n, room)
            if take == n:
                from_.pop()
            else:
                from_[-1] = (d, s + take, n - take)
            bin_.append((d, s, take))
            room -= take
            if amount == take:
                low += 1
            else:
                donors[low] = (donors[low][0], amount - take, from_)
        if room == 0:
            done.append((t, bin_))
        elif last:
            done.append((window, bin_))
        else:
            return done, bin_
    return done, []


def step_groups(windows: list[tuple[int, list]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step group per window: windows of one tier, dealt so that the groups' real tokens are alike."""
    out, base = [0] * len(windows), 0
    for t in sorted({w[0] for w in windows}):
        own = [i for i, w in enumerate(windows) if w[0] == t]
        groups = max(1, -(-len(own) * t // step_tokens))
        heap = [(0, 0, g) for g in range(groups)]
        for i in sorted(own, key=lambda i: (-sum(p[2] for p in windows[i][1]), i)):
            tokens, count, g = heapq.heappop(heap)
            out[i] = base + g
            heapq.heappush(heap, (tokens + sum(p[2] for p in windows[i][1]), count + 1, g))
        base += groups
    return out


class Packer:
    """Packs one partition's documents batch by batch; keeps only the documents of the batch and what it carries over."""

    def __init__(self, window: int, smallest: int, batch_tokens: int, partition: int):
        self.window, self.smallest, self.batch_tokens = window, smallest, batch_tokens
        self.docs: list[tuple] = []  # (id, ids, start of these ids in the document, ids of the document)
        self.tokens, self.sequence, self.group = 0, partition << 33, partition << 33

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0, len(ids)))
        self.tokens += len(ids)

    def full(self) -> bool:
        return self.tokens >= self.batch_tokens

    def flush(self, last: bool) -> list[tuple]:
        windows, rest = pack([len(d[1]) for d in self.docs], self.window, self.smallest, last)
        groups, rows = step_groups(windows), []
        for (tier, pieces), group in zip(windows, groups, strict=True):
            offset = 0
            for d, s, n in pieces:
                doc_id, ids, base, total = self.docs[d]
                rows.append((doc_id, base + s, n, zlib.crc32(ids[s : s + n].tobytes()), total, self.sequence, offset, tier, self.group + group))
                offset += n
            self.sequence += 1
        self.group += max(groups, default=-1) + 1
        self.docs = [(self.docs[d][0], self.docs[d][1][s : s + n].copy(), self.docs[d][2] + s, self.docs[d][3]) for d, s, n in rest]
        self.tokens = sum(n for _, _, n in rest)
        return rows


def pack_documents(df: DataFrame, path: str, end_id: int = END_ID, window: int = WINDOW, smallest: int = SMALLEST, batch_tokens: int = BATCH_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group."""
    docs = with_text(df, id_col, text_col)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *[c.split()[0] for c in COLUMNS.split(", ")]]

    def run(batches):
        e = encoder(path, cut_at_spaces)
        packer, schema = Packer(window, smallest, batch_tokens, TaskContext.get().partitionId()), None

        def rows(found):
            cols = list(zip(*found, strict=True))
            kinds = [schema.field("doc_id").type, *[pa.int64()] * 6, pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        for step in steps(batches, step_bytes=ENCODE_BYTES):
            schema = step.schema
            ids, offsets = e.encode(*utf8(step.column("text")))
            ids = ids.astype("<u4")
            for i, doc_id in enumerate(step.column("doc_id").to_pylist()):
                packer.add(doc_id, np.append(ids[offsets[i] : offsets[i + 1]], np.array(end_id, "<u4")))
                if packer.full() and (found := packer.flush(False)):
                    yield rows(found)
        if packer.docs:
            yield rows(packer.flush(True))

    return docs.mapInArrow(run, f"doc_id {id_type}, {COLUMNS}")


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(VOCABULARY))


QUERIES = {"op7_packing": op7_packing}
