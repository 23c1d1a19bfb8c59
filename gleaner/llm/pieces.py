"""Token ids of whole texts by a BPE tokenizer file, with each distinct piece of text encoded once per worker.

Texts are cut into pre-tokens by classes of their bytes.  A pre-token of at most 23 bytes is a key of three numbers that
hold its very bytes, so a hash table of arrays finds its ids without any chance of a wrong match; the pre-tokens of a
step are looked up together.  New ones are encoded together too, one merge of each per round, always the pair of lowest
rank and of those the first, as the library does.

Only ASCII and the Latin letters of U+00C0 to U+00FF are classed here.  Around anything else, and around apostrophes,
whose contractions are pre-tokens of their own, the text up to the next safe cuts goes to the library.  A safe cut of
byte-level BPE stands before a space or a line end behind a character that is no white space: every pre-token ends
there, whatever follows, and none looks back.  Tokenizers that drop white space are cut behind runs of spaces and line
ends, across which neither Unicode forms nor pre-tokens reach.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np

from ._common import mix

#: Text bytes that one step encodes.
ENCODE_BYTES = 1 << 20
_WIDTH, _BLOCK, _PAD = 23, 4_096, 65_535
_NONE = np.int32((1 << 31) - 1)
_tokenizers: dict = {}
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
WHITE, LETTER, DIGIT, SIGN, ODD, TAIL = range(6)


def _classes() -> np.ndarray:
    """Class of each byte; TAIL is the second byte of a Latin letter if 0xC3 stands before it."""
    out = np.full(256, ODD, np.uint8)
    out[33:127] = SIGN
    out[ord("'")] = ODD
    out[[9, 10, 11, 12, 13, 32]] = WHITE
    for first, last, kind in ((48, 57, DIGIT), (65, 90, LETTER), (97, 122, LETTER), (0x80, 0xBF, TAIL), (0xC3, 0xC3, LETTER)):
        out[first : last + 1] = kind
    out[[0x97, 0xB7]] = ODD  # the signs of multiplication and division stand among the letters
    return out


_CLASS = _classes()


def tokenizer(path: str):
    """The library's tokenizer of a vocabulary file, one per process; special strings are ordinary text."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        _tokenizers[path] = t
    return _tokenizers[path]


def _before(data: np.ndarray, back: int, fill: int = 32) -> np.ndarray:
    """The value `back` places before each one."""
    out = np.full(len(data), fill, data.dtype)
    out[back:] = data[: len(data) - back]
    return out


def _after(data: np.ndarray, fill: int) -> np.ndarray:
    out = np.full(len(data), fill, data.dtype)
    out[:-1] = data[1:]
    return out


# --------------------------------------------------------------------- cuts
def classed(data: np.ndarray) -> np.ndarray:
    kind = _CLASS[data]
    high = np.flatnonzero(data >= 0x80)
    if len(high):
        here, last, after = data[high], data[np.maximum(high - 1, 0)], data[np.minimum(high + 1, len(data) - 1)]
        lead, tail = here == 0xC3, _CLASS[here] == TAIL
        kind[high[tail & (last != 0xC3)]] = ODD
        kind[high[tail & (last == 0xC3)]] = LETTER
        kind[high[lead & (_CLASS[after] != TAIL)]] = ODD
    return kind


def whole_segments(kind: np.ndarray, edge: np.ndarray, safe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edges, slow): between safe cuts that hold something odd there are no other edges; slow marks their bytes."""
    if not (kind == ODD).any():
        return edge, np.zeros(len(kind), bool)
    starts = np.flatnonzero(safe)
    slow = np.repeat(np.logical_or.reduceat(kind == ODD, starts), np.diff(np.append(starts, len(kind))))
    return np.where(slow, safe, edge), slow


def cut_before_spaces(data: np.ndarray, begins: np.ndarray):
    """(bytes to encode, edges, slow, dropped) for byte-level BPE; begins marks the first byte of each text.

    A space belongs to the letters, digits or signs behind it.  Of a run of white space the last character before other
    text stands alone, or goes with that text if it is a space.
    """
    kind, last, second = classed(data), _before(data, 1), _before(data, 2)
    # No white space beyond ASCII ends in other pairs of bytes than these; where they mean something else a cut is lost.
    tail = ((last >= 0x80) & (last <= 0x8A)) | (last == 0x9F) | (last == 0xA0) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF)
    may_be_white = tail & ((second == 0xC2) | (second == 0x80) | (second == 0x81) | (second == 0x9A))
    safe = begins | (((data == 32) | (data == 10)) & (last > 32) & ~may_be_white)
    white = kind == WHITE
    ends = np.append(begins[1:], True)
    edge = (kind != _before(kind, 1)) & ~(~white & (last == 32)) | (white & ~_after(white, True) & ~ends) | begins
    edge, slow = whole_segments(kind, edge, safe)
    return data, edge, slow, np.zeros(len(data), bool)


def cut_at_spaces(data: np.ndarray, begins: np.ndarray):
    """The same for a tokenizer that lower-cases, drops white space and takes each digit by itself."""
    kind, last = classed(data), _before(data, 1)
    space = (data == 32) | (data == 10)
    safe = begins | (~space & ((last == 32) | (last == 10)))
    edge, slow = whole_segments(kind, (kind != _before(kind, 1, TAIL)) | (kind == DIGIT) | begins, safe)
    capital = ((data >= 65) & (data <= 90)) | ((last == 0xC3) & (data >= 0x80) & (data <= 0x9E))
    return np.where(capital & ~slow, data + 32, data).astype(np.uint8), edge, slow, (kind == WHITE) & ~slow


def next_cut(data: np.ndarray, start: int, window: int = 1 << 16) -> int:
    """The first place from start on with a space or line end behind an ASCII letter or digit; else the end."""
    for at in range(max(start, 1), len(data), window):
        here, last = data[at : at + window], _CLASS[data[at - 1 : at - 1 + window]][: len(data) - at]
        hit = np.flatnonzero(((here == 32) | (here == 10)) & ((last == DIGIT) | ((last == LETTER) & (data[at - 1 : at - 1 + window][: len(here)] < 0x80))))
        if len(hit):
            return at + int(hit[0])
    return len(data)


# --------------------------------------------------------------------- merges
class Merges:
    """Encodes many short pre-tokens at once by the ranks of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        signs = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(plain))}
        self.inner = np.array([vocabulary[signs[b]] for b in range(256)], np.int32)
        self.final = np.array([vocabulary[signs[b] + suffix] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        code = np.array([(vocabulary[a] << 16) | vocabulary[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        code, rank = np.unique(code, return_index=True)
        self.code, self.rank = code.astype(np.uint32), rank.astype(np.int32)
        self.usable = max(vocabulary.values()) < _PAD and not model.get("dropout") and not model.get("ignore_merges")

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = (a.astype(np.uint32) << np.uint32(16)) | b.astype(np.uint32)
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where(self.code[at] == code, self.rank[at], _NONE)

    def encode(self, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids per row, all ids) of pre-tokens: rows [n, width] of bytes, the first `sizes` of which count."""
        out = np.full(rows.shape, _PAD, np.uint16)
        order = np.argsort(sizes, kind="stable")
        for at in range(0, len(order), _BLOCK):
            own = order[at : at + _BLOCK]
            width = int(sizes[own].max())
            column = np.arange(width)
            ids = np.where(column == sizes[own][:, None] - 1, self.final[rows[own, :width]], self.inner[rows[own, :width]])
            ids[column >= sizes[own][:, None]] = _PAD
            rank = self.ranks(ids[:, :-1], ids[:, 1:])
            while True:
                best = rank.argmin(1) if rank.shape[1] else np.zeros(len(own), np.int64)
                lowest = rank[np.arange(len(own)), best] if rank.shape[1] else np.full(len(own), _NONE)
                done = lowest == _NONE
                out[own[done], : ids.shape[1]] = ids[done]
                if done.all():
                    break
                own, ids, rank, best, lowest = own[~done], ids[~done], rank[~done], best[~done], lowest[~done]
                every, column = np.arange(len(own)), np.arange(ids.shape[1] - 1)
                fresh = self.merged[lowest]
                ids = np.where(column > best[:, None], ids[:, 1:], ids[:, :-1])
                ids[every, best] = fresh
                rank = np.where(column[:-1] >= best[:, None], rank[:, 1:], rank[:, :-1])
                inside = np.flatnonzero(best < ids.shape[1] - 1)
                rank[inside, best[inside]] = self.ranks(fresh[inside], ids[inside, best[inside] + 1])
                inside = np.flatnonzero(best > 0)
                rank[inside, best[inside] - 1] = self.ranks(ids[inside, best[inside] - 1], fresh[inside])
        filled = out != _PAD
        return filled.sum(1), out[filled].astype(np.uint32)


# --------------------------------------------------------------------- the table of pieces met
class Table:
    """Open addressing over exact keys of three numbers; row numbers grow in the order of insertion."""

    def __init__(self, slots: int = 1 << 16):
        self.slot, self.used = np.full(slots, -1, np.int32), 0
        self.keys = np.zeros((slots // 2, 3), np.uint64)

    def home(self, keys: np.ndarray) -> np.ndarray:
        folded = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15) + keys[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F) + keys[:, 2] * np.uint64(0xD1B54A32D192ED03)
        return (mix(folded) & np.uint64(len(self.slot) - 1)).astype(np.int64)

    def same(self, rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
        return (self.keys.take(rows, 0, mode="wrap") == keys).all(1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is new."""
        at = self.home(keys)
        out = self.slot[at].astype(np.int64)
        left = np.flatnonzero((out >= 0) & ~self.same(out, keys))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.slot) - 1)
            out[left] = self.slot[at[left]]
            left = left[out[left] >= 0]
            left = left[~self.same(out[left], keys[left])]
        return out

    def place(self, keys: np.ndarray, first_row: int) -> None:
        """Enter distinct keys that are not in the table as rows from first_row on."""
        at, left = self.home(keys), np.arange(len(keys))
        while len(left):
            free = left[self.slot[at[left]] < 0]
            self.slot[at[free]] = first_row + free  # of several that want one slot the last gets it
            left = left[self.slot[at[left]] != first_row + left]
            at[left] = (at[left] + 1) & (len(self.slot) - 1)

    def add(self, keys: np.ndarray) -> None:
        rows = self.used + len(keys)
        if rows > len(self.keys):
            held = self.keys[: self.used]
            self.slot = np.full(1 << (2 * rows).bit_length(), -1, np.int32)
            self.keys = np.zeros((len(self.slot) // 2, 3), np.uint64)
            self.keys[: self.used] = held
            self.place(held, 0)
        self.keys[self.used : rows] = keys
        self.place(keys, self.used)
        self.used = rows


class PieceEncoder:
    """Encodes texts piece by piece; knows the ids of the pieces met lately, at most about `keep` of them."""

    def __init__(self, path: str, cut, keep: int = 400_000):
        self.tokenizer, self.merges, self.cut, self.keep = tokenizer(path), Merges(path), cut, keep
        self.forget()

    def forget(self) -> None:
        self.table = Table()
        self.start, self.size, self.flat, self.ids = np.zeros(1 << 10, np.int32), np.zeros(1 << 10, np.uint8), np.zeros(1 << 10, np.uint32), 0

    def by_library(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return sizes, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))

    def learn(self, keys: np.ndarray, slow: np.ndarray) -> None:
        """Enter new pieces (distinct keys) and their ids."""
        length = (keys[:, 2] >> np.uint64(56)).astype(np.int64)
        raw = np.ascontiguousarray(keys).view(np.uint8)[:, :_WIDTH]
        slow = slow | (not self.merges.usable)
        for own, encode in ((np.flatnonzero(~slow), lambda r, n: self.merges.encode(r, n)), (np.flatnonzero(slow), lambda r, n: self.by_library([bytes(x[:k]) for x, k in zip(r, n, strict=True)]))):
            if len(own):
                sizes, ids = encode(raw[own], length[own])
                rows, total = self.table.used + len(own), self.ids + len(ids)
                while rows > len(self.start):
                    self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
                while total > len(self.flat):
                    self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
                self.size[self.table.used : rows] = sizes
                self.start[self.table.used : rows] = self.ids + np.cumsum(sizes) - sizes
                self.flat[self.ids : total] = ids
                self.ids = total
                self.table.add(keys[own])

    def encode(self, data: np.ndarray, offsets: np.ndarray, most: int = 2 * ENCODE_BYTES) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of the texts) of UTF-8 texts that stand one after another.

        Of longer data than `most` bytes a slice at a time is encoded, cut before a space behind a letter or digit.
        """
        cuts = [0]
        while len(data) - cuts[-1] > most:
            cuts.append(next_cut(data, cuts[-1] + most // 2))
        found, places, counts, total = [], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0
        for a, b in zip(cuts, [*cuts[1:], len(data)], strict=True):
            inner = offsets[(offsets > a) & (offsets < b)] - a
            ids, per = self.encode_slice(data[a:b], np.concatenate([[0], inner, [b - a]]))
            found.append(ids)
            places.append(a + np.concatenate([inner, [b - a]]))
            counts.append(total + per[1:])
            total += len(ids)
        ids = found[0] if len(found) == 1 else np.concatenate(found)
        return ids, np.concatenate(counts)[np.searchsorted(np.concatenate(places), offsets)]

    def encode_slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self.table.used > self.keep:
            self.forget()
        begins = np.zeros(len(data), bool)
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        data, edge, slow, dropped = self.cut(data, begins)
        start = np.flatnonzero(edge)
        length = np.diff(np.append(start, len(data)))
        kept = ~dropped[start]
        start, length = start[kept], length[kept]
        short = length <= _WIDTH
        padded = np.concatenate([data, np.zeros(32, np.uint8)])
        eight = np.ndarray(len(data) + 24, "<u8", padded, strides=(1,))
        at, n = (start, length) if short.all() else (start[short], length[short])
        keys = np.zeros((len(at), 3), np.uint64)
        for k in range(3):
            own = slice(None) if k == 0 else np.flatnonzero(n > 8 * k)
            keys[own, k] = eight[at[own] + 8 * k] & _LOW_BYTES[np.minimum(n[own] - 8 * k, 8)]
        keys[:, 2] |= n.astype(np.uint64) << np.uint64(56)
        rows = self.table.find(keys)
        new = np.flatnonzero(rows < 0)
        if len(new):
            order = new[np.lexsort(keys[new].T)]
            first = np.ones(len(order), bool)
            first[1:] = (keys[order[1:]] != keys[order[:-1]]).any(1)
            self.learn(keys[order[first]], slow[at[order[first]]])
            rows[new] = self.table.find(keys[new])
        where, sizes = self.start[rows].astype(np.int64), self.size[rows].astype(np.int64)
        flat = self.flat
        if not short.all():  # long pieces hardly come again: their ids serve this call only
            pieces = [data[a : a + k].tobytes() for a, k in zip(start[~short].tolist(), length[~short].tolist(), strict=True)]
            place = {p: i for i, p in enumerate(dict.fromkeys(pieces))}
            long_sizes, ids = self.by_library(list(place))
            own = np.array([place[p] for p in pieces])
            all_where, all_sizes = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
            all_where[short], all_sizes[short] = where, sizes
            all_where[~short], all_sizes[~short] = self.ids + (np.cumsum(long_sizes) - long_sizes)[own], long_sizes[own]
            where, sizes, flat = all_where, all_sizes, np.concatenate([self.flat[: self.ids], ids])
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.arange(total) + np.repeat(where - (ends - sizes), sizes)]
        return ids, np.concatenate([[0], ends])[np.searchsorted(start, offsets)]


_encoders: dict = {}


def encoder(path: str, cut) -> PieceEncoder:
    """One encoder per process and vocabulary; Spark reuses its Python workers, so later tasks find it warm."""
    key = (path, cut.__name__)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, cut)
    return _encoders[key]
