"""Operator 3: byte-level BPE encoding and decoding by overlapping chunks.

A long text is cut into chunks that overlap.  Each chunk is pre-tokenised on its own; where the pre-token boundaries of
two neighbours meet inside their overlap they agree from there on, as a match depends only on what follows its start.
The text is stitched at these places and the pieces between them are encoded one by one.  Decoding concatenates the raw
bytes of the ids.

Defined results.  A null text is empty: no ids, and the hashes of no bytes.  A match that touches the end of its slice
is not trusted, and a text is never cut behind white space, where the pattern looks ahead.  If an overlap holds no such
common boundary it is doubled, in the end up to the end of the text, so any text comes out right; the next chunk begins
at the boundary that was found, so no text is scanned more than a few times, whatever stands in it.  Rows are encoded
one by one; repeated rows and null ids keep their rows, and extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._common import steps, strings, with_text

CHUNK_CHARS, OVERLAP_CHARS = 32_768, 512
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def boundaries(pattern, text: str, start: int, stop: int) -> list[int]:
    """Ends of the matches in text[start:stop], pre-tokenised on its own; a match that touches a cut end is left out."""
    piece = text[start:stop]
    ends = [start + m.end() for m in pattern.finditer(piece)]
    return ends if stop == len(text) else [e for e in ends if e < stop]


def stitched(pattern, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[str]:
    """Pieces of a text, cut at true pre-token boundaries about every `chunk` characters."""
    if not text:
        return []
    cuts = [0]
    while len(text) - cuts[-1] > chunk + overlap:
        last, width = cuts[-1], overlap
        start = last + chunk
        while True:
            stop = min(start + width, len(text))
            right = {start, *boundaries(pattern, text, start, stop)}
            meet = next((e for e in boundaries(pattern, text, last, stop) if e >= start and e in right and not text[e - 1].isspace()), None)
            if meet is not None or stop == len(text):
                break
            width *= 2
        if meet is None or meet == len(text):
            break  # what is left is one piece
        cuts.append(meet)
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]


class Codec:
    """Encoder and decoder of a file of mergeable ranks."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token

    def encode(self, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> np.ndarray:
        found = [self.encoding.encode_to_numpy(p, disallowed_special=()) for p in stitched(self.pattern, text, chunk, overlap)]
        return found[0] if len(found) == 1 else np.concatenate(found) if found else np.zeros(0, np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


_codecs: dict[tuple, Codec] = {}


def codec(path: str, pattern: str = public_tokenizers.PATTERN) -> Codec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode(df: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers in one binary value; one pass, no shuffle."""
    docs = with_text(df, id_col, text_col)

    def run(batches):
        c = codec(path, pattern)
        for step in steps(batches):
            ids = [c.encode(t, chunk, overlap).astype("<u4").tobytes() for t in strings(step.column("text"))]
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc_id, ids, raw): raw holds the bytes that the ids stand for."""

    def run(batches):
        c = codec(path, pattern)
        for step in steps(batches, "ids"):
            raw = [c.decode(np.frombuffer(x or b"", "<u4")) for x in step.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), step.column("ids"), pa.array(raw, pa.binary())], ["doc_id", "ids", "raw"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids binary, raw binary")


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    both = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), path), path)
    return both.selectExpr("doc_id", "cast(octet_length(ids) / 4 as bigint) as n_tokens", "sha2(ids, 256) as ids_sha256", "sha2(raw, 256) as decoded_sha256")


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


QUERIES = {"op3_byte_bpe": op3_byte_bpe}
