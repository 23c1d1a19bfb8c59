"""Encoding, packing and token shards against the libraries, with awkward texts."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from gleaner.llm import bpe, packing, pieces, repair
from gleaner.llm._common import utf8

AWKWARD = [
    None, "", " ", "a", "a  b \n c\n\n d\t e  ", "  x", "it's 'sabc !'s  12 3　 k", "ſ Σας ΑΣ <|endoftext|> <|startoftext|>", "é ́x a b\x1cc", "The.\nWas, it. a.\n b.\nc, \nd.,\ne\n",
    "x.\n\ny,", " İ. É,\nÑ.\n", "ab.c,d. e .f , g,", "x" * 5000, "日本語" * 700, " " * 3000 + "end", "word " * 3000, "🙂🙃 " * 50, "a b c",
]


def frame(spark, texts):
    rows = [(i, t, "fr", "x", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, ids string, node string").repartition(3)


def ranks():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def test_stitching_equals_whole_text():
    pattern, rng = regex.compile(P.PATTERN), random.Random(1)
    for t in [x or "" for x in AWKWARD] + ["".join(rng.choice("ab '  \n1.s") for _ in range(rng.randint(0, 400))) for _ in range(200)]:
        cut = bpe.stitched(pattern, t, 64, 8)
        assert "".join(cut) == t
        assert [m for c in cut for m in pattern.findall(c)] == pattern.findall(t)


def test_byte_bpe(spark):
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    path = P.path("byte_bpe_multi_50k.tiktoken")
    got = bpe.decode(bpe.encode(frame(spark, AWKWARD), path, chunk=100, overlap=10), path).collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        t = AWKWARD[r.doc_id] or ""
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == e.encode_ordinary(t)
        assert bytes(r.raw) == t.encode()
    assert bpe.encode(frame(spark, AWKWARD).limit(0), path).count() == 0
    assert bpe.digest(b"") == hashlib.sha256(b"").hexdigest()


def test_piece_encoder_equals_library():
    rng = random.Random(6)
    texts = [t or "" for t in AWKWARD] + ["!\x1c!", "é.x\u0301y", "ΟΔΟΣ ΑΣ.", "a\u0085b", "_x_ __ a_b ²3 ①x Ⅷ"]
    # White space beyond ASCII, and letters whose last bytes look like it, before and behind cuts.
    texts += [f"{a}{w}{s}{b}" for a in ("x", "é", "à", "。", "Ѡ", "") for w in ("\u00a0", "\u0085", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\u200b", "") for s in (" ", "\n", " \n ", "  ") for b in ("y", "\u0301z", "'s", "")]
    texts += ["".join(rng.choice("ab.,!_1² \n\tÉñ\u0301İΣ'") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    for name, cut in (("byte_bpe_50k.json", pieces.cut_before_spaces), ("word_bpe_49k.json", pieces.cut_at_spaces)):
        e = pieces.PieceEncoder(P.path(name), cut, keep=5)
        want = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
        for _ in range(3):
            ids, at = e.encode(*utf8(pa.array(texts)))
            assert [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))] == want
        for most in (64, 1000):  # long data in slices, cut inside texts too
            ids, at = e.encode(*utf8(pa.array(texts)), most=most)
            assert [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))] == want


def test_packing_law(spark):
    rng = random.Random(2)
    texts = AWKWARD + [" ".join(rng.choice(["alpha", "beta", "zq", "x1"]) for _ in range(rng.randint(1, 3000))) for _ in range(60)]
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    rows = packing.pack_documents(frame(spark, texts), P.path("word_bpe_49k.json"), batch_tokens=20_000).collect()
    docs, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert set(docs) == set(range(len(texts)))
    for i, rs in docs.items():
        ids, at = np.array([*t.encode(texts[i] or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(rs, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    waste = 0
    for rs in windows.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and len({r.step_group for r in rs}) == 1
        waste += 2048 - at if at & (at - 1) else 0
    assert waste <= 3 * 2048  # one window per partition


def test_step_groups_are_balanced():
    windows = [(2048, [(i, 0, 100 + i % 900)]) for i in range(640)]
    groups = packing.step_groups(windows)
    sums = defaultdict(int)
    for (_, p), g in zip(windows, groups, strict=True):
        sums[g] += p[0][2]
    assert len(sums) == 20 and max(sums.values()) < 1.02 * min(sums.values())


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    for ids, starts in (
        (np.zeros(5000, np.uint32), np.array([0, 1, 1000, 4999])), (rng.integers(0, 4, 20_000).astype(np.uint32), np.arange(0, 20_000, 37)),
        (np.tile(np.arange(7, dtype=np.uint32), 900), np.array([0, 50])), (np.array([2], np.uint32), np.array([0])),
    ):
        shard = repair.Shard(repair.write_shard(ids, starts))
        want = np.split(ids, starts[1:])
        assert all(np.array_equal(a, b) for a, b in zip(shard.documents(), want, strict=True))
        for i in rng.integers(0, len(starts), 5):
            assert np.array_equal(shard.ids(int(i)), want[i])
    assert len(shard.rules) == 0
    big = repair.Shard(repair.write_shard(np.tile(np.arange(7, dtype=np.uint32), 900), np.array([0])))
    assert big.n_symbols < 1500 and big.lengths.max() >= 8


def test_token_shards(spark, tmp_path):
    texts = AWKWARD + ["same text " * 40] * 30
    df = frame(spark, texts)
    extra = spark.createDataFrame([(None, "null id", None, None, None), (3, AWKWARD[3], "x", None, None)], df.schema)
    path = f"file://{tmp_path}/shards"
    repair.write(df.unionByName(extra), path, P.path("byte_bpe_50k.json"), shard_ids=500)
    rows = sorted(repair.read(spark, path).collect(), key=lambda r: r.start)
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    order = [(None, "null id"), *sorted([*enumerate(texts), (3, AWKWARD[3])], key=lambda x: x[0])]
    at = 0
    assert [r.doc_id for r in rows] == [i for i, _ in order]
    for r, (_, text) in zip(rows, order, strict=True):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_repair_goes_on_until_no_pair_pays():
    rng = np.random.default_rng(3)
    passage, other = rng.integers(0, 300, 640), lambda: rng.integers(300, 50_000, 40)
    docs = [np.concatenate([other(), passage, other()]).astype(np.uint32) for _ in range(40)]
    ids, starts = np.concatenate(docs), np.concatenate([[0], np.cumsum([len(d) for d in docs])[:-1]])
    symbols, rules, lengths, at = repair.compress(ids, starts, repair.BASE)
    inside = np.ones(len(symbols) - 1, bool)
    inside[at[1:] - 1] = False
    pairs = np.stack([symbols[:-1], symbols[1:]], 1)[inside]
    assert np.unique(pairs, axis=0, return_counts=True)[1].max() < repair.MIN_COUNT and lengths.max() > 64
    shard = repair.Shard(repair.write_shard(ids, starts))
    assert all((a == b).all() for a, b in zip(shard.documents(), docs, strict=True)) and (shard.ids(7) == docs[7]).all()


def test_shard_files_are_in_document_order(spark, tmp_path):
    rng = random.Random(9)
    rows = [(rng.randrange(-500, 5000), " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randrange(40)))) for _ in range(600)]
    path = str(tmp_path / "shards")
    repair.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), path, P.path(repair.VOCABULARY), shard_ids=900)
    files = [pq.read_table(f).to_pylist() for f in sorted((tmp_path / "shards").glob("part-*"))]
    assert sum(map(bool, files)) == 4  # every task has its ranges
    order = [d for rows in files for r in rows for d in r["doc_ids"]]
    assert order == sorted(d for d, _ in rows)
    places = [(r["range"], r["block"]) for rows in files for r in rows]
    assert places == sorted(places)


def test_stitching_scans_a_text_a_few_times_only():
    """Texts with and without boundaries: the characters scanned grow with the text, not with its square."""
    pattern, scanned = regex.compile(P.PATTERN), []

    class Counted:
        def finditer(self, piece):
            scanned.append(len(piece))
            return pattern.finditer(piece)

    for unit in ("7", " ", "word ", "7 ", "-", "日本 12! ", "x\n\n"):
        for n in (1 << 16, 1 << 18):
            text = (unit * n)[:n]
            scanned.clear()
            pieces_ = bpe.stitched(Counted(), text, 1024, 16)
            assert "".join(pieces_) == text and sum(scanned) <= 6 * n
            assert [m[0] for p in pieces_ for m in pattern.finditer(p)] == pattern.findall(text)


def test_one_document_is_decoded_from_its_own_frames():
    rng = np.random.default_rng(7)
    docs = [np.tile(rng.integers(0, 50, 30), rng.integers(1, 9)).astype(np.uint32) for _ in range(900)]
    starts = np.cumsum([0, *(len(d) for d in docs[:-1])])
    shard = repair.Shard(repair.write_shard(np.concatenate(docs), starts, frame=512))
    assert shard.n_symbols > 20 * 512
    inflated, plain = [], shard._inflate

    def counted(data):
        inflated.append(len(out := plain(data)))
        return out

    shard._inflate = counted
    for i in (0, 450, 899):
        inflated.clear()
        assert np.array_equal(shard.ids(i), docs[i]) and 1 <= len(inflated) <= 2 and max(inflated) <= 2 * 512
    assert all(np.array_equal(a, b) for a, b in zip(shard.documents(), docs, strict=True))
    with pytest.raises(ValueError, match="shard"):
        repair.Shard(b"junk")
