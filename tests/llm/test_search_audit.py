"""SimHash, filter audit and ranked search against plain Python on small tables."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
import xxhash

from gleaner.llm import blockmax, filteraudit, simhash

WORDS = [f"w{i}" for i in range(60)] + ["Über", "naïve", "日本", "THE", "a-b", "x1"]


def roots_of(n, links):
    top = list(range(n))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# --------------------------------------------------------------------- SimHash
def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    parts = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words] if words else []
    h = [xxhash.xxh64_intdigest(b" ".join(p), 42) for p in parts]
    return sum(1 << k for k in range(64) if sum(x >> k & 1 for x in h) * 2 > len(h))


def plain_components(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 3]
    roots = roots_of(len(rows), links)
    low = {}
    for (k, _), r in zip(rows, roots, strict=True):
        if k is not None:
            low[r] = min(low.get(r, k), k)
    return sorted(((k, f"{p:016x}", low.get(r)) for (k, _), p, r in zip(rows, prints, roots, strict=True)), key=str)


def test_simhash_against_all_pairs(spark):
    rng = random.Random(11)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "A b C"), (8, "a B c"), (None, "a b c"), (None, None), (9, "a b c d"), (9, "a b c d")]
    for i in range(100, 130):
        words = [rng.choice(WORDS) for _ in range(rng.choice([5, 40, 300]))]
        rows.append((i, " ".join(words)))
        for j in range(3):
            own = list(words)
            own[rng.randrange(len(own))] = rng.choice(WORDS)
            rows.append((i * 10 + j, "  ".join(own)))
    df = spark.createDataFrame([(k, t, "x", 0) for k, t in rows], "doc_id long, text string, fingerprint string, node long").repartition(5)
    for most in (1, 64):
        out = simhash.classes(df, most=most)
        assert out.columns == ["doc_id", "fingerprint", "component_id"]
        assert sorted(map(tuple, out.collect()), key=str) == plain_components(rows)
    assert simhash.classes(df.limit(0)).collect() == []


def test_simhash_pieces(monkeypatch):
    rng = random.Random(5)
    for size in (1, 7, 64):
        text = "".join(rng.choice(["ab ", "c", "\n", " ", "d\x0be "]) for _ in range(120)).encode()
        flat = [s for k, w in enumerate(simhash.pieces(text, 0, len(text), size)) for s in (simhash.shingles(w) if k == 0 or len(w) >= 3 else [])]
        assert flat == simhash.shingles(text.split())


def test_links_of_crowded_keys(spark, most=2):
    """Clusters of fingerprints a few bits apart: the components are those of all pairs."""
    rng = random.Random(most)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        weak = rng.sample(range(64), 14)
        for _ in range(60):
            prints.add(centre ^ sum(1 << b for b in rng.sample(weak, rng.choice([1, 2, 5, 8]))))
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    links = [(i, j) for i, a in enumerate(prints) for j, b in enumerate(prints[:i]) if bin((a ^ b) & (2**64 - 1)).count("1") <= 3]
    want = [prints[r] for r in roots_of(len(prints), links)]
    found = {r.node: r.root for r in simhash.linked(spark.createDataFrame([(p,) for p in prints], "node long"), most).collect()}
    got = [found.get(p, p) for p in prints]
    assert len(set(want)) > 6 and got == want


def test_index_levels():
    for width, unit in [(2, 8), (3, 8), (4, 8), (5, 8), (13, 4)]:
        chosen = simhash.masks(width, unit)
        assert len(chosen) == math.comb(width + 3, 3) and {bin(m & (2**64 - 1)).count("1") for m in chosen} == {width * unit}
        rng = random.Random(width)
        for _ in range(300):
            x = sum(1 << b for b in rng.sample(range(64), 3))
            assert any(x & m == 0 for m in chosen)
    assert simhash.levels(100)[0] == (2, 8) and simhash.levels(10**12)[0] == (5, 8)


# --------------------------------------------------------------------- filter audit
def plain_audit(docs, labels):
    parts, smallest = {}, {}
    for k, t, _ in docs:
        if k is not None:
            smallest[t or ""] = min(smallest.get(t or "", k), k)
    for k, t, part in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = "".join(
            f for f, c in zip("ABCDE", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), re.search(r"[#$%&*|]", t), k is not None and k > smallest[t]), strict=True) if c
        )
        parts.setdefault(part or "", []).append((fails, k is not None and (k, 1) in {(a, q) for a, q, _ in labels}, k is not None and (k, 1) in {(a, x) for a, _, x in labels}))
    out = {}
    for part, rows in parts.items():
        share = Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                share[f] += len(gone)
                left = [r for r in left if f not in r[0]]
                failing = sum(f in r[0] for r in rows)
                out[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), sum(r[0] == f for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(share[order[step - 1]])
    return out


def test_filter_audit_against_replay(spark):
    rng = random.Random(12)
    pool = [" ".join(rng.choice(WORDS) for _ in range(rng.choice([3, 120, 250]))) + rng.choice(["", "#", " $x"]) for _ in range(25)] + [" ".join(f"q{i}" for i in range(260)), "a " * 300, None, "", "ÀÉ A　b"]
    docs = [(rng.choice([None, *range(60)]), rng.choice(pool), rng.choice(["en", "de", None, ""])) for _ in range(150)]
    docs += docs[:5]
    labels = [(rng.choice([None, *range(70)]), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(60)]
    df = spark.createDataFrame([(*d, "mine", 7) for d in docs], "doc_id long, text string, lang string, mask string, good int")
    lb = spark.createDataFrame([(*x, 1) for x in labels], "doc_id long, quality int, toxic int, n int")
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in filteraudit.audit(df, lb).collect()}
    want = plain_audit(docs, labels)
    assert len(want) == 3 * 600 and got == want
    assert filteraudit.audit(df.limit(0), lb).collect() == [] and filteraudit.audit(df, lb.limit(0)).count() == 1800


def test_parity_sums_invert_exactly(spark):
    rng = np.random.default_rng(3)
    cells = {m: int(n) for m, n in enumerate(rng.integers(0, 10**12, 32))}
    df = spark.createDataFrame([("p", m, n) for m, n in cells.items()], "part string, mask int, n long")
    sums = filteraudit.parity_sums(df, 5, "part")
    plain = [sum(n * (-1) ** bin(s & m).count("1") for m, n in cells.items()) for s in range(32)]
    assert sums.first().sums == plain
    assert {r.mask: r.n for r in filteraudit.mask_cells(sums, 5, "part").collect()} == cells


# --------------------------------------------------------------------- ranked search
def plain_search(docs, items, k=20):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(d, Counter(cut(t))) for d, t in docs]
    n_docs, length = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for d, b in bags:
            m = 100 - 25 + (25 * sum(b.values()) * n_docs) // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m)) for t in cut(text) if t in b)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_search_against_all_documents(spark):
    rng = random.Random(13)
    zipf = [w for i, w in enumerate(WORDS) for _ in range(1 + 200 // (i + 1))]
    docs = [(i, " ".join(rng.choice(zipf) for _ in range(rng.choice([1, 8, 60, 400])))) for i in range(400)]
    docs += docs[:15] + [(None, docs[3][1]), (500, None), (501, ""), (502, "--- !!"), (503, "the\x00THE;The"), (504, "w59 " * 5000)]
    items = [(1, "The w3 w3 w40"), (2, None), (3, "!!"), (4, "unknown words"), (5, " ".join(WORDS)), (6, "w59 naïve 日本 x1"), (7, docs[5][1]), (8, "a b")]
    df = spark.createDataFrame([(*d, 1, "c") for d in docs], "doc_id long, text string, n int, terms string").repartition(3)
    it = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, rank int")
    want = plain_search(docs, items)
    for options in ({}, {"most": 600}, {"query_rows": 2}):
        out = blockmax.search(df, it, **options)
        assert out.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, out.collect()), key=str) == want
    assert sorted(map(tuple, blockmax.search(df, it, k=1).collect()), key=str) == plain_search(docs, items, 1)
    assert blockmax.search(df, it.limit(0)).collect() == [] == blockmax.search(df.limit(0), it).collect()
    split = spark.createDataFrame([(1, "w3 w3 the"), (1, "w40"), (1, "w40")], "item_id long, text string")
    assert sorted(map(tuple, blockmax.search(df, split).collect()), key=str) == plain_search(docs, [(1, "w3 w3 the w40")])


def test_long_texts_are_cut_between_terms():
    rng = random.Random(2)
    raw = "".join(rng.choice(["ab", "é", " ", "-", "Q7"]) for _ in range(500)).encode()
    folded = raw.translate(blockmax._FOLD)
    for size in (1, 5, 100):
        assert [w for p in blockmax.pieces(folded, 0, len(folded), size) for w in p] == blockmax.terms(raw)


def test_blocks_are_the_cheapest(spark):
    """The cut costs what the best of all cuts on the grid costs."""
    rng = np.random.default_rng(4)
    for _ in range(30):
        sizes = rng.integers(0, 14, 4)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        impact = rng.integers(1, 1000, starts[-1])
        begin = blockmax.block_starts(impact, starts, unit=2, widest=3, price=1.5)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if a == b:
                continue
            x, price = impact[a:b].astype(float), 1.5 * impact[a:b].std() + 1
            cost = lambda cuts, x=x, price=price: sum((j - i) * x[i:j].max() + price for i, j in zip(cuts, [*cuts[1:], len(x)], strict=True))
            grid = range(2, len(x), 2)
            cuts = ([0, *(g for k, g in enumerate(grid) if m >> k & 1)] for m in range(1 << len(grid)))
            best = min(cost(c) for c in cuts if all(j - i <= 6 for i, j in zip(c, [*c[1:], len(x)], strict=True)))
            assert cost([int(p - a) for p in begin if a <= p < b]) == pytest.approx(best)


def test_blocks_are_skipped():
    """A rare strong term among common ones: most postings are never opened, and the result is that of a full scan."""
    rng = np.random.default_rng(6)
    docs, vocabulary = 100_000, 6
    lists = [np.flatnonzero(rng.random(docs) < p) for p in (0.9, 0.7, 0.5, 0.3, 0.0006, 0.0003)]
    owner, term = np.concatenate(lists), np.repeat(np.arange(vocabulary), [len(x) for x in lists])
    order = np.lexsort((term, owner))
    owner, term = owner[order], term[order]
    tf, n = rng.integers(1, 9, len(owner)), rng.integers(20, 900, docs)
    shard = blockmax.Shard(np.arange(docs), np.zeros(docs, bool), n, owner, term, tf, vocabulary, docs, int(n.sum()))
    weight = np.array([40, 200, 600, 1100, 4600, 6200])
    score, _, ids = shard.search(np.arange(vocabulary), weight, 20, blockmax.nothing())
    full = np.bincount(shard.doc, shard.impact * np.repeat(weight, np.diff(shard.lists)), docs).astype(np.int64)
    best = np.lexsort((np.arange(docs), -full))[:20]
    assert ids.tolist() == best.tolist() and score.tolist() == full[best].tolist()
    assert shard.opened < 0.2 * len(owner)
