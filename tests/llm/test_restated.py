"""Language models, toxicity weights, order sketches and licence scores against plain restatements."""

import math
import random
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from gleaner.llm import language, licenses, orderminhash, toxicity


# --------------------------------------------------------------------- Kneser-Ney
def plain_symbols(text, order):
    """Letters in lower case, each run of others behind a letter one space, behind spaces for the start."""
    out = []
    for c in text.lower():
        if c.isalpha():
            out.append(c)
        elif out and out[-1] != " ":
            out.append(" ")
    return [" "] * (order - 1) + out


class PlainKneserNey:
    def __init__(self, texts, order, letters):
        self.order, self.letters = order, letters
        counts = [Counter() for _ in range(order + 1)]
        for t in texts:
            s = plain_symbols(t, order)
            for i in range(order - 1, len(s)):
                for k in range(1, order + 1):
                    counts[k][tuple(s[i - k + 1 : i + 1])] += 1
        self.n, self.total, self.kinds, self.discount = {}, {}, {}, {}
        for k in range(1, order + 1):
            n = counts[k] if k == order else Counter(g[1:] for g in counts[k + 1])
            ones, twos = sum(v == 1 for v in n.values()), sum(v == 2 for v in n.values())
            self.n[k], self.discount[k] = n, ones / (ones + 2 * twos) if ones and twos else 0.75
            self.total[k], self.kinds[k] = Counter(), Counter()
            for g, v in n.items():
                self.total[k][g[:-1]] += v
                self.kinds[k][g[:-1]] += 1

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / self.letters
        lower = self.p(gram[1:])
        total = self.total[k][gram[:-1]]
        if not total:
            return lower
        d = self.discount[k]
        return max(self.n[k][gram] - d, 0) / total + d * self.kinds[k][gram[:-1]] / total * lower

    def entropy(self, text):
        s = plain_symbols(text, self.order)
        logs = [math.log(self.p(tuple(s[i - self.order + 1 : i + 1]))) for i in range(self.order - 1, len(s))]
        return -sum(logs) / len(logs)


@pytest.mark.parametrize("order", [2, 4])
def test_language_models_are_interpolated_kneser_ney(order):
    rng = random.Random(order)
    texts = {lang: ["".join(rng.choice(signs) for _ in range(rng.randrange(5, 90))) for _ in range(12)] for lang, signs in (("x", "abcde  é."), ("y", "abxyzß  1"), ("z", "日本 語a"))}
    model = language.estimate(texts, order)
    letters = len({c for ts in texts.values() for t in ts for c in plain_symbols(t, order)[order - 1 :]}) + 1
    plain = [PlainKneserNey(texts[lang], order, letters) for lang in model.languages]
    asked = ["abc dé", "XYZ!! ß", "語語 日本a", "qqq", "a", *texts["x"][:3], *texts["y"][:3]]
    found, n = language.entropies(model, asked)
    assert np.allclose(found, [[m.entropy(t) for m in plain] for t in asked], rtol=2e-5)
    assert n.tolist() == [sum(c.isalpha() for c in t) for t in asked]
    tables = [sum(m.p((*context, c)) for c in {g[-1] for g in m.n[1]}) for m in plain for context in [tuple("ab"[: order - 1])]]
    assert all(0.5 < t <= 1 + 1e-9 for t in tables)


# --------------------------------------------------------------------- toxicity
def plain_buckets(text):
    s, out = [ord(c) for c in f" {text.lower()} "], set()
    for n in toxicity.ORDERS:
        for i in range(len(s) - n + 1):
            code = 0
            for c in s[i : i + n]:
                code = (code * 0x100000001B3 + c) & (2**64 - 1)
            out.add(((code ^ n) * 0x9E3779B97F4A7C15 & (2**64 - 1)) >> (64 - toxicity.BUCKET_BITS))
    return out - {0}


def test_toxicity_is_logistic_regression_on_log_count_ratios():
    rng = random.Random(8)
    mild, rude = ["calm", "tree", "river", "stone", "light"], ["vile", "scum", "rot"]
    texts = [" ".join(rng.choice(mild) for _ in range(6)) for _ in range(40)] + [" ".join(rng.choice(mild + rude) for _ in range(6)) for _ in range(25)] + ["", "Ünrelated"]
    toxic = np.array([0] * 40 + [1] * 25 + [0, 1])
    weight = np.where(toxic == 1, 0.5, 2.0)
    ridge = 1e-3
    model = toxicity.fit_arrays(texts, toxic, weight, min_z=2.0, ridge=ridge, rounds=30_000)
    sets, n = [plain_buckets(t) for t in texts], [(toxic == 0).sum(), (toxic == 1).sum()]
    seen = [Counter(b for s, y in zip(sets, toxic, strict=True) if y == c for b in s) for c in (0, 1)]
    ratio = {}
    for b in seen[0] | seen[1]:
        p = [(seen[c][b] + 1) / (n[c] + 2) for c in (0, 1)]
        pooled = (seen[0][b] + seen[1][b] + 1) / (sum(n) + 2)
        z = (p[1] - p[0]) / math.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1]))
        if abs(z) >= 2.0 and seen[0][b] + seen[1][b] >= 3:
            ratio[b] = math.log(p[1] / p[0])
    assert set(ratio) == set(model.bucket.tolist()) and len(ratio) > 10
    # The fitted weights are where the weighted logistic loss with its ridge is flat.
    cols = sorted(ratio)
    x = np.array([[ratio[b] if b in s else 0.0 for b in cols] for s in sets])
    scale = np.array([ratio[b] for b in cols])
    w = np.array([dict(zip(model.bucket.tolist(), model.weight.tolist(), strict=True))[b] for b in cols]) / scale
    share = weight / weight.sum()
    score = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    assert np.abs(x.T @ (share * (score - toxic)) + ridge * w).max() < 1e-4 and abs((share * (score - toxic)).sum()) < 1e-4
    table = model.table()
    wanted = np.zeros(1 << toxicity.BUCKET_BITS, bool)
    wanted[model.bucket] = True
    got = toxicity.score_texts(model, table, wanted, texts)
    assert np.allclose(got, score, atol=1e-5) and got[toxic == 1].mean() > got[toxic == 0].mean() + 0.3


# --------------------------------------------------------------------- Order MinHash
def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_sketch(text, k=3, per_bin=2):
    """Occurrence-numbered k-mers; two smallest hashes a bin, in text order, hashed together."""
    words = [p for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w for p in (w if len(w) > 24 else [w])]
    mask = -(1 << 24)
    firsts, repeats, times = {}, [], Counter()
    for i in range(len(words)):
        h = 42
        for w in words[i : i + k]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        h = signed(h) >> 24
        if times[h] == 0:
            firsts[h] = i
        else:
            again = xxhash.xxh64_intdigest(struct.pack("<i", times[h]), xxhash.xxh64_intdigest(struct.pack("<q", h), 42))
            repeats.append((signed(again) & mask) | i)
        times[h] += 1
    bins = defaultdict(list)
    for x in sorted([(h << 24) | i for h, i in firsts.items()] + repeats):
        if len(bins[x >> 58]) < per_bin:
            bins[x >> 58].append(x)
    out = []
    for b, xs in sorted(bins.items()):
        h = 42
        for _, value in sorted((x & ((1 << 24) - 1), x >> 24) for x in xs):
            h = xxhash.xxh64_intdigest(struct.pack("<q", value), h)
        out.append(((b + 32) << 32) | (h & 0xFFFFFFFF))
    return out


def test_order_sketches_are_those_of_the_definition(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)] + ["日本", "é", "x" * 30, "a.b"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (0, 1, 2, 3, 5, 40, 300, 900)] + ["a b c " * 60, " \t lead\n\n trail ", "y" * 70, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.sketch for r in orderminhash.fingerprints(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain_sketch(t or ""), (i, t)


# --------------------------------------------------------------------- licences
def test_licence_scores_are_cosines(spark):
    rng = random.Random(10)
    words = lambda t: re.findall(r"[a-z]+|[0-9]+(?:\.[0-9]+)*", t.lower())
    templates = licenses.TEMPLATES
    noise = "the quick brown fox runs over many lazy dogs near old rivers".split()
    texts = ["plain text without any notice", "", "This code has a license of its own\nnot a known one"]
    for _, t in templates[:8]:
        w = t.split()
        for cut in (0.0, 0.15):
            texts.append(" ".join(rng.choice(noise) for _ in range(9)) + " " + " ".join(x for x in w if rng.random() >= cut) + "\n" + " ".join(rng.choice(noise) for _ in range(12)))
    df = Counter(t for x in [*texts, *(b for _, b in templates)] for t in set(words(x)))
    total = len(texts) + len(templates)
    idf = {t: math.log((total + 1) / (n + 1)) + 1 for t, n in df.items()}
    vector = lambda ws: {t: (1 + math.log(n)) * idf[t] for t, n in Counter(ws).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    theirs = [(name, vector(words(t)), len(words(t))) for name, t in templates]

    reach = max(n for _, _, n in theirs) - 1

    def score(ws, template):
        a = vector(ws)
        return round(min(sum(x * template[1].get(t, 0) for t, x in a.items()) / (norm(a) * norm(template[1])), 1.0), 6)

    cue = re.compile(licenses.CUE.replace("(?i)", ""), re.I)
    want = {}
    for i, text in enumerate(texts):
        lines = [x for x in text.split("\n") if cue.search(x)]
        passages = [words(x) for x in (*lines, *([" ".join(lines)] if len(lines) > 1 else []))]
        every = words(text)
        at = [j for j, w in enumerate(every) if re.search("licen[cs]|redistribut|spdx", w) or every[j : j + 3] == ["permission", "is", "hereby"] or every[j : j + 2] == ["public", "domain"]] if cue.search(text) else []
        for j in at:
            # Lengths of the templates that the words around the place can still reach.
            near = set(every[max(j - reach, 0) : j + reach + 1])
            for length in {n for _, v, n in theirs if sum((v[t] / norm(v)) ** 2 for t in near & set(v)) >= (licenses.THRESHOLD - 1e-6) ** 2}:
                low = max(j - length + 1, 0)
                passages += [every[s : s + length] for s in range(low, max(min(j, len(every) - length), low) + 1)]
        found = [(-score(p, t), t[0]) for p in passages if p for t in theirs]
        best = min((f for f in found if -f[0] >= licenses.THRESHOLD), default=None)
        want[i] = (best and best[1], best and pytest.approx(-best[0], abs=2e-6))
    frame = spark.createDataFrame([(i, f"d{i}/f.txt", t) for i, t in enumerate(texts)], "doc_id long, path string, text string")
    got = {r.doc_id: (r.own_license, r.score) for r in licenses.scan(frame).collect()}
    assert got == want and sum(v[0] is not None for v in want.values()) >= 10
