"""Bounded summaries of corroborating rows against all pairs."""

import random

from gleaner.operators import verify

LABELS = ["a", "b", "c"]


def random_rows(rng, n, contents):
    domain = lambda: ".".join([*(rng.choice(LABELS) for _ in range(rng.randrange(0, 4))), rng.choice(["cn", "com", "x.org"])])
    return [(i, domain(), rng.choice(contents)) for i in range(n)]


def first_partner(rows, domain, content):
    return next((p for p, d, c in sorted(rows) if not verify.related(d, domain) and c != content), None)


def test_summary_answers_every_row_and_stays_small():
    rng = random.Random(1)
    for trial in range(300):
        rows = random_rows(rng, rng.randrange(1, 60), [1, 2] if trial % 2 else range(20))
        kept = verify.summary(rows)
        asked = rows + random_rows(rng, 40, [1, 2, 99])
        assert all(first_partner(kept, d, c) == first_partner(rows, d, c) for _, d, c in asked)
        cut = rng.randrange(len(rows))
        assert verify.summary(verify.summary(rows[:cut]) + verify.summary(rows[cut:])) == kept
    sizes = [len(verify.summary(random_rows(rng, n, range(n)))) for n in (100, 1000, 20_000)]
    assert max(sizes) <= 12 * 13 and sizes[2] <= 3 * max(sizes[0], 10)


def test_corroboration_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(verify, "_HELD_ROWS", 7)
    rng = random.Random(2)
    rows = [(rng.choice(["k", "k", "k", "m", None]), rng.choice([1, 1, None]), *r) for r in random_rows(rng, 400, range(4))]
    rows += [("k", 1, 900, None, 1), ("k", 1, 901, "z.cn", None), ("solo", 1, 902, "z.cn", 3)]
    df = spark.createDataFrame(rows, "k string, j int, pos long, d string, c int").repartition(5)
    got = {r.pos: r.corroborator for r in verify.corroboration(df, ["k", "j"], "pos", "d", "c").collect()}
    want = {}
    for k, j, pos, d, c in rows:
        if k is None or j is None:
            continue
        others = [x[2:] for x in rows if x[:2] == (k, j) and None not in x]
        want[pos] = None if d is None or c is None else first_partner(others, d, c)
    assert got == want and sum(v is not None for v in want.values()) > 200
