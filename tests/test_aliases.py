"""Names of a registry in texts, against plain Python over all names."""

import random
import re

from gleaner.operators import aliases

REGISTRY = "kind string, place int, domain string, alias string"


def bare(x):
    return re.sub("(?:有限责任公司|股份有限公司|有限公司|公司)$", "", re.sub(r"[\s·•（）()“”\"']", "", x or "").lower())


def plain_best(value, names, as_name):
    own = bare(value)
    fits = [(0 if as_name and bare(a) == own else 1, len(a), a) for a in names if own and bare(a) and (bare(a) in own or (as_name and own in bare(a)))]
    return min(fits)[2] if fits else None


def plain_clues(lead, registry):
    tables = {}
    for kind, place, domain, alias in sorted(registry, key=lambda r: r[1]):
        tables.setdefault(kind, {}).setdefault(domain, []).append(alias.strip())
    _, organization, investors, evidence, candidate = lead
    found = [(d, plain_best(organization, names, True), "structured") for d, names in tables["company"].items()]
    found += [(d, plain_best(i, names, True), "structured") for d, names in tables["investor"].items() for i in investors or []]
    found += [(d, plain_best(t, names, False), layer) for kind in ("investor", "company") for d, names in tables[kind].items() for t, layer in ((evidence, "evidence"), (candidate, "candidate"))]
    found = [f for f in found if f[1]]
    return tuple(list(dict.fromkeys(f[i] for f in found)) for i in range(3))


def test_clues_against_all_names(spark):
    rng = random.Random(1)
    signs = "天地玄黄宇宙洪荒AbC 公司"
    word = lambda n: "".join(rng.choice(signs) for _ in range(rng.randrange(1, n)))
    registry = [(rng.choice(["company", "investor"]), k, f"d{k}.cn", rng.choice([word(4), word(7) + "有限公司", " ", "“" + word(3) + "”"])) for k in (rng.randrange(25) for _ in range(300))]
    leads = [(i, rng.choice([None, "", word(5), word(9) + "有限责任公司"]), rng.choice([None, [], [word(4), None, word(8)]]), rng.choice([None, word(60)]), word(40)) for i in range(60)]
    df = spark.createDataFrame(leads, "lead_id long, organization string, investors array<string>, evidence string, candidate string").repartition(3)
    rows = spark.createDataFrame(registry, REGISTRY)
    want = {x[0]: plain_clues(x, registry) for x in leads}
    for most in (1 << 20, 900):  # one pass; several
        got = {r.lead_id: (r.domains, r.aliases, r.layers) for r in aliases.official_clues(df, rows, most=most).collect()}
        assert got == {k: v for k, v in want.items() if v[0]}
    assert aliases.official_clues(df, rows.limit(0)).collect() == [] == aliases.official_clues(df.limit(0), rows).collect()


def test_a_hundred_thousand_names(spark):
    rng = random.Random(2)
    names = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(6, 11))) for _ in range(100_000)]
    registry = spark.createDataFrame([("company", i, f"d{i % 5000}", n) for i, n in enumerate(names)], "kind string, place long, domain string, alias string").selectExpr("kind", "cast(place % 5000 as int) place", "domain", "alias")
    texts = [(i, "".join(rng.choice("abcdefgh") for _ in range(4000)) + rng.choice(names)) for i in range(12)] + [(99, None), (98, "")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {(r.doc_id, r.domain): r.alias for r in aliases.named_in(df, registry, "doc_id", "text").collect()}
    want = {}
    for k, t in texts:
        for i, n in enumerate(names):
            if t and n in t:
                at = (k, f"d{i % 5000}")
                want[at] = min(want.get(at, n), n, key=lambda a: (len(a), a))
    assert len(want) > 12 and got == want


def test_names_contained_in_short_texts(spark):
    """Against every pair of text and name; names of many lengths, repeats, and parts that many of them share."""
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ab客") for _ in range(rng.randrange(n)))
    names, texts = [word(8) for _ in range(150)] + ["客户00000012", "客户00000123"], [(i, word(20)) for i in range(120)] + [(500, None), (501, "融资客户00000012客户00000012")]
    got = {tuple(r) for r in aliases.contained(spark.createDataFrame(texts, "at long, said string"), spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    want = {(i, n) for i, t in texts for n in names if n and t and n in t}
    assert got == want and len(want) > 300
    assert aliases.contained(spark.createDataFrame(texts, "at long, said string"), spark.createDataFrame([], "name string")).collect() == []


def test_signals_hold_no_automaton_of_all_companies(spark, monkeypatch):
    from gleaner.operators import report, signals

    monkeypatch.setattr(aliases, "Names", None)
    monkeypatch.setattr(aliases, "pieces", None)
    leads = spark.createDataFrame([(1, "甲火箭融资", ["a"], 10), (2, "乙卫星融资", ["a"], 10)], "lead long, said string, rounds array<string>, day long")
    known = spark.createDataFrame([("甲火箭", ["a"], 20)], "company string, rounds array<string>, day long")
    assert [r.lead for r in signals.overlapping(leads, known).collect()] == [1]
    subjects = spark.createDataFrame([(1, "甲火箭"), (2, "甲火箭公司"), (3, "甲火箭"), (4, "乙")], "pos long, subject string")
    assert {frozenset(r) for r in report.held_subjects(subjects, "pos", "subject").collect()} == {frozenset((1, 2)), frozenset((1, 3))}
