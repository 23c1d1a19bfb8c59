"""Project and financing folds in blocks against one plain pass over all rows."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from gleaner.operators import resolve

WORDS = ["卫星", "激光", "通信", "终端", "采购", "项目", "一期", "二期", "研制", "服务", "系统", "测试"]
EVENT = "pos long, buyer string, category string, title string, codes array<string>, base_codes array<string>, rebid boolean, year int, year_stated boolean, batch string, lot string, us long"
KNOWN = "id string, buyer string, category string, title string, codes array<string>, base_codes array<string>, year int, batch string, lot string, latest_us long"
DAY = resolve.DAY_US


def plain_projects(events, known=()):
    """The fold over the whole list, as it is defined."""
    projects = [k | {"span_end_us": resolve.months_after(k["latest_us"], 18)} for k in known]
    out = {}
    for e in sorted(events, key=lambda e: e["pos"]):
        d = resolve.plain_match(e, projects, len(projects))
        own = None
        if d["relation"] == "same_project":
            own = next(p for p in projects if p["id"] == d["project_id"])
            own |= {"latest_us": max(own["latest_us"], e["us"]), "codes": sorted({*own["codes"], *e["codes"]}), "base_codes": sorted({*own["base_codes"], *e["base_codes"]})}
        elif d["relation"] == "new_project":
            own = {k: e[k] for k in ("buyer", "category", "title", "year", "batch", "lot")} | {"id": f"{e['pos']:012d}", "codes": e["codes"], "base_codes": e["base_codes"], "latest_us": e["us"]}
            projects.append(own)
        if own:
            own["span_end_us"] = resolve.months_after(own["latest_us"], 18)
        new = d["relation"] == "new_project"
        out[e["pos"]] = (own and own["id"], d["relation"], d["reason"], 0.0 if new else d["score"])
    return out


def events(rng, n, buyers):
    out = []
    for i in range(n):
        title = "".join(rng.choice(WORDS) for _ in range(rng.choice([3, 6, 9])))
        if out and rng.random() < 0.5:
            title = rng.choice(out)["title"]
            title = title.replace(rng.choice(WORDS), rng.choice(WORDS), 1)
        codes = [f"x{rng.randrange(n // 3)}"] if rng.random() < 0.4 else []
        out.append({
            "pos": i, "buyer": rng.choice(buyers), "category": rng.choice("cccd"), "title": title, "codes": codes, "base_codes": [c + "b" for c in codes] or ([f"x{rng.randrange(n // 3)}b"] if rng.random() < 0.2 else []),
            "rebid": rng.random() < 0.25, "year": rng.choice([2024, 2025, 2025, None]), "year_stated": rng.random() < 0.5, "batch": rng.choice([None, None, "1", "2"]), "lot": rng.choice([None, None, "1"]), "us": rng.randrange(900) * DAY,
        })
    return out


def folded(spark, rows, known=None):
    df = spark.createDataFrame([tuple(r.values()) for r in rows], EVENT).repartition(3)
    old = None if known is None else spark.createDataFrame([tuple(k.values()) for k in known], KNOWN)
    return {r.pos: (r.project, r.relation, r.reason, r.score) for r in resolve.fold_projects(df, old).collect()}


def test_projects_of_one_crowded_buyer(spark):
    """All events are one buyer's: the blocks are many, and the decisions those of one pass."""
    rows = events(random.Random(1), 400, ["b"])
    assert folded(spark, rows) == plain_projects(rows)
    stored = spark.createDataFrame([tuple(r.values()) for r in rows], EVENT)
    sizes = [r["count"] for r in resolve._project_blocks(stored).groupBy("block").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 300


def test_projects_of_several_buyers_and_a_state(spark):
    rows = events(random.Random(2), 150, ["b", "c", None])
    known = [{"id": f"p{i}", "buyer": "b", "category": "c", "title": rows[i]["title"], "codes": [f"x{i}"], "base_codes": [], "year": None, "batch": None, "lot": None, "latest_us": 0} for i in range(12)]
    assert folded(spark, rows, known) == plain_projects(rows, [dict(k) for k in known])


@pytest.mark.parametrize(("change", "reason"), [({"buyer": "z"}, "buyer_mismatch"), ({"category": "z"}, "category_mismatch"), ({"lot": "2"}, "conflicting_lot"), ({"batch": "7", "title": "另外的采购公告"}, "conflicting_batch"), ({"title": "另外的采购公告"}, "no_match")])
def test_the_only_project_gives_the_reason(spark, change, reason):
    first = {"pos": 0, "buyer": "b", "category": "c", "title": "卫星激光终端", "codes": [], "base_codes": [], "rebid": False, "year": 2025, "year_stated": True, "batch": "1", "lot": "1", "us": 0}
    rows = [first, first | {"pos": 5, "us": DAY}, first | change | {"pos": 7}, first | {"pos": 9, "buyer": "y"}]
    got = folded(spark, rows)
    assert got == plain_projects(rows) and got[7][1:3] == ("new_project", reason) and got[9][2] == "no_match"
    known = [{k: first[k] for k in ("buyer", "category", "title", "codes", "base_codes", "year", "batch", "lot")} | {"latest_us": 0}]
    known = [{"id": "p"} | k for k in known]
    assert folded(spark, rows[2:], known) == plain_projects(rows[2:], [dict(k) for k in known])


def test_alike_titles_lose_no_pair(spark):
    rng = random.Random(5)
    titles = {""}
    while len(titles) < 400:
        t = "".join(rng.choice(WORDS) for _ in range(rng.choice([1, 2, 5, 8])))
        titles |= {t, t + rng.choice(WORDS), t.replace(rng.choice(WORDS), "", 1), "aab" * rng.randrange(1, 90)}
    rows = [(i, rng.choice("st"), t) for i, t in enumerate(sorted(titles))]
    df = spark.createDataFrame(rows, "at long, scope string, title string")
    made = {(r.a, r.b) for r in resolve.alike_titles(df, "at", "scope", "title").collect()}
    pairs = [(a, b) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1]]
    close = {(a[0], b[0]) for a, b in pairs if max(SequenceMatcher(None, x, y).ratio() for x, y in ((a[2], b[2]), (b[2], a[2]))) >= 0.75}
    bound = {(a[0], b[0]) for a, b in pairs if SequenceMatcher(None, a[2], b[2]).quick_ratio() >= 0.75}
    assert close and close <= made and made <= bound and len(made) < 0.2 * len(pairs)


def plain_financings(rows):
    known, out = [], {}
    for e in sorted(rows, key=lambda e: e["pos"]):
        days = lambda f: abs(f["day"] - e["day"])  # noqa: B023, E731
        found = [f for f in known if f["fingerprint"] == e["fingerprint"]][:1]
        if not found:
            mine = set(e["rounds"])
            shared = [f for f in known if e["identity"] and f["identity"] == e["identity"] and mine and set(f["rounds"]) and (mine <= set(f["rounds"]) or set(f["rounds"]) <= mine) and f["kind"] == e["kind"] and days(f) <= 45 and f["all"] & set(e["urls"])]
            terms = [f for f in known if e["terms"] is not None and f["terms"] == e["terms"] and days(f) <= 7]
            found = shared if len(shared) == 1 else terms if len(terms) == 1 else []
        if not found:
            found = [e | {"all": set()}]
            known.append(found[0])
        found[0]["all"] |= set(e["urls"])
        out[e["pos"]] = found[0]["pos"]
    return out


def test_financings_of_one_crowded_company(spark):
    rng = random.Random(6)
    rows = [
        {"pos": i, "identity": rng.choice(["甲", "甲", "甲", "乙", ""]), "rounds": sorted(rng.sample(["a", "a+", "b"], rng.choice([0, 1, 1, 2]))), "kind": rng.choice(["round_equity", "round_equity", "strategic", None]), "day": rng.randrange(150), "fingerprint": f"f{rng.randrange(900)}",
         "terms": rng.choice([None, f"t{rng.randrange(120)}"]), "urls": [f"u{rng.randrange(140)}" for _ in range(rng.choice([0, 1, 2]))]}
        for i in range(500)
    ]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "pos long, identity string, rounds array<string>, kind string, day long, fingerprint string, terms string, urls array<string>").repartition(3)
    want = plain_financings(rows)
    assert {r.pos: r.financing for r in resolve.fold_financings(df).collect()} == want and 50 < len(set(want.values())) < 450


def test_terms_of_financings(spark):
    """Too little known gives none; the round's plus sign falls away, an undisclosed amount needs investors."""
    cases = [("甲", None, "a轮", True, "1", ["x"], True), ("甲", None, "", True, "1", ["x"], False), ("甲", "strategic", "", True, "1", [], True), ("", None, "a轮", True, "1", [], False), ("甲", None, "a轮", True, None, ["x"], False), ("甲", None, "a轮", False, None, [], False), ("甲", None, "a轮", False, None, ["x"], True)]
    df = spark.createDataFrame(cases, "c string, k string, r string, d boolean, a string, i array<string>, told boolean")
    out = df.select("told", resolve.financing_terms(*[F.col(x) for x in "ckrdai"]).alias("t")).collect()
    assert [r.told for r in out] == [r.t is not None for r in out]
    reports = [(1, "北京天穹火箭有限公司", "A轮", None, "2026-07-01", 1e8, True, ["远航 基金"], ["http://a.cn/1?utm_source=z"]), (2, "天穹火箭", "A+轮", None, "2026-07-05", 1e8, True, ["远航基金", " "], ["http://b.cn/1"]), (3, "天穹火箭股份有限公司", "A轮、B轮", None, "2026-08-10", 2e8, True, [], ["http://A.cn/1"])]
    rows = spark.createDataFrame(reports, "pos long, company string, round_name string, subtype string, announced string, amount_cny double, disclosed boolean, investors array<string>, urls array<string>").withColumn("announced_at", F.to_date("announced"))
    got = {r.pos: r.financing for r in resolve.fold_financings(resolve.prepared_financings(rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_buyers_of_few_events_need_no_similarity_join(spark, monkeypatch):
    """Only a buyer and category of more than `most` events is dealt into blocks by its titles; the decisions stay."""
    rows = events(random.Random(8), 200, ["b", "b", "b", "c", "d", None])
    want, plain, asked = plain_projects(rows), resolve._project_blocks, []
    df = spark.createDataFrame([tuple(r.values()) for r in rows], EVENT)
    got = lambda most: {r.pos: (r.project, r.relation, r.reason, r.score) for r in resolve.fold_projects(df, most=most).collect()}
    monkeypatch.setattr(resolve, "_project_blocks", lambda rows: asked.append(rows.select("buyer", "category").distinct().count()) or plain(rows))
    assert got(200) == want and asked == []
    assert got(40) == want and asked == [1]


def test_most_alike_is_the_first_of_the_greatest_similarity():
    rng = random.Random(9)
    for _ in range(300):
        title, *others = ("".join(rng.choice("ab 项") for _ in range(rng.choice([1, 3, 6]))) for _ in range(6))
        scores = [SequenceMatcher(None, title, t).ratio() for t in others]
        best, found = resolve.most_alike(title, [{"title": t, "id": i} for i, t in enumerate(others)])
        assert (best, found["id"]) == (max(scores), scores.index(max(scores)))


def test_companies_of_few_reports_are_not_linked(spark, monkeypatch):
    """One name may stand for several identities; they are one block.  Only a crowded company is linked over its keys."""
    rng = random.Random(10)
    of = {"n0": ["甲"], "n1": ["甲", "乙"], "n2": ["丙"], "n3": ["丁", ""]}
    rows = []
    for i in range(200):
        name = rng.choice([*of, "n0", "n0"])
        rows.append({"pos": i, "name": name, "identity": rng.choice(of[name]), "rounds": rng.choice([["a"], ["b"], ["a", "b"]]), "kind": "round_equity", "day": rng.randrange(90), "fingerprint": f"{name}{rng.randrange(30)}", "terms": rng.choice([None, f"{name}{rng.randrange(9)}"]), "urls": [f"u{rng.randrange(20)}"]})
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "pos long, name string, identity string, rounds array<string>, kind string, day long, fingerprint string, terms string, urls array<string>").repartition(3)
    want, plain, asked = plain_financings(rows), resolve.block_ids, []
    monkeypatch.setattr(resolve, "block_ids", lambda rows, *a: asked.append(rows.count()) or plain(rows, *a))
    got = lambda most: {r.pos: r.financing for r in resolve.fold_financings(df, most=most).collect()}
    assert got(200) == want and asked == []
    assert got(60) == want and len(asked) == 1 and 60 < asked[0] < 200
