"""Entity resolution: notices to projects, reports to financings.

Both folds are sequential by definition, as each decision changes what the next one sees.  They run in lossless blocks:
rows that no rule can bring together, directly or over others, are folded apart, so even one buyer's or company's rows
spread over many tasks.  Titles that may be alike are found by an exact similarity join, not by comparing all pairs.
"""

from __future__ import annotations

from calendar import monthrange
from datetime import date, timedelta
from difflib import SequenceMatcher
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.urls import normalize_url
from ..sources.shared import stored
from .blocks import block_ids, by_scope, connected, in_blocks

DAY_US = 86_400_000_000
LIFECYCLE_MONTHS = 18
SUSPECTED, SAME = 0.75, 0.9
#: Rows of one buyer and category, or one company, that are a block as they stand.
MOST = 2_000


def months_after(us: int, months: int) -> int:
    """The same time of day so many calendar months later, the day cut to the month's length."""
    days, rest = divmod(int(us), DAY_US)
    day = date(1970, 1, 1) + timedelta(days=days)
    year, month = divmod(day.year * 12 + day.month - 1 + months, 12)
    later = date(year, month + 1, min(day.day, monthrange(year, month + 1)[1]))
    return (later - date(1970, 1, 1)).days * DAY_US + rest


@lru_cache(maxsize=1 << 15)
def likeness(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def most_alike(title: str, projects: list[dict]) -> tuple[float, dict]:
    """The greatest similarity of a title, with the first project that has it; only equal titles reach 1."""
    equal = next((p for p in projects if p["title"] == title), None)
    if equal is not None:
        return 1.0, equal
    best, found = -1.0, None
    for p in projects:
        n, m = len(title), len(p["title"])
        if 2.0 * min(n, m) / (n + m) > best and (score := likeness(title, p["title"])) > best:  # no more than the shorter one can match
            best, found = score, p
    return best, found


def plain_match(event: dict, projects: list[dict], total: int) -> dict:
    """Decision for one event against the projects of its buyer; `total` counts all projects anywhere.

    event: buyer, category, title (core), codes, base_codes, rebid, year, year_stated, batch, lot, us.
    project: id, buyer, category, title, codes, base_codes, year, batch, lot, latest_us, span_end_us.
    """

    def out(relation, project=None, reason="no_match", score=0.0):
        return {"relation": relation, "project_id": project and project["id"], "reason": reason, "score": score}

    eligible, failures = [], []
    for p in sorted(projects, key=lambda p: p["id"]):
        if p["buyer"] != event["buyer"]:
            failures.append("buyer_mismatch")
            continue
        if p["category"] != event["category"]:
            failures.append("category_mismatch")
            continue
        exact = bool(set(event["codes"]) & set(p["codes"]))
        clash = next((f for f in ("year", "batch", "lot") if event[f] is not None and p[f] is not None and str(event[f]) != str(p[f])), None)
        if clash == "year" and exact and not event["year_stated"]:
            clash = None
        if clash:
            failures.append(f"conflicting_{clash}")
        else:
            eligible.append(p)
    if not eligible:
        return out("new_project", reason=failures[0] if total == 1 and failures else "buyer_mismatch" if total == 1 else "no_match")
    for p in eligible:
        if set(event["codes"]) & set(p["codes"]) and (not event["rebid"] or event["title"] == p["title"]):
            return out("same_project", p, "exact_project_code", 1.0)
    aligned = [p for p in eligible if event["rebid"] and (set(event["codes"]) & set(p["codes"]) or set(event["base_codes"]) & set(p["base_codes"]))]
    for p in aligned:
        if p["title"] == event["title"]:
            return out("same_project", p, "rebid_original_code", 1.0)
    best, p = most_alike(event["title"], aligned or eligible)
    if event["rebid"]:
        if p in aligned:
            return out("suspected", p, "rebid_core_title_mismatch", best)
        return out("suspected", p, "rebid_code_unaligned", best) if best >= SUSPECTED else out("new_project", score=best)
    if event["title"] == p["title"]:
        return out("same_project", p, "same_buyer_title", 1.0)
    timely = p["latest_us"] is None or p["latest_us"] <= event["us"] <= p["span_end_us"]
    if best >= SAME and timely:
        return out("same_project", p, "title_similarity", best)
    if best >= SUSPECTED:
        return out("suspected", p, "invalid_lifecycle_timing" if best >= SAME else "title_similarity", best)
    return out("new_project", score=best)


# --------------------------------------------------------------------- titles that may be alike
def numbered_characters(title: Column) -> Column:
    """A title's characters as a set: each with the number of its occurrence."""
    chars = F.array_sort(F.filter(F.split(title, ""), lambda c: c != ""))
    return F.transform(chars, lambda c, i: F.concat(c, (i - F.array_position(chars, c)).cast("string")))


def alike_titles(titles: DataFrame, at: str, scope: str, title: str, least: float = SUSPECTED) -> DataFrame:
    """(a, b, bound): pairs of one scope, a < b, whose lengths and characters allow a similarity of `least`.

    The similarity is twice the matching characters over all characters, so it is at most `bound`, twice the common
    characters over all.  With n characters a title has least / (2 - least) * n of them in common with any partner; the
    first of these in an order by rarity stands among its n - need + 1 rarest.  Only titles that share such a character
    meet, only if both have enough characters from there on and their lengths allow it, and of those only pairs within
    the bound are returned.  No pair that reaches `least` is lost.  titles: different titles per scope.
    """
    rows = titles.select(F.col(at).alias("at"), F.col(scope).alias("scope"), numbered_characters(F.col(title)).alias("t"))
    sets = stored(rows.withColumn("n", F.size("t")).where("n > 0"), "title-sets")
    each = sets.select("at", "scope", "n", F.explode("t").alias("c"))
    rare = each.groupBy("scope", "c").agg(F.count("*").alias("df")).where("df > 1")
    # A character of one title only finds nobody, but stays in the order: it takes a place of the prefix.
    ordered = each.join(rare, ["scope", "c"], "left").groupBy("at", "scope", "n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "c"))).alias("o"))
    need = F.ceil(F.col("n") * (least / (2 - least)) - 1e-9)
    prefix = ordered.select("at", "scope", "n", F.posexplode(F.slice("o", F.lit(1), (F.col("n") - need + 1).cast("int"))).alias("p", "x")).select("at", "scope", "n", "p", F.col("x.c").alias("c"), F.col("x.df").alias("df")).where("df > 1")
    prefix = stored(prefix.drop("df"), "title-prefixes")
    other = prefix.select("scope", "c", F.col("at").alias("at2"), F.col("n").alias("n2"), F.col("p").alias("p2"))
    both = (F.col("n") + F.col("n2")) * (least / 2) - 1e-9
    met = prefix.join(other, ["scope", "c"]).where((F.col("at") < F.col("at2")) & (F.least("n", "n2") >= both) & (F.col("n") - F.col("p") >= both) & (F.col("n2") - F.col("p2") >= both))
    pairs = met.select(F.col("at").alias("a"), F.col("at2").alias("b")).distinct()
    left, right = sets.select(F.col("at").alias("a"), F.col("t").alias("ta"), F.col("n").alias("na")), sets.select(F.col("at").alias("b"), F.col("t").alias("tb"), F.col("n").alias("nb"))
    bound = 2.0 * F.size(F.array_intersect("ta", "tb")) / (F.col("na") + F.col("nb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", bound.alias("bound")).where(F.col("bound") >= least - 1e-12)


# --------------------------------------------------------------------- projects
def _scope() -> Column:
    return F.concat_ws("\x01", F.coalesce("buyer", F.lit("\x02")), F.coalesce("category", F.lit("\x02")))


def _project_blocks(rows: DataFrame) -> DataFrame:
    """(pos, block): rows that share a code, a base code, a title or an alike title with the same buyer and category."""
    scoped = rows.select("pos", _scope().alias("scope"), "title", "codes", "base_codes")
    tagged = lambda kind, values: F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.concat_ws("\x01", F.lit(kind), "scope", v))
    keys = F.concat(tagged("c", F.col("codes")), tagged("b", F.col("base_codes")), tagged("t", F.array(F.coalesce("title", F.lit("")))))
    scoped = stored(scoped, "project-rows")
    titles = scoped.groupBy("scope", "title").agg(F.min("pos").alias("at"))
    return block_ids(scoped, "pos", keys, alike_titles(titles, "at", "scope", "title").select("a", "b"))


_EVENT = ("buyer", "category", "title", "year", "batch", "lot")


def _plain(row: dict) -> dict:
    return {k: None if isinstance(v, float) and v != v else v for k, v in row.items()}


def _project(row: dict) -> dict:
    own = {k: row[k] for k in _EVENT} | {"id": row["id"], "codes": list(row["codes"]), "base_codes": list(row["base_codes"]), "latest_us": row["us"]}
    return own | {"span_end_us": None if row["us"] is None else months_after(row["us"], LIFECYCLE_MONTHS)}


def _fold_block(rows: list[dict]) -> list[tuple]:
    projects: list[dict] = []
    out = []
    for e in map(_plain, rows):
        if e["known"]:
            projects.append(_project(e))
            continue
        d = plain_match(e, projects, 1 if len(projects) == 1 else 2)
        own, alone = None, None
        if d["relation"] == "same_project":
            own = next(p for p in projects if p["id"] == d["project_id"])
            own["latest_us"] = e["us"] if own["latest_us"] is None else max(own["latest_us"], e["us"])
            own["codes"], own["base_codes"] = sorted({*own["codes"], *e["codes"]}), sorted({*own["base_codes"], *e["base_codes"]})
            own["span_end_us"] = months_after(own["latest_us"], LIFECYCLE_MONTHS)
        elif d["relation"] == "new_project":
            alone, d = len(projects) and d["reason"] if len(projects) == 1 else None, d | {"reason": "no_match", "score": 0.0}
            own = _project(e)
            projects.append(own)
        out.append((e["pos"], own and own["id"], d["relation"], d["reason"], float(d["score"]), alone, bool(d["relation"] == "new_project" and len(projects) == 1)))
    return out


def _only_reason(folded: DataFrame, rows: DataFrame) -> tuple[int, str] | None:
    """(pos, reason) of the event that opens the second project of all: it alone meets a list of one project."""
    ahead = rows.where("known").limit(2).collect()  # two rows tell enough
    opened = folded.where("relation = 'new_project'").orderBy("pos").limit(2).collect()
    if len(ahead) > 1 or len(ahead) + len(opened) < 2:
        return None
    second = opened[1 - len(ahead)]
    if not second["first"]:  # its block held the project
        return second.pos, second.alone or "no_match"
    event, only = (rows.where(F.col("pos") == p).first().asDict() for p in (second.pos, ahead[0].pos if ahead else opened[0].pos))
    found = plain_match(event, [_project(only)], 1)
    return second.pos, found["reason"] if found["relation"] == "new_project" else "no_match"


def fold_projects(events: DataFrame, known: DataFrame | None = None, most: int = MOST) -> DataFrame:
    """(pos, project, relation, reason, score): events resolved one after another, in order of pos, from 0.

    events: pos, buyer, category, title (core), codes, base_codes, rebid, year, year_stated, batch, lot, us.
    known: projects of the state, id, buyer, category, title, codes, base_codes, year, batch, lot, latest_us.

    A buyer or category mismatch always excludes, and every decision rests on a shared code, a shared base code or a
    similarity of 0.75: these make the blocks of a buyer and category with many rows; one of few rows is a block as it
    stands.  So `score` is 0 for a new project, whose best similarity is below that.
    Where the whole list holds one project, the reason of a new one is that project's first failing guard; this can be
    one event only, the one that opens the second project, and it is settled after the fold.  New projects are named by
    the position of their event in twelve digits; similarity ties go to the smallest name.
    """
    none = F.array().cast("array<string>")
    rows = events.select(F.col("pos").cast("long").alias("pos"), F.lpad(F.col("pos").cast("string"), 12, "0").alias("id"), F.lit(False).alias("known"), *_EVENT, F.coalesce("codes", none).alias("codes"), F.coalesce("base_codes", none).alias("base_codes"), "rebid", "year_stated", "us")
    if known is not None:
        old = known.select((-1 - F.monotonically_increasing_id()).alias("pos"), "id", F.lit(True).alias("known"), *_EVENT, F.coalesce("codes", none).alias("codes"), F.coalesce("base_codes", none).alias("base_codes"), F.lit(False).alias("rebid"), F.lit(False).alias("year_stated"), F.col("latest_us").alias("us"))
        rows = old.unionByName(rows)
    rows = stored(rows, "project-events")
    blocked, rest = by_scope(rows, _scope(), most)
    if rest is not None:
        blocked = blocked.unionByName(rest.join(_project_blocks(rest), "pos"))
    schema = "pos long, project string, relation string, reason string, score double, alone string, first boolean"
    folded = stored(in_blocks(blocked, ["pos"], _fold_block, schema), "project-matches")
    only = _only_reason(folded, rows)
    reason = F.col("reason") if only is None else F.when(F.col("pos") == only[0], F.lit(only[1])).otherwise(F.col("reason"))
    return folded.select("pos", "project", "relation", reason.alias("reason"), "score")


# --------------------------------------------------------------------- financings
def financing_terms(company: Column, subtype: Column, round_name: Column, disclosed: Column, amount: Column, investors: Column) -> Column:
    """The terms by which reports of different days are one financing; null where too little is known.

    company and round_name are normal forms, amount is text, investors an array of normal forms.
    """
    kind = F.coalesce(subtype, F.when(round_name != "", F.lit("round_equity")))
    names = F.array_sort(F.array_distinct(F.filter(F.coalesce(investors, F.array().cast("array<string>")), lambda i: i != "")))
    vague = (company == "") | kind.isNull() | ((kind == "round_equity") & (round_name == "")) | (disclosed & amount.isNull()) | (amount.isNull() & (F.size(names) == 0))
    terms = F.concat_ws("\x01", company, kind, round_name, disclosed.cast("string"), F.coalesce(amount, F.lit("\x02")), F.array_join(names, "\x03"))
    return F.when(~F.coalesce(vague, F.lit(True)), terms)


def prepared_financings(reports: DataFrame) -> DataFrame:
    """The columns that fold_financings() needs, of reports in order of pos.

    reports: pos, company, round_name, subtype, announced_at, amount_cny, disclosed, investors, urls.
    """
    from ..functions import ids

    company, round_name = text.normalize_nfkc(F.col("company")), text.normalize_nfkc(F.coalesce("round_name", F.lit("")))
    rows = reports.withColumn("__c", company).withColumn("__r", round_name).withColumn("__a", ids.amount_text(F.col("amount_cny").cast("double")))
    names = F.transform(F.coalesce("investors", F.array().cast("array<string>")), lambda i: text.normalize(i))
    rounds = text.rounds(F.col("round_name"))
    return rows.select(
        "pos", F.col("__c").alias("name"), text.organization(F.col("company")).alias("identity"), rounds.alias("rounds"), F.coalesce("subtype", F.when(F.size(rounds) > 0, F.lit("round_equity"))).alias("kind"), F.datediff("announced_at", F.lit("1970-01-01").cast("date")).cast("long").alias("day"),
        ids.financing_fingerprint(F.col("announced_at"), F.col("__a"), F.col("__c"), names, F.col("__r"), F.col("subtype")).alias("fingerprint"),
        financing_terms(F.col("__c"), F.col("subtype"), F.col("__r"), F.coalesce("disclosed", F.lit(False)), F.col("__a"), names).alias("terms"),
        F.array_distinct(F.transform(F.filter("urls", lambda u: u.isNotNull() & (u != "")), lambda u: normalize_url(u))).alias("urls"),
    )


def _company_scopes(rows: DataFrame) -> DataFrame:
    """rows with scope: a number for each identity, the same for identities that share a name, directly or over others."""
    hashed = rows.withColumn("scope", F.xxhash64(F.coalesce("identity", F.lit("\x02"))))
    pairs = hashed.select("name", "scope").distinct()
    several = stored(pairs.groupBy("name").agg(F.min("scope").alias("a"), F.collect_list("scope").alias("b")).where(F.size("b") > 1).select("a", F.explode("b").alias("b")), "shared-names")
    if several.isEmpty():
        return hashed
    joined = connected(several).withColumnRenamed("pos", "scope").withColumnRenamed("block", "__top")
    return hashed.join(joined, "scope", "left").withColumn("scope", F.coalesce("__top", "scope")).drop("__top")


def fold_financings(rows: DataFrame, same_terms_days: int = 7, shared_source_days: int = 45, most: int = MOST) -> DataFrame:
    """(pos, financing): reports merged one after another, in order of pos, by three rules, the first that decides.

    1. The fingerprint of the financing's first report.  2. Exactly one financing with a common source, the same company
    and kind, rounds of which one set holds the other, and a first report at most 45 days apart.  3. Exactly one of the
    same terms, at most 7 days apart.  A financing keeps the terms of its first report and unites the sources of all.
    rows: pos, identity, rounds, kind, day, fingerprint, terms, urls (see prepared_financings).

    A rule needs an equal fingerprint, equal terms, or a source of the same company, which make the blocks.  Where rows
    have a `name` besides, which rows of equal fingerprint or terms share, a company with few reports is a block as it
    stands.
    """
    tagged = lambda kind, c: F.array(F.when(c.isNotNull(), F.concat_ws("\x01", F.lit(kind), c)))
    scoped = "name" in rows.columns
    # A financing takes the sources of all its reports, of other identities too, so these do not part the keys.
    sources = F.transform("urls", lambda u: F.concat_ws("\x01", F.lit("u"), *[F.col("scope").cast("string")] * scoped, u))
    keys = F.concat(tagged("f", F.col("fingerprint")), tagged("t", F.col("terms")), sources)
    rows = stored(rows.select("pos", *["name"] * scoped, "identity", "rounds", "kind", "day", "fingerprint", "terms", "urls"), "financing-reports")

    def work(reports: list[dict]) -> list[tuple]:
        known: list[dict] = []
        prints, by_url, by_terms = {}, {}, {}
        out = []
        for e in map(_plain, reports):
            mine, urls = frozenset(e["rounds"]), set(e["urls"])

            def near(f, days, e=e):
                return e["day"] is not None and f["day"] is not None and abs(e["day"] - f["day"]) <= days

            def shared(f, e=e, mine=mine):
                fits = f["identity"] == e["identity"] and f["kind"] == e["kind"] and mine and f["rounds"] and (mine <= f["rounds"] or f["rounds"] <= mine)
                return bool(e["identity"] and fits) and near(f, shared_source_days)

            found = prints.get(e["fingerprint"])
            if found is None:
                same = [k for k in sorted({k for u in urls for k in by_url.get(u, ())}) if shared(known[k])]
                if len(same) != 1:
                    same = [k for k in by_terms.get(e["terms"], ()) if near(known[k], same_terms_days)] if e["terms"] is not None else []
                found = same[0] if len(same) == 1 else None
            if found is None:
                found = len(known)
                known.append({"pos": e["pos"], "identity": e["identity"], "kind": e["kind"], "rounds": mine, "day": e["day"]})
                prints.setdefault(e["fingerprint"], found)
                if e["terms"] is not None:
                    by_terms.setdefault(e["terms"], []).append(found)
            for u in urls:
                by_url.setdefault(u, set()).add(found)
            out.append((e["pos"], known[found]["pos"]))
        return out

    blocked, rest = by_scope(_company_scopes(rows).drop("name"), F.col("scope"), most) if scoped else (None, rows)
    if rest is not None:
        linked = rest.join(block_ids(rest, "pos", keys), "pos")
        blocked = linked if blocked is None else blocked.unionByName(linked)
    return in_blocks(blocked, ["pos"], work, "pos long, financing long")


def overlap_anti(leads: DataFrame, verified: DataFrame, company: str, round_: str, when: str, days: int = 45) -> DataFrame:
    """Leads that no verified financing of the same company and round overlaps within `days` whole days.

    An equality join on company and round; only the nearest dates of each lead's key are held against it.
    """
    dates = verified.groupBy(F.col(company).alias("__c"), F.col(round_).alias("__r")).agg(F.array_sort(F.collect_set(F.to_date(when))).alias("__dates"))
    near = F.exists("__dates", lambda d: F.abs(F.datediff(F.col(when), d)) <= days)
    joined = leads.join(dates, (F.col(company) == F.col("__c")) & (F.col(round_) == F.col("__r")), "left")
    return joined.where(F.col("__dates").isNull() | ~near).drop("__c", "__r", "__dates")
