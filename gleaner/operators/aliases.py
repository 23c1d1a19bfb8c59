"""Names of a registry table in texts: one pass of an automaton over each text, whatever the number of names.

A registry has rows (kind, place, domain, alias): kind is company or investor, place orders the domains of a kind.  Its
bare names are built into an Aho-Corasick automaton per task.  The registry reaches the tasks only in pieces of a checked
size; a larger one takes several passes, whose best aliases per domain are merged.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored

#: Bytes of bare names that one pass takes to every task.
PIECE_BYTES = 8 << 20
_HIT = "probe long, stage int, sub int, kind string, place int, domain string, exact int, n int, alias string"


def bare_name(value: Column) -> Column:
    """A name without white space, brackets and its legal form, lower case."""
    return F.regexp_replace(F.lower(F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)[\s·•（）()“”\"']", "")), "(?:有限责任公司|股份有限公司|有限公司|公司)$", "")


class Names:
    """Bare names of a registry piece: which of them a text holds, and which of them hold a name."""

    def __init__(self, rows: list[tuple[str, str, int, str, str]]):
        """rows: bare name, kind, place, domain, alias."""
        import ahocorasick

        self.rows, self.by_bare = rows, {}
        for i, row in enumerate(rows):
            self.by_bare.setdefault(row[0], []).append(i)
        self.automaton = ahocorasick.Automaton()
        for bare, own in self.by_bare.items():
            self.automaton.add_word(bare, own)
        self.automaton.make_automaton()
        self._tails: list[tuple[str, str]] | None = None

    def inside(self, text: str) -> set[int]:
        """Rows whose bare name stands in the text."""
        return {i for own in {id(x): x for _, x in self.automaton.iter(text)}.values() for i in own} if self.rows else set()

    def around(self, name: str) -> set[int]:
        """Rows whose bare name holds the name: it begins one of their tails, which are kept in order."""
        if self._tails is None:
            self._tails = sorted({(bare[k:], bare) for bare in self.by_bare for k in range(len(bare))})
        out, at = set(), bisect_left(self._tails, (name,))
        while at < len(self._tails) and self._tails[at][0].startswith(name):
            out.update(self.by_bare[self._tails[at][1]])
            at += 1
        return out

    def best(self, said: str, as_name: bool, kinds: str | None) -> dict[tuple[str, int, str], tuple[int, int, str]]:
        """(kind, place, domain) -> the best alias: equal names first, then the shortest, then by text."""
        found: dict = {}
        for i in self.inside(said) | (self.around(said) if as_name else set()):
            bare, kind, place, domain, alias = self.rows[i]
            if kinds is None or kind == kinds:
                mine = (0 if as_name and bare == said else 1, len(alias), alias)
                at = (kind, place, domain)
                found[at] = min(found.get(at, mine), mine)
        return found


def pieces(registry: DataFrame, most: int = PIECE_BYTES, bare: Callable[[Column], Column] | None = bare_name) -> Iterator[list[tuple]]:
    """The registry's rows in pieces of about `most` bytes; its size is known before any row leaves the executors."""
    alias = F.col("alias") if bare is None else F.trim("alias")
    rows = registry.select((alias if bare is None else bare(alias)).alias("bare"), "kind", F.col("place").cast("int").alias("place"), "domain", alias.alias("alias")).where("bare <> '' and domain is not null").distinct()
    rows = stored(rows, "registry")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("bare") + F.octet_length("alias") + F.octet_length("domain")), F.lit(0))).first()[0]
    n = max(1, -(-size // most))
    for k in range(n):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("bare", "domain"), F.lit(n)) == k).toLocalIterator()]


def found_names(probes: DataFrame, registry: DataFrame, most: int = PIECE_BYTES, bare: Callable[[Column], Column] | None = bare_name) -> DataFrame:
    """(probe, stage, sub, kind, place, domain, alias): the best alias of each domain that a probe names.

    probes: probe (an id), stage and sub (carried along), said (bare), as_name, and kinds, the kind that is asked, null
    for both.  In a text an alias counts where it stands in it; a name counts also where it stands in the alias.
    bare gives the normal form of aliases, in which `said` is already; without one, aliases are taken as they stand.
    """
    asked = probes.where("said <> ''")
    hits: DataFrame | None = None
    for rows in pieces(registry, most, bare):

        def run(batches, rows=rows):
            names = Names(rows)
            for part in batches:
                out = []
                for probe, stage, sub, said, as_name, kinds in part.itertuples(index=False):
                    out += [(probe, stage, sub, *at, *mine) for at, mine in names.best(said, as_name, kinds).items()]
                yield pd.DataFrame(out, columns=["probe", "stage", "sub", "kind", "place", "domain", "exact", "n", "alias"])

        one = asked.select("probe", "stage", "sub", "said", "as_name", "kinds").mapInPandas(run, _HIT)
        hits = one if hits is None else hits.unionByName(one)
    best = hits.groupBy("probe", "stage", "sub", "kind", "place", "domain").agg(F.min(F.struct("exact", "n", "alias")).alias("b"))
    return best.select("probe", "stage", "sub", "kind", "place", "domain", F.col("b.alias").alias("alias"))


def contained(texts: DataFrame, names: DataFrame) -> DataFrame:
    """(at, name): the names that stand in short texts, as an equality join, for as many names as there are texts.

    A name is found by one of its parts, as long as the largest power of two that fits: the one that the fewest names
    have.  Texts offer all their parts of those lengths, and what meets is held against the whole name.  For long texts
    and few names, see found_names().  texts: at, said.  names: name; all in normal form.
    """
    wide = F.expr("shiftleft(1, length(bin(char_length(name))) - 1)")
    sized = names.select("name").where("name <> ''").distinct().select("name", F.char_length("name").alias("n"), wide.alias("k"))
    part = lambda c, i, k: F.struct(k.alias("k"), F.xxhash64(F.substring(c, i, k)).alias("h"), i.alias("i"))
    each = stored(sized.select("name", F.explode(F.transform(F.sequence(F.lit(1), F.col("n") - F.col("k") + 1), lambda i: part(F.col("name"), i, F.col("k")))).alias("p")).select("name", "p.*"), "name-parts")
    shared = each.groupBy("k", "h").agg(F.count("*").alias("df"))
    anchors = stored(each.join(shared, ["k", "h"]).groupBy("name").agg(F.min(F.struct("df", "i", "k", "h")).alias("a")).select("name", "a.k", "a.h", F.col("a.i").alias("off")), "name-anchors")
    widths = sorted(r.k for r in anchors.select("k").distinct().collect())  # powers of two, so a handful
    none = F.array().cast("array<struct<k:int,h:bigint,i:int>>")
    size = F.char_length("said")
    own = lambda k: F.when(size >= k, F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: part(F.col("said"), i, F.lit(k)))).otherwise(none)
    offered = texts.select("at", F.explode(F.concat(*[own(k) for k in widths], none)).alias("p")).select("at", "p.*")
    met = offered.join(anchors, ["k", "h"]).where("i >= off").select("at", "name", (F.col("i") - F.col("off") + 1).alias("from"))
    held = met.join(texts, "at").where(F.substring("said", F.col("from"), F.char_length("name")) == F.col("name"))
    return held.select("at", "name").distinct()


def named_in(texts: DataFrame, registry: DataFrame, id_col: str, text_col: str, most: int = PIECE_BYTES) -> DataFrame:
    """(id, kind, domain, alias) of the domains with an alias in a text, the shortest one first by text."""
    probes = texts.select(F.col(id_col).cast("long").alias("probe"), F.lit(0).alias("stage"), F.lit(0).alias("sub"), bare_name(F.col(text_col)).alias("said"), F.lit(False).alias("as_name"), F.lit(None).cast("string").alias("kinds"))
    return found_names(probes, registry, most).select(F.col("probe").alias(id_col), "kind", "domain", "alias")


def official_clues(leads: DataFrame, registry: DataFrame, id_col: str = "lead_id", most: int = PIECE_BYTES) -> DataFrame:
    """(lead_id, domains, aliases, layers) of the official sites that leads name, in three layers.

    Structured fields come first: the organization among companies, then each investor among investors; then the quotes
    and the candidate's own text, investors before companies.  All three lists are without repeats, in that order; leads
    that name nobody have no row.  leads: lead_id (long), organization, investors, evidence, candidate.
    """
    none = F.lit(None).cast("string")

    def probe(stage, sub, said, as_name, kinds):
        return F.struct(F.lit(stage).alias("stage"), sub.cast("int").alias("sub"), bare_name(said).alias("said"), F.lit(as_name).alias("as_name"), kinds.alias("kinds"))

    fixed = F.array(probe(0, F.lit(0), F.col("organization"), True, F.lit("company")), probe(2, F.lit(0), F.col("evidence"), False, none), probe(2, F.lit(1), F.col("candidate"), False, none))
    backers = F.transform(F.coalesce("investors", F.array().cast("array<string>")), lambda x, i: probe(1, i, x, True, F.lit("investor")))
    probes = leads.select(F.col(id_col).cast("long").alias("probe"), F.explode(F.concat(fixed, backers)).alias("p")).select("probe", "p.*")
    stage = F.when((F.col("stage") == 2) & (F.col("kind") == "company"), 3).otherwise(F.col("stage"))
    layer = F.when(F.col("stage") < 2, "structured").when(F.col("sub") == 0, "evidence").otherwise("candidate")
    each = found_names(probes, registry, most).select("probe", F.struct(stage.alias("stage"), "place", "sub", "domain", "alias", layer.alias("layer")).alias("m"))
    found = each.groupBy("probe").agg(F.array_sort(F.collect_list("m")).alias("m"))
    pick = lambda f: F.array_distinct(F.transform("m", lambda x: x[f]))
    return found.select(F.col("probe").alias(id_col), pick("domain").alias("domains"), pick("alias").alias("aliases"), pick("layer").alias("layers"))
