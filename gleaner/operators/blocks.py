"""Lossless blocks for order-dependent folds: rows that share no key, directly or over other rows, never meet.

Blocks are the connected components of positions over shared keys.  A fold of a block is greedy and ordered; a block too
large for one task is folded in rounds: the first rows are folded exactly, then all others are held against the new
leaders at once, in many tasks.  Both give what one pass over the rows in order gives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..sources.shared import stored

#: Rows of a block that one task folds; larger blocks are folded in rounds that decide at least STEP rows each.
MOST, STEP = 20_000, 4_000


def _kept(links: DataFrame) -> tuple[DataFrame, tuple]:
    """Stored links (u, v) with their count and checksum, both taken while they are written."""
    seen = Observation()
    out = stored(links.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")), "block-links")
    return out, (seen.get["n"], seen.get["sum"])


def connected(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(pos, block): for every position with a link, the smallest position that links lead to.

    Large and small stars in turn: each node hands its larger neighbours, then its smaller ones, to the smallest node it
    knows.  Distances halve, so the rounds grow with the logarithm of a component's length.  Only minima are kept per
    node, and they combine before the shuffle.  Raises RuntimeError if links still change after max_rounds.
    """
    link = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    held, before = _kept(link)
    for _ in range(max_rounds):
        if not before[0]:
            break
        either = held.unionByName(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = either.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        larger = either.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smaller = larger.groupBy("u").agg(F.min("v").alias("m"))
        handed = larger.join(smaller, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        held, now = _kept(handed)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"blocks did not settle in {max_rounds} rounds")
    leaves = held.select(F.col("u").alias("pos"), F.col("v").alias("block"))
    return leaves.unionByName(held.select(F.col("v").alias("pos"), F.col("v").alias("block")).distinct())


def key_links(df: DataFrame, pos: str, keys: Column) -> DataFrame:
    """(a, b): each position with the smallest position of each of its keys; keys is an array column, nulls are skipped."""
    pairs = stored(df.select(F.col(pos).cast("long").alias("b"), F.explode(F.array_distinct(F.array_compact(keys))).alias("key")), "block-keys")
    first = pairs.groupBy("key").agg(F.min("b").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    return pairs.join(first, "key").select("a", "b")


def block_ids(df: DataFrame, pos: str, keys: Column, links: DataFrame | None = None, max_rounds: int = 60) -> DataFrame:
    """(pos, block): the smallest position connected over shared keys, or over further links (a, b) of positions."""
    own = key_links(df, pos, keys)
    found = connected(own if links is None else own.unionByName(links.select(F.col("a").cast("long"), F.col("b").cast("long"))), max_rounds=max_rounds)
    alone = df.select(F.col(pos).cast("long").alias("pos")).join(found, "pos", "left_anti").distinct()
    return stored(found.unionByName(alone.select("pos", F.col("pos").alias("block"))), "blocks")


def by_scope(rows: DataFrame, scope: Column, most: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows with block, rows of crowded scopes or None); rows of different scopes must never meet, rows should be stored.

    A scope of at most `most` rows is a block as it stands: blocks may be coarser than need be, and nothing has to be
    linked.  Scopes with an equal hash are one block, or crowded together.  Rows of larger scopes come without a block.
    """
    scoped = rows.withColumn("block", F.xxhash64(scope))
    crowded = stored(scoped.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > most).select("block"), "crowded-scopes")
    if crowded.isEmpty():
        return scoped, None
    return scoped.join(crowded, "block", "left_anti"), scoped.join(crowded, "block", "left_semi").drop("block")


# --------------------------------------------------------------------- greedy folds
class Leaders:
    """Group leaders in order, found by their keys where keys are given."""

    def __init__(self, same: Callable[[dict, dict], bool]):
        self.same, self.rows, self.by_key = same, [], {}

    def first(self, row: dict, keys: Sequence[str] | None) -> int | None:
        """Place of the first leader that the row equals; one without a shared key is not asked."""
        asked = range(len(self.rows)) if keys is None else sorted({k for key in keys for k in self.by_key.get(key, ())})
        return next((k for k in asked if self.same(row, self.rows[k])), None)

    def add(self, row: dict, keys: Sequence[str] | None) -> int:
        self.rows.append(row)
        for key in keys or ():
            self.by_key.setdefault(key, []).append(len(self.rows) - 1)
        return len(self.rows) - 1


def _keys(row: dict) -> list[str] | None:
    keys = row.get("__keys")
    return None if keys is None else [k for k in keys if k is not None]


def greedy_groups(rows: list[dict], same: Callable[[dict, dict], bool]) -> list[int]:
    """For each row, in order, the index of the first earlier group leader it equals, else its own.

    Rows of a column __keys are held against leaders of a shared key only.
    """
    leaders, places, out = Leaders(same), [], []
    for i, row in enumerate(rows):
        keys = _keys(row)
        found = leaders.first(row, keys)
        if found is None:
            found = leaders.add(row, keys)
            places.append(i)
        out.append(places[found])
    return out


def in_blocks(blocked: DataFrame, order: Sequence[str], work: Callable[[list[dict]], list[tuple]], schema: str) -> DataFrame:
    """What `work` makes of each block's rows, in order, nulls last; blocked has the column block.

    Rows come sorted by block, so a task holds one block at a time, and small blocks cost no call of their own between
    Spark and Python.
    """
    names = [field.strip().split(" ")[0] for field in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[dict] = []
        for part in batches:
            out: list[tuple] = []
            for row in part.to_dict("records"):
                if held and held[0]["block"] != row["block"]:
                    out += work(held)
                    held = []
                held.append(row)
            yield pd.DataFrame(out, columns=names, dtype=object)
        yield pd.DataFrame(work(held) if held else [], columns=names, dtype=object)

    return blocked.repartition("block").sortWithinPartitions("block", *[F.asc_nulls_last(c) for c in order]).mapInPandas(run, schema)


def fold(df: DataFrame, pos: str, keys: Column, order: Sequence[str], same: Callable[[dict, dict], bool], links: DataFrame | None = None, most: int = MOST, step: int = STEP, scope: Column | None = None) -> DataFrame:
    """(pos, leader): greedy first-leader clustering, inside lossless blocks, rows in the given order, nulls last.

    The relation need not be transitive: a row is held against group leaders only, the earliest first.  Rows that it
    relates must share a key, or else be connected by the links (a, b) of positions, if these are given.  Where they
    must be of one scope too, only the rows of scopes of more than `most` rows are dealt into finer blocks.
    """
    if scope is not None and links is None:
        small, rest = by_scope(df, scope, most)
        done = _folded(small.withColumn("__keys", F.array_distinct(F.array_compact(keys))), pos, [*order, pos], same)
        return done if rest is None else done.unionByName(fold(rest, pos, keys, order, same, None, most, step))
    found = block_ids(df, pos, keys, links)
    blocks = found.select(F.col("pos").alias("__pos"), "block")
    keyed = F.array_distinct(F.array_compact(keys)) if links is None else F.lit(None).cast("array<string>")
    blocked = df.withColumn("__keys", keyed).join(blocks, F.col(pos) == F.col("__pos")).drop("__pos")
    crowded = found.groupBy("block").agg(F.count("*").alias("__n")).where(F.col("__n") > most).select("block")
    if crowded.isEmpty():
        return _folded(blocked, pos, [*order, pos], same)
    crowded = stored(crowded, "crowded-blocks")
    small = _folded(blocked.join(crowded, "block", "left_anti"), pos, [*order, pos], same)
    return small.unionByName(fold_crowded(blocked.join(crowded, "block", "left_semi"), pos, order, same, step))


def _folded(blocked: DataFrame, pos: str, order: Sequence[str], same: Callable[[dict, dict], bool]) -> DataFrame:
    def work(rows: list[dict]) -> list[tuple]:
        return [(row[pos], rows[lead][pos]) for row, lead in zip(rows, greedy_groups(rows, same), strict=True)]

    return in_blocks(blocked, order, work, "pos long, leader long")


def numbered(df: DataFrame, at: str = "__at") -> DataFrame:
    """df with __rank, its place inside its block in order of `at`, a monotonically increasing id.

    The high bits of the id name the sort partition: ranks inside those, plus the rows of a block in earlier ones.
    """
    part = F.shiftright(at, 33)
    sizes = df.groupBy("block", part.alias("__part")).agg(F.count("*").alias("__n"))
    before = sizes.select("block", "__part", (F.sum("__n").over(Window.partitionBy("block").orderBy("__part")) - F.col("__n")).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("block", "__part").orderBy(at))
    return df.withColumn("__part", part).join(before, ["block", "__part"]).withColumn("__rank", F.col("__before") + inside).drop("__part", "__before")


def fold_crowded(blocked: DataFrame, pos: str, order: Sequence[str], same: Callable[[dict, dict], bool], step: int = STEP) -> DataFrame:
    """fold() for blocks of any size; blocked: rows with block and __keys.

    Each round folds the first `step` undecided rows of each block in one task.  Their leaders are final, as no earlier
    row is undecided; every later row then finds its first match among them, chunk by chunk in tasks of their own, and
    is decided if it has one.  The others go to the next round, still in order.
    """
    left = stored(blocked.orderBy("block", *[F.asc_nulls_last(c) for c in (*order, pos)]).withColumn("__at", F.monotonically_increasing_id()), "crowded-rows")
    done: DataFrame | None = None

    def match(rows: pd.DataFrame, leads: pd.DataFrame) -> pd.DataFrame:
        leaders = Leaders(same)
        own = leads.sort_values("__at", kind="stable")
        for lead in own.to_dict("records"):
            leaders.add(lead, _keys(lead))
        found = [leaders.first(r, _keys(r)) for r in rows.to_dict("records")]
        at = own[pos].to_numpy()
        return pd.DataFrame({"pos": rows[pos], "leader": pd.array([None if f is None else int(at[f]) for f in found], "Int64")})

    while True:
        ranked = stored(numbered(left), "crowded-ranks")
        head = ranked.where(F.col("__rank") <= step)
        folded = stored(_folded(head, pos, ["__at"], same), "crowded-heads")
        done = folded if done is None else done.unionByName(folded)
        rest = ranked.where(F.col("__rank") > step).withColumn("__chunk", F.floor((F.col("__rank") - 1) / step).cast("long")).drop("__rank")
        chunks = rest.select("block", "__chunk").distinct()
        leads = head.join(folded.where("pos = leader").select(F.col("pos").alias("__lead")), F.col(pos) == F.col("__lead")).drop("__lead", "__rank").join(chunks, "block")
        leads = leads.select(*[F.col(c).alias(c) for c in leads.columns])  # columns of their own beside those of rest
        found = stored(rest.groupBy("block", "__chunk").cogroup(leads.groupBy("block", "__chunk")).applyInPandas(match, "pos long, leader long"), "crowded-matches")
        done = done.unionByName(found.where("leader is not null"))
        open_ = found.where("leader is null").select(F.col("pos").alias("__open"))
        if open_.isEmpty():
            return done
        left = stored(rest.drop("__chunk").join(open_, F.col(pos) == F.col("__open"), "left_semi"), "crowded-rows")
