"""Connected components of a link table by alternating large and small stars, without collecting links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 50) -> DataFrame:
    """(node, root): for each node with a link, the smallest node it is connected to.

    Each star step keeps only a minimum per node, which Spark combines before the shuffle; a node with very many
    neighbours is met again in a join that adaptive execution can split.  Self links and nulls are left out.
    """
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v").distinct()
    links, before = stored(links, "links"), None
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        links = stored(small, "links")
        now = _state(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
