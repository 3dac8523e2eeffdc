"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.storage import Scratch


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both(edges)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    )


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, label`` for every node of an edge table ``u, v``; the label is the least node of the component.

    Each round rewires the edges towards least neighbours (a large star, then a
    small star), so a group of any size ends as one star in a logarithmic
    number of rounds.  Edges stay linear in the input; least neighbours are
    pre-aggregated, and the joins back to a hot node are inner joins that
    adaptive execution may split.  Loops and repeated edges are allowed.
    """

    def mark(table: DataFrame) -> tuple:
        spread = F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))
        return tuple(table.agg(F.count("*"), F.sum(spread.cast("decimal(38,0)"))).first())

    now = scratch.table(edges.where("u <> v").select("u", "v").distinct(), "edges")
    before = mark(now)
    while before[0]:
        nxt = scratch.table(_small_star(_large_star(now)).where("u <> v").distinct(), "edges")
        scratch.drop(now)
        now, after = nxt, mark(nxt)
        if after == before:
            break
        before = after
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
