"""Exact ranks and running totals that no single task has to hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: hex digits of the hash that name a bucket; 16**3 buckets per stratum
PREFIX_DIGITS = 3
#: ranges a distribution is cut into for running totals, and again each of them while one has more rows than a task may hold
RANGES = 128
ROWS_PER_TASK = 1_000_000


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on columns of the same names where a null meets a null."""
    named = right.withColumnsRenamed({c: f"_on_{i}" for i, c in enumerate(on)})
    meet = F.lit(True)
    for i, c in enumerate(on):
        meet = meet & F.col(c).eqNullSafe(F.col(f"_on_{i}"))
    return left.join(named, meet).drop(*[f"_on_{i}" for i in range(len(on))])


def split_hash(seed: int, key: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def stratified_rank(df: DataFrame, strata: Sequence[str], key: str, seed: int) -> DataFrame:
    """Adds ``stratum_rank`` (from 1, in hash order) and ``stratum_size``.

    Hash prefixes cut every stratum into even buckets.  Buckets are counted
    first; rows are then numbered inside their bucket only.  A null stratum is
    a stratum of its own, and a null key is hashed as an empty one.
    """
    hashed = df.withColumn("_h", split_hash(seed, key)).withColumn("_b", F.left("_h", F.lit(PREFIX_DIGITS)))
    counts = hashed.groupBy(*strata, "_b").count()
    stratum = Window.partitionBy(*strata)  # at most 16**PREFIX_DIGITS rows per stratum
    before = stratum.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        *strata,
        "_b",
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"),
        F.sum("count").over(stratum).alias("stratum_size"),
    )
    place = F.row_number().over(Window.partitionBy(*strata, "_b").orderBy("_h", key))
    return (
        join_null_safe(hashed.withColumn("_place", place), bases, [*strata, "_b"])
        .withColumn("stratum_rank", F.col("_base") + F.col("_place"))
        .drop("_h", "_b", "_place", "_base")
    )


def _largest(rows: DataFrame, groups: Sequence[str]) -> int:
    """Rows of the largest group."""
    return rows.groupBy(*groups).count().agg(F.max("count")).first()[0] or 0


def running_totals(counts: DataFrame, groups: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Adds ``<value>_before`` (sum over smaller ``order``) and ``<value>_total``.

    ``counts`` has one row per group and ``order`` value.  The order column is
    cut at its quantiles; range sums are summed up per group, rows only within
    their range.  Ranges follow the number of rows: as long as one has more than
    ``ROWS_PER_TASK``, each is cut again in the same way.  A null group is a
    group of its own.
    """
    cuts = [i / RANGES for i in range(1, RANGES)]
    shape = F.struct(
        F.percentile_approx(order, cuts, 1000).alias("cuts"), *[F.sum(v).alias(f"{v}_total") for v in values]
    )
    if groups:
        shaped = join_null_safe(counts, counts.groupBy(*groups).agg(shape.alias("_shape")), groups)
    else:
        shaped = counts.withColumn("_shape", counts.agg(shape.alias("_shape")).scalar())
    # the shape is read once per row and its cuts are searched, so keep it a column
    ranged = shaped.withColumn("_r", F.size(F.filter("_shape.cuts", lambda c: c <= F.col(order))))
    sums = ranged.groupBy(*groups, "_r").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    earlier = Window.partitionBy(*groups).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*groups, "_r", *[F.coalesce(F.sum(f"_{v}").over(earlier), F.lit(0)).alias(f"_{v}_base") for v in values])
    within = [*groups, f"_r{len(groups)}"]
    named = ranged.withColumnRenamed("_r", within[-1])
    largest = _largest(named, within)
    if ROWS_PER_TASK < largest < _largest(counts, groups):
        deeper = running_totals(named.drop("_shape"), within, order, values).drop(*[f"{v}_total" for v in values])
        placed = deeper.withColumnsRenamed({f"{v}_before": f"_{v}_in" for v in values} | {within[-1]: "_r"})
        placed = join_null_safe(placed, ranged.groupBy(*groups).agg(F.first("_shape").alias("_shape")), groups) if groups else placed.withColumn(
            "_shape", counts.agg(shape.alias("_shape")).scalar()
        )
    else:
        inside = Window.partitionBy(*groups, "_r").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        placed = ranged.withColumns({f"_{v}_in": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    return (
        join_null_safe(placed, bases, [*groups, "_r"])
        .select(
            *counts.columns,
            *[(F.col(f"_{v}_base") + F.col(f"_{v}_in")).alias(f"{v}_before") for v in values],
            *[F.col(f"_shape.{v}_total").alias(f"{v}_total") for v in values],
        )
    )
