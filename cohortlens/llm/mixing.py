"""Mixing of sources to target weights: budgets over a tree, then seeded epochs.

Method.  The token budget flows down a tree of domain, language and source.  At
each node it is shared by the children's weights; a child cannot take more than
its part of the corpus holds, times the epochs allowed, and what it leaves goes to
its siblings by weight.  Since a node's capacity is that of all below it, budget
reaches a cousin only after all siblings are full.  A leaf then takes whole
epochs of its documents, and of the next epoch, in an order seeded anew, the
documents that start before its budget ends.

Only counts per leaf are shared out; the order of a large leaf is cut into
buckets by the leading digits of a hash of key and text, whose sums are added up
before any bucket is sorted.  A key of very many rows is spread by their texts,
and equal rows are one row with a count there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.storage import Scratch

EPOCHS = 2
SEED = 8
#: documents of a leaf per bucket, about
BUCKET_DOCS = 20_000

_BLANK = r"[\\t\\n\\x0B\\f\\r]"


def count_words(text: str) -> Column:
    return F.expr(
        f"size(array_remove(split(regexp_replace(coalesce(`{text}`, ''), '{_BLANK}', ' '), ' '), ''))"
    ).cast("long")


def _weights(level: DataFrame, name: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for value, w in weights.items():
        out = F.when(F.col(name) == value, w).otherwise(out)
    return out.cast("double")


def share_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``given`` per child: its share of ``budget`` (that of the parent, on each child) by ``weight``, at most ``cap``.

    Children are filled in order of capacity per weight; the first that is not
    full sets the level for it and all after it.
    """
    w = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    by = w.orderBy(F.col("cap") / F.col("weight"), name)
    past = by.rowsBetween(Window.unboundedPreceding, -1)
    rest = by.rowsBetween(0, Window.unboundedFollowing)
    ranked = children.select(
        "*", F.row_number().over(by).alias("rank"),
        ((F.col("budget") - F.coalesce(F.sum("cap").over(past), F.lit(0.0))) / F.sum("weight").over(rest)).alias("level"),
    )
    short = F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("rank"))
    first = ranked.withColumn("first", F.min(short).over(w))
    level = F.max(F.when(F.col("rank") == F.col("first"), F.col("level"))).over(w)
    open_ = F.col("first").isNotNull() & (F.col("rank") >= F.col("first"))
    return first.withColumn("given", F.when(open_, level * F.col("weight")).otherwise(F.col("cap"))).drop("rank", "level", "first")


def budgets(leaves: DataFrame, budget: float, weights: dict[str, dict[str, int]], epochs: int) -> DataFrame:
    """``quota`` of each leaf ``domain, lang, source`` with ``tokens``."""
    keys = ["domain", "lang", "source"]
    leaves = leaves.where("tokens > 0").withColumn("cap", (F.col("tokens") * epochs).cast("double"))
    above, parent_keys = leaves.agg(F.least(F.lit(float(budget)), F.sum("cap")).alias("budget")), []
    for depth, name in enumerate(keys):
        level = leaves.groupBy(*keys[: depth + 1]).agg(F.sum("cap").alias("cap"))
        level = level.join(above, parent_keys) if parent_keys else level.crossJoin(above)  # one row
        level = level.withColumn("weight", _weights(level, name, weights.get(name, {})))
        given = share_out(level, parent_keys, name)
        parent_keys = keys[: depth + 1]
        above = given.select(*parent_keys, F.col("given").alias("budget"))
    return above.select(*keys, F.floor("budget").cast("long").alias("quota")).join(leaves.select(*keys, "tokens", "docs"), keys)


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    *,
    domain: str,
    weights: dict[str, dict[str, int]],
    share: float,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document and epoch that takes it: ``key, domain, lang, source, n_tokens, text_crc32, epoch``.

    ``domain`` is a SQL expression over the columns of ``docs``; ``weights`` has
    whole numbers for values of ``domain``, ``lang`` and ``source``, others count
    1; the budget is ``share`` of the words of the corpus, and no document is
    taken more than ``epochs`` times.  Tokens are words cut at ASCII blanks.

    A document whose start lies before the end of its leaf's budget is taken
    whole.  Texts without words (null ones too) are never taken.  A null domain,
    language or source counts as the empty name.  Order within a leaf is by the
    MD5 of seed, epoch, key (left out if null) and the MD5 of the text; equal
    rows stand together.  Other columns are read only by ``domain``.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = scratch.table(
        docs.select(
            F.col(key).alias("key"), F.coalesce(F.expr(domain).cast("string"), F.lit("")).alias("domain"),
            F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
            F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), count_words(text).alias("n_tokens"),
            F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")).alias("text_crc32"),
            F.md5(F.coalesce(F.col(text), F.lit(""))).alias("text_md5"),
        ).where("n_tokens > 0"),
        "rows",
    )
    keys = ["domain", "lang", "source"]
    leaves = scratch.table(rows.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "leaves")
    total, most = leaves.agg(F.sum("tokens"), F.max("docs")).first()
    digits = max(1, math.ceil(math.log((most or 1) / BUCKET_DOCS + 1, 16)))
    quota = budgets(leaves, math.floor((total or 0) * share), weights, epochs)
    quota = scratch.table(
        quota.select(*keys, F.expr("quota div tokens").alias("whole"), F.expr("quota % tokens").alias("rest")), "quota"
    )
    rows = rows.join(quota, keys)
    out = [*(F.col(c) for c in ("key", *keys, "n_tokens", "text_crc32")), F.col("epoch").cast("int")]
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("epoch")
    full = rows.where("whole > 0").select("*", every).select(*out)

    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.col("key").cast("string"), "text_md5"))
    partial = rows.where("rest > 0").withColumn("order", order).withColumn("bucket", F.substring("order", 1, digits))
    sums = partial.groupBy(*keys, "bucket").agg(F.sum("n_tokens").alias("of_bucket"))
    before = F.sum("of_bucket").over(Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    ahead = sums.select(*keys, "bucket", F.coalesce(before, F.lit(0)).alias("ahead"))
    # buckets that start behind the end of the budget are not sorted
    near = partial.join(ahead, [*keys, "bucket"]).where("ahead < rest")
    equal = near.groupBy(*keys, "bucket", "order", "key", "n_tokens", "text_crc32", "whole", "rest", "ahead").agg(F.count("*").alias("copies"))
    in_order = Window.partitionBy(*keys, "bucket").orderBy("order", "key", "n_tokens", "text_crc32")
    past = F.sum(F.col("n_tokens") * F.col("copies")).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    left = equal.withColumn("left", F.col("rest") - F.col("ahead") - F.coalesce(past, F.lit(0))).where("left > 0")
    fits = F.least("copies", F.expr("(left + n_tokens - 1) div n_tokens"))  # of equal rows, those that start before the end
    head = left.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), fits))).withColumn("epoch", F.col("whole")).select(*out)
    return full.unionByName(head).withColumnRenamed("key", key)
