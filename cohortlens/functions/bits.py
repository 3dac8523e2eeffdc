"""A set of keys as bits: a small table that tells for most rows of a large one that they are not in the set.

A row goes through a hash of its key; keys of the set always pass, others pass
by chance.  Rows that do not pass need no exchange to meet the set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bits of a set: this many for each key, and not more than MOST (64 MB to broadcast)
PER_KEY = 16
MOST = 1 << 28


def bit_table(keys: DataFrame, hashed: Column, count: int | None = None) -> tuple[DataFrame, int]:
    """``word, bits`` of the set of ``hashed`` (64-bit hashes), and how many bits there are.

    ``count`` is a known bound of the number of keys.  The table has at most a
    64th of that many rows, whatever the number of keys; with very many keys it
    lets more rows pass.
    """
    count = keys.count() if count is None else count
    size = 1 << 10
    while size < min(MOST, PER_KEY * count):
        size *= 2
    slot = keys.select(F.pmod(hashed, F.lit(size)).cast("long").alias("slot"))
    word = slot.groupBy((F.col("slot") / 64).cast("long").alias("word"))
    return word.agg(F.bit_or(F.expr("shiftleft(1L, int(slot % 64))")).alias("bits")), size


def marked(rows: DataFrame, hashed: Column, table: DataFrame, size: int, name: str) -> DataFrame:
    """Rows with a boolean ``name``: false means that the row's key is surely not in the set."""
    slot = F.pmod(F.coalesce(hashed, F.lit(0)), F.lit(size)).cast("long")
    small = F.broadcast(table.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    joined = rows.withColumn("_slot", slot).join(small, (F.col("_slot") / 64).cast("long") == F.col("_word"), "left")
    hit = F.coalesce(F.expr("getbit(_bits, int(_slot % 64))"), F.lit(0)) == 1
    return joined.withColumn(name, hit).drop("_slot", "_word", "_bits")
