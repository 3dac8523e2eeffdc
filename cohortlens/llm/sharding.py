"""Shards of equal row counts: a Feistel permutation of global row numbers.

Method.  Rows get numbers 0..N-1 in key order.  A Feistel network permutes the
numbers of the next power of two; a number that lands outside 0..N-1 walks the
cycle on until it is inside, which is a permutation of 0..N-1 again.  The place
``q`` of a row gives shard ``q mod shards`` and slot ``q div shards``: sizes
differ by one row at most, slots have no gaps, and where a row goes (or which row
is at a place) can be computed from the row count and the seed alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.storage import Scratch
from cohortlens.llm.words import scramble

SHARDS = 40
SEED = 20
ROUNDS = 8
#: bytes counted for a row besides its text
ROW_BYTES = 16


def _halves(n: int) -> tuple[int, int]:
    bits = max(2, (n - 1).bit_length())
    return bits // 2, bits - bits // 2


def _network(x: np.ndarray, n: int, seed: int, order: range) -> np.ndarray:
    low_bits, high_bits = _halves(n)
    low, high = x & np.uint64((1 << low_bits) - 1), x >> np.uint64(low_bits)
    for r in order:
        key = np.uint64((seed * ROUNDS + r + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        if r % 2:
            low = low ^ (scramble(high + key) & np.uint64((1 << low_bits) - 1))
        else:
            high = high ^ (scramble(low + key) & np.uint64((1 << high_bits) - 1))
    return (high << np.uint64(low_bits)) | low


def permuted(rows: np.ndarray, n: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """Place of each row number (``inverse``: row number at each place), all in 0..n-1."""
    order = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    out = np.asarray(rows).astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        out[walking] = _network(out[walking], n, seed, order)
        walking = walking[out[walking] >= np.uint64(n)]
    return out.astype(np.int64)


def row_numbers(rows: DataFrame, order: list[str], scratch: Scratch) -> tuple[DataFrame, int]:
    """``rows`` with ``row_no`` 0..N-1 in the given order of columns, and N.

    Equal rows are counted once and expanded after numbering, so many copies of
    one row are one record in the sort.  The order is total up to equal rows.
    """
    counted = scratch.table(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")), "counted")
    ranged = counted.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = scratch.table(ranged.withColumn("at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("at", 33)
    # one row per partition of the range, so the window below is short
    sums = ranged.groupBy(part.alias("part")).agg(F.sum("copies").alias("of_part"))
    before = F.sum("of_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = scratch.table(sums.select("part", F.coalesce(before, F.lit(0)).alias("offset"), "of_part"), "offsets")
    n = offsets.agg(F.sum("of_part")).first()[0] or 0
    inside = F.sum("copies").over(Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    numbered = ranged.withColumn("part", part).withColumn("inside", inside - F.col("copies")).join(offsets, "part")
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    expanded = numbered.select(*rows.columns, "offset", "inside", copy.alias("copy"))
    return expanded.select(*rows.columns, (F.col("offset") + F.col("inside") + F.col("copy")).alias("row_no")), n


def shard(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *, shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """One row per input row: ``key, size, text_crc32, row_no, shard, slot``.

    ``size`` is the number of UTF-8 bytes of the text and ``ROW_BYTES``; a null
    text counts as empty.  Rows are numbered by key, then checksum and size, null
    keys first; equal rows take neighbouring numbers and land apart.  Only these
    three numbers move, texts stay where they are; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "sharding")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"), (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
    )
    numbered, n = row_numbers(rows, ["key", "text_crc32", "size"], scratch)

    @F.pandas_udf("long")
    def place(row_no: pd.Series) -> pd.Series:
        return pd.Series(permuted(row_no.to_numpy(), n, seed))

    return numbered.withColumn("place", place("row_no")).select(
        F.col("key").alias(key), "size", "text_crc32", "row_no",
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"), F.floor(F.col("place") / shards).cast("long").alias("slot"),
    )
