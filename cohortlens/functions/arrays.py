"""Array expressions that stay linear on long arrays.

Nested lambdas are written as SQL text: one expression, one call into the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def running_start(column: str, chunk: int = 64) -> Column:
    """Sum of the elements before each element of an integer array column.

    Appending inside one fold copies the array at every step.  The fold is
    therefore done per chunk, and once over the chunk totals.
    """

    def starts(xs: str, base: str) -> str:
        grown = f"aggregate({xs}, array({base}), (acc, x) -> array_append(acc, element_at(acc, -1) + x))"
        return f"slice({grown}, 1, size({xs}))"

    chunks = f"transform(sequence(1, size({column}), {chunk}), i -> slice({column}, i, {chunk}))"
    totals = f"transform({chunks}, c -> aggregate(c, 0L, (acc, x) -> acc + x))"
    long = f"flatten(transform(arrays_zip({chunks}, {starts(totals, '0L')}), z -> {starts('z.`0`', 'z.`1`')}))"
    return F.expr(
        f"case when size({column}) <= 0 then cast(array() as array<bigint>)"
        f" when size({column}) <= {chunk} then {starts(column, '0L')} else {long} end"
    )
