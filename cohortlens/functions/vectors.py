"""Vector expressions over array columns."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values of the stand-in text encoder ---------------------------------
GRAM = 3
HASH_BASE = 31
PAD = "#"
# --------------------------------------------------------------------------------


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` loops."""
    return F.element_at(F.transform(F.array(value), use), 1)


def norm(vector: Column) -> Column:
    squares = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return F.sqrt(squares)


def unit(vector: Column) -> Column:
    """L2-normalised float vector; a zero vector stays zero."""
    divisor = F.coalesce(F.nullif(norm(vector), F.lit(0.0)), F.lit(1.0))
    return bound(divisor, lambda length: F.transform(vector, lambda x: (x / length).cast("float")))


def confidence(score: Column) -> Column:
    """Inner product of unit vectors as a number in [0, 1]."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (score + 1.0) / 2.0))


def hashed_counts(text: Column, dim: int) -> Column:
    """Character trigrams of the padded lower-case text, counted by bucket and L2-normalised; zeros without a trigram."""

    @F.pandas_udf("array<float>")
    def counts(padded: pd.Series) -> pd.Series:
        codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in padded]
        size = np.array([len(c) for c in codes], np.int64)
        flat = np.concatenate([*codes, np.zeros(0, np.uint32)]).astype(np.int64)
        row = np.repeat(np.arange(len(codes)), size)
        grams = max(0, len(flat) - GRAM + 1)
        whole = row[:grams] == row[GRAM - 1 :]  # not those that run on into the next text
        code = np.zeros(grams, np.int64)
        for k in range(GRAM):
            code = code * HASH_BASE + flat[k : k + grams]
        at = row[:grams][whole] * dim + code[whole] % dim
        out = np.bincount(at, minlength=len(codes) * dim).reshape(-1, dim).astype(float)
        length = np.sqrt((out * out).sum(1))
        return pd.Series(list((out / np.where(length > 0, length, 1.0)[:, None]).astype(np.float32)))

    return counts(F.coalesce(F.concat(F.lit(PAD), F.lower(text), F.lit(PAD)), F.lit("")))
