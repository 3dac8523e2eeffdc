"""Whitening of embeddings by the polarisation of variances.

Method.  Entries become whole numbers.  One pass sums them, a second one adds up
exact squares of centred values: of every dimension and of the sum of every two
dimensions.  As var(a + b) = var(a) + var(b) + 2 cov(a, b), differences of these
variances are all covariances, still in whole numbers; only the assembled matrix
is rounded, once, before its eigenvectors are found.

Values are centred at the whole number nearest to their mean, so squares stay
small; what the mean has beyond it is taken off exactly at the end.  Tasks give
back one number per pair of dimensions, which Spark adds up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.storage import Scratch

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
#: entries of this size or more are an error, smaller ones are exact
LARGEST = 1 << 40
#: eigenvalues below this share of their sum are taken as zero
LEAST_SHARE = 1e-12
#: rows whose squares are added together in 64 bits
BLOCK = 4096

_WHOLE = pa.decimal128(38, 0)


def _matrix(column: pa.ListArray, kind: type) -> np.ndarray:
    return column.flatten().to_numpy().astype(kind, copy=False).reshape(len(column), -1)


def _sums(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each dimension."""
    total = None
    for b in rows:
        for i in range(0, b.num_rows, BLOCK):
            part = _matrix(b.column("x").slice(i, BLOCK), np.int64).sum(axis=0).astype(object)
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array([Decimal(int(t)) for t in total], _WHOLE)], names=["i", "total"]
        )


def squares(z: np.ndarray) -> np.ndarray:
    """At (i, j): the sum of squares of ``z_i + z_j``, and of ``z_i`` at (i, i); exact, as Python numbers, for i <= j."""
    if int(np.abs(z).max(initial=0)) ** 2 * 4 * len(z) >= 1 << 63:
        z = z.astype(object)
    d = z.shape[1]
    out = np.zeros((d, d), z.dtype)
    for i in range(d):
        out[i, i] = (z[:, i] * z[:, i]).sum()
        both = z[:, i : i + 1] + z[:, i + 1 :]
        out[i, i + 1 :] = (both * both).sum(axis=0)
    return out.astype(object)


def _squares(centre: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in rows:
            for i in range(0, b.num_rows, BLOCK):
                part = squares(_matrix(b.column("x").slice(i, BLOCK), np.int64) - centre)
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total))
            values = [Decimal(int(v)) for v in total[i, j]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values, _WHOLE)], names=["i", "j", "total"]
            )

    return run


def covariances(n: int, rest: list[int], total: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariances from sums of squares about a centre and from the sums that are left about it, ``rest``."""
    d = len(rest)
    # n * n * variance, in whole numbers
    one = [n * total[i, i] - rest[i] ** 2 for i in range(d)]
    out = np.zeros((d, d))
    for i in range(d):
        out[i, i] = one[i] / (n * n)
        for j in range(i + 1, d):
            both = n * total[i, j] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - one[i] - one[j]) / (2 * n * n)
    return out


def _project(n: int, centre: np.ndarray, rest: list[int], axes: np.ndarray):
    offset = np.array([r / n for r in rest])
    whole = np.array(rest, object)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            if not b.num_rows:
                continue
            z = _matrix(b.column("x"), np.int64) - centre
            if n * (int(np.abs(z).max()) + 1) < 1 << 28 and z.shape[1] < 128:
                away = n * z - whole.astype(np.int64)
            else:
                away = n * z.astype(object) - whole
            deviation = [Decimal(int(v)) for v in (away * away).sum(axis=1)]
            w = (z - offset) @ axes
            at = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("key"), pa.array(deviation, _WHOLE),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(w.ravel())),
                ],
                names=["key", "deviation", "w"],
            )

    return run


def _products(mean: np.ndarray | None):
    """Sums of ``w`` (at i = -1), or of products of ``w - mean``."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in rows:
            w = _matrix(b.column("w"), np.float64)
            part = w.sum(axis=0)[None, :] if mean is None else (w - mean).T @ (w - mean)
            total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "total"]
            )

    return run


def _summed(table: DataFrame, run, kind: str) -> dict[tuple[int, int], object]:
    added = table.mapInArrow(run, f"i int, j int, total {kind}").groupBy("i", "j").agg(F.sum("total").alias("total"))
    return {(r["i"], r["j"]): r["total"] for r in added.collect()}


def whiten(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", *, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """One row per vector and component: ``key, component, n, deviation, whitened, explained, identity_error``.

    An entry c becomes ``floor(scale * c) + shift``.  ``deviation`` is the sum
    of squares of ``n * x - sum(x)``, a decimal without places, the same on all
    rows of a vector.  ``whitened`` has mean 0 and variance 1, components by
    falling variance; ``identity_error`` is the largest deviation of the
    covariances of all components from the identity.

    Vectors that are null, empty, or hold null or non-finite entries are left
    out.  Vectors of several lengths, and entries of ``LARGEST`` or more, are
    an error.  Components without variance are left out: equal vectors, or one
    alone, give no rows.  Repeated rows count each, null keys too.  Columns not
    named are not read.

    The driver gets one number for each pair of dimensions, whatever the number
    of vectors.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    given = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform("v", lambda c: F.when(
        F.abs(c) < LARGEST, F.floor(scale * c).cast("long") + shift
    ).otherwise(F.raise_error(F.lit("an entry is too large"))))
    whole_rows = scratch.table(given.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite).select("key", whole.alias("x")), "whole")
    n, least, most = whole_rows.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if least != most:
        raise ValueError("vectors of several lengths")
    kind = whole_rows.schema["key"].dataType.simpleString()
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    nothing = spark.createDataFrame(
        [], f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
    if not n:
        return nothing
    added = whole_rows.mapInArrow(_sums, "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").alias("total")).collect()
    sums = [int(r["total"]) for r in sorted(added, key=lambda r: r["i"])]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    at = np.array(centre, np.int64)
    total = {k: int(v) for k, v in _summed(whole_rows, _squares(at), "decimal(38,0)").items()}
    covariance = covariances(n, rest, total)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    trace = float(np.trace(covariance))
    k = int((values[:components] > LEAST_SHARE * trace).sum())
    if not k:
        return nothing
    projected = scratch.table(
        whole_rows.mapInArrow(_project(n, at, rest, axes[:, :k] / np.sqrt(values[:k])), f"key {kind}, deviation decimal(38,0), w array<double>"),
        "projected",
    )
    scratch.drop(whole_rows)
    mean = _summed(projected, _products(None), "double")
    mean = np.array([mean[0, j] / n for j in range(k)])
    product = _summed(projected, _products(mean), "double")
    error = max(abs(product[i, j] / n - (i == j)) for i in range(k) for j in range(k))
    explained = F.array(*(F.lit(float(v / trace)) for v in values[:k]))
    long = projected.select("key", "deviation", F.posexplode("w").alias("at", "whitened"))
    return long.select(
        F.col("key"), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(float(error)).alias("identity_error"),
    ).toDF(*names)
