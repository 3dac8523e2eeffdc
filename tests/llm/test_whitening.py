"""Whitened components against covariances made entry by entry in exact fractions."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows):
    """Whole numbers, deviations and covariances of (key, vector) rows."""
    kept = [(k, v) for k, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in kept]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    mean = [Fraction(s, n) for s in sums]
    deviation = [sum((n * r[i] - sums[i]) ** 2 for i in range(d)) for r in x]
    cov = [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n for j in range(d)] for i in range(d)]
    centred = np.array([[float(r[i] - mean[i]) for i in range(d)] for r in x])
    return [k for k, _ in kept], n, deviation, np.array([[float(c) for c in r] for r in cov]), centred


def compare(got, rows, components):
    keys, n, deviation, cov, centred = brute(rows)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    want = centred @ axes / np.sqrt(values)
    assert len(got) == len(keys) * len(values)
    assert {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, len(values) + 1))
    assert sorted((str(r.vec_id), int(r.deviation)) for r in got if r.component == 1) == sorted(
        (str(k), v) for k, v in zip(keys, deviation, strict=True)
    )
    for c in range(len(values)):
        mine = sorted(((str(r.vec_id), int(r.deviation), r.whitened) for r in got if r.component == c + 1), key=lambda t: t[:2])
        own = sorted(((str(k), v, w) for k, v, w in zip(keys, deviation, want[:, c], strict=True)), key=lambda t: t[:2])
        mine, own = np.array([m[2] for m in mine]), np.array([w[2] for w in own])
        assert np.abs(mine - own * np.sign(mine @ own)).max() < 1e-8
        share = next(r.explained for r in got if r.component == c + 1)
        assert share == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-8


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    mix = rng.normal(size=(5, 5))
    rows = [(i, [float(c) for c in np.float32(rng.normal(size=5) @ mix + 3)]) for i in range(300)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (400, None), (401, []), (402, [1.0, None, 1.0, 1.0, 1.0]), (403, [float("nan")] * 5), (404, [1.0, 2.0, float("inf"), 1.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"key": F.lit("x"), "n": F.lit(1), "w": F.lit(2), "x": F.lit(3), "component": F.lit(4)})
    compare(whitening.whiten(df, components=3).collect(), rows, 3)


def test_sums_beyond_64_bits():
    z = np.array([[1 << 40, -3], [5, 1 << 40]])
    out = whitening.squares(z)
    assert out[0, 0] == (1 << 80) + 25 and out[0, 1] == ((1 << 40) - 3) ** 2 + ((1 << 40) + 5) ** 2
    small = np.arange(12).reshape(4, 3)
    assert whitening.squares(small)[0, 2] == sum((a + b) ** 2 for a, b in zip(small[:, 0], small[:, 2], strict=True))


def test_large_entries_and_no_variance(spark):
    big = [(i, [float(i * (1 << 30)), float(i % 3)]) for i in range(20)]
    got = whitening.whiten(spark.createDataFrame(big, SCHEMA), components=1).collect()
    keys, n, deviation, _, _ = brute(big)
    assert sorted((r.vec_id, int(r.deviation)) for r in got) == list(zip(keys, deviation, strict=True))
    flat = spark.createDataFrame([(1, [2.0, 2.0]), (2, [2.0, 2.0])], SCHEMA)
    assert whitening.whiten(flat).collect() == [] and whitening.whiten(flat.limit(0)).columns[0] == "vec_id"
    assert whitening.whiten(flat.limit(0)).collect() == []
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [2.0, 2.0]), (2, [2.0])], SCHEMA))


def test_query(spark):
    from cohortlens.llm import queries

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    compare(queries.op12_whitening(spark, "/root/testdata/sf0.001").collect(), rows, 32)
