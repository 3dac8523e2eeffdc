import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohortlens.operators import boosting
from cohortlens.operators import models as md


def _rows(spark, n, parts):
    ids = spark.range(0, n, 1, parts)
    x = F.array((F.hash("id") % 50).cast("double"), (F.col("id") % 7).cast("double"), (F.col("id") % 3 == 0).cast("double"))
    y = ((F.hash("id") % 50 + 8 * (F.col("id") % 7) + F.hash("id", F.lit(1)) % 40) > 45).cast("double")
    return ids.select(array_to_vector(x).alias("features"), y.alias("label"), F.array(F.lit(True), F.col("id") % 4 > 0).alias("member"))


def test_a_table_of_tens_of_thousands_of_rows_needs_no_job_per_level(spark, monkeypatch):
    monkeypatch.setattr(boosting, "_level", lambda *_: (_ for _ in ()).throw(AssertionError("a job per level")))
    made = boosting.boost(_rows(spark, 30_000, 4), 2, trees=3)
    assert all(len(m.losses) == 4 and m.losses[3] < m.losses[0] for m in made)


def test_a_wide_table_does_not_go_to_a_task_per_fit(spark, monkeypatch):
    seen, level = [], boosting._level
    monkeypatch.setattr(boosting, "TASK_BYTES", 10_000)
    monkeypatch.setattr(boosting, "_level", lambda *how: seen.append(1) or level(*how))
    boosting.boost(_rows(spark, 2_000, 4), 2, trees=1)
    assert len(seen) == 5


def test_trees_are_the_same_however_rows_lie_and_are_added_up(spark, monkeypatch):
    monkeypatch.setattr(boosting, "PLAIN_ROWS", 0)
    rows = _rows(spark, 6_000, 5)
    first = boosting.boost(rows, 2, trees=8)
    monkeypatch.setattr(boosting, "MOST_CODES", 1)  # features one by one
    monkeypatch.setattr(boosting, "LEAST_CODES", 1)
    other = boosting.boost(rows.repartition(3), 2, trees=8)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 1_000)
    blocks = boosting.boost(rows.repartition(7), 2, trees=8)
    for a, b, c in zip(first, other, blocks, strict=True):
        for x in (b, c):
            assert np.array_equal(a.feature, x.feature) and np.array_equal(a.cut, x.cut) and np.array_equal(a.value, x.value)


def test_codes_give_the_sums_of_every_feature():
    rng = np.random.default_rng(5)
    sizes = np.array([32, 1, 2, 7, 2, 31, 2])
    bins = np.stack([rng.integers(0, s, 500) for s in sizes], 1).astype(np.uint8)
    node, g, h = rng.integers(0, 4, 500), np.rint(rng.normal(size=500) * 100), np.rint(rng.random(500) * 100)
    starts = np.cumsum(sizes) - sizes
    plan = {"sizes": sizes, "starts": starts, "total": int(sizes.sum()), "bundles": boosting._bundles(sizes, 100_000)}
    assert sorted(sum(plan["bundles"], [])) == list(range(7)) and len(plan["bundles"]) < 4
    got = boosting._added(boosting._codes(bins, plan), node, 4, (g, h), boosting._spread(plan), plan["total"])
    want = np.zeros((4, plan["total"], 2))
    for f in range(7):
        np.add.at(want, (node, starts[f] + bins[:, f]), np.stack([g, h], 1))
    assert np.array_equal(got, want)


def test_a_linear_fit_makes_few_tasks(spark, monkeypatch):
    parts = []
    whole = md.LogisticRegression.fit
    monkeypatch.setattr(md.LogisticRegression, "fit", lambda self, df: parts.append(df.rdd.getNumPartitions()) or whole(self, df))
    rows = _rows(spark, 1_000, 16)
    md.fit_logistic(rows)
    monkeypatch.setattr(md, "LOGISTIC_TASK_ROWS", 300)
    md.fit_logistic(rows)
    assert parts == [1, 4]


def test_few_rows_are_added_up_one_by_one_without_rounding(spark, monkeypatch):
    seen, whole = [], boosting._in_tasks
    monkeypatch.setattr(boosting, "_in_tasks", lambda packed, fits, plan: seen.append(plan) or whole(packed, fits, plan))
    boosting.boost(_rows(spark, 2_000, 4), 2, trees=1)
    assert seen[0]["units"] == [None, None] and seen[0]["bundles"] == [[0], [1], [2]]
    margin, y = np.array([0.1, -0.3]), np.array([0.0, 1.0])
    p = 1 / (1 + np.exp(-margin))
    assert np.array_equal(boosting._slopes(margin, y, np.ones(2), None)[0], p - y)
