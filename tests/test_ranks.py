import random

import pytest

from cohortlens.functions.layout import fill_cores
from cohortlens.operators import features as ft
from cohortlens.operators.ranks import running_totals
from cohortlens.operators.validate import valid_rows  # noqa: F401  the module must load alone


def test_rows_with_a_null_label_stay(spark):
    rows = [(f"p{i}", None if i % 10 == 0 else i % 2 == 0) for i in range(100)]
    df = spark.createDataFrame(rows, "patient_id string, label boolean")
    assert ft.stratified_split(df, "label").count() == 100
    folds = ft.stratified_folds(df, "label", 5).where("label is null").groupBy("fold").count().collect()
    assert [r["count"] for r in folds] == [2] * 5


def test_a_null_group_has_running_totals(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 7), ("a", 1, 1)], "g string, x int, n int")
    got = {(r.g, r.x): (r.n_before, r.n_total) for r in running_totals(df, ["g"], "x", ["n"]).collect()}
    assert got == {(None, 1): (0, 12), (None, 2): (5, 12), ("a", 1): (0, 1)}


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_ranges_follow_the_number_of_rows(spark, monkeypatch, groups):
    """No task orders more rows than the bound, however many there are."""
    from cohortlens.operators import ranks

    monkeypatch.setattr(ranks, "RANGES", 4)
    monkeypatch.setattr(ranks, "ROWS_PER_TASK", 40)
    sizes, largest = [], ranks._largest
    monkeypatch.setattr(ranks, "_largest", lambda rows, by: sizes.append(largest(rows, by)) or sizes[-1])
    rng = random.Random(1)
    rows = [(g, x, rng.randrange(9), rng.randrange(9)) for g in ("a", None) for x in rng.sample(range(5000), 900)]
    rows = rows if groups else [r for r in rows if r[0] == "a"]
    df = spark.createDataFrame(rows, "g string, x int, n int, m int")
    got = {(r.g, r.x): (r.n_before, r.m_before, r.n_total, r.m_total) for r in running_totals(df, groups, "x", ["n", "m"]).collect()}
    assert len(got) == len(rows)
    for g in {r[0] for r in rows}:
        n = m = 0
        own = sorted(r for r in rows if r[0] == g)
        total = sum(r[2] for r in own), sum(r[3] for r in own)
        for _, x, a, b in own:
            assert got[g, x] == (n, m, *total)
            n, m = n + a, m + b
    assert max(sizes) == 900 and sizes[-2 if sizes[-1] > 40 else -1] <= 40 and min(sizes) <= 40


def test_too_many_categories_are_an_error(spark):
    df = spark.range(ft.MAX_CATEGORIES + 1).selectExpr("cast(id as string) as c")
    with pytest.raises(ValueError):
        ft.fit_categories(df, ["c"])


def test_split_size_may_have_a_unit(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    try:
        assert fill_cores(spark.range(10)).count() == 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
