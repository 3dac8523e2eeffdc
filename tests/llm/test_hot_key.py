"""A third of all rows under one key, and none: distinct texts are nodes of their own."""

import random

import pytest
from pyspark.sql import functions as F

from cohortlens.llm.near_duplicates import near_duplicates


@pytest.mark.parametrize("hot", [3, None])
def test_many_texts_of_one_key(spark, hot):
    rng = random.Random(6)
    rows, least = [], {}
    for i in range(1000):
        words = [f"w{rng.randrange(50_000)}" for _ in range(120)]
        other = [*words]
        other[60] = "changed"
        rows += [(hot, " ".join(words)), (10_000 + i, " ".join(other))]
        if i % 100 == 0:
            rows += [(hot, " ".join(words))] * 3
        least[" ".join(words)] = least[" ".join(other)] = hot if hot is not None else 10_000 + i
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = F.struct("doc_id", F.xxhash64("text").alias("t"))
    named = docs.withColumn("k", key)
    got = near_duplicates(docs)
    assert got.count() == len(rows)
    assert {r.component_id for r in got.collect()} == set(least.values())
    pairs = near_duplicates(named, key="k").groupBy("component_id").agg(F.countDistinct("k.t").alias("n"))
    assert [r.n for r in pairs.select("n").distinct().collect()] == [2]


def test_pipeline_takes_other_columns_and_rows_of_no_file(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(150)), "en", "s", 1) for i in range(130)]
    rows += [(None, "%%% $$$ " * 100, "en", "s", 1), (7, *rows[7][1:]), (7, rows[7][1] + " end", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    odd = {c: F.lit(1) for c in ("_at", "original", "kept", "seq", "node", "label", "key", "n", "_maybe_not")}
    docs.withColumns(odd).write.parquet(str(tmp_path / "d"))
    for given in (docs.withColumns(odd), spark.read.parquet(str(tmp_path / "d"))):
        kept = cp.reject_outliers(spark, given, "")
        assert kept.columns == given.columns and kept.count() == len(rows) - 1
        assert cp.drop_near_duplicates(spark, kept, "").count() == 130
    nothing = docs.limit(0)
    assert cp.drop_near_duplicates(spark, cp.reject_outliers(spark, nothing, ""), "").count() == 0
