import os

from cohortlens.functions.storage import Scratch, new_folder, passing_tables, shared_dir, staged


def test_passing_tables_go_and_others_stay(spark):
    kept = staged(spark.range(3), "kept")
    with passing_tables(spark, "batch"):
        inside = new_folder(spark, "inside")
        spark.range(2).write.parquet(inside)
        assert os.path.isdir(inside)
    assert not os.path.exists(inside) and kept.count() == 3
    assert new_folder(spark, "x").startswith(f"{shared_dir(spark)}/x-")


def test_scratch_tables_can_be_dropped(spark):
    with Scratch(spark, "scratch") as scratch:
        first, second = scratch.table(spark.range(3), "a"), scratch.table(spark.range(4), "b")
        scratch.drop(first)
        assert second.count() == 4 and len(os.listdir(scratch.folder)) == 1
    assert not os.path.exists(scratch.folder)
