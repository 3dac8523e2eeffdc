from pyspark.sql import functions as F

from cohortlens.functions import bits


def test_members_pass_and_most_others_do_not(spark):
    rows = spark.range(20_000).select("id", F.xxhash64("id").alias("h"))
    chosen = rows.where("id % 40 = 7")
    table, size = bits.bit_table(chosen, F.col("h"))
    out = bits.marked(rows, F.col("h"), table, size, "maybe")
    assert out.columns == ["id", "h", "maybe"] and out.count() == 20_000
    assert out.where("id % 40 = 7 and maybe").count() == 500
    assert out.where("id % 40 <> 7 and maybe").count() < 20_000 * 0.1
    assert table.count() <= size / 64


def test_full_and_empty_sets(spark):
    rows = spark.range(100).select("id", F.xxhash64("id").alias("h"))
    table, size = bits.bit_table(rows, F.col("h"), count=1)  # too few bits: more pass, none is lost
    assert bits.marked(rows, F.col("h"), table, size, "maybe").where("maybe").count() == 100
    table, size = bits.bit_table(rows.limit(0), F.col("h"))
    assert bits.marked(rows, F.col("h"), table, size, "maybe").where("maybe").count() == 0
    assert bits.marked(rows.withColumn("h", F.lit(None).cast("long")), F.col("h"), table, size, "m").count() == 100
