"""Where rows and matrices lie while they are worked on."""

import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from cohortlens.functions import layout
from cohortlens.operators import mapping as mp
from cohortlens.operators import negation as ng
from cohortlens.operators import text as tx
from cohortlens.streaming import micro_batches


def test_a_batch_of_one_file_is_spread_over_the_cores(spark, tmp_path):
    rows = spark.range(200).coalesce(1)
    rows.write.parquet(str(tmp_path / "in"))
    seen = []

    def outputs(batch):
        seen.append(batch.rdd.getNumPartitions())
        return {"rows": batch}

    arriving = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    micro_batches.run_stream(arriving, outputs, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert seen == [spark.sparkContext.defaultParallelism]
    assert spark.read.parquet(str(tmp_path / "out/rows")).count() == 200


def test_tasks_follow_the_size_of_the_texts(spark, tmp_path, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    spark.range(300).select(F.col("id").alias("n"), F.lit("no pain , fever").alias("text")).write.parquet(str(tmp_path / "notes"))
    notes = spark.read.parquet(str(tmp_path / "notes"))
    lexicon = tx.phrase_table(spark, {"all": ["pain", "fever"]}, tx.MENTION_KIND)

    def found():
        return ng.negated_mentions(notes, lexicon, ng.cue_table(spark), ["n"], "text")

    small = {tuple(r) for r in found().collect()}
    size = layout._estimated_bytes(notes)
    monkeypatch.setattr(layout, "TASK_BYTES", -(-size // (3 * cores)))
    tasks = -(-size // layout.TASK_BYTES)
    assert tasks > cores and found().rdd.getNumPartitions() == tasks
    assert {tuple(r) for r in found().collect()} == small and len(small) == 600


def test_every_distinct_text_is_encoded_once(spark):
    notes = spark.createDataFrame([(i, "Fever and pain .") for i in range(60)], "n long, text string")
    concepts = spark.createDataFrame([(0, "C:0", "fever", [1.0, 0.0]), (1, "C:1", "pain", [0.0, 1.0])], "vector_idx long, hpo_id string, text string, embedding array<float>")
    made = spark.sparkContext.accumulator(0)

    def of(text):
        made.add(1)
        return [float(text.lower() == "fever"), float(text.lower() == "pain")]

    def encoder(texts):
        return texts.withColumn("embedding", F.udf(of, "array<float>")("text"))

    got = mp.enrich_notes(notes, concepts, ["n"], "text", top_k=1, encoder=encoder).collect()
    assert sorted((r.n, r.hpo_id) for r in got) == [(i, c) for i in range(60) for c in ("C:0", "C:1")]
    assert made.value <= 12  # two texts, some steps of one run


def test_scores_of_a_task_take_little_room():
    rng = np.random.default_rng(0)
    queries, concepts = rng.standard_normal((3000, 8)), rng.standard_normal((4000, 8))
    tracemalloc.start()
    places = sum(len(rows) for rows, _, _ in mp._top(queries, concepts, np.arange(4000), 9))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert places == 27_000 and peak < 48 << 20
    assert mp.BROADCAST_MATRIX_BYTES <= 64 << 20  # of which every worker of an executor holds one
