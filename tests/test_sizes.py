"""What goes through exchanges and folders for notes, texts and spans."""

import os
import random

import numpy as np
from pyspark.sql import functions as F

from cohortlens.operators import mapping as mp
from cohortlens.operators import negation as ng
from cohortlens.plans import queries


def exchanged(spark, df):
    """Rows, and the records and bytes written for their exchanges."""

    def written():
        context = spark.sparkContext
        context._jsc.sc().listenerBus().waitUntilEmpty()
        none = context._gateway.new_array(context._jvm.double, 0)
        stages = context._jsc.sc().statusStore().stageList(None, False, False, none, None)
        every = [stages.apply(i) for i in range(stages.size())]
        return np.array([sum(s.shuffleWriteRecords() for s in every), sum(s.shuffleWriteBytes() for s in every)])

    before = written()
    rows = df.collect()
    return rows, *(written() - before)


def test_tokens_are_counted_without_an_exchange_of_tokens(spark, tmp_path):
    docs = [(i % 9, " ".join(f"w{i}x{j % 400}" for j in range(1000))) for i in range(10)] + [(None, "a a b"), (20, None), (21, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows, records, _ = exchanged(spark, queries.tokenize_docs(spark, str(tmp_path)))
    found = {r.doc_id: (r.n_tokens, r.n_distinct) for r in rows}
    assert found[0] == (2000, 800) and found[1] == (1000, 400) and found[None] == (3, 2) and set(found) == {None, *range(9)}
    assert records <= len(docs)


def test_pieces_are_exchanged_as_text(spark):
    rng = random.Random(5)
    texts = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(4000)) + ".") for i in range(20)]
    spans = [(i, at, at + 9) for i in range(20) for at in range(0, len(texts[i][1]), 1000)]
    notes = spark.createDataFrame(texts, "id int, t string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found, _, size = exchanged(spark, ng.align_spans(notes, spark.createDataFrame(spans, "id int, start int, end int"), ["id"], "t"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert len(found) == len(spans) and all(r.n_tokens for r in found)
    assert size < 1.5 * sum(len(t) for _, t in texts)


def test_every_note_is_a_file_in_one_folder(spark, tmp_path, monkeypatch):
    people = [(k, 100.25 * k, "BUILDING", k % 5) for k in [*range(1, 60), 7]]
    spark.createDataFrame(people, "c_custkey long, c_acctbal double, c_mktsegment string, c_nationkey long").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    monkeypatch.setattr(queries, "new_folder", lambda _, name: str(tmp_path / name))
    rows = queries.read_notes(spark, str(tmp_path)).collect()
    assert len(rows) == 58 and all(r.named for r in rows)  # one is null, and one id has two notes
    note = queries.d.notes(spark, str(tmp_path)).where("patient_id = 'PT000007'").first().clinical_note
    assert f"{note}\n{note}\n" in [r.text for r in rows]
    assert not [f for f in os.scandir(tmp_path / "notes") if f.is_dir()]


def test_hashed_vectors_by_hand(spark, tmp_path):
    texts = ["Aab aab", "", None, "x", "\U0001f600 É aab", "aaaaaaa"]
    rows = mp.hashed_vectors(spark.createDataFrame(list(enumerate(texts)), "n int, text string").coalesce(1)).orderBy("n").collect()
    for r, text in zip(rows, texts):
        padded = [*map(ord, f"#{(text or '').lower()}#")]
        counts = np.zeros(64)
        for a, b, c in zip(padded, padded[1:], padded[2:]):
            counts[((a * 31 + b) * 31 + c) % 64] += 1
        length = np.sqrt((counts**2).sum()) or 1.0
        assert r.embedding == (counts / length).astype(np.float32).tolist()
    spark.createDataFrame([(1, "some part")], "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    found = queries.hashed_vectors(spark, str(tmp_path))
    # a small file goes to every core, and buckets are not counted by one search of the text each
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" in plan and "array_remove" not in plan and found.where(F.col("x") <= 0).count() == 0
