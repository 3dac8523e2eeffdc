import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import mapping as mp
from cohortlens.operators.negation import cue_table

CONCEPTS = "vector_idx bigint, hpo_id string, text string, embedding array<float>"


def random_tables(spark, n=300, q=50, dim=16, labels=12, seed=5):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    v[n // 2 :] = v[: n - n // 2]  # every vector twice, so there are ties
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    w = rng.normal(size=(q, dim))
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    concepts = spark.createDataFrame([(i, f"HP:{i % labels}", f"t{i}", v[i].tolist()) for i in range(n)], CONCEPTS)
    queries = spark.createDataFrame([(f"q{i}", w[i].tolist()) for i in range(q)], "mention_text string, embedding array<float>")
    return v.astype(np.float32).astype(float), w.astype(np.float32).astype(float), concepts, queries


def brute(v, w, labels, k):
    out = {}
    for i, x in enumerate(w):
        score = np.round(v @ x, 9)
        hits = sorted(range(len(v)), key=lambda j: (-score[j], j))[: 3 * k]
        best = {}
        for j in hits:
            best.setdefault(f"HP:{j % labels}", j)
        out[f"q{i}"] = [(f"t{j}", h) for h, j in best.items()][:k]
    return out


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0, "block": 64}])
@pytest.mark.parametrize("top_k", [1, 10])
def test_candidates_match_brute_force(spark, limits, top_k):
    v, w, concepts, queries = random_tables(spark)
    got = {}
    for r in mp.find_candidates(queries, concepts, top_k, **limits).orderBy("mention_text", "rank").collect():
        assert 0.0 <= r.confidence <= 1.0
        got.setdefault(r.mention_text, []).append((r.hpo_label, r.hpo_id))
    assert got == brute(v, w, 12, top_k)


def test_bad_vectors_and_empty_index(spark):
    _, _, concepts, queries = random_tables(spark, n=10, q=2)
    odd = queries.unionByName(
        spark.createDataFrame([("none", None), ("short", [1.0]), ("hole", [None] * 16)], queries.schema)
    )
    assert {r.mention_text for r in mp.find_candidates(odd, concepts, 2).collect()} == {"q0", "q1"}
    assert mp.find_candidates(queries, concepts.limit(0), 3).count() == 0
    mentions = spark.createDataFrame([(1, "none", 0, 4, False)], "note int, text string, start int, end int, negated boolean")
    row = mp.map_mentions(mentions, mp.find_candidates(odd, concepts, 2), ["note"]).first()
    assert (row.hpo_id, row.hpo_label, row.confidence) == ("", "", 0.0)


def test_top_k_range(spark):
    _, _, concepts, queries = random_tables(spark, n=4, q=1)
    for k in (0, 11):
        with pytest.raises(ValueError):
            mp.nearest(queries, concepts, k)


def test_unit_vectors(spark):
    rows = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "embedding array<float>")
    assert [[round(x, 6) for x in r.embedding] for r in mp.normalize_vectors(rows).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_bands(spark):
    rows = spark.createDataFrame([(0.9,), (0.89,), (0.7,), (0.69,)], "c double")
    assert [r[0] for r in rows.select(mp.confidence_band(F.col("c"))).collect()] == ["high", "moderate", "moderate", "low"]


def test_hot_text_is_spread(spark):
    mentions = spark.range(1000).select(
        F.col("id").alias("note"), F.lit("pain").alias("text"), F.lit(0).alias("start"), F.lit(4).alias("end"), F.lit(False).alias("negated")
    )
    candidates = spark.createDataFrame([("pain", 1, "HP:1", "Pain", 0.9)], "mention_text string, rank int, hpo_id string, hpo_label string, confidence double")
    mapped = mp.map_mentions(mentions, candidates, ["note"])
    assert mapped.where("hpo_id = 'HP:1'").count() == 1000


def test_notes_to_concepts(spark):
    concepts = spark.createDataFrame(
        [(0, "HP:1", "Seizure"), (1, "HP:1", "seizures"), (2, "HP:2", "Hypotonia"), (3, "HP:3", "Hearing loss")],
        "vector_idx bigint, hpo_id string, text string",
    )
    notes = spark.createDataFrame([(1, "Seizures and hypotonia. No hearing loss."), (2, "well"), (3, None)], "id int, t string")
    found = mp.enrich_notes(notes, concepts, ["id"], "t")
    assert sorted((r.id, r.text, r.hpo_id, r.negated, len(r.candidates)) for r in found.collect()) == [
        (1, "Seizures", "HP:1", False, 3), (1, "hearing loss", "HP:3", True, 3), (1, "hypotonia", "HP:2", False, 3),
    ]
    digest = {r.id: r.digest for r in mp.term_digest(notes, found, ["id"]).collect()}
    assert digest[1] == "- seizures (HP:1)\n- Hypotonia (HP:2)"
    assert digest[2] == digest[3] == f"{mp.NO_FINDINGS} {mp.DIGEST_DISCLAIMER}"


def test_a_concept_of_another_length_is_an_error(spark):
    concepts = spark.createDataFrame([(0, "A", "a", [1.0, 0.0]), (1, "B", "b", [1.0, 0.0, 0.0])], CONCEPTS)
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "mention_text string, embedding array<float>")
    with pytest.raises(ValueError):
        mp.nearest(queries, concepts)


def test_concepts_with_nan_take_no_place(spark):
    rows = [(0, "A", "a", [1.0, 0.0]), (1, "B", "b", [float("nan"), 0.0]), (2, "C", "c", [0.0, 1.0])]
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "mention_text string, embedding array<float>")
    got = mp.nearest(queries, spark.createDataFrame(rows, CONCEPTS), top_k=1).collect()
    assert {r.hpo_id for r in got} == {"A", "C"}


def test_texts_stay_where_they_are(spark, monkeypatch):
    """With many concept blocks no row of the texts, and no hit, goes through an exchange."""
    rng = np.random.default_rng(5)
    concepts = [(i, f"C{i % 40}", f"t{i}", [float(x) for x in rng.integers(-3, 4, 8)]) for i in range(500)]
    queries = [(f"q{i}", [float(x) for x in rng.integers(-3, 4, 8)]) for i in range(60)]
    concepts = spark.createDataFrame(concepts, "vector_idx bigint, hpo_id string, text string, embedding array<float>")
    queries = spark.createDataFrame(queries, "mention_text string, embedding array<float>")
    plans = []
    table = mp.Scratch.table
    monkeypatch.setattr(mp.Scratch, "table", lambda self, df, name: plans.append(df._jdf.queryExecution().toString()) or table(self, df, name))
    once = mp.nearest(queries, concepts, 2)
    blocks = mp.nearest(queries, concepts, 2, broadcast_bytes=0, block=37)
    rows = lambda df: sorted(map(tuple, df.select("mention_text", "vector_idx", "hpo_id", "hpo_label", "score").collect()))
    assert rows(blocks) == rows(once) and len(rows(blocks)) == 60 * 6
    assert len(plans) > 10 and not any("Exchange" in p for p in plans)
