import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import evaluation as ev
from cohortlens.operators import features as ft
from cohortlens.operators.ranks import stratified_rank


def scored_df(spark, y, p, **groups):
    names = list(groups)
    rows = [(int(a), float(b), *(groups[g][i] for g in names)) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "y int, p double" + "".join(f", {g} string" for g in names))


def pair_auroc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return float((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())


def step_ap(y, p):
    out, tp, fp = 0.0, 0, 0
    for s in sorted(set(p), reverse=True):
        here = p == s
        tp, fp = tp + int(y[here].sum()), fp + int((1 - y[here]).sum())
        out += y[here].sum() / y.sum() * tp / (tp + fp)
    return float(out)


@pytest.mark.parametrize("digits", [1, 2, 9])
def test_ranking_metrics(spark, digits):
    rng = np.random.default_rng(digits)
    y = rng.integers(0, 2, 700)
    p = np.round(np.clip(rng.normal(0.4 + 0.1 * y, 0.2), 0, 1), digits)
    r = ev.ranking_metrics(scored_df(spark, y, p)).first()
    assert (r.n, r.n_pos) == (700, int(y.sum()))
    assert r.auroc == pytest.approx(pair_auroc(y, p)) and r.auprc == pytest.approx(step_ap(y, p))
    assert r.brier == pytest.approx(float(((p - y) ** 2).mean()))


def test_one_score_for_a_third_of_all_rows(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 900)
    p = np.where(np.arange(900) % 3 == 0, 0.5, rng.random(900))
    assert ev.auroc(scored_df(spark, y, p)).first()[0] == pytest.approx(pair_auroc(y, p))


def test_one_class_has_no_auroc(spark):
    r = ev.ranking_metrics(scored_df(spark, [1, 1, 1], [0.1, 0.2, 0.3])).first()
    assert r.auroc is None and r.auprc == 1.0
    assert ev.ranking_metrics(scored_df(spark, [0, 0], [0.1, 0.2])).first().auprc is None


def test_subgroups_skip_thin_ones(spark):
    y = [1, 1, 0] * 4 + [1] + [0] * 9 + [1] * 10 + [1, 1] + [0] * 7
    p = list(np.linspace(0, 1, len(y)))
    g = ["ok"] * 12 + ["one"] * 10 + ["all"] * 10 + ["few"] * 9
    got = ev.subgroup_table(scored_df(spark, y, p, stage=g), dimensions=["stage"]).collect()
    assert [(r.group, r.n, r.n_pos) for r in got] == [("ok", 12, 8)]


def test_age_bands(spark):
    ages = [0, 1, 50, 51, 65, 66, 75, 76, 200, 201, None]
    got = spark.createDataFrame([(a,) for a in ages], "a int").select(ev.age_group(F.col("a"))).collect()
    assert [r[0] for r in got] == ["nan", "<50", "<50", "50-65", "50-65", "65-75", "65-75", ">75", ">75", "nan", "nan"]


def test_calibration_edges_close_on_the_right(spark):
    got = ev.calibration_curve(scored_df(spark, [0, 1, 1, 0], [0.0, 0.1, 0.11, 1.0])).orderBy("bin").collect()
    assert [(r.bin, r.n, r.fraction_positive) for r in got] == [(0, 2, 0.5), (1, 1, 1.0), (9, 1, 0.0)]


def test_thresholds(spark):
    y, p = np.array([1, 0, 1, 0, 1]), np.array([0.9, 0.5, 0.5, 0.2, 0.05])
    table = ev.threshold_table(scored_df(spark, y, p), thresholds=[0.5, 0.95, 0.1]).orderBy("threshold").collect()
    assert [(r.threshold, r.precision, r.recall, r.f1, r.specificity, r.n_alerted, r.false_negatives) for r in table] == [
        (0.1, 0.5, 0.6667, 0.5714, 0.0, 4, 1), (0.5, 0.6667, 0.6667, 0.6667, 0.5, 3, 1), (0.95, 0.0, 0.0, 0.0, 1.0, 0, 3),
    ]
    full = ev.threshold_table(scored_df(spark, y, p))
    assert full.count() == 17 and ev.best_threshold(full).first().threshold == 0.25


def test_extraction_with_a_failed_case(spark):
    cases = spark.createDataFrame([(0, "ok"), (1, "ok"), (2, "failed")], "case_id int, status string")
    expected = spark.createDataFrame(
        [(0, "Fever", "H1", False), (0, "fever", "H1", True), (0, "rash", "H2", True), (1, "pain", "H3", True), (2, "x", "H4", False), (2, "x", "H4", True)],
        "case_id int, text string, hpo_id string, negated boolean",
    )
    predicted = spark.createDataFrame(
        [(0, "fever", 0, True), (0, "FEVER", 9, False), (0, "cough", 5, False), (1, "pain", 3, False)],
        "case_id int, text string, start int, negated boolean",
    )
    candidates = spark.createDataFrame(
        [("FEVER", 1, "H9"), ("FEVER", 2, "H1"), ("pain", 1, "H3")], "mention_text string, rank int, hpo_id string"
    )
    r = ev.evaluate_extraction(cases, expected, predicted, candidates).first()
    # texts: fever and pain found of fever, rash, pain and two of the failed case; cough is extra
    assert (r.extraction_precision, r.extraction_recall, r.total_cases) == (0.6667, 0.4, 3)
    assert (r.top1_accuracy, r.top3_accuracy) == (0.3333, 1.0)
    assert r.negation_fp_rate == 0.3333  # fever's first prediction is negated, rash has none, pain is not
    gate = ev.regression_gate(ev.evaluate_extraction(cases, expected, predicted, candidates)).first()
    assert gate.passed is False


def test_ranks_are_dense_and_the_same_on_any_layout(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("patient_id"), (F.col("id") % 3 == 0).alias("y"))
    a = {r.patient_id: r.stratum_rank for r in stratified_rank(rows.repartition(1), ["y"], "patient_id", 1).collect()}
    b = stratified_rank(rows.repartition(13), ["y"], "patient_id", 1).collect()
    assert {r.patient_id: r.stratum_rank for r in b} == a
    for flag in (True, False):
        ranks = sorted(r.stratum_rank for r in b if r.y is flag)
        assert ranks == list(range(1, len(ranks) + 1)) and {r.stratum_size for r in b if r.y is flag} == {len(ranks)}


def test_split_and_folds_keep_shares(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("patient_id"), (F.col("id") % 4 == 0).alias("y"))
    split = {(r.y, r.split): r["count"] for r in ft.stratified_split(rows, "y").groupBy("y", "split").count().collect()}
    assert split == {(True, "test"): 50, (True, "train"): 200, (False, "test"): 150, (False, "train"): 600}
    assert {r["count"] for r in ft.stratified_folds(rows, "y", 5).groupBy("y", "fold").count().collect()} == {50, 150}


def test_one_pass_gives_what_the_single_metrics_give(spark):
    import random

    draw = random.Random(3)
    cases = [(c, "failed" if c % 5 == 4 else "ok") for c in range(12)]
    words = [f"w{i}" for i in range(6)]
    found = {(draw.randrange(12), draw.randrange(300)) for _ in range(120)}
    surface = lambda w: w.upper() if draw.random() < 0.4 else w
    mapped = [(c, surface(draw.choice(words)), s, draw.random() < 0.4) for c, s in sorted(found) if c % 5 != 4]
    ids = {t: draw.sample(range(8), draw.randrange(5)) for t in {m[1] for m in mapped}}
    asked = [(draw.randrange(12), surface(draw.choice(words)), f"C{draw.randrange(8)}", draw.random() < 0.5) for _ in range(80)]
    cases_df = spark.createDataFrame(cases, "case_id int, status string")
    expected = spark.createDataFrame(asked + asked[:9], "case_id int, text string, hpo_id string, negated boolean")
    predicted = spark.createDataFrame(mapped, "case_id int, text string, start int, negated boolean")
    candidates = spark.createDataFrame(
        [(t, r + 1, f"C{i}", "", 0.5) for t, own in ids.items() for r, i in enumerate(own)],
        "mention_text string, rank int, hpo_id string, hpo_label string, confidence double",
    )
    listed = candidates.groupBy("mention_text").agg(
        F.array_sort(F.collect_list(F.struct("rank", "hpo_id", "hpo_label", "confidence"))).alias("candidates")
    )
    both = predicted.join(listed.withColumnRenamed("mention_text", "text"), "text", "left")
    got = ev.evaluate_mapped(cases_df, expected, both).first().asDict()
    want = {}
    for part in (
        ev.extraction_prf(cases_df, expected, predicted), ev.mapping_topk(cases_df, expected, predicted, candidates),
        ev.negation_fp(cases_df, expected, predicted),
    ):
        want |= part.first().asDict()
    assert got == want | {"total_cases": 12} and 0 < got["top1_correct"] < got["top3_correct"]
    nothing = ev.evaluate_mapped(cases_df.limit(0), expected.limit(0), both.limit(0)).first()
    assert (nothing.expected, nothing.extraction_f1, nothing.total_cases) == (0, 0.0, 0)


def test_report_counts_scores_once(spark, monkeypatch):
    """All sections come from one table of counts and agree with the tables made apart."""
    rng = random.Random(9)
    rows = [
        (rng.randrange(2), rng.randrange(100) / 100, rng.choice(["F", "M", None]), rng.choice("xy"), "II", rng.choice(["<50", "50-65"]))
        for _ in range(400)
    ]
    scored = spark.createDataFrame(rows, "y int, p double, sex string, cancer_type string, stage string, age_group string")
    counted = []
    monkeypatch.setattr(ev, "staged", lambda df, name, write=ev.staged: counted.append(name) or write(df, name))
    got = {(r.section, r.item, r.metric): r.value for r in ev.model_report(scored, "m").collect()}
    assert counted == ["score-counts", "thresholds"]
    for metric, value in ev.metric_summary(scored).first().asDict().items():
        assert got["metrics", "all", metric] == value
    groups = ev.subgroup_table(scored).collect()
    for r in groups:
        for metric in ("n", "n_pos", "ae_rate", "auroc", "auprc", "brier"):
            assert got["subgroup_analysis", "=".join(v for v in (r["dimension"], r["group"]) if v is not None), metric] == r[metric]
    assert len([k for k in got if k[0] == "subgroup_analysis"]) == 6 * len(groups)
    for r in ev.threshold_table(scored).collect():
        assert got["threshold_analysis", f"{r.threshold:.2f}", "f1"] == r.f1
    assert ev.model_report(scored.limit(0), "m").count() == 0
