import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohortlens.operators import evaluation as ev
from cohortlens.operators import features as ft
from cohortlens.operators.boosting import bin_cuts, boost
from cohortlens.operators import models as md
from cohortlens.operators import scoring as sc
from cohortlens.plans import derived as d

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    out = ft.stratified_split(d.patients(spark, SF), "adverse_event")
    return out.where("split = 'train'").drop("split"), out.where("split = 'test'").drop("split")


@pytest.fixture(scope="module")
def trained(rows):
    return md.train_models(rows[0], fits={md.LOGISTIC: md.fit_logistic, md.BOOSTED: lambda t: md.fit_boosted(t, trees=2)})


def test_features_fill_and_flags_once(spark):
    patients = d.patients(spark, SF).limit(3)
    ids = [r.patient_id for r in patients.collect()]
    flags = spark.createDataFrame([(ids[0], 2, True), (ids[0], 1, False)], "patient_id string, symptom_count int, has_pain boolean")
    got = {r.patient_id: r for r in ft.prepare_features(patients, flags).collect()}
    assert len(got) == 3 and (got[ids[0]].symptom_count, got[ids[0]].has_pain) == (2.0, 1)
    assert got[ids[1]].has_pain == 0 and all(v is not None for r in got.values() for v in r)


def test_scaling_uses_the_population_deviation(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "age double, wbc double")
    scaler = ft.fit_scaler(rows, ["age", "wbc"])
    assert scaler == {"age": (2.0, 1.0), "wbc": (5.0, 1.0)}
    assert [tuple(r) for r in ft.scale_numeric(rows, scaler).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_one_hot_drops_the_first_and_ignores_the_unseen(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",), ("z",)], "cancer_type string")
    fitted = ft.fit_categories(rows.where("cancer_type <> 'z'"), ["cancer_type"])
    assert [tuple(r)[1:] for r in ft.one_hot(rows, fitted).collect()] == [(1.0, 0.0), (0.0, 0.0), (0.0, 1.0), (0.0, 0.0)]


def test_logistic_is_the_minimum_of_the_penalised_loss(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2))
    y = (x[:, 0] + rng.normal(size=200) > 0.8).astype(float)
    train = spark.createDataFrame(
        [(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"]
    )
    model = md.fit_logistic(train)
    w, b = model.coefficients.toArray(), model.intercept
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    gap = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
    assert np.abs(x.T @ gap + w).max() < 1e-2 and abs(gap.sum()) < 1e-2


def test_predictions(rows, trained):
    train, test = rows
    by_name = {}
    for name in (md.LOGISTIC, md.BOOSTED, md.ENSEMBLE):
        by_name[name] = {r.patient_id: r.probability for r in trained.predict(test, model=name).collect()}
        assert len(by_name[name]) == test.count() and all(0 <= p <= 1 for p in by_name[name].values())
    for key, p in by_name[md.ENSEMBLE].items():
        assert p == pytest.approx((by_name[md.LOGISTIC][key] + by_name[md.BOOSTED][key]) / 2)
    assert trained.best == md.BOOSTED
    with pytest.raises(ValueError):
        trained.predict(test, model="other")
    fit = trained.predict(train, keep=["adverse_event"]).select(F.col("adverse_event").cast("int").alias("y"), F.col("probability").alias("p"))
    assert ev.auroc(fit).first()[0] > 0.6


def test_save_and_load(spark, rows, trained, tmp_path):
    trained.save(spark, str(tmp_path / "m"))
    loaded = md.RiskModels.load(spark, str(tmp_path / "m"))
    a = {r.patient_id: r.probability for r in trained.predict(rows[1], model=md.ENSEMBLE).collect()}
    b = {r.patient_id: r.probability for r in loaded.predict(rows[1], model=md.ENSEMBLE).collect()}
    assert a == pytest.approx(b, abs=1e-9)


def test_model_scores_name_their_source(rows, trained):
    got = sc.score_patients(rows[1], models=trained, model=md.LOGISTIC).select("model_used").distinct().collect()
    assert [r[0] for r in got] == [md.LOGISTIC]


def test_registered_queries_boost_all_rounds(spark, monkeypatch):
    from cohortlens.plans import queries

    asked = []
    monkeypatch.setattr(md, "boost_saved", lambda rows, fits, trees, seed: asked.append((fits, trees)) or boost(rows, fits, trees=1))
    tests = ft.stratified_split(d.patients(spark, SF), "adverse_event").where("split = 'test'").count()
    for name in ("fit_boosted", "predict_ensemble"):
        assert queries.QUERIES[name](spark, SF).count() == tests
    assert queries.QUERIES["train_report_patients"](spark, SF).where("section = 'cross_validation'").count() == 4
    # the report makes all fits of all folds at once
    assert asked == [(3, md.TREES), (3, md.TREES), (18, md.TREES)] and md.TREES == 300


def brute_boost(x, y, cuts, drawn, columns, trees, depth=4, rate=0.05):
    """One fit, row by row."""
    weight = np.where(y > 0, max(1, (1 - y).sum() / y.sum()), 1.0)
    margin, losses = np.zeros(len(y)), []
    for t in range(trees):
        losses.append((weight * (np.logaddexp(0, margin) - y * margin)).sum() / weight.sum())
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)

        def grow(rows, level):
            used = rows[drawn[t][rows]]
            G, H = g[used].sum(), h[used].sum()
            best = (1e-12, None)
            for f in columns[t] if level < depth else ():
                for c in cuts[f]:
                    left = used[x[used, f] <= c]
                    a, b = g[left].sum(), h[left].sum()
                    gain = a * a / (b + 1) + (G - a) ** 2 / (H - b + 1) - G * G / (H + 1)
                    if b >= 1 and H - b >= 1 and gain > best[0] + 1e-9:
                        best = (gain, (f, c))
            if best[1] is None:
                margin[rows] -= rate * G / (H + 1)
                return
            f, c = best[1]
            grow(rows[x[rows, f] <= c], level + 1)
            grow(rows[x[rows, f] > c], level + 1)

        grow(np.arange(len(y)), 0)
    return margin, losses


@pytest.mark.parametrize("block", [20_000, 150])
def test_boosting_is_that_of_the_plain_algorithm(spark, monkeypatch, block):
    """In a task per fit, and in a job per level over blocks."""
    from cohortlens.operators import boosting

    monkeypatch.setattr(boosting, "BLOCK_ROWS", block)
    monkeypatch.setattr(boosting, "CHECKPOINT", 5)
    rng = np.random.default_rng(7)
    x = np.stack([rng.integers(0, 9, 400), rng.normal(size=400).round(2), rng.integers(0, 2, 400)], 1).astype(float)
    y = (x[:, 0] + 2 * x[:, 1] + rng.normal(size=400) > 6).astype(float)
    inside = rng.random(400) < 0.7
    rows = spark.createDataFrame(
        [(i, Vectors.dense(a), float(b), [True, bool(m), False]) for i, (a, b, m) in enumerate(zip(x, y, inside))],
        ["id", "features", "label", "member"],
    )
    made = boost(rows, 3, trees=12, row_sample=1.0)
    cuts = bin_cuts(rows)
    columns = [np.sort(np.random.default_rng((ft.SEED, t)).permutation(3)[:2]) for t in range(12)]
    for k, own in enumerate([np.ones(400, bool), inside]):
        margin, losses = brute_boost(x[own], y[own], cuts, [np.ones(own.sum(), bool)] * 12, columns, 12)
        assert np.allclose(made[k].margins(x[own]), margin) and np.allclose(made[k].losses[:-1], losses)
    assert not made[2].margins(x).any()
    scored = {r.id: r.probability for r in made[0].transform(rows).collect()}
    assert np.allclose([scored[i] for i in range(400)], 1 / (1 + np.exp(-made[0].margins(x))))
    # a fit is the same whatever other fits there are, with rows and columns drawn too, and however rows lie
    both = boost(rows, 3, trees=3)
    alone = boost(rows.orderBy(F.desc("id")).select("features", "label", F.array(F.element_at("member", 2)).alias("member")), 1, trees=3)[0]
    assert np.array_equal(both[1].feature, alone.feature) and np.allclose(both[1].value, alone.value)


def test_fits_are_saved_and_found_again(spark, rows, monkeypatch, tmp_path):
    from cohortlens.operators import boosting

    monkeypatch.setattr(boosting, "shared_dir", lambda _: str(tmp_path))
    prepared = ft.prepare_features(rows[0].withColumn("label", F.col("adverse_event").cast("double")), keep=["label"])
    table = ft.FeaturePlan.fit(prepared).assemble(prepared, ["patient_id", "label"])
    members = lambda *of: F.array(*[F.pmod(F.hash("patient_id"), F.lit(3)) != k for k in of])
    made, whole = [], boosting.boost
    monkeypatch.setattr(boosting, "boost", lambda r, n, **o: made.append(n) or whole(r, n, **o))
    first = boosting.boost_saved(table.withColumn("member", members(0, 1)), 2, trees=2)
    again = boosting.boost_saved(table.withColumn("member", members(2, 1, 0)), 3, trees=2)
    assert made == [2, 1]
    for a, b in ((first[0], again[2]), (first[1], again[1])):
        assert np.array_equal(a.feature, b.feature) and np.array_equal(a.cut, b.cut) and a.losses == b.losses
        assert np.array_equal(a.value, b.value)


def test_losses_fall(spark, rows):
    prepared = ft.prepare_features(rows[0].withColumn("label", F.col("adverse_event").cast("double")), keep=["label"])
    model = md.fit_boosted(ft.FeaturePlan.fit(prepared).assemble(prepared, ["patient_id", "label"]), trees=20)
    assert len(model.losses) == 21 and all(b < a for a, b in zip(model.losses, model.losses[1:]))


def test_a_large_table_has_a_partition_per_core_and_sends_back_splits(spark, monkeypatch):
    from cohortlens.operators import boosting

    rng = np.random.default_rng(3)
    rows = spark.createDataFrame(
        [(Vectors.dense(rng.integers(0, 50, 3).astype(float)), float(rng.random() < 0.4), [True, i % 3 > 0]) for i in range(4000)],
        ["features", "label", "member"],
    )
    in_tasks = boost(rows, 2, trees=3)
    seen, level = [], boosting._level

    def watched(state, *how):
        found = level(state, *how)
        seen.append((state.getNumPartitions(), sum(a.nbytes for fit in found[0] for a in fit)))
        return found

    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    monkeypatch.setattr(boosting, "_level", watched)
    over_blocks = boost(rows, 2, trees=3)
    assert len(seen) == 13 and {parts for parts, _ in seen} == {min(spark.sparkContext.defaultParallelism, 4000 // boosting.TASK_ROWS)}
    assert max(size for _, size in seen) < 1000  # sums of 3 features and 32 bins are larger
    for a, b in zip(in_tasks, over_blocks):
        assert np.array_equal(a.feature, b.feature) and np.array_equal(a.cut, b.cut) and np.allclose(a.value, b.value)
    assert boosting._tasks(100_000_000, 12) == 79  # tasks stay of bounded size
