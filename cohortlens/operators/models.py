"""Adverse-event classifiers on Spark ML, with cross-fitted calibration."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import staged
from .boosting import TREES, BoostedTrees, boost_saved
from .evaluation import ranking_metrics
from .features import FeaturePlan, SEED, class_weights, prepare_features, stratified_folds
from .ranks import stratified_rank

# --- fixed values: model parameters ---------------------------------------------------
LOGISTIC_C = 1.0
LOGISTIC_ITERATIONS = 1000
CALIBRATION_FOLDS = 3
CV_FOLDS = 5
#: fits that run side by side
SIDE_BY_SIDE = 8
#: rows per task of a linear fit at least: each of its many passes costs a task per partition
LOGISTIC_TASK_ROWS = 50_000
# --------------------------------------------------------------------------------------

LOGISTIC, BOOSTED, ENSEMBLE = "logistic_regression", "gbt", "ensemble"

Fit = Callable[[DataFrame], Model | BoostedTrees]


def fit_logistic(train: DataFrame, c: float = LOGISTIC_C, iterations: int = LOGISTIC_ITERATIONS) -> LogisticRegressionModel:
    """L2 logistic regression with balanced classes on ``features, label``."""
    w = class_weights(train, "label").first()
    weighted = train.withColumn("_w", F.when(F.col("label") == 1, F.lit(w["weight_pos"])).otherwise(F.lit(w["weight_neg"])))
    total = float(w["n_pos"] + w["n_neg"])  # balanced weights add up to the row count
    weighted = weighted.coalesce(max(1, -(-int(total) // LOGISTIC_TASK_ROWS)))
    return LogisticRegression(
        regParam=1.0 / (c * total), elasticNetParam=0.0, standardization=False, maxIter=iterations, weightCol="_w"
    ).fit(weighted)


def fit_boosted(train: DataFrame, trees: int = TREES, seed: int = SEED) -> BoostedTrees:
    """Boosted trees with the rarer class weighted up on ``features, label``."""
    return boosted_together(train.withColumn("member", F.array(F.lit(True))), 1, trees, seed)[0]


def boosted_together(rows: DataFrame, fits: int, trees: int = TREES, seed: int = SEED) -> list[BoostedTrees]:
    """Boosted trees for several training sets of one table, see ``boosting.boost``."""
    return boost_saved(rows, fits, trees=trees, seed=seed)


#: fits of one table that can be made together say so
fit_boosted.together = boosted_together


def _raw_score(model: Model | BoostedTrees, df: DataFrame, name: str) -> DataFrame:
    """The number that is calibrated: the margin of a linear model, the probability of trees."""
    if isinstance(model, BoostedTrees):
        return model.transform(df, name=name)
    source = "rawPrediction" if isinstance(model, LogisticRegressionModel) else "probability"
    out = model.transform(df).withColumn(name, vector_to_array(source)[1])
    return out.drop("rawPrediction", "probability", "prediction")


@dataclass(frozen=True)
class CalibratedModel:
    """Pairs of a classifier and the isotonic map fitted on the rows it did not see."""

    pairs: list[tuple[Model | BoostedTrees, IsotonicRegressionModel]]

    def predict(self, df: DataFrame, name: str = "probability") -> DataFrame:
        """Adds the mean calibrated probability."""
        out = df
        parts = []
        for i, (model, isotonic) in enumerate(self.pairs):
            out = isotonic.transform(_raw_score(model, out, "_raw")).withColumnRenamed("prediction", f"_p{i}").drop("_raw")
            parts.append(F.col(f"_p{i}"))
        mean = sum(parts[1:], parts[0]) / len(parts)
        return out.withColumn(name, F.greatest(F.lit(0.0), F.least(F.lit(1.0), mean))).drop(*[f"_p{i}" for i in range(len(parts))])


def _side_by_side(spark: SparkSession, work: Callable, items: Sequence) -> list:
    with ThreadPool(min(SIDE_BY_SIDE, max(1, len(items)))) as pool:
        return pool.starmap(inheritable_thread_target(spark)(work), items)


def _fitted(rows: DataFrame, fit: Fit, members: Sequence[Column]) -> list[Model | BoostedTrees]:
    """One model of the rows of each member condition: together if the fit can do that, else side by side."""
    together = getattr(fit, "together", None)
    if together is not None:
        return together(rows.withColumn("member", F.array(*[F.coalesce(m, F.lit(False)) for m in members])), len(members))
    return _side_by_side(rows.sparkSession, lambda m: fit(rows.where(m)), [(m,) for m in members])


def _isotonic(model: Model | BoostedTrees, held: DataFrame) -> IsotonicRegressionModel:
    """Held-out rows are averaged per distinct score first, which gives the same map."""
    scored = _raw_score(model, held, "_raw")
    points = scored.groupBy("_raw").agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("_w"))
    isotonic = IsotonicRegression(featuresCol="_raw", labelCol="label", weightCol="_w").fit(points)
    isotonic.setFeaturesCol("_raw")
    return isotonic


def calibrate_isotonic(train: DataFrame, fit: Fit, folds: int = CALIBRATION_FOLDS, seed: int = SEED) -> CalibratedModel:
    """Fit on all folds but one and calibrate on the one, for each fold.

    ``train``: ``patient_id, features, label``.
    """
    dealt = staged(stratified_folds(train, "label", folds, seed=seed), "folds")
    models = _fitted(dealt, fit, [F.col("fold") != k for k in range(folds)])
    held = [(m, dealt.where(F.col("fold") == k)) for k, m in enumerate(models)]
    return CalibratedModel(list(zip(models, _side_by_side(train.sparkSession, _isotonic, held), strict=True)))


@dataclass
class RiskModels:
    """Fitted features and the calibrated models trained on them."""

    plan: FeaturePlan
    models: dict[str, CalibratedModel]
    metrics: dict[str, dict[str, float]] = field(default_factory=dict)

    @property
    def best(self) -> str:
        """Trees if present, else the linear model."""
        return BOOSTED if BOOSTED in self.models else LOGISTIC

    def predict(
        self,
        patients: DataFrame,
        flags: DataFrame | None = None,
        model: str | None = None,
        keep: Sequence[str] = (),
    ) -> DataFrame:
        """``patient_id``, ``keep`` columns and ``probability``."""
        name = model or self.best
        chosen = list(self.models) if name == ENSEMBLE else [name]
        missing = [m for m in chosen if m not in self.models]
        if missing or not chosen:
            raise ValueError(f"model {name!r} is not trained")
        columns = ["patient_id", *keep]
        out = self.plan.assemble(prepare_features(patients, flags, keep=keep), columns)
        for m in chosen:
            out = self.models[m].predict(out, f"_{m}")
        parts = [F.col(f"_{m}") for m in chosen]
        return out.select(*columns, (sum(parts[1:], parts[0]) / len(parts)).alias("probability"))

    # ---- persistence -----------------------------------------------------

    def save(self, spark: SparkSession, path: str) -> None:
        """Models as Spark ML folders, fitted feature values as tables."""
        for name, calibrated in self.models.items():
            for i, (model, isotonic) in enumerate(calibrated.pairs):
                where = f"{path}/models/{name}/{i}/classifier"
                model.save(spark, where) if isinstance(model, BoostedTrees) else model.write().overwrite().save(where)
                isotonic.write().overwrite().save(f"{path}/models/{name}/{i}/isotonic")
        scaler = [(c, float(m), float(s)) for c, (m, s) in self.plan.scaler.items()]
        spark.createDataFrame(scaler, "feature string, mean double, deviation double").write.mode("overwrite").parquet(f"{path}/scaler")
        categories = list(self.plan.categories.items())
        spark.createDataFrame(categories, "feature string, categories array<string>").write.mode("overwrite").parquet(f"{path}/categories")
        rows = [(n, len(c.pairs), json.dumps(self.metrics.get(n, {}))) for n, c in self.models.items()]
        spark.createDataFrame(rows, "model string, parts int, metrics string").write.mode("overwrite").parquet(f"{path}/index")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "RiskModels":
        """Whatever models were saved there."""
        kinds = {LOGISTIC: LogisticRegressionModel.load, BOOSTED: lambda where: BoostedTrees.load(spark, where)}
        scaler = spark.read.schema("feature string, mean double, deviation double").parquet(f"{path}/scaler")
        categories = spark.read.schema("feature string, categories array<string>").parquet(f"{path}/categories")
        index = spark.read.schema("model string, parts int, metrics string").parquet(f"{path}/index").collect()
        plan = FeaturePlan(
            {r["feature"]: (r["mean"], r["deviation"]) for r in scaler.collect()},
            {r["feature"]: list(r["categories"]) for r in categories.collect()},
        )
        models = {
            r["model"]: CalibratedModel(
                [
                    (
                        kinds[r["model"]](f"{path}/models/{r['model']}/{i}/classifier"),
                        IsotonicRegressionModel.load(f"{path}/models/{r['model']}/{i}/isotonic"),
                    )
                    for i in range(r["parts"])
                ]
            )
            for r in index
        }
        return cls(plan, models, {r["model"]: json.loads(r["metrics"]) for r in index})


def train_models(
    train: DataFrame,
    flags: DataFrame | None = None,
    label: str = "adverse_event",
    fits: Mapping[str, Fit] | None = None,
    folds: int = CALIBRATION_FOLDS,
    seed: int = SEED,
) -> RiskModels:
    """Fit features and all models on labelled patients.

    The assembled rows are written once: every fold of every model reads them.
    """
    fits = fits if fits is not None else {LOGISTIC: fit_logistic, BOOSTED: fit_boosted}
    prepared = staged(prepare_features(train.withColumn("label", F.col(label).cast("double")), flags, keep=["label"]), "features")
    plan = FeaturePlan.fit(prepared)
    rows = staged(plan.assemble(prepared, ["patient_id", "label"]), "assembled")
    return RiskModels(plan, {name: calibrate_isotonic(rows, fit, folds, seed) for name, fit in fits.items()})


def stratified_cv(
    train: DataFrame,
    flags: DataFrame | None = None,
    label: str = "adverse_event",
    fit: Fit = fit_logistic,
    folds: int = CV_FOLDS,
    calibration_folds: int = CALIBRATION_FOLDS,
    seed: int = SEED,
) -> DataFrame:
    """``fold, auroc`` of a fresh calibrated model per fold."""
    _, scores = cross_fitted(train, flags, label, {"model": fit}, folds, calibration_folds, seed, final=False)
    return scores["model"]


def cross_fitted(
    train: DataFrame,
    flags: DataFrame | None,
    label: str,
    fits: Mapping[str, Fit],
    folds: int = CV_FOLDS,
    calibration_folds: int = CALIBRATION_FOLDS,
    seed: int = SEED,
    final: bool = True,
    validated: Sequence[str] | None = None,
) -> tuple[RiskModels, dict[str, DataFrame]]:
    """Models of all rows (``final``), and ``fold, auroc`` of each of the ``validated`` ones (all of them).

    One table holds the rows, the fold of each, and for every scheme (all rows
    but those of a fold; all rows) the calibration fold within it.  Fits that
    can be made together are made for all schemes and calibration folds at
    once, others side by side.  Values for scaling and categories are those of
    a scheme's own rows; trees, which scaling does not change, take those of
    all rows.
    """
    spark = train.sparkSession
    labelled = prepare_features(train.withColumn("label", F.col(label).cast("double")), flags, keep=["label"])
    ranked = stratified_rank(labelled, ["label"], "patient_id", seed)
    place = F.col("stratum_rank") - 1
    within = [
        F.when(place % folds != s, F.pmod(place - F.floor((place + folds - 1 - s) / folds), F.lit(calibration_folds)))
        for s in range(folds)
    ] + [place % calibration_folds]
    dealt = ranked.withColumn("cv_fold", (place % folds).cast("int")).withColumn(
        "within", F.array(*[w.cast("int") for w in within])
    )
    dealt = staged(dealt.drop("stratum_rank", "stratum_size"), "dealt")
    keep = ["patient_id", "label", "cv_fold", "within"]
    whole = FeaturePlan.fit(dealt)
    assembled = staged(whole.assemble(dealt, keep), "assembled")
    models, scores = {}, {}
    for name, fit in fits.items():
        cross = validated is None or name in validated
        schemes = [s for s in range(folds + 1) if (cross if s < folds else final)]
        mine = [(s, k) for s in schemes for k in range(calibration_folds)]

        def of_scheme(s: int) -> DataFrame:
            if s == folds or hasattr(fit, "together"):
                return assembled
            return staged(FeaturePlan.fit(dealt.where(F.col("cv_fold") != s)).assemble(dealt, keep), "assembled-fold")

        tables = dict(zip(schemes, _side_by_side(spark, of_scheme, [(s,) for s in schemes]), strict=True))
        inner = lambda s: F.element_at("within", s + 1)
        if hasattr(fit, "together"):
            fitted = _fitted(assembled, fit, [inner(s) != k for s, k in mine])
        else:
            fitted = _side_by_side(spark, lambda s, k: fit(tables[s].where(inner(s) != k)), mine)
        held = [(m, tables[s].where(inner(s) == k)) for m, (s, k) in zip(fitted, mine, strict=True)]
        pairs = list(zip(fitted, _side_by_side(spark, _isotonic, held), strict=True))
        calibrated = {s: CalibratedModel(pairs[i * calibration_folds : (i + 1) * calibration_folds]) for i, s in enumerate(schemes)}
        if final:
            models[name] = calibrated[folds]
        scored = None
        for s in schemes:
            if s < folds:
                part = calibrated[s].predict(tables[s].where(F.col("cv_fold") == s))
                part = part.select("cv_fold", F.col("label").cast("int").alias("y"), F.col("probability").alias("p"))
                scored = part if scored is None else scored.unionByName(part)
        if scored is not None:
            scores[name] = ranking_metrics(staged(scored, "cv-scores"), groups=["cv_fold"]).select(F.col("cv_fold").alias("fold"), "auroc")
    return RiskModels(whole, models), scores


def cv_summary(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.bround(F.avg("auroc"), 4).alias("cv_auroc_mean"), F.bround(F.stddev_pop("auroc"), 4).alias("cv_auroc_std")
    )
