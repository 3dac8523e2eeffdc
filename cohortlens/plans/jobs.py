"""Whole jobs put together from the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import staged
from ..operators import evaluation as ev
from ..operators import features as ft
from ..operators import models as md
from ..operators.symptoms import batch_flags
from ..sources import write_report


def train_report(
    patients: DataFrame,
    label: str = "adverse_event",
    fits: Mapping[str, md.Fit] | None = None,
    cv_models: Sequence[str] | None = None,
    save_to: str | None = None,
    apply_negation: bool = True,
    seed: int = ft.SEED,
) -> DataFrame:
    """Split, extract flags, train all models, and report on the test rows.

    Returns the long report of every model: headline metrics, thresholds and
    subgroups, the calibration curve, cross-validated AUROC (of every model, or
    of ``cv_models``), and ``best_model``.  With ``save_to`` models and report are stored.
    """
    spark = patients.sparkSession
    fits = fits if fits is not None else {md.LOGISTIC: md.fit_logistic, md.BOOSTED: md.fit_boosted}
    split = staged(ft.stratified_split(patients, label, seed=seed), "split")
    flags = staged(batch_flags(split, apply_negation=apply_negation), "flags")
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    models, validated = md.cross_fitted(train, flags, label, fits, seed=seed, validated=cv_models)
    labels = test.select(
        "patient_id", "sex", "stage", "cancer_type", ev.age_group(F.col("age")).alias("age_group"),
        F.col(label).cast("int").alias("y"),
    )
    out = None
    for name in models.models:
        scores = models.predict(test, flags, name).withColumnRenamed("probability", "p")
        scored = staged(labels.join(scores, "patient_id"), f"scores-{name}")
        parts = [ev.model_report(scored, name), _calibration(scored, name)]
        if name in validated:
            cv = md.cv_summary(validated[name])
            parts.append(_rows(cv, name, "cross_validation", ["cv_auroc_mean", "cv_auroc_std"]))
        models.metrics[name] = ev.metric_summary(scored).first().asDict()
        for part in parts:
            out = part if out is None else out.unionByName(part)
    best = spark.range(0, 1, 1, 1).select(
        F.lit(models.best).alias("model"), F.lit("best_model").alias("section"), F.lit("all").alias("item"),
        F.lit("chosen").alias("metric"), F.lit(1.0).alias("value"),
    )
    report = staged(out.unionByName(best), "report")
    if save_to:
        models.save(spark, save_to)
        write_report(report, f"{save_to}/report", partition_by=["model"])
        thresholds = report.where(F.col("section") == "threshold_analysis")
        write_report(thresholds, f"{save_to}/thresholds", "csv")
    return report


def _calibration(scored: DataFrame, model: str) -> DataFrame:
    curve = ev.calibration_curve(scored).withColumn("item", F.format_string("bin=%d", "bin"))
    return _rows(curve, model, "calibration", ["fraction_positive", "mean_predicted", "n"], item=F.col("item"))


def _rows(table: DataFrame, model: str, section: str, metrics: Sequence[str], item=None) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    named = table.select((item if item is not None else F.lit("all")).alias("item"), F.inline(cells))
    return named.select(F.lit(model).alias("model"), F.lit(section).alias("section"), "item", "metric", "value")
