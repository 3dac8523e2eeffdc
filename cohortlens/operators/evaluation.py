"""Exact evaluation tables for risk scores and for extraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.storage import staged
from .ranks import running_totals

# --- fixed values -----------------------------------------------------------------
THRESHOLDS = (
    0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90,
)
SHOWN_THRESHOLDS = (0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.70)
CALIBRATION_BINS = 10
MIN_GROUP_ROWS = 10
MIN_GROUP_POSITIVES = 2
AGE_GROUPS = ((0, 50, "<50"), (50, 65, "50-65"), (65, 75, "65-75"), (75, 200, ">75"))
AUROC_DIMENSIONS = ("cancer_type", "sex", "age_group")
TABLE_DIMENSIONS = ("sex", "cancer_type", "stage", "age_group")
TOP1_GATE = 0.70
# ----------------------------------------------------------------------------------


def ranking_metrics(scored: DataFrame, y: str = "y", p: str = "p", groups: Sequence[str] = ()) -> DataFrame:
    """``n, n_pos, auroc, auprc, brier`` of all rows, or of each group.

    Rows are counted per score before anything is ordered, and the counts are
    written once, so what made the scores runs once.  AUROC gives ties
    one half; AUPRC is average precision over distinct scores.  AUROC is null
    without both classes, AUPRC without positives.
    """
    return _metrics_of_counts(score_counts(scored, y, p, groups), groups)


def score_counts(scored: DataFrame, y: str = "y", p: str = "p", groups: Sequence[str] = ()) -> DataFrame:
    """Written counts ``pos, neg, rows`` per group and score ``_p``."""
    label = F.col(y).cast("bigint")
    return staged(
        scored.groupBy(*groups, F.col(p).cast("double").alias("_p")).agg(
            F.sum(label).alias("pos"), F.sum(1 - label).alias("neg"), F.count(F.lit(1)).alias("rows")
        ),
        "score-counts",
    )


def _metrics_of_counts(counts: DataFrame, groups: Sequence[str]) -> DataFrame:
    pos, neg, score = F.col("pos"), F.col("neg"), F.col("_p")
    tp = F.col("pos_total") - F.col("pos_before")
    fp = F.col("neg_total") - F.col("neg_before")
    return (
        running_totals(counts, groups, "_p", ["pos", "neg"])
        .groupBy(*groups)
        .agg(
            F.sum(pos + neg).alias("n"),
            F.sum(pos).alias("n_pos"),
            F.sum(pos * (F.col("neg_before") + neg / 2)).alias("_area"),
            F.sum(pos * tp / (tp + fp)).alias("_precision"),
            F.sum(pos * F.pow(score - 1, F.lit(2)) + neg * F.pow(score, F.lit(2))).alias("_square"),
        )
        .select(
            *groups,
            "n",
            "n_pos",
            F.try_divide("_area", F.col("n_pos").cast("double") * (F.col("n") - F.col("n_pos"))).alias("auroc"),
            F.try_divide("_precision", "n_pos").alias("auprc"),
            F.try_divide("_square", "n").alias("brier"),
        )
    )


def auroc(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return ranking_metrics(scored, y, p).select("auroc")


def auprc(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return ranking_metrics(scored, y, p).select("auprc")


def brier(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return scored.agg(F.avg(F.pow(F.col(p) - F.col(y), F.lit(2))).alias("brier"))


def calibration_curve(scored: DataFrame, y: str = "y", p: str = "p", bins: int = CALIBRATION_BINS) -> DataFrame:
    """``bin, fraction_positive, mean_predicted, n`` of the bins that have rows."""
    bin_no = F.least(F.greatest(F.ceil(F.col(p) * bins) - 1, F.lit(0)), F.lit(bins - 1)).cast("int")
    return scored.groupBy(bin_no.alias("bin")).agg(
        F.avg(F.col(y).cast("double")).alias("fraction_positive"),
        F.avg(p).alias("mean_predicted"),
        F.count(F.lit(1)).alias("n"),
    )


def age_group(age: Column) -> Column:
    """Bands closed on the right; an age in none of them is ``nan``."""
    out = F.lit("nan")
    for low, high, name in reversed(AGE_GROUPS):
        out = F.when((age > low) & (age <= high), name).otherwise(out)
    return out


def by_dimension(scored: DataFrame, dimensions: Sequence[str], whole: bool = False) -> DataFrame:
    """One row per input row and dimension: ``dimension, group``; with ``whole``, one more of null dimension."""
    pairs = [F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("group")) for d in dimensions]
    if whole:
        nothing = F.lit(None).cast("string")
        pairs.append(F.struct(nothing.alias("dimension"), nothing.alias("group")))
    pairs = F.array(*pairs)
    return scored.select("*", F.inline(pairs))


def _judged_groups(scored: DataFrame, y: str, p: str, dimensions: Sequence[str]) -> DataFrame:
    return ranking_metrics(by_dimension(scored, dimensions), y, p, ["dimension", "group"]).where(_enough())


def _enough() -> Column:
    return (F.col("n") >= MIN_GROUP_ROWS) & (F.col("n_pos") >= MIN_GROUP_POSITIVES) & (F.col("n_pos") < F.col("n"))


def subgroup_auroc(
    scored: DataFrame, y: str = "y", p: str = "p", dimensions: Sequence[str] = AUROC_DIMENSIONS
) -> DataFrame:
    return _judged_groups(scored, y, p, dimensions).select("dimension", "group", F.bround("auroc", 4).alias("auroc"))


def subgroup_table(
    scored: DataFrame, y: str = "y", p: str = "p", dimensions: Sequence[str] = TABLE_DIMENSIONS
) -> DataFrame:
    """Metrics per group; sort by ``dimension, auroc desc`` to show them."""
    return _judged_groups(scored, y, p, dimensions).select(
        "dimension",
        "group",
        "n",
        "n_pos",
        F.bround(F.col("n_pos") / F.col("n"), 4).alias("ae_rate"),
        *[F.bround(m, 4).alias(m) for m in ("auroc", "auprc", "brier")],
    )


def threshold_table(
    scored: DataFrame, y: str = "y", p: str = "p", thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """Alert quality at each threshold.

    A row is counted once, under the number of thresholds it reaches; the
    table comes from those few counts.
    """
    rows = scored.select(F.col(p).alias("_p"), F.col(y).cast("bigint").alias("pos"), F.lit(1).alias("rows"))
    return _thresholds_of_counts(rows, thresholds)


def _thresholds_of_counts(counted: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    steps = sorted(thresholds)
    reached = F.lit(0)
    for t in steps:
        reached = reached + (F.col("_p") >= F.lit(float(t))).cast("int")
    counts = counted.groupBy(reached.alias("_k")).agg(F.sum("pos").alias("pos"), F.sum("rows").alias("all"))
    line = F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(float(t)).alias("threshold")) for i, t in enumerate(steps)])
    alert = F.col("_k") > F.col("_i")
    table = (
        counts.select("*", F.inline(line))
        .groupBy("threshold")
        .agg(
            F.sum(F.when(alert, F.col("pos")).otherwise(0)).alias("true_positives"),
            F.sum(F.when(alert, F.col("all") - F.col("pos")).otherwise(0)).alias("false_positives"),
            F.sum(F.when(~alert, F.col("pos")).otherwise(0)).alias("false_negatives"),
            F.sum(F.when(~alert, F.col("all") - F.col("pos")).otherwise(0)).alias("_tn"),
        )
    )
    tp, fp, fn, tn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives", "_tn"))
    one = F.lit(1)
    table = table.withColumns({"_p": tp / F.greatest(tp + fp, one), "_r": tp / F.greatest(tp + fn, one)})
    f1 = 2 * F.col("_p") * F.col("_r") / F.greatest(F.col("_p") + F.col("_r"), F.lit(1e-9))
    return table.select(
        "threshold",
        F.bround("_p", 4).alias("precision"),
        F.bround("_r", 4).alias("recall"),
        F.bround(f1, 4).alias("f1"),
        F.bround(tn / F.greatest(tn + fp, one), 4).alias("specificity"),
        (tp + fp).alias("n_alerted"),
        "true_positives",
        "false_positives",
        "false_negatives",
    )


def best_threshold(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("f1"), "threshold").limit(1).select("threshold", "precision", "recall", "f1")


def metric_summary(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Headline metrics, four digits."""
    return ranking_metrics(scored, y, p).select(*[F.bround(m, 4).alias(m) for m in ("auroc", "auprc", "brier")])


def model_report(scored: DataFrame, model: str, y: str = "y", p: str = "p") -> DataFrame:
    """All report tables of one model in long form.

    ``model, section, item, metric, value``; the section ``threshold_display``
    repeats the thresholds a reader is shown.  The scored rows are read once, and
    counted per score for all rows and for each group; every section comes from
    these counts.  No rows give an empty report.
    """
    groups = ["dimension", "group"]
    counts = score_counts(by_dimension(scored, TABLE_DIMENSIONS, whole=True), y, p, groups)
    thresholds = staged(_thresholds_of_counts(counts.where(F.col("dimension").isNull()), THRESHOLDS), "thresholds")
    per_threshold = [c for c in thresholds.columns if c != "threshold"]
    shown = F.col("threshold").isin(*[float(t) for t in SHOWN_THRESHOLDS])
    item = F.format_string("%.2f", "threshold")
    parts = [
        _long(best_threshold(thresholds).withColumn("item", item), "best_threshold", ["precision", "recall", "f1"]),
        _long(thresholds.withColumn("item", item), "threshold_analysis", per_threshold),
        _long(
            thresholds.where(shown).withColumn("item", item),
            "threshold_display",
            ["precision", "recall", "f1", "n_alerted", "true_positives", "false_positives"],
        ),
        _ranking_sections(_metrics_of_counts(counts, groups)),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.lit(model).alias("model"), "section", "item", "metric", "value")


def _ranking_sections(metrics: DataFrame) -> DataFrame:
    """The headline metrics of all rows (null dimension) and the table of groups, in one pass."""
    whole = F.col("dimension").isNull()
    rate = F.bround(F.col("n_pos") / F.col("n"), 4)
    ranked = {m: F.bround(m, 4) for m in ("auroc", "auprc", "brier")}

    def cells(values: dict[str, Column]) -> Column:
        return F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in values.items()])

    of_group = {"n": F.col("n"), "n_pos": F.col("n_pos"), "ae_rate": rate, **ranked}
    return metrics.where(whole | _enough()).select(
        F.when(whole, "metrics").otherwise("subgroup_analysis").alias("section"),
        F.when(whole, "all").otherwise(F.concat_ws("=", "dimension", "group")).alias("item"),
        F.inline(F.when(whole, cells(ranked)).otherwise(cells(of_group))),
    )


def _long(table: DataFrame, section: str, metrics: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return table.select(F.lit(section).alias("section"), "item", F.inline(cells))


# --------------------------------------------------------------------------
# extraction
# --------------------------------------------------------------------------


def _cases_ok(cases: DataFrame) -> DataFrame:
    return cases.where(F.col("status") == "ok").select("case_id")


def extraction_prf(cases: DataFrame, expected: DataFrame, predicted: DataFrame) -> DataFrame:
    """Micro precision, recall and F1 over distinct lower-cased texts per case.

    ``cases``: ``case_id, status``.  A failed case adds its expected mentions,
    as listed, to the denominator of recall and nothing else.
    """
    ok = _cases_ok(cases)

    def sides(rows: DataFrame, is_predicted: int) -> DataFrame:
        return rows.join(ok, "case_id", "left_semi").select(
            "case_id",
            F.lower("text").alias("text"),
            F.lit(is_predicted).alias("p"),
            F.lit(1 - is_predicted).alias("e"),
        )

    both = (
        sides(predicted, 1)
        .unionByName(sides(expected, 0))
        .groupBy("case_id", "text")
        .agg(F.max("p").alias("p"), F.max("e").alias("e"))
    )
    totals = both.agg(
        F.coalesce(F.sum(F.col("p") * F.col("e")), F.lit(0)).alias("true_positives"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("predicted"),
        F.coalesce(F.sum("e"), F.lit(0)).alias("_expected"),
    )
    missed = expected.join(cases.where(F.col("status") != "ok"), "case_id", "left_semi").agg(F.count(F.lit(1)).alias("n"))
    counted = totals.withColumn("expected", F.col("_expected") + missed.scalar())
    precision = _ratio(F.col("true_positives"), F.col("predicted"))
    recall = _ratio(F.col("true_positives"), F.col("expected"))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    return counted.select(
        "true_positives",
        "predicted",
        "expected",
        F.bround(precision, 4).alias("extraction_precision"),
        F.bround(recall, 4).alias("extraction_recall"),
        F.bround(f1, 4).alias("extraction_f1"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def mapping_topk(cases: DataFrame, expected: DataFrame, predicted: DataFrame, candidates: DataFrame) -> DataFrame:
    """Share of expected mentions, among those predicted, whose concept is first or in the first three.

    Candidates are those of the last prediction with that text.
    """
    ok = _cases_ok(cases)
    surface = (
        predicted.join(ok, "case_id", "left_semi")
        .groupBy("case_id", F.lower("text").alias("_key"))
        .agg(F.max_by("text", "start").alias("mention_text"))
    )
    ranked = candidates.where(F.col("rank") <= 3).groupBy("mention_text").agg(
        F.max(F.when(F.col("rank") == 1, F.col("hpo_id"))).alias("_first"), F.collect_set("hpo_id").alias("_three")
    )
    checked = (
        expected.join(ok, "case_id", "left_semi")
        .withColumn("_key", F.lower("text"))
        .join(surface, ["case_id", "_key"])
        .join(ranked, "mention_text", "left")
    )
    hits = checked.agg(
        F.count(F.lit(1)).alias("mapping_total"),
        F.count_if(F.col("_first") == F.col("hpo_id")).alias("top1_correct"),
        F.count_if(F.array_contains("_three", F.col("hpo_id"))).alias("top3_correct"),
    )
    return hits.select(
        "mapping_total",
        "top1_correct",
        "top3_correct",
        F.bround(_ratio(F.col("top1_correct"), F.col("mapping_total")), 4).alias("top1_accuracy"),
        F.bround(_ratio(F.col("top3_correct"), F.col("mapping_total")), 4).alias("top3_accuracy"),
    )


def negation_fp(cases: DataFrame, expected: DataFrame, predicted: DataFrame) -> DataFrame:
    """Share of expected-negated mentions whose first prediction is not negated."""
    ok = _cases_ok(cases)
    first = (
        predicted.join(ok, "case_id", "left_semi")
        .groupBy("case_id", F.lower("text").alias("_key"))
        .agg(F.min_by("negated", "start").alias("_negated"))
    )
    judged = (
        expected.where("negated")
        .join(ok, "case_id", "left_semi")
        .withColumn("_key", F.lower("text"))
        .join(first, ["case_id", "_key"], "left")
        .agg(F.count(F.lit(1)).alias("negation_total"), F.count_if(~F.col("_negated")).alias("negation_false_positives"))
    )
    return judged.withColumn(
        "negation_fp_rate", F.bround(_ratio(F.col("negation_false_positives"), F.col("negation_total")), 4)
    )


def evaluate_extraction(
    cases: DataFrame, expected: DataFrame, predicted: DataFrame, candidates: DataFrame
) -> DataFrame:
    """All extraction metrics in one row."""
    prf = extraction_prf(cases, expected, predicted).withColumn("_one", F.lit(1))
    top = mapping_topk(cases, expected, predicted, candidates).withColumn("_one", F.lit(1))
    neg = negation_fp(cases, expected, predicted).withColumn("_one", F.lit(1))
    return (
        prf.join(top, "_one")
        .join(neg, "_one")
        .select(
            "extraction_precision", "extraction_recall", "extraction_f1", "top1_accuracy", "top3_accuracy",
            "negation_fp_rate", cases.agg(F.count(F.lit(1)).alias("n")).scalar().alias("total_cases"),
        )
    )


def evaluate_mapped(cases: DataFrame, expected: DataFrame, mapped: DataFrame) -> DataFrame:
    """All counts and metrics of extraction, mapping and negation in one row, in one pass over each table.

    ``mapped`` is what ``mapping.enrich_notes`` returns, with ``case_id``: the
    mentions of a case with their negation and candidates.  Mentions and
    expected ones meet once, by case and lower-cased text; a row of that has
    all that any metric needs.  Definitions are those of ``extraction_prf``,
    ``mapping_topk`` and ``negation_fp``.
    """
    three = F.transform(F.filter("candidates", lambda c: c["rank"] <= 3), lambda c: c["hpo_id"])
    found = mapped.select(
        "case_id", F.lower("text").alias("key"), F.col("start").cast("long").alias("start"), F.col("negated").alias("was_negated"),
        three.alias("three"),
    )
    # equal expected mentions are counted first, so what is listed below are distinct concepts
    asked = expected.groupBy("case_id", F.lower("text").alias("key"), "hpo_id", "negated").agg(F.count(F.lit(1)).alias("n"))
    asked = asked.select("case_id", "key", F.struct("hpo_id", "negated", "n").alias("asked"))
    met = found.unionByName(asked, allowMissingColumns=True).groupBy("case_id", "key").agg(
        F.count("start").alias("found"),
        F.min_by("was_negated", "start").alias("first_negated"),
        F.max_by("three", "start").alias("three"),
        F.collect_list("asked").alias("asked"),
    )

    def mentions(of=lambda a: F.lit(True)) -> Column:
        return F.aggregate(F.filter("asked", of), F.lit(0).cast("long"), lambda n, a: n + a["n"])

    ok, hit, some = F.col("ok"), F.col("found") > 0, F.size("asked") > 0
    first = F.try_element_at("three", F.lit(1))
    total = lambda value: F.coalesce(F.sum(value), F.lit(0).cast("long"))
    counts = met.join(cases.select("case_id", (F.col("status") == "ok").alias("ok")), "case_id").agg(
        F.count_if(ok & hit & some).alias("true_positives"),
        F.count_if(ok & hit).alias("predicted"),
        total(F.when(ok, some.cast("long")).otherwise(mentions())).alias("expected"),
        total(F.when(ok & hit, mentions())).alias("mapping_total"),
        total(F.when(ok & hit, mentions(lambda a: a["hpo_id"] == first))).alias("top1_correct"),
        total(F.when(ok & hit, mentions(lambda a: F.array_contains("three", a["hpo_id"])))).alias("top3_correct"),
        total(F.when(ok, mentions(lambda a: a["negated"]))).alias("negation_total"),
        total(F.when(ok & hit & ~F.col("first_negated"), mentions(lambda a: a["negated"]))).alias("negation_false_positives"),
    )
    precision, recall = _ratio(F.col("true_positives"), F.col("predicted")), _ratio(F.col("true_positives"), F.col("expected"))
    rounded = {
        "extraction_precision": precision,
        "extraction_recall": recall,
        "extraction_f1": F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)),
        "top1_accuracy": _ratio(F.col("top1_correct"), F.col("mapping_total")),
        "top3_accuracy": _ratio(F.col("top3_correct"), F.col("mapping_total")),
        "negation_fp_rate": _ratio(F.col("negation_false_positives"), F.col("negation_total")),
    }
    return counts.select(
        "*", *[F.bround(v, 4).alias(k) for k, v in rounded.items()],
        cases.agg(F.count(F.lit(1)).alias("n")).scalar().alias("total_cases"),
    )


def regression_gate(metrics: DataFrame, metric: str = "top1_accuracy", threshold: float = TOP1_GATE) -> DataFrame:
    return metrics.select(
        F.lit(metric).alias("metric"),
        F.col(metric).alias("value"),
        F.lit(threshold).alias("threshold"),
        (F.col(metric) >= threshold).alias("passed"),
    )


def cohort_profile(patients: DataFrame) -> DataFrame:
    """``section, item, n, share``: row count, event prevalence, frequencies."""
    total = patients.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("adverse_event").alias("events"),
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("cohort").alias("section"), F.lit("patients").alias("item"), F.col("rows").alias("n"), F.lit(1.0).alias("share")),
                F.struct(F.lit("cohort").alias("section"), F.lit("adverse_event").alias("item"), F.col("events").alias("n"), F.try_divide("events", "rows").alias("share")),
            )
        )
    )
    rows = patients.agg(F.count(F.lit(1)).alias("n")).scalar()
    pairs = F.array(
        F.struct(F.lit("ae_type").alias("section"), F.col("ae_type").alias("item")),
        F.struct(F.lit("cancer_type").alias("section"), F.col("cancer_type").alias("item")),
    )
    counts = (
        patients.select(F.inline(pairs))
        .where(F.col("item").isNotNull())
        .groupBy("section", "item")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("section", "item", "n", F.try_divide("n", rows).alias("share"))
    )
    return total.unionByName(counts)
