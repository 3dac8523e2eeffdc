"""Risk scores, tiers and patient summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import join_flags
from .models import RiskModels
from .symptoms import VOCABULARY, note_rollup, symptom_mentions

# --- fixed values: rule-based score ---------------------------------------------------
BASE_RISK = 0.30
STAGE_RISK = {"IV": 0.12, "III": 0.06}
ECOG_STEP = 0.05
OLD_AGE, OLD_AGE_RISK = 70, 0.05
LOW_ANC, LOW_ANC_RISK = 1.0, 0.10
LOW_HEMOGLOBIN, LOW_HEMOGLOBIN_RISK = 10.0, 0.07
SYMPTOM_STEP = 0.02
FEVER_RISK = 0.08
INFECTION_RISK = 0.10
MAX_RISK = 0.99
MISSING = {"stage": "II", "ecog_score": 1, "age": 60, "anc": 2.0, "hemoglobin": 12.0}
# --- fixed values: tiers, lab limits and summary wording ----------------------------------
HIGH_TIER, MEDIUM_TIER = 0.60, 0.35
LAB_LIMITS = (
    ("anc", "below", 1.0),
    ("hemoglobin", "below", 10.0),
    ("platelets", "below", 100.0),
    ("alt", "above", 80.0),
    ("creatinine", "above", 1.3),
    ("bilirubin", "above", 1.5),
)
NEXT_STEPS = {
    "high": "Urgent clinical review recommended. Consider same-day assessment, CBC with differential, and dose "
    "modification per institutional protocol.",
    "medium": "Close monitoring indicated. Schedule follow-up within 48–72 hours and repeat labs at next visit.",
    "low": "Continue current treatment. Routine monitoring at scheduled visit.",
}
SUMMARY_DISCLAIMER = (
    "This summary is generated for clinical decision support only. "
    "It does not constitute a diagnosis. Always involve a qualified clinician."
)
# -----------------------------------------------------------------------------------------

HEURISTIC, HEURISTIC_FALLBACK = "heuristic", "heuristic_fallback"


def heuristic_risk() -> Column:
    """Rule-based probability over patient columns and note flags.

    Terms are added in a fixed order; the sum is compared with tier limits in
    binary floating point.
    """

    def known(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(MISSING[name]))

    def points(condition: Column, value: float) -> Column:
        return F.when(condition, F.lit(value)).otherwise(F.lit(0.0))

    stage = F.lit(0.0)
    for name, value in STAGE_RISK.items():
        stage = F.when(known("stage") == name, F.lit(value)).otherwise(stage)
    score = F.lit(BASE_RISK) + stage + known("ecog_score") * F.lit(ECOG_STEP)
    score = score + points(known("age") > OLD_AGE, OLD_AGE_RISK)
    score = score + points(known("anc") < LOW_ANC, LOW_ANC_RISK)
    score = score + points(known("hemoglobin") < LOW_HEMOGLOBIN, LOW_HEMOGLOBIN_RISK)
    score = score + F.col("symptom_count") * F.lit(SYMPTOM_STEP)
    score = score + points(F.col("has_fever").cast("int") == 1, FEVER_RISK)
    score = score + points(F.col("has_infection").cast("int") == 1, INFECTION_RISK)
    return F.greatest(F.lit(0.0), F.least(F.lit(MAX_RISK), score))


def risk_tier(probability: Column, high: float = HIGH_TIER, medium: float = MEDIUM_TIER) -> Column:
    return F.when(probability >= high, "high").when(probability >= medium, "medium").otherwise("low")


def score_patients(
    patients: DataFrame,
    flags: DataFrame | None = None,
    models: RiskModels | None = None,
    model: str | None = None,
    high: float = HIGH_TIER,
    medium: float = MEDIUM_TIER,
) -> DataFrame:
    """Patients with ``risk_probability`` (4 digits), ``risk_tier``, ``model_used``.

    A row the model gives no probability for falls back to the rules.
    """
    scored = join_flags(patients, flags).withColumn("_rules", heuristic_risk())
    if models is None:
        raw, used = F.col("_rules"), F.lit(HEURISTIC)
    else:
        name = model or models.best
        predicted = models.predict(patients, flags, name).withColumnRenamed("probability", "_model")
        scored = scored.join(predicted, "patient_id", "left")
        raw = F.coalesce("_model", "_rules")
        used = F.when(F.col("_model").isNotNull(), name).otherwise(HEURISTIC_FALLBACK)
    return scored.withColumns(
        {"risk_tier": risk_tier(raw, high, medium), "model_used": used, "risk_probability": F.bround(raw, 4)}
    ).drop("_rules", "_model")


def plain_digits(x: Column) -> Column:
    """A double as text without an exponent, for any size a lab value may have."""
    usual = (F.abs(x) >= 1e-3) & (F.abs(x) < 1e7) | (x == 0)
    fixed = F.regexp_replace(F.regexp_replace(x.cast("decimal(38,12)").cast("string"), "0+$", ""), r"\.$", ".0")
    return F.when(usual, x.cast("string")).otherwise(fixed)


def abnormal_labs() -> Column:
    """Texts of the lab values beyond their limit, in fixed order."""

    def finding(lab: str, side: str, limit: float) -> Column:
        beyond = F.col(lab) < limit if side == "below" else F.col(lab) > limit
        text = F.concat(F.lit(f"{lab} "), plain_digits(F.col(lab).cast("double")), F.lit(f" ({side} threshold {limit})"))
        return F.when(beyond, text)

    return F.filter(F.array(*[finding(*row) for row in LAB_LIMITS]), lambda x: x.isNotNull())


def next_step(tier: Column) -> Column:
    out = F.lit(NEXT_STEPS["medium"])
    for name, text in NEXT_STEPS.items():
        out = F.when(tier == name, F.lit(text)).otherwise(out)
    return out


def risk_summary(categories: str = "categories_present") -> Column:
    """Five lines of text over a scored patient row."""

    def listed(values: Column, none: str) -> Column:
        return F.when(F.size(values) > 0, F.array_join(values, ", ")).otherwise(none)

    age = F.coalesce(F.col("age").cast("string"), F.lit("unknown"))
    sex = F.when(F.coalesce("sex", F.lit("M")) == "M", "male").otherwise("female")
    cancer = F.upper(F.replace(F.coalesce("cancer_type", F.lit("cancer")), F.lit("_"), F.lit(" ")))
    treatment = F.replace(F.coalesce("treatment", F.lit("treatment")), F.lit("_"), F.lit("/"))
    symptoms = F.transform(F.array_sort(categories), lambda c: F.replace(c, F.lit("_"), F.lit(" ")))
    percent = F.bround(F.col("risk_probability") * 100, 0).cast("int")
    return F.concat_ws(
        "\n",
        F.format_string(
            "Patient %s: %s-year-old %s with %s, currently on %s.",
            F.coalesce("patient_id", F.lit("")), age, sex, cancer, treatment,
        ),
        F.format_string("Extracted symptoms: %s.", listed(symptoms, "none documented")),
        F.format_string("Laboratory findings: %s.", listed(abnormal_labs(), "within normal limits")),
        F.format_string(
            "Estimated adverse event risk: %d%% (%s tier, model: %s).", percent, F.upper("risk_tier"), F.col("model_used")
        ),
        F.concat(F.lit("Recommended next step: "), next_step(F.col("risk_tier"))),
    )


def summarize_risk(
    patients: DataFrame,
    note_override: str | None = None,
    models: RiskModels | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Symptoms, risk and summary of every patient in one row.

    ``note_override`` names a column whose note, if not empty, replaces the
    patient's own.  The note is read once for all three.
    """
    own = F.nullif(F.col("clinical_note"), F.lit(""))
    note = F.coalesce(F.nullif(F.col(note_override), F.lit("")), own) if note_override else own
    noted = patients.withColumn("clinical_note", F.coalesce(note, F.lit("")))
    mentions = symptom_mentions(noted, ["patient_id"], "clinical_note")
    rolled = note_rollup(noted, mentions, ["patient_id"], tuple(VOCABULARY))
    found = [c for c in rolled.columns if c != "patient_id"]
    rolled = rolled.withColumns({c: F.col(c).cast("int") for c in found if c.startswith("has_")})
    scored = score_patients(noted.drop(*found).join(rolled, "patient_id"), None, models)
    return scored.select(
        "patient_id",
        *keep,
        "categories_present",
        "symptom_count",
        "max_grade",
        "risk_probability",
        "risk_tier",
        "model_used",
        risk_summary().alias("summary"),
        F.lit(SUMMARY_DISCLAIMER).alias("disclaimer"),
    )
