"""Input checks that split a table instead of failing a request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: accepted ranges ---------------------------------------------
MAX_NOTE_CHARS = 10_000
TOP_K_RANGE = (1, 10)
AGE_RANGE = (18, 110)
CYCLE_RANGE = (1, 50)
ECOG_RANGE = (0, 4)
SCORE_RANGE = (0, 10)
LABS = ("wbc", "anc", "hemoglobin", "platelets", "creatinine", "alt", "bilirubin")
SCORES = ("fatigue_score", "nausea_score", "pain_score", "dyspnea_score")
STAGES = ("I", "II", "III", "IV")
SEXES = ("M", "F")
# --------------------------------------------------------------------------------


def check_top_k(top_k: int) -> int:
    low, high = TOP_K_RANGE
    if not low <= top_k <= high:
        raise ValueError(f"top_k must be between {low} and {high}, not {top_k}")
    return top_k


def _reasons(checks: dict[str, Column]) -> Column:
    """Names of the failed checks; a check that is null has failed."""
    found = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()])
    return F.filter(found, lambda r: r.isNotNull())


def validate_notes(notes: DataFrame, text: str = "text", optional: bool = False) -> DataFrame:
    """Adds ``reasons``, empty for a valid row."""
    given = F.col(text).isNotNull()
    long_enough = F.length(text) >= 1
    short_enough = F.length(text) <= MAX_NOTE_CHARS
    if optional:
        return notes.withColumn("reasons", _reasons({"note_too_long": ~given | short_enough}))
    return notes.withColumn(
        "reasons",
        _reasons({"note_missing": given, "note_empty": ~given | long_enough, "note_too_long": ~given | short_enough}),
    )


def validate_patients(patients: DataFrame) -> DataFrame:
    """Adds ``reasons``; a missing symptom score counts as 0, other fields must be set."""
    scored = patients.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in SCORES})
    required = ("patient_id", "cancer_type", "treatment")
    checks = {c: F.col(c).isNotNull() for c in required}
    checks |= {
        "age": F.col("age").between(*AGE_RANGE),
        "sex": F.col("sex").isin(*SEXES),
        "stage": F.col("stage").isin(*STAGES),
        "cycle_number": F.col("cycle_number").between(*CYCLE_RANGE),
        "ecog_score": F.col("ecog_score").between(*ECOG_RANGE),
    }
    checks |= {c: (F.col(c) >= 0) & ~F.isnan(F.col(c).cast("double")) for c in LABS}  # NaN >= 0 holds in Spark
    checks |= {c: F.col(c).between(*SCORE_RANGE) for c in SCORES}
    checks["clinical_note"] = F.col("clinical_note").isNull() | (F.length("clinical_note") <= MAX_NOTE_CHARS)
    return scored.withColumn("reasons", _reasons(checks))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") == 0).drop("reasons")


def quarantined_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") > 0)
