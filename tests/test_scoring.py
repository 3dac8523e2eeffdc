import pytest
from pyspark.sql import functions as F

from cohortlens.operators import scoring as sc
from cohortlens.operators import validate as va
from cohortlens.sources import schemas

BASE = dict(
    patient_id="A", age=60, sex="F", cancer_type="lung_nsclc", stage="II", treatment="a_b", cycle_number=1, ecog_score=1,
    wbc=5.0, anc=2.0, hemoglobin=12.0, platelets=150.0, creatinine=1.0, alt=20.0, bilirubin=1.0, fatigue_score=0.0,
    nausea_score=0.0, pain_score=0.0, dyspnea_score=0.0, clinical_note=None, adverse_event=False, ae_type=None, ae_grade=None,
)


def patients(spark, *changes):
    rows = [{**BASE, "patient_id": f"P{i}", **c} for i, c in enumerate(changes)]
    columns = [c.split()[0] for c in schemas.PATIENTS.replace("\n", " ").split(",")]
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], schemas.PATIENTS)


def test_rules(spark):
    rows = patients(
        spark,
        dict(stage=None, ecog_score=None, age=None, anc=None, hemoglobin=None),
        dict(stage="IV", ecog_score=3, age=75, anc=0.5, hemoglobin=8.0),
        dict(stage="III", ecog_score=0, age=70, anc=1.0, hemoglobin=10.0),
        dict(stage="I", ecog_score=0, age=40),
    )
    flags = spark.createDataFrame([("P1", 5, True, True)], "patient_id string, symptom_count int, has_fever boolean, has_infection boolean")
    got = [(r.risk_probability, r.risk_tier, r.model_used) for r in sc.score_patients(rows, flags).orderBy("patient_id").collect()]
    assert got == [(0.35, "medium", "heuristic"), (0.99, "high", "heuristic"), (0.36, "medium", "heuristic"), (0.3, "low", "heuristic")]


def test_tier_never_falls_with_probability(spark):
    rank = {"low": 0, "medium": 1, "high": 2}
    rows = spark.range(0, 101).select((F.col("id") / 100).alias("p")).select("p", sc.risk_tier(F.col("p")).alias("t")).orderBy("p").collect()
    tiers = [rank[r.t] for r in rows]
    assert tiers == sorted(tiers) and rows[60].t == "high" and rows[35].t == "medium" and rows[34].t == "low"


def test_labs_are_strict_and_ordered(spark):
    rows = patients(spark, dict(anc=1.0, alt=80.0), dict(anc=0.9, platelets=None, bilirubin=1.6, alt=81.0))
    got = [r[0] for r in rows.orderBy("patient_id").select(sc.abnormal_labs()).collect()]
    assert got == [[], ["anc 0.9 (below threshold 1.0)", "alt 81.0 (above threshold 80.0)", "bilirubin 1.6 (above threshold 1.5)"]]


def test_summary(spark):
    rows = patients(spark, dict(clinical_note="Fever, no pain.", sex="M"), dict(clinical_note="Fever.")).withColumn(
        "other", F.when(F.col("patient_id") == "P1", "Rash.")
    )
    got = {r.patient_id: r for r in sc.summarize_risk(rows, "other").collect()}
    assert got["P0"].summary.split("\n") == [
        "Patient P0: 60-year-old male with LUNG NSCLC, currently on a/b.",
        "Extracted symptoms: fever.",
        "Laboratory findings: within normal limits.",
        "Estimated adverse event risk: 45% (MEDIUM tier, model: heuristic).",
        f"Recommended next step: {sc.NEXT_STEPS['medium']}",
    ]
    assert got["P1"].categories_present == ["rash"]


@pytest.mark.parametrize(
    "change, reasons",
    [
        ({}, []),
        (dict(age=17), ["age"]),
        (dict(age=110, cycle_number=50, ecog_score=4), []),
        (dict(sex="X", stage="V"), ["sex", "stage"]),
        (dict(wbc=-0.1, anc=None), ["wbc", "anc"]),
        (dict(pain_score=None), []),
        (dict(pain_score=10.1), ["pain_score"]),
        (dict(clinical_note="x" * 10_001), ["clinical_note"]),
        (dict(treatment=None), ["treatment"]),
    ],
)
def test_patient_checks(spark, change, reasons):
    checked = va.validate_patients(patients(spark, change))
    assert checked.first().reasons == reasons
    assert va.valid_rows(checked).count() == (not reasons) and va.quarantined_rows(checked).count() == bool(reasons)


def test_note_checks(spark):
    notes = spark.createDataFrame([(None,), ("",), ("x",), ("x" * 10_000,), ("x" * 10_001,)], "text string")
    assert [r.reasons for r in va.validate_notes(notes).collect()] == [["note_missing"], ["note_empty"], [], [], ["note_too_long"]]
    assert [r.reasons for r in va.validate_notes(notes, optional=True).collect()] == [[], [], [], [], ["note_too_long"]]


def test_lab_values_are_told_in_plain_digits(spark):
    df = spark.createDataFrame([(0.0005,), (1e7,), (2.5,), (0.0,), (12345678.25,)], "x double")
    got = [r[0] for r in df.select(sc.plain_digits(F.col("x"))).collect()]
    assert got == ["0.0005", "10000000.0", "2.5", "0.0", "12345678.25"]
