"""Schemas of everything read from storage."""

ONTOLOGY = """
graphs ARRAY<STRUCT<
  nodes: ARRAY<STRUCT<
    id: STRING, type: STRING, lbl: STRING,
    meta: STRUCT<synonyms: ARRAY<STRUCT<pred: STRING, val: STRING>>, definition: STRUCT<val: STRING>>>>,
  edges: ARRAY<STRUCT<sub: STRING, pred: STRING, obj: STRING>>,
  meta: STRUCT<version: STRING>>>
"""

TERMS = "id STRING, label STRING, synonyms ARRAY<STRING>, definition STRING"
TERM_DOCUMENT = (
    "version STRING, term_count INT, "
    "terms ARRAY<STRUCT<id: STRING, label: STRING, synonyms: ARRAY<STRING>, definition: STRING>>"
)
RELEASE = "version STRING, term_count BIGINT"

CUES = "preceding_negations ARRAY<STRING>, following_negations ARRAY<STRING>"

GOLD = "note STRING, expected_mentions ARRAY<STRUCT<text: STRING, hpo_id: STRING, negated: BOOLEAN>>"

CONCEPT_VECTORS = "vector_idx BIGINT, hpo_id STRING, text STRING, embedding ARRAY<FLOAT>"

PATIENTS = """
patient_id STRING, age INT, sex STRING, cancer_type STRING, stage STRING, treatment STRING, cycle_number INT,
ecog_score INT, wbc DOUBLE, anc DOUBLE, hemoglobin DOUBLE, platelets DOUBLE, creatinine DOUBLE, alt DOUBLE,
bilirubin DOUBLE, fatigue_score DOUBLE, nausea_score DOUBLE, pain_score DOUBLE, dyspnea_score DOUBLE,
clinical_note STRING, adverse_event BOOLEAN, ae_type STRING, ae_grade INT
"""
