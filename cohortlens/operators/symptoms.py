"""Symptom categories: mentions, severity grade and per-note roll-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.layout import tasks_by_key
from .negation import MENTION, cue_table, flag_negated
from .text import compile_lexicon, match_phrases, phrase_table, resolve_overlaps

# --- fixed values: symptom vocabulary ----------------------------------------
VOCABULARY: dict[str, list[str]] = {
    "fatigue": [
        "fatigue", "asthenia", "tiredness", "lethargy", "exhaustion", "weakness", "generalized weakness",
        "cancer-related fatigue", "treatment-related fatigue",
    ],
    "nausea": ["nausea", "nauseous", "queasiness", "queasy", "chemotherapy-induced nausea", "CINV"],
    "vomiting": ["vomiting", "emesis", "retching", "throwing up", "chemotherapy-induced vomiting"],
    "fever": ["fever", "pyrexia", "febrile", "high temperature", "elevated temperature", "hyperthermia"],
    "neuropathy": [
        "peripheral neuropathy", "neuropathy", "paresthesia", "paresthesias", "numbness", "tingling",
        "pins and needles", "burning sensation in hands", "burning sensation in feet",
        "chemotherapy-induced neuropathy", "CIPN", "sensory neuropathy", "motor neuropathy",
    ],
    "dyspnea": [
        "dyspnea", "shortness of breath", "SOB", "breathlessness", "difficulty breathing",
        "respiratory distress", "air hunger", "exertional dyspnea",
    ],
    "pain": [
        "pain", "painful", "aching", "burning pain", "nociceptive pain", "neuropathic pain", "cancer pain",
        "treatment-related pain",
    ],
    "bleeding": [
        "bleeding", "hemorrhage", "haemorrhage", "hematuria", "haematuria", "hemoptysis", "haemoptysis",
        "epistaxis", "bruising", "ecchymosis", "petechiae", "purpura", "blood in urine",
    ],
    "infection": [
        "infection", "sepsis", "febrile neutropenia", "bacteremia", "bacteraemia", "cellulitis", "pneumonia",
        "urinary tract infection", "fungal infection", "opportunistic infection",
    ],
    "thrombosis": [
        "thrombosis", "deep vein thrombosis", "DVT", "pulmonary embolism", "PE", "venous thromboembolism",
        "VTE", "blood clot", "thrombus", "clot",
    ],
    "pneumonitis": [
        "pneumonitis", "checkpoint pneumonitis", "immune-related pneumonitis", "interstitial lung disease",
        "ILD", "radiation pneumonitis", "drug-induced pneumonitis",
    ],
    "colitis": [
        "colitis", "immune-related colitis", "checkpoint colitis", "immunotherapy-related colitis", "diarrhea",
        "diarrhoea", "loose stools", "watery stools",
    ],
    "hepatotoxicity": [
        "hepatotoxicity", "elevated liver enzymes", "transaminase elevation", "elevated ALT", "elevated AST",
        "hepatitis", "jaundice", "drug-induced hepatitis", "immune-related hepatitis",
    ],
    "mucositis": [
        "mucositis", "oral mucositis", "stomatitis", "mouth sores", "mouth ulcers", "mucosal inflammation",
        "oral ulceration",
    ],
    "alopecia": ["alopecia", "hair loss", "hair thinning", "chemotherapy-induced alopecia"],
    "rash": [
        "rash", "skin rash", "dermatitis", "pruritus", "itching", "urticaria", "hives", "maculopapular rash",
        "immune-related rash", "checkpoint rash",
    ],
    "neutropenia": [
        "neutropenia", "low neutrophils", "febrile neutropenia", "grade 3 neutropenia", "grade 4 neutropenia",
        "neutrophil count low",
    ],
    "anemia": [
        "anemia", "anaemia", "low hemoglobin", "low haemoglobin", "low Hgb", "hemoglobin low",
        "treatment-related anemia",
    ],
    "thrombocytopenia": [
        "thrombocytopenia", "low platelets", "platelet count low", "platelet count reduced",
        "thrombocytopenic",
    ],
}
# --- fixed values: grade words and the context they are looked for in ----------
GRADE_WORDS = {1: "mild", 2: "moderate", 3: "severe", 4: "life[ -]?threatening"}
GRADE_CONTEXT = 150
# ------------------------------------------------------------------------------


def vocabulary(spark: SparkSession, extra: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """The vocabulary as ``kind, category, phrase`` rows, with extra categories."""
    table = phrase_table(spark, VOCABULARY, MENTION)
    return table.unionByName(phrase_table(spark, extra, MENTION)).dropDuplicates() if extra else table


def grade_pattern(grade: int) -> str:
    """Java pattern of one grade; letters, digits and _ delimit words."""
    return (
        r"(?i)(?<![\p{L}\p{N}_])(?:"
        + f"{GRADE_WORDS[grade]}|grade[ -]?{grade}|ctcae[ -]?grade[ -]?{grade}"
        + r")(?![\p{L}\p{N}_])"
    )


def infer_grade(context: str) -> Column:
    """Highest grade named in a context column, null if none.

    A plain search for the words spares most contexts the pattern.
    """
    low = F.lower(context)

    def named(grade: int) -> Column:
        word = F.lit(GRADE_WORDS[grade].split("[")[0])
        return (F.contains(low, word) | F.contains(low, F.lit("grade"))) & F.regexp_like(context, F.lit(grade_pattern(grade)))

    return F.coalesce(*[F.when(named(g), F.lit(g)) for g in (4, 3, 2, 1)])


def symptom_mentions(
    notes: DataFrame,
    keys: Sequence[str],
    text: str,
    vocab: DataFrame | None = None,
    cues: DataFrame | None = None,
    apply_negation: bool = True,
    with_grade: bool = True,
) -> DataFrame:
    """Category mentions: ``category, start, end, text, n_tokens, grade, negated``.

    Overlaps are resolved within each category, then over all; one span may
    stay under two categories.  The text is scanned once for vocabulary and
    cues together, and the hits are shuffled once.
    """
    spark = notes.sparkSession
    rows = (vocab if vocab is not None else vocabulary(spark)).select("kind", "category", "phrase")
    if apply_negation:
        rows = rows.unionByName((cues if cues is not None else cue_table(spark)).select("kind", "category", "phrase"))
    hits = match_phrases(notes, compile_lexicon(rows), keys, text, context_chars=GRADE_CONTEXT if with_grade else 0)
    grade = F.when(F.col("kind") == MENTION, infer_grade("context")) if with_grade else F.lit(None).cast("int")
    events = tasks_by_key(hits.withColumn("grade", grade).drop("context"), keys, notes)
    if apply_negation:
        found = flag_negated(events, keys)
    else:
        found = events.drop("kind", "sentence", "split").withColumn("negated", F.lit(False))
    return resolve_overlaps(found, keys, within="category")


def note_rollup(
    notes: DataFrame, mentions: DataFrame, keys: Sequence[str], categories: Sequence[str] = tuple(VOCABULARY)
) -> DataFrame:
    """Per note: confirmed categories, their count, the highest grade, flags.

    ``categories_present`` is sorted; every note of the input has a row.
    """
    confirmed = mentions.where(~F.col("negated"))
    per_note = confirmed.groupBy(*keys).agg(
        F.array_sort(F.collect_set("category")).alias("categories_present"),
        F.max("grade").alias("max_grade"),
        *[F.bool_or(F.col("category") == c).alias(f"has_{c}") for c in categories],
    )
    return (
        notes.select(*keys)
        .join(per_note, list(keys), "left")
        .select(
            *keys,
            F.coalesce("categories_present", F.array().cast("array<string>")).alias("categories_present"),
            F.coalesce(F.size(F.when(F.col("categories_present").isNotNull(), F.col("categories_present"))), F.lit(0)).alias("symptom_count"),
            "max_grade",
            *[F.coalesce(f"has_{c}", F.lit(False)).alias(f"has_{c}") for c in categories],
        )
    )


def batch_flags(
    patients: DataFrame,
    key: str = "patient_id",
    text: str = "clinical_note",
    apply_negation: bool = False,
    categories: Sequence[str] = tuple(VOCABULARY),
) -> DataFrame:
    """The roll-up as 0/1 columns for a feature table, one row per patient."""
    found = symptom_mentions(patients, [key], text, apply_negation=apply_negation, with_grade=False)
    rolled = note_rollup(patients, found, [key], categories)
    return rolled.select(key, "symptom_count", *[F.col(f"has_{c}").cast("int").alias(f"has_{c}") for c in categories])
