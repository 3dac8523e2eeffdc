"""Patient features: fill, scale, one-hot, weights, splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import stratified_rank

# --- fixed values: feature groups ---------------------------------------------------
NUMERIC = (
    "age", "cycle_number", "ecog_score", "stage_ordinal",
    "wbc", "anc", "hemoglobin", "platelets", "creatinine", "alt", "bilirubin",
    "fatigue_score", "nausea_score", "pain_score", "dyspnea_score",
    "symptom_count",
)
NOTE_FLAGS = (
    "has_fatigue", "has_nausea", "has_fever", "has_neuropathy",
    "has_dyspnea", "has_pain", "has_bleeding", "has_infection",
    "has_thrombosis", "has_pneumonitis", "has_colitis",
    "has_hepatotoxicity", "has_mucositis", "has_neutropenia",
    "has_anemia", "has_thrombocytopenia",
)
DEMOGRAPHIC = ("sex_binary",)
CATEGORICAL = ("cancer_type", "treatment")
STAGE_ORDINALS = {"I": 1, "II": 2, "III": 3, "IV": 4}
STAGE_DEFAULT = 2
TEST_SHARE = 0.20
SEED = 42
# ------------------------------------------------------------------------------------

#: stands for a missing category, which gets a column of its own
NO_CATEGORY = "0"


def stage_ordinal(stage: Column) -> Column:
    pairs = [F.lit(v) for pair in STAGE_ORDINALS.items() for v in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), stage), F.lit(STAGE_DEFAULT))


def sex_binary(sex: Column) -> Column:
    return F.coalesce((sex == "M").cast("int"), F.lit(0))


def join_flags(patients: DataFrame, flags: DataFrame | None, key: str = "patient_id") -> DataFrame:
    """Patients with their note flags; no flags means zeros.

    Flags given twice for a patient count as set, so no patient is doubled.
    """
    names = [*NOTE_FLAGS, "symptom_count"]
    if flags is None:
        return patients.withColumns({c: F.lit(0) for c in names if c not in patients.columns})
    present = [c for c in names if c in flags.columns]
    one_each = flags.groupBy(key).agg(*[F.max(F.col(c).cast("int")).alias(c) for c in present])
    joined = patients.drop(*[c for c in names if c in patients.columns]).join(one_each, key, "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)) if c in present else F.lit(0) for c in names}
    )


def prepare_features(
    patients: DataFrame, flags: DataFrame | None = None, key: str = "patient_id", keep: Sequence[str] = ()
) -> DataFrame:
    """The feature columns, nulls and NaN filled, with ``key`` and the ``keep`` columns."""
    joined = join_flags(patients, flags, key).withColumns(
        {"stage_ordinal": stage_ordinal(F.col("stage")), "sex_binary": sex_binary(F.col("sex"))}
    )
    return joined.select(
        key,
        *keep,
        *[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(0.0)).alias(c) for c in NUMERIC],
        *[F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c) for c in (*NOTE_FLAGS, *DEMOGRAPHIC)],
        *[F.coalesce(c, F.lit(NO_CATEGORY)).alias(c) for c in CATEGORICAL if c not in keep],
    )


# --------------------------------------------------------------------------
# fitted transforms
# --------------------------------------------------------------------------


def fit_scaler(features: DataFrame, columns: Sequence[str] = NUMERIC) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; no spread means no scaling."""
    row = features.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in columns}


def scale_numeric(features: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    return features.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scaler.items()})


#: each category becomes a column
MAX_CATEGORIES = 1000


def fit_categories(features: DataFrame, columns: Sequence[str] = CATEGORICAL) -> dict[str, list[str]]:
    """Sorted categories per column; more than ``MAX_CATEGORIES`` of one column are an error."""
    counts = features.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    wide = [c for c in columns if counts[c] > MAX_CATEGORIES]
    if wide:
        raise ValueError(f"more than {MAX_CATEGORIES} categories: {wide}")
    row = features.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in columns]).first()
    return {c: list(row[c]) for c in columns}


def one_hot(features: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """0/1 columns ``<column>=<value>`` for all but the first category.

    An unseen value is all zeros.
    """
    return features.withColumns(
        {f"{c}={v}": (F.col(c) == v).cast("double") for c, values in categories.items() for v in values[1:]}
    )


@dataclass(frozen=True)
class FeaturePlan:
    """What was fitted on the training rows."""

    scaler: dict[str, tuple[float, float]]
    categories: dict[str, list[str]]

    @classmethod
    def fit(cls, features: DataFrame) -> "FeaturePlan":
        return cls(fit_scaler(features), fit_categories(features))

    @property
    def columns(self) -> list[str]:
        # in the order of CATEGORICAL, whatever order the plan was stored in
        hot = [f"{c}={v}" for c in CATEGORICAL for v in self.categories.get(c, ())[1:]]
        return [*NUMERIC, *hot, *NOTE_FLAGS, *DEMOGRAPHIC]

    def assemble(self, features: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` columns and the ``features`` vector."""
        wide = one_hot(scale_numeric(features, self.scaler), self.categories)
        # the assembler reads plain names only
        plain = wide.select(*keep, *[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(self.columns)])
        inputs = [f"f{i}" for i in range(len(self.columns))]
        return VectorAssembler(inputCols=inputs, outputCol="features").transform(plain).select(*keep, "features")


# --------------------------------------------------------------------------
# weights and splits
# --------------------------------------------------------------------------


def class_weights(labelled: DataFrame, label: str) -> DataFrame:
    """One row: balanced weight of each class and the positive weight for trees."""
    pos, n = F.sum(F.col(label).cast("bigint")), F.count(label)
    return labelled.agg(pos.alias("n_pos"), (n - pos).alias("n_neg")).select(
        "n_pos",
        "n_neg",
        F.try_divide(F.col("n_pos") + F.col("n_neg"), 2 * F.col("n_pos")).alias("weight_pos"),
        F.try_divide(F.col("n_pos") + F.col("n_neg"), 2 * F.col("n_neg")).alias("weight_neg"),
        F.greatest(F.lit(1.0), F.col("n_neg") / F.greatest(F.lit(1), F.col("n_pos"))).alias("tree_weight_pos"),
    )


def stratified_split(
    df: DataFrame, label: str, key: str = "patient_id", share: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Adds ``split`` (``test`` or ``train``), the same share of every class."""
    ranked = stratified_rank(df, [label], key, seed)
    test = F.col("stratum_rank") <= F.round(F.col("stratum_size") * share)
    return ranked.withColumn("split", F.when(test, "test").otherwise("train")).drop("stratum_rank", "stratum_size")


def split_flags(flags: DataFrame, side: DataFrame, key: str = "patient_id") -> DataFrame:
    return flags.join(side.select(key), key, "left_semi")


def stratified_folds(
    df: DataFrame, label: str, folds: int, key: str = "patient_id", seed: int = SEED, name: str = "fold"
) -> DataFrame:
    """Adds a fold number; every class is dealt out evenly."""
    ranked = stratified_rank(df, [label], key, seed)
    return ranked.withColumn(name, ((F.col("stratum_rank") - 1) % folds).cast("int")).drop("stratum_rank", "stratum_size")
