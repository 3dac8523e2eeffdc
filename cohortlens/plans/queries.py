"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .. import sources
from ..functions.layout import fill_cores
from ..functions.storage import new_folder, staged
from ..operators import evaluation as ev
from ..operators import features as ft
from ..operators import mapping as mp
from ..operators import models as md
from ..operators import negation as ng
from ..operators import ontology as on
from ..operators import scoring as sc
from ..operators import symptoms as sy
from ..operators import text as tx
from ..operators import validate as va
from ..sources import schemas
from ..streaming import stream_concepts, stream_phenotypes, stream_risk
from . import derived as d
from .jobs import train_report

Query = Callable[[SparkSession, str], DataFrame]

#: words that occur in the documents, some inside others
DOC_TERMS = {
    "english": ["the", "the the", "of the", "in the", "to the", "that the", "is the", "the and"],
    "linking": ["the of", "of and", "and the", "of", "and"],
    "french": ["de la", "la", "le de", "et"],
    "german": ["der", "der der", "und die", "die"],
}
DOC_CUES = ["with", "for the", "que", "das", "no"]
CHAT_CUES = ["that", "que le", "nicht"]
EXTRA_VOCABULARY = {"labs": ["labs reviewed", "hémoglobine"], "fever": ["temp"]}


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return fill_cores(d.table(spark, sf, "documents").select("doc_id", "text"))


def _notes(spark: SparkSession, sf: str) -> DataFrame:
    return fill_cores(d.notes(spark, sf))


def _doc_lexicon(spark: SparkSession) -> DataFrame:
    return tx.phrase_table(spark, DOC_TERMS, tx.MENTION_KIND)


def _spans(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in ("start", "end", "text")], F.col("start").alias("s"), F.col("end").alias("e"), F.col("text").alias("mention"))


# ---- text -----------------------------------------------------------------------


def tokenize_docs(spark: SparkSession, sf: str) -> DataFrame:
    # texts are laid out by key, since their tokens would take much more room in an exchange
    docs = d.table(spark, sf, "documents").select("doc_id", "text").repartition("doc_id")
    return tx.tokenize(docs, ["doc_id"], "text").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.count_distinct("token").alias("n_distinct"),
        F.sum(F.col("start").cast("bigint")).alias("start_sum"),
        F.sum(F.col("end").cast("bigint")).alias("end_sum"),
    )


def match_terms_docs(spark: SparkSession, sf: str) -> DataFrame:
    found = tx.find_mentions(_docs(spark, sf), tx.compile_lexicon(_doc_lexicon(spark)), ["doc_id"], "text")
    return _spans(found).select("doc_id", "s", "e", "mention")


def match_categories_docs(spark: SparkSession, sf: str) -> DataFrame:
    found = sy.symptom_mentions(_docs(spark, sf), ["doc_id"], "text", vocab=_doc_lexicon(spark), apply_negation=False, with_grade=False)
    return _spans(found).select("doc_id", "category", "s", "e", "mention")


def negate_docs(spark: SparkSession, sf: str) -> DataFrame:
    found = ng.negated_mentions(_docs(spark, sf), _doc_lexicon(spark), ng.custom_cues(spark, DOC_CUES), ["doc_id"], "text")
    return _spans(found).select("doc_id", "s", "e", "negated")


def _chat(spark: SparkSession, sf: str) -> DataFrame:
    return fill_cores(
        d.table(spark, sf, "conversations").select((F.col("conv_id") * 100000 + F.col("turn")).alias("msg_id"), "text")
    )


def custom_cues_chat(spark: SparkSession, sf: str) -> DataFrame:
    found = ng.negated_mentions(_chat(spark, sf), _doc_lexicon(spark), ng.custom_cues(spark, CHAT_CUES), ["msg_id"], "text")
    return _spans(found).select("msg_id", "s", "e", "mention", "negated")


def align_spans(spark: SparkSession, sf: str) -> DataFrame:
    docs = d.table(spark, sf, "documents")
    far = F.floor(F.col("n_chars") * 2 / 3).cast("int")
    spans = docs.select(
        "doc_id",
        F.inline(
            F.array(
                F.struct((F.col("n_chars") % 97).cast("int").alias("start"), (F.col("n_chars") % 97 + 1 + F.col("n_chars") % 13).cast("int").alias("end")),
                F.struct(far.alias("start"), (far + 5).alias("end")),
            )
        ),
    )
    found = ng.align_spans(_docs(spark, sf), spans, ["doc_id"], "text")
    return found.select("doc_id", F.col("start").alias("s"), F.col("end").alias("e"), "token_start", "token_end", "n_tokens")


def negate_spans(spark: SparkSession, sf: str) -> DataFrame:
    notes = _notes(spark, sf)
    spans = notes.where(F.length("clinical_note") > 0).select(
        "patient_id", (F.length("clinical_note") % 23).alias("start"), (F.length("clinical_note") % 23 + 6).alias("end")
    )
    found = ng.negate_spans(notes, spans, ng.cue_table(spark), ["patient_id"], "clinical_note")
    return found.select("patient_id", F.col("start").alias("s"), F.col("end").alias("e"), "token_start", "token_end", "negated")


def _symptoms(spark: SparkSession, sf: str, **how) -> tuple[DataFrame, DataFrame]:
    notes = _notes(spark, sf)
    return notes, sy.symptom_mentions(notes, ["patient_id"], "clinical_note", **how)


def symptom_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return _spans(_symptoms(spark, sf)[1]).select("patient_id", "category", "s", "e", "mention", "grade", "negated")


def infer_grade(spark: SparkSession, sf: str) -> DataFrame:
    return _spans(_symptoms(spark, sf, apply_negation=False)[1]).select("patient_id", "category", "s", "grade")


def _flat_rollup(rolled: DataFrame) -> DataFrame:
    return rolled.withColumn("categories_present", F.array_join("categories_present", ","))


def note_rollup(spark: SparkSession, sf: str) -> DataFrame:
    notes, found = _symptoms(spark, sf)
    return _flat_rollup(sy.note_rollup(notes, found, ["patient_id"]))


def extend_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    vocab = tx.extend_vocabulary(sy.vocabulary(spark), tx.phrase_table(spark, EXTRA_VOCABULARY, tx.MENTION_KIND))
    notes, found = _symptoms(spark, sf, vocab=vocab)
    rolled = sy.note_rollup(notes, found, ["patient_id"], categories=[*sy.VOCABULARY, "labs"])
    return _flat_rollup(rolled).select("patient_id", "categories_present", "symptom_count", "has_fever", "has_labs")


def batch_flags(spark: SparkSession, sf: str) -> DataFrame:
    return sy.batch_flags(_notes(spark, sf))


# ---- mapping ----------------------------------------------------------------------


def _concepts(spark: SparkSession, sf: str) -> DataFrame:
    return d.derive(spark, sf, d.CONCEPTS_SQL, "embeddings")


def _vector_queries(spark: SparkSession, sf: str) -> DataFrame:
    return _concepts(spark, sf).select(F.col("text").alias("mention_text"), "embedding")


def normalize_vectors(spark: SparkSession, sf: str) -> DataFrame:
    doubled = d.table(spark, sf, "embeddings").withColumn("embedding", F.transform("embedding", lambda x: x * 2))
    return mp.normalize_vectors(doubled).select("vec_id", F.posexplode_outer("embedding").alias("i", "x")).select(
        "vec_id", "i", F.round(F.col("x").cast("double"), 5).alias("x")
    )


def nearest(spark: SparkSession, sf: str) -> DataFrame:
    return mp.nearest(_vector_queries(spark, sf), _concepts(spark, sf)).select(
        "mention_text", "vector_idx", "score"
    )


def dedupe_concepts(spark: SparkSession, sf: str) -> DataFrame:
    hits = mp.nearest(_vector_queries(spark, sf), _concepts(spark, sf))
    return mp.dedupe_concepts(hits).select("mention_text", "hpo_id", "hpo_label", "score")


def _candidates(spark: SparkSession, sf: str, top_k: int) -> DataFrame:
    return mp.find_candidates(_vector_queries(spark, sf), _concepts(spark, sf), top_k)


def rank_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return _candidates(spark, sf, 10)


def confidence_band(spark: SparkSession, sf: str) -> DataFrame:
    return _candidates(spark, sf, 10).select(
        "mention_text", "rank", mp.confidence_band(F.col("confidence")).alias("band")
    )


def _vector_mentions(spark: SparkSession, sf: str) -> DataFrame:
    """A mention per vector; every third has a text no vector stands for."""
    return d.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("note_id"),
        F.when(F.col("vec_id") % 3 == 0, "unmapped").otherwise(F.concat(F.lit("term "), F.col("vec_id").cast("string"))).alias("text"),
        F.lit(0).alias("start"),
        F.lit(4).alias("end"),
        (F.col("vec_id") % 4 == 0).alias("negated"),
    )


def map_mentions(spark: SparkSession, sf: str) -> DataFrame:
    mapped = mp.map_mentions(_vector_mentions(spark, sf), _candidates(spark, sf, 3), ["note_id"])
    return mapped.select(
        "note_id", "text", "hpo_id", "hpo_label", "confidence", "negated",
        F.coalesce(F.size("candidates"), F.lit(0)).alias("n_candidates"),
        F.coalesce(F.array_join(F.col("candidates.hpo_id"), ","), F.lit("")).alias("candidate_ids"),
    )


def empty_index(spark: SparkSession, sf: str) -> DataFrame:
    none = _concepts(spark, sf).where(F.col("embedding").isNull())
    candidates = mp.find_candidates(_vector_queries(spark, sf), none)
    mapped = mp.map_mentions(_vector_mentions(spark, sf), candidates, ["note_id"])
    return mapped.select("note_id", "text", "hpo_id", "hpo_label", "confidence")


def term_digest(spark: SparkSession, sf: str) -> DataFrame:
    mentions = _vector_mentions(spark, sf)
    mapped = mp.map_mentions(mentions, _candidates(spark, sf, 3), ["note_id"])
    return mp.term_digest(mentions.select("note_id"), mapped, ["note_id"])


def hashed_vectors(spark: SparkSession, sf: str) -> DataFrame:
    texts = fill_cores(d.table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("text")))
    return (
        mp.hashed_vectors(texts)
        .select("p_partkey", F.posexplode_outer("embedding").alias("bucket", "x"))
        .where(F.col("x") != 0)
        .select("p_partkey", "bucket", F.round(F.col("x").cast("double"), 5).alias("x"))
    )


def _note_concepts(spark: SparkSession) -> DataFrame:
    """Vocabulary phrases as concept texts, an id per category."""
    rows = [
        {"vector_idx": c * 100 + i, "hpo_id": f"C:{c:03d}", "text": p}
        for c, ps in enumerate(sy.VOCABULARY.values())
        for i, p in enumerate(ps)
    ]
    return tx.constant_table(spark, rows, "vector_idx bigint, hpo_id string, text string")


def _flat_enriched(found: DataFrame) -> DataFrame:
    return _spans(found).select(
        "patient_id", "s", "e", "mention", "negated", "hpo_id", "hpo_label", "confidence",
        F.array_join(F.col("candidates.hpo_id"), ",").alias("candidate_ids"),
    )


def enrich_notes(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_enriched(mp.enrich_notes(_notes(spark, sf), _note_concepts(spark), ["patient_id"], "clinical_note"))


# ---- ontology ----------------------------------------------------------------------


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return d.derive(spark, sf, d.EDGES_SQL, "part")


def _nodes(spark: SparkSession, sf: str) -> DataFrame:
    flat = d.derive(spark, sf, d.NODES_SQL, "part")
    synonyms = F.transform(F.split("syn", r"\|"), lambda v: F.struct(F.lit("hasExactSynonym").alias("pred"), v.alias("val")))
    return flat.select("ord", "id", "type", "lbl", F.struct(synonyms.alias("synonyms"), F.when(F.col("def").isNotNull(), F.struct(F.col("def").alias("val"))).alias("definition")).alias("meta"))


def _terms(spark: SparkSession, sf: str) -> DataFrame:
    return on.build_terms(_nodes(spark, sf), on.subtree(_edges(spark, sf), d.GRAPH_ROOT))


def node_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _nodes(spark, sf).select("ord", on.node_id(F.col("id")).alias("hpo_id"))


def release_version(spark: SparkSession, sf: str) -> DataFrame:
    base = "http://purl.obolibrary.org/obo/hp/releases/2024-04-"
    url = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit(base), F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0"), F.lit("/hp.json"))).when(
        F.col("n_nationkey") % 3 == 1, F.concat(F.lit("local-"), F.col("n_name"))
    )
    return d.table(spark, sf, "nation").select("n_nationkey", on.release_version(url).alias("version"))


def subtree(spark: SparkSession, sf: str) -> DataFrame:
    return on.subtree(_edges(spark, sf), d.GRAPH_ROOT)


def build_terms(spark: SparkSession, sf: str) -> DataFrame:
    return _terms(spark, sf).select("id", "label", F.array_join("synonyms", "|").alias("synonyms"), "definition")


def label_synonym_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return on.label_synonym_pairs(_terms(spark, sf))


def lookup_term(spark: SparkSession, sf: str) -> DataFrame:
    wanted = d.table(spark, sf, "part").select(F.concat(F.lit("HP:"), F.lpad(F.col("p_partkey").cast("string"), 7, "0")).alias("hpo_id"))
    return on.lookup_terms(wanted, _terms(spark, sf)).select("hpo_id", "label", "definition")


def ontology_stats(spark: SparkSession, sf: str) -> DataFrame:
    version = _edges(spark, sf).agg(F.lit("http://purl.obolibrary.org/obo/hp/releases/2024-04-26/hp.json").alias("version_url"))
    return on.ontology_stats(_terms(spark, sf), version)


# ---- validation -----------------------------------------------------------------------


def validate_notes(spark: SparkSession, sf: str) -> DataFrame:
    return va.validate_notes(_docs(spark, sf)).select("doc_id", F.array_join("reasons", ",").alias("reasons"))


def validate_patients(spark: SparkSession, sf: str) -> DataFrame:
    return va.validate_patients(d.patients(spark, sf)).select("patient_id", F.array_join("reasons", ",").alias("reasons"))


# ---- features -------------------------------------------------------------------------


def _flags(spark: SparkSession, sf: str) -> DataFrame:
    return sy.batch_flags(_notes(spark, sf), apply_negation=True)


def _prepared(spark: SparkSession, sf: str) -> DataFrame:
    return ft.prepare_features(d.patients(spark, sf), _flags(spark, sf))


def features(spark: SparkSession, sf: str) -> DataFrame:
    return _prepared(spark, sf)


def scale_numeric(spark: SparkSession, sf: str) -> DataFrame:
    prepared = ft.prepare_features(d.patients(spark, sf))
    scaled = ft.scale_numeric(prepared, ft.fit_scaler(prepared))
    return scaled.select("patient_id", *[F.round(c, 6).alias(c) for c in ft.NUMERIC])


def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    prepared = ft.prepare_features(d.patients(spark, sf))
    fitted = ft.fit_categories(prepared.where(F.col("treatment") != "imatinib"))
    hot = [c for c in ft.one_hot(prepared, fitted).columns if "=" in c]
    return ft.one_hot(prepared, fitted).select(
        "patient_id", *[F.col(f"`{c}`").cast("int").alias(c.replace("=", "_")) for c in hot]
    )


def assemble(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    prepared = ft.prepare_features(d.patients(spark, sf))
    vectors = ft.FeaturePlan.fit(prepared).assemble(prepared, ["patient_id"])
    values = vector_to_array("features")
    return vectors.select(
        "patient_id", F.size(values).alias("n_features"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 5).alias("feature_sum"),
    )


def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return ft.class_weights(d.patients(spark, sf), "adverse_event")


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return ft.stratified_split(d.patients(spark, sf), "adverse_event").select("patient_id", "split")


def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    return ft.stratified_folds(d.patients(spark, sf), "adverse_event", md.CV_FOLDS).select("patient_id", "fold")


def split_flags(spark: SparkSession, sf: str) -> DataFrame:
    split = ft.stratified_split(d.patients(spark, sf), "adverse_event")
    flags = sy.batch_flags(_notes(spark, sf))
    return ft.split_flags(flags, split.where(F.col("split") == "test")).select("patient_id", "symptom_count")


# ---- models ---------------------------------------------------------------------------


def _labelled(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    split = staged(ft.stratified_split(d.patients(spark, sf), "adverse_event"), "split")
    return split, staged(_flags(spark, sf), "flags")


def _test_scores(spark: SparkSession, sf: str, fits: dict, model: str) -> DataFrame:
    split, flags = _labelled(spark, sf)
    models = md.train_models(split.where(F.col("split") == "train"), flags, fits=fits)
    return models.predict(split.where(F.col("split") == "test"), flags, model).select(
        "patient_id", F.round("probability", 6).alias("probability")
    )


def fit_logistic(spark: SparkSession, sf: str) -> DataFrame:
    """Uncalibrated logistic probabilities of the test rows."""
    split, flags = _labelled(spark, sf)
    prepared = ft.prepare_features(split.withColumn("label", F.col("adverse_event").cast("double")), flags, keep=["label", "split"])
    train = prepared.where(F.col("split") == "train")
    plan = ft.FeaturePlan.fit(train)
    model = md.fit_logistic(plan.assemble(train, ["patient_id", "label"]))
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(plan.assemble(prepared.where(F.col("split") == "test"), ["patient_id"]))
    return scored.select("patient_id", F.round(vector_to_array("probability")[1], 6).alias("probability"))


def fit_boosted(spark: SparkSession, sf: str) -> DataFrame:
    return _test_scores(spark, sf, {md.BOOSTED: md.fit_boosted}, md.BOOSTED)


def calibrate_isotonic(spark: SparkSession, sf: str) -> DataFrame:
    return _test_scores(spark, sf, {md.LOGISTIC: md.fit_logistic}, md.LOGISTIC)


def predict_ensemble(spark: SparkSession, sf: str) -> DataFrame:
    return _test_scores(spark, sf, {md.LOGISTIC: md.fit_logistic, md.BOOSTED: md.fit_boosted}, md.ENSEMBLE)


def stratified_cv(spark: SparkSession, sf: str) -> DataFrame:
    split, flags = _labelled(spark, sf)
    return md.cv_summary(md.stratified_cv(split.where(F.col("split") == "train"), flags))


def save_load_model(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of a model before and after a round trip through storage."""
    split, flags = _labelled(spark, sf)
    models = md.train_models(split.where(F.col("split") == "train"), flags, fits={md.LOGISTIC: md.fit_logistic})
    path = new_folder(spark, "model")
    models.save(spark, path)
    loaded = md.RiskModels.load(spark, path)
    test = split.where(F.col("split") == "test")
    before = models.predict(test, flags).withColumnRenamed("probability", "before")
    after = loaded.predict(test, flags).withColumnRenamed("probability", "after")
    return before.join(after, "patient_id").select("patient_id", F.round("after", 6).alias("probability"), (F.col("before") == F.col("after")).alias("same"))


def score_patients_model(spark: SparkSession, sf: str) -> DataFrame:
    split, flags = _labelled(spark, sf)
    models = md.train_models(split.where(F.col("split") == "train"), flags, fits={md.LOGISTIC: md.fit_logistic})
    return sc.score_patients(split, flags, models).select("patient_id", "risk_probability", "risk_tier", "model_used")


# what holds for fitted models whatever their numbers are, and what SQL can count


def logistic_gradient(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the penalised loss is flat at the fitted coefficients, feature by feature."""
    from pyspark.ml.functions import vector_to_array

    split, flags = _labelled(spark, sf)
    train = ft.prepare_features(split.where(F.col("split") == "train").withColumn("label", F.col("adverse_event").cast("double")), flags, keep=["label"])
    plan = ft.FeaturePlan.fit(train)
    rows = staged(plan.assemble(train, ["label"]), "rows")
    model, w = md.fit_logistic(rows), ft.class_weights(rows, "label").first()
    weight = F.when(F.col("label") == 1, F.lit(w["weight_pos"])).otherwise(F.lit(w["weight_neg"]))
    gap = weight * (vector_to_array("probability")[1] - F.col("label"))
    x = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
    sums = model.transform(rows).select(gap.alias("gap"), F.posexplode(x).alias("at", "x")).groupBy("at").agg(
        F.sum(F.col("gap") * F.col("x")).alias("slope"), F.sum(F.abs(F.col("gap") * F.col("x"))).alias("size")
    )
    named = [(i, c, float(b) / md.LOGISTIC_C) for i, (c, b) in enumerate(zip(plan.columns, model.coefficients.toArray(), strict=True))]
    names = spark.createDataFrame([*named, (len(named), "intercept", 0.0)], "at int, feature string, pull double")
    flat = F.abs(F.col("slope") + F.col("pull")) <= 1e-3 * (F.col("size") + F.abs("pull")) + 1e-6
    return names.join(sums, "at").select("feature", flat.alias("flat"))


def _calibrated(spark: SparkSession, sf: str, name: str, fit) -> tuple[md.CalibratedModel, DataFrame]:
    """A calibrated model of the training rows, and these rows with their folds."""
    split, flags = _labelled(spark, sf)
    train = ft.prepare_features(split.where(F.col("split") == "train").withColumn("label", F.col("adverse_event").cast("double")), flags, keep=["label"])
    rows = staged(ft.FeaturePlan.fit(train).assemble(train, ["patient_id", "label"]), "rows")
    return md.calibrate_isotonic(rows, fit), ft.stratified_folds(rows, "label", md.CALIBRATION_FOLDS)


def boosted_losses(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the training loss of each fold's trees falls in each round."""
    model, _ = _calibrated(spark, sf, md.BOOSTED, md.fit_boosted)
    rows = [(k, r, b < a) for k, (trees, _) in enumerate(model.pairs) for r, (a, b) in enumerate(zip(trees.losses, trees.losses[1:]), 1)]
    return spark.createDataFrame(rows, "fold int, round int, falls boolean")


def isotonic_folds(spark: SparkSession, sf: str) -> DataFrame:
    """An isotonic map keeps the number of events of the rows it was fitted on, and never falls."""
    model, dealt = _calibrated(spark, sf, md.LOGISTIC, md.fit_logistic)
    out = None
    for k in range(len(model.pairs)):
        one = md.CalibratedModel(model.pairs[k : k + 1]).predict(dealt.where(F.col("fold") == k))
        part = one.groupBy("fold").agg(
            F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("events"), F.bround(F.sum("probability"), 6).alias("expected_events")
        ).withColumn("rising", F.lit(bool((np.diff(model.pairs[k][1].predictions.toArray()) >= 0).all())))
        out = part if out is None else out.unionByName(part)
    return out


def models_survive_storage(spark: SparkSession, sf: str) -> DataFrame:
    return save_load_model(spark, sf).select("patient_id", "same")


def model_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """Every patient is scored by the model, and tiered by its probability."""
    scored = score_patients_model(spark, sf)
    fits = sc.risk_tier(F.col("risk_probability")) == F.col("risk_tier")
    near = F.exists(F.array(*map(F.lit, (sc.HIGH_TIER, sc.MEDIUM_TIER))), lambda t: F.abs(F.col("risk_probability") - t) < 1e-4)  # rounded
    return scored.select("patient_id", "model_used", F.col("risk_probability").between(0, 1).alias("is_share"), (fits | near).alias("tier_fits"))


# ---- scoring --------------------------------------------------------------------------


def heuristic_risk(spark: SparkSession, sf: str) -> DataFrame:
    return sc.score_patients(d.patients(spark, sf), _flags(spark, sf)).select(
        "patient_id", "risk_probability", "risk_tier", "model_used"
    )


def abnormal_labs(spark: SparkSession, sf: str) -> DataFrame:
    return d.patients(spark, sf).select("patient_id", F.array_join(sc.abnormal_labs(), ", ").alias("labs"))


def summarize_risk(spark: SparkSession, sf: str) -> DataFrame:
    return sc.summarize_risk(d.patients(spark, sf)).withColumn("categories_present", F.array_join("categories_present", ","))


def risk_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Every fourth patient's note is replaced by the one of another column."""
    override = F.when(F.substring("patient_id", -1, 1).isin("0", "4", "8"), F.concat(F.lit("No pain. Severe rash on arm "), F.col("age").cast("string")))
    noted = d.patients(spark, sf).withColumn("given_note", override)
    return sc.summarize_risk(noted, "given_note").select("patient_id", "summary")


# ---- evaluation -----------------------------------------------------------------------


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return d.derive(spark, sf, d.SCORES_SQL, "documents", "labels")


def auroc(spark: SparkSession, sf: str) -> DataFrame:
    return ev.auroc(_scores(spark, sf)).select(F.round("auroc", 9).alias("auroc"))


def auprc(spark: SparkSession, sf: str) -> DataFrame:
    return ev.auprc(_scores(spark, sf)).select(F.round("auprc", 9).alias("auprc"))


def brier(spark: SparkSession, sf: str) -> DataFrame:
    return ev.brier(_scores(spark, sf), y="toxic").select(F.round("brier", 9).alias("brier"))


def calibration_curve(spark: SparkSession, sf: str) -> DataFrame:
    return ev.calibration_curve(_scores(spark, sf)).select(
        "bin", F.round("fraction_positive", 9).alias("fraction_positive"), F.round("mean_predicted", 9).alias("mean_predicted"), "n"
    )


def threshold_table(spark: SparkSession, sf: str) -> DataFrame:
    return ev.threshold_table(_scores(spark, sf))


def best_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return ev.best_threshold(ev.threshold_table(_scores(spark, sf), y="toxic"))


def _risk_rows(spark: SparkSession, sf: str) -> DataFrame:
    scored = sc.score_patients(d.patients(spark, sf), _flags(spark, sf))
    return scored.select(
        "sex", "cancer_type", "stage", ev.age_group(F.col("age")).alias("age_group"),
        F.col("adverse_event").cast("int").alias("y"), F.col("risk_probability").alias("p"),
    )


def age_groups(spark: SparkSession, sf: str) -> DataFrame:
    return d.patients(spark, sf).groupBy(ev.age_group(F.col("age")).alias("age_group")).agg(
        F.count(F.lit(1)).alias("n"), F.min("age").alias("youngest"), F.max("age").alias("oldest")
    )


def subgroup_auroc(spark: SparkSession, sf: str) -> DataFrame:
    return ev.subgroup_auroc(_risk_rows(spark, sf))


def subgroup_table(spark: SparkSession, sf: str) -> DataFrame:
    return ev.subgroup_table(_risk_rows(spark, sf))


def model_report(spark: SparkSession, sf: str) -> DataFrame:
    return ev.model_report(staged(_risk_rows(spark, sf), "risk"), "heuristic")


def cohort_profile(spark: SparkSession, sf: str) -> DataFrame:
    return ev.cohort_profile(d.patients(spark, sf)).withColumn("share", F.round("share", 9))


def _gold(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(d.derive(spark, sf, s, "embeddings") for s in (d.CASES_SQL, d.EXPECTED_SQL, d.PREDICTED_SQL))


def _gold_candidates(spark: SparkSession, sf: str, predicted: DataFrame) -> DataFrame:
    return mp.find_candidates(predicted.select(F.col("text").alias("mention_text"), "embedding"), _concepts(spark, sf), 3)


def _note_gold(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Cases of notes, failed where there is none, and what a reader found in them."""
    cases = _notes(spark, sf).select(
        F.col("patient_id").alias("case_id"), F.when(F.col("clinical_note").isNull(), "failed").otherwise("ok").alias("status")
    )
    ids = F.create_map(*[F.lit(x) for c, name in enumerate(sy.VOCABULARY) for x in (name, f"C:{c:03d}")])
    expected = d.derive(spark, sf, d.NOTE_GOLD_SQL, "customer")
    return cases, expected.select("case_id", "text", F.element_at(ids, F.col("category")).alias("hpo_id"), "negated")


def _evaluated(spark: SparkSession, sf: str) -> DataFrame:
    """The whole flow from notes to concepts, judged against the gold mentions."""
    mapped = mp.enrich_notes(_notes(spark, sf), _note_concepts(spark), ["patient_id"], "clinical_note")
    return ev.evaluate_mapped(*_note_gold(spark, sf), mapped.withColumnRenamed("patient_id", "case_id"))


def extraction_prf(spark: SparkSession, sf: str) -> DataFrame:
    return _evaluated(spark, sf).select(
        "true_positives", "predicted", "expected", "extraction_precision", "extraction_recall", "extraction_f1"
    )


def mapping_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _evaluated(spark, sf).select("mapping_total", "top1_correct", "top3_correct", "top1_accuracy", "top3_accuracy")


def negation_fp(spark: SparkSession, sf: str) -> DataFrame:
    return _evaluated(spark, sf).select("negation_total", "negation_false_positives", "negation_fp_rate")


def failed_cases(spark: SparkSession, sf: str) -> DataFrame:
    cases, expected = _note_gold(spark, sf)
    return expected.join(cases, "case_id").groupBy("status").agg(F.count(F.lit(1)).alias("expected_mentions"), F.count_distinct("case_id").alias("cases"))


def evaluate_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return _evaluated(spark, sf).select(
        "extraction_precision", "extraction_recall", "extraction_f1", "top1_accuracy", "top3_accuracy", "negation_fp_rate", "total_cases"
    )


def evaluate_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics over predictions of every vector, with candidates by vector search."""
    cases, expected, predicted = _gold(spark, sf)
    return ev.evaluate_extraction(cases, expected, predicted, _gold_candidates(spark, sf, predicted))


def regression_gate(spark: SparkSession, sf: str) -> DataFrame:
    return ev.regression_gate(evaluate_extraction(spark, sf))


# ---- storage and streams -------------------------------------------------------------------


def patients_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "patients")
    sources.write_patients(d.patients(spark, sf), f"{path}/parquet", f"{path}/csv")
    back = spark.read.schema(schemas.PATIENTS).option("header", True).option("multiLine", True).option("escape", "\\").csv(f"{path}/csv")
    rows = back.select("patient_id", F.col("anc").alias("csv_anc"), F.col("age").alias("csv_age"))
    return sources.read_patients(spark, f"{path}/parquet").join(rows, "patient_id")


def terms_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "terms")
    sources.write_terms(_terms(spark, sf), "2024-04-26", path)
    terms, release = sources.read_terms(spark, path)
    return terms.select("id", "label", F.array_join("synonyms", "|").alias("synonyms"), "definition").join(
        release.withColumnRenamed("version", "release"), F.lit(True)
    )


def vectors_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "vectors")
    _concepts(spark, sf).write.parquet(path)
    back = sources.read_concept_vectors(spark, path)
    return back.select("vector_idx", "hpo_id", "text", F.posexplode("embedding").alias("pos", "element"))


#: rows that go into one document of a written collection
DOCUMENT_ROWS = 500
#: notes that a task writes to files
NOTES_PER_TASK = 100_000


def _json_files(documents: DataFrame, spark: SparkSession, name: str) -> str:
    """A folder with one JSON file per row of ``documents``: ``doc`` numbers them, ``body`` is the text."""
    path = new_folder(spark, name)
    documents.write.partitionBy("doc").text(path)
    return path


def read_ontology(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes and edges read back from ontology documents of a few hundred nodes each."""
    nodes = _nodes(spark, sf)
    count = -(-nodes.count() // DOCUMENT_ROWS)
    nodes = nodes.groupBy(F.expr(f"ord div {DOCUMENT_ROWS}").alias("doc")).agg(F.collect_list(F.struct("id", "type", "lbl", "meta")).alias("nodes"))
    edges = _edges(spark, sf).groupBy(F.pmod(F.crc32("sub"), F.lit(count)).alias("doc")).agg(
        F.collect_list(F.struct("sub", "pred", "obj")).alias("edges")
    )
    graph = F.struct(F.coalesce("nodes", F.array()).alias("nodes"), F.coalesce("edges", F.array()).alias("edges"))
    body = F.to_json(F.struct(F.array(graph).alias("graphs")))
    read = sources.read_ontology(spark, _json_files(nodes.join(edges, "doc", "full").select("doc", body.alias("body")), spark, "ontology"))
    synonyms = F.array_join(F.transform("meta.synonyms", lambda s: s["val"]), "|")
    return read.nodes.select(
        F.lit("node").alias("what"), "id", F.col("type").alias("kind"), F.col("lbl").alias("name"), synonyms.alias("synonyms"),
        F.col("meta.definition.val").alias("definition"),
    ).unionByName(
        read.edges.select(F.lit("edge").alias("what"), F.col("sub").alias("id"), F.col("pred").alias("kind"), F.col("obj").alias("name")),
        allowMissingColumns=True,
    )


def read_cues(spark: SparkSession, sf: str) -> DataFrame:
    """Cue lists read back; every third document has no list of following cues."""
    rows = d.table(spark, sf, "part").select(
        F.expr(f"p_partkey div {DOCUMENT_ROWS}").alias("doc"), F.col("p_partkey") % 2 == 0, F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))
    ).toDF("doc", "first", "phrase")
    lists = rows.groupBy("doc").agg(
        F.collect_list(F.when(F.col("first"), F.col("phrase"))).alias("preceding_negations"),
        F.collect_list(F.when(~F.col("first"), F.col("phrase"))).alias("following_negations"),
    )
    after = F.when(F.col("doc") % 3 != 0, F.col("following_negations")).alias("following_negations")
    body = F.to_json(F.struct("preceding_negations", after))
    return sources.read_cues(spark, _json_files(lists.select("doc", body.alias("body")), spark, "cues"))


def read_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Gold cases of ten mentions each read back; mentions that are not negated leave that to the default."""
    rows = d.derive(spark, sf, d.CONCEPTS_SQL, "embeddings").withColumn("case", F.expr("vector_idx div 10"))
    mention = F.struct("text", "hpo_id", F.when(F.col("vector_idx") % 3 == 0, F.lit(True)).alias("negated"))
    cases = rows.groupBy("case").agg(F.collect_list(F.when(F.col("vector_idx") % 70 >= 10, mention)).alias("expected_mentions"))
    case = F.struct(F.concat(F.lit("note "), F.col("case").cast("string")).alias("note"), "expected_mentions")
    files = cases.groupBy(F.expr("case div 50").alias("doc")).agg(F.to_json(F.collect_list(case)).alias("body"))
    return sources.read_gold(spark, _json_files(files, spark, "gold")).select("note", "text", "hpo_id", "negated")


def _write_notes(path: str, rows: Iterable[Row]) -> None:
    """A text file per row, all in one folder; a writer of tables would move and protect each file by a call of its own."""
    fs, folder = FileSystem.from_uri(path)
    for i, row in enumerate(rows):
        with fs.open_output_stream(f"{folder}/note-{TaskContext.get().partitionId()}-{i}.txt") as out:
            out.write(f"{row.body}\n".encode())


def read_notes(spark: SparkSession, sf: str) -> DataFrame:
    """Every note as a text file of its own, read back whole; names are the writer's, so they are counted."""
    notes = d.notes(spark, sf).where(F.col("clinical_note").isNotNull())
    tasks = max(spark.sparkContext.defaultParallelism, -(-notes.count() // NOTES_PER_TASK))
    files = (  # notes of one id make one file, in the order of the table
        notes.withColumn("at", F.monotonically_increasing_id()).repartition(tasks, "patient_id")
        .groupBy("patient_id").agg(F.array_sort(F.collect_list(F.struct("at", "clinical_note"))).alias("rows"))
        .select(F.array_join("rows.clinical_note", "\n").alias("body"))
    )
    path = new_folder(spark, "notes")
    fs, folder = FileSystem.from_uri(path)
    fs.create_dir(folder)
    files.foreachPartition(lambda rows: _write_notes(path, rows))
    return sources.read_notes(spark, path).select("text", F.col("note_id").endswith(".txt").alias("named"))


def report_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "report")
    table = ev.threshold_table(_scores(spark, sf))
    sources.write_report(table, f"{path}/json")
    sources.write_report(table, f"{path}/csv", "csv")
    as_csv = spark.read.schema(table.schema).option("header", True).csv(f"{path}/csv")
    return spark.read.schema(table.schema).json(f"{path}/json").unionByName(as_csv)


def _arriving(spark: SparkSession, rows: DataFrame, files: int = 4) -> DataFrame:
    """A file stream that takes one file per batch."""
    path = new_folder(spark, "arriving")
    rows.repartition(files, rows.columns[0]).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _run_stream(spark: SparkSession, start, *args, **kw) -> str:
    """Runs a stream to its end; the folder of its outputs."""
    out = new_folder(spark, "streamed")
    start(*args, out=f"{out}/data", checkpoint=f"{out}/checkpoint", **kw).awaitTermination()
    return f"{out}/data"


def _streamed(spark: SparkSession, start, *args, name: str, **kw) -> DataFrame:
    return spark.read.parquet(f"{_run_stream(spark, start, *args, **kw)}/{name}")


def stream_phenotypes_notes(spark: SparkSession, sf: str) -> DataFrame:
    rows = _arriving(spark, _notes(spark, sf))
    found = _streamed(spark, stream_phenotypes, rows, _note_concepts(spark), ["patient_id"], "clinical_note", name="mentions")
    return _flat_enriched(found)


def stream_concepts_notes(spark: SparkSession, sf: str) -> DataFrame:
    rows = _arriving(spark, _notes(spark, sf))
    found = _streamed(spark, stream_concepts, rows, ["patient_id"], "clinical_note", name="mentions")
    return _spans(found).select("patient_id", "category", "s", "e", "mention", "grade", "negated")


def stream_risk_patients(spark: SparkSession, sf: str) -> DataFrame:
    rows = _arriving(spark, d.patients(spark, sf))
    out = _run_stream(spark, stream_risk, rows)
    scored, rejected = spark.read.parquet(f"{out}/risk"), spark.read.parquet(f"{out}/quarantine")
    told = F.array_join("reasons", ",").alias("reasons")
    return scored.select("patient_id", "risk_probability", "risk_tier", "summary").unionByName(
        rejected.select("patient_id", told), allowMissingColumns=True
    )


def train_report_patients(spark: SparkSession, sf: str) -> DataFrame:
    return train_report(d.patients(spark, sf))


_NAMED = (
    note_rollup, tokenize_docs, match_terms_docs, match_categories_docs, negate_docs, custom_cues_chat, align_spans,
    negate_spans, symptom_mentions, infer_grade, extend_vocabulary, batch_flags,
    normalize_vectors, nearest, dedupe_concepts, rank_candidates, confidence_band, map_mentions, empty_index,
    term_digest, hashed_vectors, enrich_notes,
    node_ids, release_version, subtree, build_terms, label_synonym_pairs, lookup_term, ontology_stats,
    validate_notes, validate_patients,
    features, scale_numeric, one_hot, assemble, class_weights, stratified_split, stratified_folds, split_flags,
    fit_logistic, fit_boosted, calibrate_isotonic, predict_ensemble, stratified_cv, save_load_model, score_patients_model,
    logistic_gradient, boosted_losses, isotonic_folds, models_survive_storage, model_tiers,
    heuristic_risk, abnormal_labs, risk_summary, summarize_risk,
    auroc, auprc, brier, calibration_curve, threshold_table, best_threshold, age_groups, subgroup_auroc, subgroup_table,
    model_report, cohort_profile, extraction_prf, mapping_topk, negation_fp, failed_cases, evaluate_extraction, evaluate_vectors,
    regression_gate, train_report_patients,
    read_ontology, read_cues, read_gold, read_notes, patients_round_trip, terms_round_trip, vectors_round_trip, report_round_trip,
    stream_phenotypes_notes, stream_concepts_notes, stream_risk_patients,
)

QUERIES: dict[str, Query] = {f.__name__: f for f in _NAMED}
