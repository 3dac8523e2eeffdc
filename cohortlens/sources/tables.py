"""Sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas


def _required(column: str, what: str) -> Column:
    """The column, or an error from the task that meets a null."""
    return F.coalesce(F.col(column), F.raise_error(F.lit(f"{what} without {column.rsplit('.', 1)[-1]}")))


def _json_documents(spark: SparkSession, schema: str, path: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


@dataclass(frozen=True)
class Ontology:
    nodes: DataFrame
    edges: DataFrame
    version_url: DataFrame


def read_ontology(spark: SparkSession, path: str) -> Ontology:
    """Nodes, edges and version of the first graph of an ontology document."""
    document = _json_documents(spark, schemas.ONTOLOGY, path)
    usable = F.coalesce(F.size("graphs"), F.lit(0)) > 0
    graph = document.select(
        F.when(usable, F.element_at("graphs", 1)).otherwise(F.raise_error(F.lit("ontology has no graphs"))).alias("g")
    )
    nodes = graph.select(F.posexplode("g.nodes").alias("ord", "n")).select("ord", "n.*")
    edges = graph.select(F.explode("g.edges").alias("e")).select("e.*")
    return Ontology(nodes, edges, graph.select(F.col("g.meta.version").alias("version_url")))


def write_terms(terms: DataFrame, version: str, path: str) -> None:
    """Terms and their release row, each a table below ``path``."""
    terms.select("id", "label", "synonyms", "definition").write.parquet(f"{path}/terms")
    release = terms.sparkSession.read.schema(schemas.TERMS).parquet(f"{path}/terms")
    release.agg(F.lit(version).alias("version"), F.count(F.lit(1)).alias("term_count")).write.parquet(f"{path}/release")


def read_terms(spark: SparkSession, path: str, document: bool = False) -> tuple[DataFrame, DataFrame]:
    """Terms and release; ``document`` reads one ``{version, terms}`` JSON file.

    A term without id or label, or a document without version or terms, is an
    error; synonyms and definition have defaults.
    """
    if document:
        raw = _json_documents(spark, schemas.TERM_DOCUMENT, path).select(
            _required("version", "term database").alias("version"), _required("terms", "term database").alias("terms")
        )
        rows = raw.select(F.explode("terms").alias("t")).select("t.*")
        release = raw.select("version", F.size("terms").cast("bigint").alias("term_count"))
    else:
        rows = spark.read.schema(schemas.TERMS).parquet(f"{path}/terms")
        release = spark.read.schema(schemas.RELEASE).parquet(f"{path}/release")
    terms = rows.select(
        _required("id", "term").alias("id"),
        _required("label", "term").alias("label"),
        F.coalesce("synonyms", F.array().cast("array<string>")).alias("synonyms"),
        F.coalesce("definition", F.lit("")).alias("definition"),
    )
    return terms, release


def read_cues(spark: SparkSession, path: str) -> DataFrame:
    """Cue lists as ``kind, phrase``; a missing list is an empty one."""
    lists = _json_documents(spark, schemas.CUES, path)
    return lists.select(
        F.explode(
            F.map_from_arrays(
                F.array(F.lit("preceding"), F.lit("following")),
                F.array(
                    F.coalesce("preceding_negations", F.array().cast("array<string>")),
                    F.coalesce("following_negations", F.array().cast("array<string>")),
                ),
            )
        ).alias("kind", "phrases")
    ).select("kind", F.explode("phrases").alias("phrase"))


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation cases: one row per expected mention, one for a case with none."""
    cases = _json_documents(spark, schemas.GOLD, path).withColumn("case_id", F.monotonically_increasing_id())
    rows = cases.select(
        "case_id", _required("note", "case").alias("note"), F.posexplode_outer("expected_mentions").alias("pos", "e")
    )
    real = F.col("pos").isNotNull()
    return rows.select(
        "case_id",
        "note",
        "pos",
        F.when(real, _required("e.text", "expected mention")).alias("text"),
        F.when(real, _required("e.hpo_id", "expected mention")).alias("hpo_id"),
        F.when(real, F.coalesce("e.negated", F.lit(False))).alias("negated"),
    )


def read_patients(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PATIENTS).parquet(path)


def write_patients(patients: DataFrame, path: str, csv_path: str | None = None) -> None:
    patients.write.parquet(path)
    if csv_path:
        patients.write.option("header", True).csv(csv_path)


def read_concept_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CONCEPT_VECTORS).parquet(path)


def read_notes(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files; the file name is the note id."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("note_id"), F.col("value").alias("text")
    )


def write_report(report: DataFrame, path: str, fmt: str = "json", partition_by: Sequence[str] = ()) -> None:
    """A report table as JSON, CSV with header, or Parquet."""
    writer = report.write.partitionBy(*partition_by) if partition_by else report.write
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
