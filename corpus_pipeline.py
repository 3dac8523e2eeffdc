"""From raw documents to packed training sequences, one written table per stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.bits import bit_table, marked
from cohortlens.functions.storage import new_folder, passing_tables, staged
from cohortlens.llm.mixing import mix
from cohortlens.llm.near_duplicates import near_duplicates
from cohortlens.llm.packing import pack
from cohortlens.llm.quality import quality_rules
from cohortlens.llm.queries import MIX
from cohortlens.llm.substrings import drop_repeats

#: key of a row within a stage
ROW = "_row"


def _numbered(docs: DataFrame) -> DataFrame:
    """Rows with ``_row``: whether their key is null, their key, and their place in the files they are read from.

    It is unique, in the order of keys with null ones last, and the same at
    every reading.  Rows that come from no file are written first.
    """
    try:
        placed = docs.select("*", F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_line"))
        placed.schema  # resolved here
    except AnalysisException:
        return _numbered(staged(docs, "rows"))
    return placed.withColumn(ROW, F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "_file", "_line"))


def _kept(docs: DataFrame, verdicts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows that ``verdicts`` keeps, each by its own number.

    Most rows are told by a table of bits that they are not among those to go;
    only the others are exchanged to meet them.
    """
    names = docs.columns
    rows = _numbered(docs)
    gone = staged(verdicts(rows.select("*")).where("not kept").select(f"{ROW}._file", f"{ROW}._line"), "gone")
    hashed = F.xxhash64("_file", "_line")
    told = marked(rows, hashed, *bit_table(gone, hashed), "_maybe")
    asked = told.where("_maybe").join(gone, ["_file", "_line"], "left_anti")
    return told.where("not _maybe").select(*names).unionByName(asked.select(*names))


def reject_outliers(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, each row by its own verdict."""
    return _kept(docs, lambda rows: quality_rules(rows, key=ROW))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, that of the least key."""
    return _kept(docs, lambda rows: near_duplicates(rows, key=ROW, shingle=5, percent=80))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go; a document without any keeps its text as it is, one that is all repeats goes."""
    cut = drop_repeats(docs.withColumn("original", F.col("text")), carry=("original", "lang", "source", "n_chars"))
    changed = F.col("n_removed") > 0
    return cut.where("n_removed < n_words or n_words = 0").select(
        "doc_id", F.when(changed, F.col("kept_text")).otherwise(F.col("original")).alias("text"), "lang", "source",
        F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the numbers that the mixture takes them, repeated where it takes a second epoch."""
    taken = mix(docs, **MIX)
    times = taken.groupBy(F.col("doc_id").alias("taken_id"), "text_crc32").agg(F.countDistinct("epoch").alias("times"))
    marked = docs.withColumn("crc", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))
    joined = marked.join(times, F.col("doc_id").eqNullSafe(F.col("taken_id")) & (F.col("crc") == F.col("text_crc32")))
    return joined.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", reject_outliers),
    ("near duplicates", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: near-duplicate search and tokenizers are beyond SQL
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage stages goes as soon as its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name.replace(" ", "-"))
        with passing_tables(spark, "stage"):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
