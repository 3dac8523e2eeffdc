"""Mentions to ontology concepts by exact vector similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import Scratch, new_folder, staged
from ..functions.vectors import confidence, hashed_counts, unit
from .negation import cue_table, negated_mentions
from .text import MENTION_KIND
from .validate import check_top_k

# --- fixed values -----------------------------------------------------------------
OVERFETCH = 3  # hits read per wanted candidate, before one is kept per concept
HIGH_CONFIDENCE = 0.90
MODERATE_CONFIDENCE = 0.70
NO_FINDINGS = "No confirmed phenotypes were identified."
DIGEST_DISCLAIMER = "This output is for decision support only and should not be used to diagnose patients."
# ----------------------------------------------------------------------------------

#: a concept matrix up to this many bytes goes to every executor; a larger one
#: does so in blocks of half of it, one after another; every Python worker holds
#: it, and a second time while it is read
BROADCAST_MATRIX_BYTES = 64 << 20
#: scores held at once by a task, in three copies
SCORES_AT_ONCE = 1 << 20
#: scores closer than this are ties, decided by vector_idx
SCORE_DIGITS = 9
#: copies of a lookup row that hot lookup keys are spread over
SALTS = 16

_HITS = "mention_text string, vector_idx bigint, hpo_id string, hpo_label string, score double"


def normalize_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    return vectors.withColumn(column, unit(F.col(column)))


def hashed_vectors(texts: DataFrame, text: str = "text", dim: int = 64) -> DataFrame:
    """Adds ``embedding``: a deterministic stand-in for a text encoder."""
    return texts.withColumn("embedding", hashed_counts(F.col(text), dim))


# --------------------------------------------------------------------------
# nearest vectors
# --------------------------------------------------------------------------


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _top(queries: np.ndarray, concepts: np.ndarray, idx: np.ndarray, fetch: int) -> Iterator[tuple]:
    """(query rows, concept rows, scores) of the best ``fetch`` per query, in chunks."""
    step = max(1, SCORES_AT_ONCE // max(1, len(concepts)))
    keep = min(fetch, len(concepts))
    for at in range(0, len(queries), step):
        scores = np.round(queries[at : at + step] @ concepts.T, SCORE_DIGITS)
        edge = np.partition(scores, -keep, axis=1)[:, -keep]
        rows, cols = np.nonzero(scores >= edge[:, None])
        found = scores[rows, cols]
        order = np.lexsort((idx[cols], -found, rows))
        rows, cols, found = rows[order], cols[order], found[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        inside = place < keep
        yield rows[inside] + at, cols[inside], found[inside]


def _hit_batches(texts: pa.Array, queries: np.ndarray, concepts: tuple, fetch: int) -> Iterator[pa.RecordBatch]:
    idx, ids, labels, matrix = concepts
    for rows, cols, found in _top(queries, matrix, idx, fetch):
        yield pa.RecordBatch.from_arrays(
            [
                texts.take(pa.array(rows)).cast(pa.string()),
                pa.array(idx[cols], pa.int64()),
                ids.take(pa.array(cols)).cast(pa.string()),
                labels.take(pa.array(cols)).cast(pa.string()),
                pa.array(found, pa.float64()),
            ],
            ["mention_text", "vector_idx", "hpo_id", "hpo_label", "score"],
        )


def _finite() -> Column:
    """Not null, not empty, and every element a finite number."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.coalesce(good, F.lit(False))


def _usable(vectors: DataFrame, dim: int) -> Column:
    return _finite() & (F.size("embedding") == dim)


def nearest(
    queries: DataFrame,
    concepts: DataFrame,
    top_k: int = 3,
    broadcast_bytes: int = BROADCAST_MATRIX_BYTES,
    block: int | None = None,
) -> DataFrame:
    """Best ``3 * top_k`` concept vectors per mention text, by inner product.

    ``queries``: ``mention_text, embedding``, one row per text.  ``concepts``:
    ``vector_idx, hpo_id, text, embedding``.  Rows with no usable vector take
    no part: null, empty, or with a null, NaN or infinite element.  The usable
    concepts must have one length, else there is an error; a query of another
    length has no candidates.  Ties go to the lower ``vector_idx``.
    """
    spark = queries.sparkSession
    fetch = OVERFETCH * check_top_k(top_k)
    size = concepts.where(_finite()).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.size("embedding")).alias("dim"),
        F.min(F.size("embedding")).alias("least"),
        F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.coalesce(F.octet_length("hpo_id"), F.lit(0))).alias("label_bytes"),
    ).first()
    if not size["rows"]:
        return spark.createDataFrame([], _HITS)
    dim = size["dim"]
    if size["least"] != dim:
        raise ValueError(f"concept vectors have several lengths, {size['least']} to {dim}")
    wanted = queries.where(_usable(queries, dim)).select("mention_text", F.col("embedding").cast("array<float>"))
    known = concepts.where(_usable(concepts, dim)).select(
        "vector_idx", "hpo_id", F.col("text").alias("hpo_label"), F.col("embedding").cast("array<float>").alias("embedding")
    )
    if size["rows"] * dim * 8 + size["label_bytes"] <= broadcast_bytes:
        return _nearest_broadcast(wanted, known, dim, fetch)
    per_row = dim * 8 + size["label_bytes"] // size["rows"] + 1
    return _nearest_blocks(wanted, known, dim, fetch, size["rows"], block or max(1, BROADCAST_MATRIX_BYTES // 2 // per_row))


def _columns(table: pa.Table, dim: int) -> tuple:
    one = table.combine_chunks()

    def column(name: str) -> pa.Array:
        c = one.column(name)
        return c.chunk(0) if c.num_chunks else pa.array([], c.type)

    return (
        column("vector_idx").to_numpy(zero_copy_only=False),
        column("hpo_id"),
        column("hpo_label"),
        _matrix(column("embedding"), dim),
    )


def _nearest_broadcast(wanted: DataFrame, known: DataFrame, dim: int, fetch: int) -> DataFrame:
    shared = wanted.sparkSession.sparkContext.broadcast(_columns(known.toArrow(), dim))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and len(shared.value[0]):
                yield from _hit_batches(batch.column(0), _matrix(batch.column(1), dim), shared.value, fetch)

    return wanted.mapInArrow(scan, _HITS)


def _nearest_blocks(wanted: DataFrame, known: DataFrame, dim: int, fetch: int, rows: int, block: int) -> DataFrame:
    """Concepts come by in broadcast blocks of bounded size; texts stay where they are.

    Every pass reads the texts with the best hits they have so far, and writes
    them with those of one more block put in.  A block adds only what beats a
    text's last place, so most blocks add little; nothing is exchanged.
    """
    spark = wanted.sparkSession
    blocks = math.ceil(rows / block)
    path = new_folder(spark, "concepts")
    known.withColumn("_c", F.pmod(F.xxhash64("vector_idx"), F.lit(blocks)).cast("int")).write.partitionBy("_c").parquet(path)
    stored = spark.read.parquet(path)
    none = F.array().cast(f"array<struct<{_BEST}>>").alias("best")
    scratch = Scratch(spark, "search")
    state = scratch.table(wanted.select("mention_text", "embedding", none), "search")
    for c in range(blocks):
        one = stored.where(F.col("_c") == c).select(*known.columns).toArrow()
        if not one.num_rows:
            continue
        shared = spark.sparkContext.broadcast(_columns(one, dim))
        before, state = state, scratch.table(state.mapInArrow(_better(shared, dim, fetch), state.schema), "search")
        shared.unpersist()
        scratch.drop(before)
    return state.select("mention_text", F.inline("best"))


_BEST = "vector_idx: bigint, hpo_id: string, hpo_label: string, score: double"


def _better(shared: Broadcast, dim: int, fetch: int):
    """Texts with the best hits of those they have and those of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = b.column(2)
            own = held.flatten()
            size = held.value_lengths().to_numpy()
            at, had = np.repeat(np.arange(b.num_rows), size), own.field("score").to_numpy(zero_copy_only=False)
            last = np.full(b.num_rows, -np.inf)
            full = size == fetch
            last[full] = had[np.cumsum(size)[full] - 1]
            idx, ids, labels, matrix = shared.value
            rows, cols, found = [at], [np.zeros(0, np.int64)], [had]
            for r, c, s in _top(_matrix(b.column(1), dim), matrix, idx, fetch):
                good = s >= last[r]
                rows.append(r[good])
                cols.append(c[good])
                found.append(s[good])
            cols = np.concatenate(cols)
            hits = pa.StructArray.from_arrays(
                [
                    pa.concat_arrays([own.field(k), new.take(pa.array(cols)).cast(own.field(k).type)])
                    for k, new in (("vector_idx", pa.array(idx, pa.int64())), ("hpo_id", ids), ("hpo_label", labels))
                ] + [pa.array(np.concatenate(found))],
                ["vector_idx", "hpo_id", "hpo_label", "score"],
            )
            rows, found = np.concatenate(rows), np.concatenate(found)
            order = np.lexsort((hits.field("vector_idx").to_numpy(), -found, rows))
            place = np.arange(len(order)) - np.searchsorted(rows[order], rows[order])
            order = order[place < fetch]
            ends = pa.array(np.searchsorted(rows[order], np.arange(b.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(ends, hits.take(pa.array(order)))], b.schema.names
            )

    return run


def dedupe_concepts(hits: DataFrame) -> DataFrame:
    """The best hit per text and concept; its text is the label."""
    best = Window.partitionBy("mention_text", "hpo_id").orderBy(F.desc("score"), "vector_idx")
    return hits.withColumn("_n", F.row_number().over(best)).where(F.col("_n") == 1).drop("_n")


def rank_candidates(concept_hits: DataFrame, top_k: int = 3) -> DataFrame:
    """``mention_text, rank, hpo_id, hpo_label, confidence`` of the best ``top_k``."""
    order = Window.partitionBy("mention_text").orderBy(F.desc("score"), "vector_idx")
    return (
        concept_hits.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top_k)
        .select("mention_text", "rank", "hpo_id", "hpo_label", confidence(F.col("score")).alias("confidence"))
    )


def find_candidates(queries: DataFrame, concepts: DataFrame, top_k: int = 3, **limits) -> DataFrame:
    """Search, keep one hit per concept, rank.

    One hit per concept is kept among the ``3 * top_k`` nearest only, so fewer
    than ``top_k`` concepts can come back.
    """
    hits = nearest(queries, concepts, top_k, **limits).repartition("mention_text")
    return rank_candidates(dedupe_concepts(hits), top_k)


def confidence_band(value: Column) -> Column:
    return F.when(value >= HIGH_CONFIDENCE, "high").when(value >= MODERATE_CONFIDENCE, "moderate").otherwise("low")


# --------------------------------------------------------------------------
# back to mentions
# --------------------------------------------------------------------------


def spread_lookup(left: DataFrame, right: DataFrame, on: str, spread_by: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Left join with a table unique in ``on``, safe for hot keys.

    Rows of one key are spread over ``salts`` copies of its lookup row by a
    hash of ``spread_by``, so a key with a third of all rows is no one task's.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [on, "_salt"], "left").drop("_salt")


def map_mentions(mentions: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mentions with ``hpo_id, hpo_label, confidence`` and all ``candidates``.

    A mention without candidates keeps its row, with empty strings and 0.0.
    """
    nested = candidates.groupBy("mention_text").agg(
        F.array_sort(F.collect_list(F.struct("rank", "hpo_id", "hpo_label", "confidence"))).alias("candidates")
    )
    found = spread_lookup(
        mentions.withColumn("mention_text", F.col("text")), nested, "mention_text", [*keys, "start", "end"]
    )
    first = F.try_element_at("candidates", F.lit(1))
    return found.drop("mention_text").withColumns(
        {
            "hpo_id": F.coalesce(first["hpo_id"], F.lit("")),
            "hpo_label": F.coalesce(first["hpo_label"], F.lit("")),
            "confidence": F.coalesce(first["confidence"], F.lit(0.0)),
        }
    )


def term_digest(notes: DataFrame, mapped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per note, a line per confirmed term in text order, or the no-findings text."""
    lines = (
        mapped.where(~F.col("negated"))
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("start", F.format_string("- %s (%s)", "hpo_label", "hpo_id").alias("line")))).alias("_l"))
        .select(*keys, F.array_join(F.col("_l.line"), "\n").alias("digest"))
    )
    return notes.select(*keys).join(lines, list(keys), "left").withColumn(
        "digest", F.coalesce("digest", F.lit(f"{NO_FINDINGS} {DIGEST_DISCLAIMER}"))
    )


def enrich_notes(
    notes: DataFrame,
    concepts: DataFrame,
    keys: Sequence[str],
    text: str,
    top_k: int = 3,
    cues: DataFrame | None = None,
    encoder=hashed_vectors,
) -> DataFrame:
    """Notes to mentions with negation and ranked concepts.

    ``concepts``: ``vector_idx, hpo_id, text`` and, unless the encoder makes
    it, ``embedding``.  Negated mentions are mapped too.  The mentions are
    written once, since both the texts to encode and the result need them; each
    distinct text is encoded once.
    """
    cues = cues if cues is not None else cue_table(notes.sparkSession)
    phrases = concepts.select(F.lit(MENTION_KIND).alias("kind"), F.col("text").alias("phrase")).distinct()
    mentions = staged(negated_mentions(notes, phrases, cues, keys, text), "mentions")
    # written too: a filter on what the encoder makes would go below the distinct, and the encoder with it
    texts = staged(mentions.select("text").distinct(), "texts")
    queries = encoder(texts).withColumnRenamed("text", "mention_text")
    vectors = concepts if "embedding" in concepts.columns else encoder(concepts)
    return map_mentions(mentions, find_candidates(queries, vectors, top_k), keys)
