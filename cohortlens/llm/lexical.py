"""Ranked lexical search by impact vectors in buckets of like length.

Method.  A document is the vector of its terms' impacts, an item the vector of
its terms' weights, and a score their inner product.  Impact vectors are sorted
by falling length and taken in buckets.  For an item and a bucket the product
of both lengths bounds every score (Cauchy-Schwarz); a bucket below the item's
floor is left out.  Inside a bucket the item's heaviest terms are looked up
first: their part of the score, plus the product of what remains of both
lengths, bounds the rest coordinate-wise.  Documents that may still reach the
floor are scored exactly, in whole numbers.  The floor of an item is the score
of its last place so far; it starts from the longest vectors of the corpus.

Impact vectors are kept over the terms of the items only: no other coordinate
adds to a score, and shorter vectors give sharper bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.storage import Scratch

TOP = 50
#: bytes of item texts that are answered in one pass over the documents
ITEM_BYTES = 8 << 20
#: longest vectors that give the first floors
HEAD = 4096
#: vectors per bucket
BUCKET = 2048
#: heaviest terms of an item that are looked up before a document is scored
FOCUS = 12

# --- fixed values: the formula ------------------------------------------------------
LENGTH_PERCENT = 50
# ------------------------------------------------------------------------------------

_BLANKED = bytes(c + 32 if 65 <= c < 91 else c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, with A-Z in lower case."""
    return text.encode("utf-8", "replace").translate(_BLANKED).split() if text else []


def _vectors(vocabulary: dict[bytes, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents as counts of the terms of a vocabulary."""
    place = vocabulary.get

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            lengths, ids, counts = [], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for text in b.column("text").to_pylist():
                terms = terms_of(text)
                known = [i for i in map(place, terms) if i is not None]
                found, times = np.unique(np.array(known, np.int32), return_counts=True)
                lengths.append(len(terms))
                ids.append(found)
                counts.append(times)
            at = pa.array(np.cumsum([0, *map(len, ids[1:])]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc"), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(at, pa.array(np.concatenate(ids))),
                    pa.ListArray.from_arrays(at, pa.array(np.concatenate(counts), pa.int64())),
                ],
                names=["doc", "n", "terms", "counts"],
            )

    return run


class _Items:
    """The items of one pass: term numbers, whole weights, floors."""

    def __init__(self, items: list[list[int]], weights: np.ndarray, floors: dict[int, int]):
        self.terms, self.weights = [], weights
        for terms in items:
            t = np.array([x for x in terms if weights[x] > 0], np.int64)
            self.terms.append(t[np.argsort(-weights[t], kind="stable")])
        self.floors = floors


def _best(found: tuple[np.ndarray, ...], top: int) -> tuple[np.ndarray, ...]:
    """The first ``top`` of (score, without key, key): highest scores, then least keys, rows without key last."""
    order = np.lexsort((found[2], found[1], -found[0]))[:top]
    return tuple(x[order] for x in found)


def _search(items: _Items, top: int, bucket: int, focus: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = items.weights.astype(np.float64)
        best = {q: (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for q in range(len(items.terms))}
        floors = [max(1, items.floors.get(q, 1)) for q in best]
        own_weight = np.zeros(len(weights), np.int64)
        for b in rows:
            for i in range(0, b.num_rows, bucket):
                some = b.slice(i, bucket)
                held = some.column("terms")
                sizes = held.value_lengths().to_numpy().astype(np.int64)
                term = held.flatten().to_numpy().astype(np.int64)
                impact = some.column("impacts").flatten().to_numpy()
                doc = some.column("doc")
                no_key, doc = doc.is_null().to_numpy(zero_copy_only=False), doc.fill_null(0).to_numpy()
                begin = np.cumsum(sizes) - sizes
                row = np.repeat(np.arange(len(sizes)), sizes)
                square = np.bincount(row, impact.astype(np.float64) ** 2, len(sizes))
                longest = np.sqrt(square.max(initial=0.0))
                order = np.argsort(term, kind="stable")
                by_term, by_row, by_impact = term[order], row[order], impact[order].astype(np.float64)
                for q, terms in enumerate(items.terms):
                    if not len(terms):
                        continue
                    own = weights[terms]
                    if np.sqrt((own**2).sum()) * longest * (1 + 1e-9) < floors[q]:
                        continue  # by length alone
                    first = terms[:focus]
                    lo, hi = np.searchsorted(by_term, first), np.searchsorted(by_term, first, "right")
                    hits = hi - lo
                    at = np.repeat(lo - np.cumsum(hits) + hits, hits) + np.arange(hits.sum())
                    part = np.bincount(by_row[at], np.repeat(own[:focus], hits) * by_impact[at], len(sizes))
                    known = np.bincount(by_row[at], by_impact[at] ** 2, len(sizes))
                    rest = np.sqrt((own[focus:] ** 2).sum()) * np.sqrt(np.maximum(square - known, 0.0) + 1e-9 * square)
                    near = np.flatnonzero((part + rest) * (1 + 1e-9) + 1e-3 >= floors[q])
                    if not len(near):
                        continue
                    # exactly, in whole numbers
                    own_weight[terms] = items.weights[terms]
                    n = sizes[near]
                    at = np.repeat(begin[near] - np.cumsum(n) + n, n) + np.arange(n.sum())
                    each = own_weight[term[at]] * impact[at]
                    score = np.add.reduceat(each, np.cumsum(n) - n) if len(each) else np.zeros(0, np.int64)
                    own_weight[terms] = 0
                    good = score >= floors[q]
                    near, score = near[good], score[good]
                    found = tuple(np.concatenate(x) for x in zip(best[q], (score, no_key[near], doc[near]), strict=True))
                    best[q] = _best(found, top)
                    if len(best[q][0]) == top:
                        floors[q] = max(floors[q], int(best[q][0][-1]))
        for q, (score, without, key) in best.items():
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(score), q), pa.int64()), pa.array(key, pa.int64(), mask=without), pa.array(score, pa.int64())
                    ],
                    names=["item", "doc", "score"],
                )

    return run


def _passes(items: DataFrame, item_bytes: int) -> Iterator[list[tuple]]:
    """Items in blocks of bounded size; the driver holds one block."""
    held, size = [], 0
    for key, text in items.toLocalIterator():
        if held and size + len(text or "") > item_bytes:
            yield held
            held, size = [], 0
        held.append((key, text))
        size += len(text or "")
    yield held


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    item_bytes: int = ITEM_BYTES,
    head: int = HEAD,
    bucket: int = BUCKET,
    focus: int = FOCUS,
) -> DataFrame:
    """``item_key, rank, key, score``: the ``top`` documents of each item with a score above 0.

    Terms, weights, impacts and scores are those of ``terms_of`` and of the
    formulas below, in whole numbers but for the logarithm.  ``rank`` counts
    from 1 without gaps; equal scores are ranked by ascending key.

    A null or empty text has no terms and does not count as a document.  A null
    key is ranked after all others of its score.  Repeated rows rank each for
    itself, and each row of ``items`` is an item of its own.  An item without
    terms, or whose terms no document holds, has no rows.  Document keys are
    integers.  Columns not named are not read.

    Items are answered ``item_bytes`` of text at a time, each time in one pass
    over the documents; only such a block, its term counts and its floors are
    ever in the driver or broadcast.  A task holds ``top`` documents an item.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical")
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    asked = items.select(F.col(item_key).alias("item_key"), F.col(item_text).cast("string").alias("text"))
    kind = asked.schema["item_key"].dataType.simpleString()
    out = None
    for block in _passes(asked, item_bytes):
        vocabulary: dict[bytes, int] = {}
        terms = [[vocabulary.setdefault(t, len(vocabulary)) for t in dict.fromkeys(terms_of(x))] for _, x in block]
        counted = scratch.table(
            rows.mapInArrow(_vectors(vocabulary), "doc long, n long, terms array<int>, counts array<long>").where("n > 0"), "counts"
        )
        total, length = counted.agg(F.count("*"), F.sum("n")).first()
        held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        weight = F.floor(1000 * F.log((2 * F.lit(total) + 2) / (2 * F.col("df") + 1))).cast("long")
        weights = np.zeros(len(vocabulary), np.int64)
        for term, w in held.select("term", weight).collect():
            weights[term] = w
        per_term = f"(1000000000 * c) div (1000 * c + 20 * (100 - {LENGTH_PERCENT} + (({LENGTH_PERCENT} * n * {total}L) div {length or 1}L)))"
        vectors = scratch.table(
            counted.where(F.size("terms") > 0)
            .select("doc", "terms", F.expr(f"transform(counts, c -> {per_term})").alias("impacts"), F.monotonically_increasing_id().alias("row"))
            .withColumn("length", F.expr("sqrt(aggregate(impacts, 0D, (a, x) -> a + double(x) * x))"))
            .repartitionByRange(F.desc("length"), "row").sortWithinPartitions(F.desc("length"), "row"),
            "vectors",
        ).select("doc", "terms", "impacts", "length")
        scratch.drop(counted)
        schema = "item long, doc long, score long"
        wide = vectors.orderBy(F.desc("length")).limit(head).coalesce(1)
        first = wide.mapInArrow(_search(_Items(terms, weights, {}), top, bucket, focus), schema)
        last = first.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") == top)
        floors = {r["item"]: r["floor"] for r in last.collect()}
        best = vectors.mapInArrow(_search(_Items(terms, weights, floors), top, bucket, focus), schema)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(i, k) for i, (k, _) in enumerate(block)], f"item long, item_key {kind}")
        named = scratch.table(ranked.join(F.broadcast(names), "item").select("item_key", "rank", "doc", "score"), "ranked")
        scratch.drop(vectors)
        out = named if out is None else out.unionByName(named)
    return out.select(F.col("item_key").alias(item_key), "rank", F.col("doc").alias(key), "score")
