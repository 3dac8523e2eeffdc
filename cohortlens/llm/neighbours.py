"""Nearest vectors by inner product: collision counting over query-centred windows.

Method.  Vectors are scaled to length 1 at most and given one more component
that fills them up to 1, so the largest inner product is the least distance.
Each block of vectors holds one sorted array per random projection.  A query's
windows are centred at its own projections; they widen round by round (virtual
rehashing: the arrays stay, the radius grows).  A window is a run of places in a
sorted array, so whether a vector lies in it is told by its place there.  A vector
that lies in the windows of more projections than the threshold is verified with
its exact inner product.
A query is done in a block once its k-th best is nearer than the radius, or
everything is verified.

Blocks are searched in rounds, each over sixteen times the vectors of those
before it.  A round starts from each query's k-th best of the rounds before, and
tasks give back only what reaches it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.storage import Scratch

K = 20
PROJECTIONS = 64
#: share of projections a vector must collide in
THRESHOLD = 0.56
#: half a window per unit of radius
HALF_WIDTH = 1.0
FIRST_RADIUS = 0.45
GROWTH = 1.13
SEED = 5
#: bytes of queries sent to all tasks at once; more queries take more passes
QUERY_BYTES = 32 << 20
#: vectors indexed together in a task
BLOCK = 32_768
#: vectors counted at a time, so that the numbers stay in the cache
COLUMNS = 4096
#: queries whose windows are looked up together; the first few show which round to start from
FEW, MANY = 16, 256
#: the first round takes at most this many vectors, about
FIRST_ROUND = 1 << 20
#: vectors up to and with a round over those before it
WIDER = 16

_HITS = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite & F.exists(wide, lambda x: x != 0), F.lit(False))


class _Best:
    """The k best per query so far that reach its floor: higher score first, then smaller id."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors
        self.ids = [np.zeros(0, np.int64)] * len(floors)
        self.scores = [np.zeros(0)] * len(floors)

    def worst_of(self, q: int, scores: np.ndarray) -> float:
        return max(self.floors[q], scores[-1] if len(scores) == self.k else -np.inf)

    def worst(self, q: int) -> float:
        return self.worst_of(q, self.scores[q])

    def merged(self, q: int, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best of ``q`` with these put in."""
        ids, scores = ids[scores >= self.floors[q]], scores[scores >= self.floors[q]]
        ids, scores = np.append(self.ids[q], ids), np.append(self.scores[q], scores)
        best = np.lexsort((ids, -scores))[: self.k]
        return ids[best], scores[best]

    def offer(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        self.ids[q], self.scores[q] = self.merged(q, ids, scores)


def _exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Equal rows give equal numbers, whatever stands beside them."""
    return (rows * query).sum(axis=1)


class _Index:
    """Sorted projections of one block of vectors of one length."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, longest: float, projections: int, seed: int):
        self.ids, self.rows, self.longest = ids, rows, longest
        scaled = rows / longest
        fill = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(axis=1)))
        self.axes = np.random.default_rng(seed).standard_normal((rows.shape[1] + 1, projections))
        spots = scaled @ self.axes[:-1] + fill[:, None] * self.axes[-1]
        order = np.argsort(spots, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(spots.T, order, axis=1)
        # a vector's place in each sorted array, as short as it can be
        places = np.arange(len(ids), dtype=np.uint16 if len(ids) <= 1 << 16 else np.uint32)
        self.places = np.empty(order.shape, places.dtype)
        np.put_along_axis(self.places, order, np.broadcast_to(places, order.shape), axis=1)
        self.usual = 0  # the round in which queries of this block are done, as far as seen

    def _counts(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """In how many of the windows each vector lies; a window is a run of places."""
        m, n = self.places.shape
        out = np.empty(n, np.uint8 if m < 256 else np.uint16)
        low, wide = low.astype(self.places.dtype)[:, None], (high - low)[:, None]
        # a place before the window wraps around to a large number; a window of all has none outside
        whole = wide > np.iinfo(self.places.dtype).max
        wide = wide.astype(self.places.dtype)
        for i in range(0, n, COLUMNS):
            inside = self.places[:, i : i + COLUMNS] - low < wide
            if whole.any():
                inside |= whole
            out[i : i + COLUMNS] = inside.view(np.uint8).sum(axis=0, dtype=out.dtype)
        return out

    def search(self, query_ids: np.ndarray, queries: np.ndarray, best: _Best, at: np.ndarray, options: dict) -> None:
        """Offers each query what collides often enough in the first round that ends it.

        Windows, what they hold and a query's k-th best only grow from round to
        round, so the last round gives all, whatever was counted before.  It is
        looked for from the round in which others were done, down and up.
        """
        lengths = np.sqrt((queries**2).sum(axis=1))
        centres = (queries / lengths[:, None]) @ self.axes[:-1]
        m = len(self.places)
        need = int(np.ceil(options["threshold"] * m))
        radii = [options["first_radius"]]

        def radius(t: int) -> float:
            while len(radii) <= t:
                radii.append(radii[-1] * options["growth"])
            return radii[t]

        def enough(q: int, t: int, worst: float) -> bool:
            reach = 1.0 - radius(t) * radius(t) / 2  # scaled inner product at this distance
            return worst >= reach * lengths[q] * self.longest

        active = np.arange(len(queries))
        turn, too_soon, ends = np.full(len(queries), self.usual), np.full(len(queries), -1), []
        low, high = np.empty((m, len(queries)), np.int64), np.empty((m, len(queries)), np.int64)
        while len(active):
            half = options["half_width"] * np.array([radius(t) for t in turn[active]])
            for j in range(m):
                low[j, active] = np.searchsorted(self.sorted[j], centres[active, j] - half, "left")
                high[j, active] = np.searchsorted(self.sorted[j], centres[active, j] + half, "right")
            still = []
            for q in active:
                t = turn[q]
                found = np.flatnonzero(self._counts(low[:, q], high[:, q]) >= need)
                everything = len(found) == len(self.ids)
                rough = self.rows[found] @ queries[q]
                rough[self.ids[found] == query_ids[q]] = -np.inf
                least = best.worst(at[q])
                if len(found) > best.k:
                    least = max(least, np.partition(rough, -best.k)[-best.k])
                good = rough >= least - 1e-9 * (1 + abs(least)) if least > -np.inf else rough > -np.inf
                found = found[good]
                ids, scores = self.ids[found], _exact(self.rows[found], queries[q])
                worst = best.worst_of(at[q], best.merged(at[q], ids, scores)[1])
                if not everything and not enough(q, t, worst):
                    too_soon[q], turn[q] = t, t + 1
                    still.append(q)
                    continue
                sooner = next((s for s in range(too_soon[q] + 1, t) if enough(q, s, worst)), t)
                if sooner < t:
                    turn[q] = sooner
                    still.append(q)
                else:
                    best.offer(at[q], ids, scores)
                    ends.append(t)
            active = np.array(still, np.int64)
        self.usual = int(np.median(ends))


def _search(sent, longest: dict[int, float], k: int, options: dict):
    """``sent`` is a broadcast of ids, vectors and floors of the queries by length."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        found = {dim: _Best(floors, k) for dim, (_, _, floors) in queries.items()}
        held: dict[int, tuple[list, list]] = {dim: ([], []) for dim in queries}

        def look(dim: int) -> None:
            ids, rows = held[dim]
            held[dim] = ([], [])
            if not ids:
                return
            index = _Index(np.concatenate(ids), np.concatenate(rows), longest[dim], options["projections"], options["seed"])
            query_ids, vectors, _ = queries[dim]
            for at in np.split(np.arange(len(query_ids)), range(FEW, len(query_ids), MANY)):
                index.search(query_ids[at], vectors[at], found[dim], at, options)

        for b in parts:
            ids, vectors = b.column("vec_id").to_numpy(zero_copy_only=False), b.column("embedding")
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            begins = np.concatenate([[0], np.cumsum(sizes)])
            for dim in np.unique(sizes):
                if dim in held:
                    rows = np.flatnonzero(sizes == dim)
                    held[dim][0].append(ids[rows])
                    held[dim][1].append(flat[begins[rows][:, None] + np.arange(dim)])
                    if sum(map(len, held[dim][0])) >= options["block"]:
                        look(dim)
        for dim in list(held):
            look(dim)
        for dim, best in found.items():
            query_ids = queries[dim][0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(query_ids, [len(x) for x in best.ids]), pa.int64()),
                    pa.array(np.concatenate([*best.ids, np.zeros(0, np.int64)]), pa.int64()),
                    pa.array(np.concatenate([*best.scores, np.zeros(0)]), pa.float64()),
                ],
                names=["query_id", "vec_id", "score"],
            )

    return run


def nearest_vectors(
    vectors: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    *,
    k: int = K,
    projections: int = PROJECTIONS,
    threshold: float = THRESHOLD,
    seed: int = SEED,
    block: int = BLOCK,
    query_bytes: int = QUERY_BYTES,
    first_round: int = FIRST_ROUND,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best of ``vectors`` for each of ``queries``.

    The score is the inner product of the vectors as given, in double precision;
    ties go to the smaller id.  A query is never its own candidate (same id).
    Vectors that are null, empty, zero or hold null or non-finite components
    take no part on either side; vectors meet only those of their own length.
    Fewer candidates than ``k`` are all returned.  Rows with a null id take no
    part; of rows with one id each counts.  Other columns are not read.

    Equal query rows count once; of several vectors under one query id the best
    hits of all are ranked together.

    Every vector is indexed, in the task that reads it.  Queries are a written
    table cut into passes of about ``query_bytes``; only those of one pass, and
    their floors, are in the driver and broadcast at a time.  The hits of every
    round are written, at most ``k`` per query, before the next starts.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")

    def clean(df: DataFrame) -> DataFrame:
        renamed = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"))
        return renamed.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))

    vectors = clean(vectors)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    per_length = vectors.groupBy(F.size("embedding").alias("dim")).agg(F.max(norm).alias("longest"), F.count("*").alias("n"))
    lengths = per_length.collect()  # one row per length
    longest = {r["dim"]: r["longest"] for r in lengths}
    asked = clean(queries).distinct()
    total = asked.agg(F.sum(F.size("embedding") * 8 + 16)).first()[0] or 0
    passes = -(-total // query_bytes)
    at = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(max(1, passes))).alias("pass")
    # in the order of passes, so that a pass reads its own row groups
    asked = scratch.table(asked.select(at, "*").repartitionByRange("pass").sortWithinPartitions("pass"), "queries")
    options = {
        "projections": projections, "threshold": threshold, "seed": seed, "block": block, "half_width": HALF_WIDTH,
        "first_radius": FIRST_RADIUS, "growth": GROWTH,
    }
    shares = [1.0]
    while sum(r["n"] for r in lengths) * shares[0] > first_round:
        shares.insert(0, shares[0] / WIDER)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "vec_id", "embedding"), 11) / F.lit(float(1 << 53))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    done = [scratch.table(spark.createDataFrame([], _HITS).withColumn("rank", F.lit(0)), "hits")]
    for i in range(passes):
        some = asked.where(F.col("pass") == i).drop("pass").toArrow().combine_chunks()
        best = done[0]
        for low, high in zip([0.0, *shares], shares):
            sent = spark.sparkContext.broadcast(_with_floors(some, best.where(F.col("rank") == k), longest))
            part = vectors.where((draw >= low) & (draw < high)) if low or high < 1 else vectors
            hits = part.mapInArrow(_search(sent, longest, k, options), _HITS).unionByName(best.drop("rank"))
            ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            best, before = scratch.table(ranked, "hits"), best
            if before is not done[0]:
                scratch.drop(before)
            sent.destroy()
        done.append(best)
    found = spark.read.schema(done[0].schema).parquet(*[t._staged_at for t in done])
    return found.select("query_id", "rank", "vec_id", "score")


def _with_floors(some: pa.Table, kth: DataFrame, longest: dict[int, float]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, vectors and floors of the queries of a pass by length; a query without ``k`` hits yet has none."""
    floors = kth.select(F.col("query_id").alias("vec_id"), "score").toArrow()  # one row per query of the pass
    known = dict(zip(floors["vec_id"].to_pylist(), floors["score"].to_pylist()))
    sizes = pc.list_value_length(some["embedding"]).to_numpy()
    by_dim = {}
    for dim in set(sizes.tolist()) & set(longest):
        rows = some.take(pa.array(np.flatnonzero(sizes == dim)))
        ids = rows["vec_id"].to_numpy()
        flat = pc.list_flatten(rows["embedding"]).to_numpy()
        by_dim[dim] = (ids, flat.reshape(-1, dim), np.array([known.get(i, -np.inf) for i in ids.tolist()]))
    return by_dim
