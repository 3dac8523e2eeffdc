"""Boosted trees for many training sets at once, over one table.

Rows say which fits they train.  All fits grow together: one Spark job per level
of depth adds up the gradients of every fit, node, feature and bin, the sums of a
fit meet in one task that chooses its splits, and the next job goes on from there.
So the number of jobs is rounds times depth however many fits there are, and only
splits come back to the driver.  Partitions are as many as cores, since each costs
a task and a copy of the sums per level.  A table of at most ``BLOCK_ROWS`` rows
and ``TASK_BYTES`` needs no jobs between levels: binned rows are small, so they go
to one task per fit, which does the same steps.  There the smaller child of a node
is added up and the larger one is what is left of the node, if sums are exact.

Beyond ``PLAIN_ROWS`` rows several features are added up at once: a code names the
bins of all features of a bundle, and the sums of its codes give those of each
feature.  Gradients are then rounded to whole multiples of a power of two that leaves
all sums exact, so sums are the same in whatever order and however many at once they
are added up.  Fewer rows are added up one by one as they lie, without rounding.

Blocks of rows hold the margins of every fit between rounds.  They are kept in
memory and written to ``spark.checkpoint.dir`` every ``CHECKPOINT`` rounds, so a
lost executor costs a few rounds.
"""

from __future__ import annotations

import functools
import hashlib
import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import exists, shared_dir, staged
from .features import SEED

# --- fixed values: model parameters ---------------------------------------------------
TREES = 300
TREE_DEPTH = 4
TREE_RATE = 0.05
ROW_SAMPLE = 0.8
COLUMN_SAMPLE = 0.8
#: added to the second derivatives of a leaf; least second derivatives of a child
PENALTY = 1.0
LEAST_CHILD = 1.0
# --------------------------------------------------------------------------------------

#: bins per feature
BINS = 32
#: saved fits of other versions of this algorithm are not taken
VERSION = 3
#: rounds between checkpoints
CHECKPOINT = 25
#: rows and bytes of a table that goes to a task per fit
BLOCK_ROWS = 1_000_000
TASK_BYTES = 64 << 20
#: rows whose gradients are added up as they are
PLAIN_ROWS = 20_000
#: rows per task in a small and in a large table
TASK_ROWS = 512
MOST_TASK_ROWS = 1_280_000
#: codes of a bundle of features at least and at most, and rows per code between
LEAST_CODES, MOST_CODES, CODE_ROWS = 64, 1024, 16


@dataclass(frozen=True)
class BoostedTrees:
    """Trees of one depth, as arrays: node ``i`` has children ``2 i + 1`` and ``2 i + 2``.

    A row goes left where its feature is at most the cut.  ``losses`` are the
    mean weighted log losses of the training rows before each round and after
    the last.
    """

    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    value: np.ndarray  # trees x leaves
    base: float
    losses: tuple[float, ...] = ()

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            while at.max(initial=0) < len(feature):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
                if not len(at):
                    break
            out += value[at - len(feature)]
        return out

    def transform(self, df: DataFrame, features: str = "features", name: str = "probability") -> DataFrame:
        """Adds the probability of class 1."""
        margins = self.margins

        @F.pandas_udf("double")
        def probability(x: pd.Series) -> pd.Series:
            return pd.Series(1 / (1 + np.exp(-margins(np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))))))

        return df.withColumn(name, probability(vector_to_array(features)))

    def table(self, spark: SparkSession) -> DataFrame:
        """``tree, node, feature, cut, value``: inner nodes have a feature and a cut, leaves a value."""
        trees, inner = self.feature.shape
        tree, node = np.indices((trees, inner + self.value.shape[1])).reshape(2, -1)
        leaf = node >= inner
        pad = lambda of, before, after: np.pad(of, ((0, 0), (before, after))).ravel()
        found = {
            "tree": pa.array(tree, pa.int32()),
            "node": pa.array(node, pa.int32()),
            "feature": pa.array(pad(self.feature, 0, inner + 1), pa.int32(), mask=leaf),
            "cut": pa.array(pad(self.cut, 0, inner + 1), mask=leaf),
            "value": pa.array(pad(self.value, inner, 0), mask=~leaf),
        }
        rows = spark.createDataFrame(pa.table(found), "tree int, node int, feature int, cut double, value double")
        return rows.coalesce(1)

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).write.mode("overwrite").parquet(f"{path}/trees")
        rest = spark.createDataFrame([(self.base, [float(x) for x in self.losses])], "base double, losses array<double>")
        rest.coalesce(1).write.mode("overwrite").parquet(f"{path}/base")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree", "node").collect()
        base, losses = spark.read.parquet(f"{path}/base").first()
        trees = rows[-1]["tree"] + 1 if rows else 0
        per = len(rows) // trees if trees else 1
        grid = np.array([[r["feature"], r["cut"], r["value"]] for r in rows], float).reshape(trees, per, 3)
        inner = per // 2
        return cls(grid[:, :inner, 0].astype(np.int64), grid[:, :inner, 1], grid[:, inner:, 2], base, tuple(losses))


def bin_cuts(rows: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """Ascending cuts of each feature between bins of about as many rows; values up to a cut are at or below it."""
    long = rows.select(F.posexplode(vector_to_array("features")).alias("feature", "value"))
    shares = [k / bins for k in range(1, bins)]
    found = long.groupBy("feature").agg(
        F.percentile_approx("value", shares, 10_000).alias("cuts"), F.max("value").alias("most")
    ).orderBy("feature")
    return [np.unique([c for c in r["cuts"] if c < r["most"]]) for r in found.collect()]


def _blocks(cuts: list[np.ndarray]):
    """Rows as binned blocks, one per batch: one pickle each."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in parts:
            x = np.array(some.column("x").to_pylist(), float).reshape(some.num_rows, -1)
            block = {
                "bins": np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], 1).astype(np.uint8),
                "y": np.array(some.column("label").to_pylist(), float),
                "member": np.array(some.column("member").to_pylist(), bool).reshape(some.num_rows, -1),
                "id": np.array(some.column("id").to_pylist(), np.int64).view(np.uint64),
            }
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], ["block"])

    return run


def _bundles(sizes: np.ndarray, rows: int) -> list[list[int]]:
    """Features that are added up together: the product of their bins is bounded by the rows, since each code is a cell."""
    most = min(MOST_CODES, max(LEAST_CODES, rows // CODE_ROWS))
    out: list[list[int]] = []
    for f in np.argsort(-sizes, kind="stable").tolist():
        fits = next((b for b in out if np.prod(sizes[b]) * sizes[f] <= most), None)
        if fits is None:
            out.append([f])
        else:
            fits.append(f)
    return out


def _codes(bins: np.ndarray, plan: dict) -> np.ndarray:
    """Bundles by rows: which bins the features of a bundle have."""
    out = np.zeros((len(plan["bundles"]), len(bins)), np.uint16)
    for code, bundle in zip(out, plan["bundles"], strict=True):
        for f in bundle:
            code *= int(plan["sizes"][f])
            code += bins[:, f]
    return out


def _spread(plan: dict) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each bundle the places of its features' bins in the sums, and which codes (rows) belong to them (columns)."""
    out = []
    for bundle in plan["bundles"]:
        sizes = plan["sizes"][bundle]
        of_code = np.unravel_index(np.arange(np.prod(sizes)), sizes)
        at = np.concatenate([plan["starts"][f] + np.arange(plan["sizes"][f]) for f in bundle])
        out.append((at, np.concatenate([b[:, None] == np.arange(n) for b, n in zip(of_code, sizes, strict=True)], axis=1).astype(float)))
    return out


def _added(codes: np.ndarray, node: np.ndarray, nodes: int, slopes: tuple, spread: list, total: int) -> np.ndarray:
    """Sums of ``slopes`` (gradients, second derivatives) by node and bin of every feature."""
    out = np.empty((2, nodes, total))
    for code, (at, belongs) in zip(codes, spread, strict=True):
        width = len(belongs)
        cell = node * width + code
        sums = np.concatenate([np.bincount(cell, v, nodes * width) for v in slopes]).reshape(-1, width)
        out[:, :, at] = (sums @ belongs).reshape(2, nodes, -1)
    return np.ascontiguousarray(out.transpose(1, 2, 0))


def _hash(h: np.ndarray, by: int) -> np.ndarray:
    h = (h ^ np.uint64(by & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _drawn(ids: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """Whether a row counts for a tree; depends on the row's content, not on where it lies or on the other fits."""
    h = _hash(_hash(ids, seed * 1_000_003), tree + 1)
    return (h >> np.uint64(11)).astype(float) < share * float(1 << 53)


def _nodes(bins: np.ndarray, feature: np.ndarray, upto: np.ndarray, depth: int) -> np.ndarray:
    """Which node of a level each row is in, counted from the left."""
    at = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    for _ in range(depth):
        at = 2 * at + 1 + (bins[rows, feature[at]] > upto[at])
    return at - (2**depth - 1)


def _slopes(margin: np.ndarray, y: np.ndarray, weight: np.ndarray, unit: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and second derivatives, as whole multiples of a unit if there is one."""
    p = 1 / (1 + np.exp(-margin))
    both = weight * (p - y), weight * p * (1 - p)
    return both if unit is None else tuple(np.rint(v / unit) for v in both)


def _loss(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    return (weight * (np.logaddexp(0, margin) - y * margin)).sum(), weight.sum()


def _sums(block: dict, trees: list, tree: int, depth: int, plan: dict, spread: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and second derivatives of every fit, node and bin; on the first level also losses."""
    bins, y, member, margin, codes = (block[c] for c in ("bins", "y", "member", "margin", "codes"))
    fits = member.shape[1]
    out = np.zeros((fits, 2**depth, plan["total"], 2))
    loss = np.zeros((fits, 2))
    all_drawn = _drawn(block["id"], tree, plan["seed"], plan["rows"])
    for k in range(fits):
        weight = np.where(y > 0, plan["positive"][k], 1.0)
        if depth == 0:
            mine = member[:, k]
            loss[k] = _loss(margin[mine, k], y[mine], weight[mine])
        mine = np.flatnonzero(member[:, k] & all_drawn)
        if not len(mine):
            continue
        slopes = _slopes(margin[mine, k], y[mine], weight[mine], plan["units"][k])
        node = _nodes(bins[mine], *trees[k], depth)
        out[k] = _added(codes[:, mine], node, 2**depth, slopes, spread, plan["total"])
    return out, loss


def _grown(block: dict, trees: list, values: np.ndarray) -> dict:
    """The block with a round's trees added to the margins of all rows, members or not."""
    margin = block["margin"].copy()
    depth = (len(trees[0][0]) + 1).bit_length() - 1
    for k, (feature, upto) in enumerate(trees):
        margin[:, k] += values[k][_nodes(block["bins"], feature, upto, depth)]
    return block | {"margin": margin}


def _add(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], a[1] + b[1]


def _splits(sums: np.ndarray, unit: float | None, starts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, ...]:
    """Best feature and last left bin of each node of a fit, and the sums left and right; -1 without a gain."""
    sums = sums * (unit or 1.0)
    ends = np.append(starts[1:], sums.shape[1])
    whole = sums[:, starts[0] : ends[0]].sum(axis=1)  # every feature has all rows
    left = np.cumsum(sums, axis=1)
    before = np.concatenate([np.zeros((len(sums), 1, 2)), left], axis=1)[:, starts]
    left = left - np.repeat(before, ends - starts, axis=1)
    right = whole[:, None] - left
    score = lambda s: s[..., 0] ** 2 / (s[..., 1] + PENALTY)
    gain = score(left) + score(right) - score(whole)[:, None]
    gain[(left[..., 1] < LEAST_CHILD) | (right[..., 1] < LEAST_CHILD)] = 0
    gain[:, ~np.repeat(allowed, ends - starts)] = 0
    best = gain.argmax(axis=1)
    feature = np.searchsorted(starts, best, "right") - 1
    none = gain[np.arange(len(sums)), best] <= 1e-12
    at = np.arange(len(sums))
    l, r = left[at, best], right[at, best]
    l[none], r[none] = whole[none], 0
    return np.where(none, -1, feature), best - starts[feature], l, r


def _allowed(tree: int, plan: dict) -> np.ndarray:
    """Which features a tree may use."""
    features = len(plan["starts"])
    allowed = np.zeros(features, bool)
    drawn = np.random.default_rng((plan["seed"], tree)).permutation(features)
    allowed[drawn[: max(1, int(plan["columns"] * features))]] = True
    return allowed


def _tasks(rows: int, cores: int) -> int:
    """Partitions of a table: one per core, more only where a partition would be too large."""
    return max(min(cores, rows // TASK_ROWS), -(-rows // MOST_TASK_ROWS), 1)


def _level(state: RDD, trees: list, tree: int, depth: int, plan: dict) -> tuple[list, np.ndarray]:
    """Splits and losses of every fit; each fit's sums meet in one task."""
    fits = len(trees)

    def summed(blocks: Iterator[dict]) -> Iterator[tuple]:
        spread = _spread(plan)
        parts = (_sums(b, trees, tree, depth, plan, spread) for b in blocks)
        some = next(parts, None)
        if some is not None:
            sums, loss = functools.reduce(_add, parts, some)
            yield from ((k, (sums[k], loss[k])) for k in range(fits))

    def chosen(fit: tuple) -> tuple:
        k, (sums, loss) = fit
        return k, (_splits(sums, plan["units"][k], plan["starts"], _allowed(tree, plan)), loss)

    added = state.mapPartitions(summed).reduceByKey(_add, min(fits, state.getNumPartitions()))
    found = added.map(chosen).collectAsMap()
    return [found[k][0] for k in range(fits)], np.stack([found[k][1] for k in range(fits)])


def _rounds(fits: int, plan: dict, level: Callable, grow: Callable) -> tuple[list, list]:
    """All rounds: ``level`` finds the splits of a level, ``grow`` puts a round's trees into the margins."""
    grown, losses = [], []
    depth = plan["depth"]
    inner = 2**depth - 1
    # a node that is not split sends all its rows left
    none = lambda: [(np.zeros(inner, np.int64), np.full(inner, 255, np.int64)) for _ in range(fits)]
    for tree in range(plan["trees"]):
        now, values = none(), np.zeros((fits, 2**depth))
        for d in range(depth):
            splits, loss = level(now, tree, d)
            if d == 0:
                losses.append(loss)
            first = 2**d - 1
            for k in range(fits):
                feature, upto, left, right = splits[k]
                split = feature >= 0
                now[k][0][first : first + 2**d][split] = feature[split]
                now[k][1][first : first + 2**d][split] = upto[split]
                if d == depth - 1:
                    both = np.stack([left, right], 1).reshape(-1, 2)
                    values[k] = -plan["rate"] * both[:, 0] / (both[:, 1] + PENALTY)
        grown.append((now, values))
        grow(now, values, tree)
    losses.append(level(none(), plan["trees"], 0)[1])
    return grown, losses


def _over_blocks(packed: DataFrame, fits: int, plan: dict) -> tuple[list, list]:
    """A job per level over all blocks."""
    state = packed.rdd.map(lambda r: pickle.loads(r[0])).map(
        lambda b: b | {"codes": _codes(b["bins"], plan), "margin": np.zeros(b["member"].shape)}
    )
    held = [state.persist(StorageLevel.MEMORY_AND_DISK)]

    def grow(now: list, values: np.ndarray, tree: int) -> None:
        after = held[-1].map(functools.partial(_grown, trees=now, values=values)).persist(StorageLevel.MEMORY_AND_DISK)
        if (tree + 1) % CHECKPOINT == 0:
            after.checkpoint()
        held.append(after)
        if len(held) > 2:  # the one before last is no more read once the last is there
            held.pop(0).unpersist()

    out = _rounds(fits, plan, lambda now, tree, d: _level(held[-1], now, tree, d, plan), grow)
    for s in held:
        s.unpersist()
    return out


class _OneFit:
    """The rows that train one fit, in one task."""

    def __init__(self, blocks: Iterator[bytes], k: int, plan: dict):
        self.plan, self.unit = plan, plan["units"][k]
        parts = [[b[c][b["member"][:, k]] for c in ("bins", "y", "id")] for b in map(pickle.loads, blocks)]
        bins, self.y, self.ids = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        self.codes, self.spread = _codes(bins, plan), _spread(plan)
        self.bins, self.first = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
        self.weight = np.where(self.y > 0, plan["positive"][k], 1.0)
        self.margin = np.zeros(len(bins))

    def _down(self, feature: np.ndarray, upto: np.ndarray, d: int) -> None:
        """Rows go to their nodes of level ``d`` from those of the level above."""
        at = self.node + (2 ** (d - 1) - 1)
        self.node = 2 * self.node + (self.bins[self.first + feature[at]] > upto[at])

    def level(self, now: list, tree: int, d: int) -> tuple[list, np.ndarray]:
        loss = np.zeros((1, 2))
        if d == 0:
            loss[0] = _loss(self.margin, self.y, self.weight)
            self.node = np.zeros(len(self.y), np.int64)
            self.drawn = np.flatnonzero(_drawn(self.ids, tree, self.plan["seed"], self.plan["rows"]))
            self.slopes = _slopes(self.margin[self.drawn], self.y[self.drawn], self.weight[self.drawn], self.unit)
            self.sums = self._added(np.arange(len(self.drawn)), self.node[self.drawn], 1)
        else:
            self._down(*now[0], d)
            node = self.node[self.drawn]
            if self.unit is None:
                self.sums = self._added(np.arange(len(node)), node, 2**d)
                return [self._chosen(tree)], loss
            less = np.bincount(node, minlength=2**d).reshape(-1, 2).argmin(axis=1)
            some = np.flatnonzero((node & 1) == less[node >> 1])
            fewer = self._added(some, node[some] >> 1, 2 ** (d - 1))
            both = np.stack([fewer, self.sums - fewer], 1)
            both[less == 1] = both[less == 1, ::-1]
            self.sums = both.reshape(2**d, *fewer.shape[1:])
        return [self._chosen(tree)], loss

    def _chosen(self, tree: int) -> tuple[np.ndarray, ...]:
        return _splits(self.sums, self.unit, self.plan["starts"], _allowed(tree, self.plan))

    def _added(self, some: np.ndarray, node: np.ndarray, nodes: int) -> np.ndarray:
        rows = self.drawn[some]
        return _added((c[rows] for c in self.codes), node, nodes, tuple(v[some] for v in self.slopes), self.spread, self.plan["total"])

    def grow(self, now: list, values: np.ndarray, tree: int) -> None:
        self._down(*now[0], self.plan["depth"])
        self.margin += values[0][self.node]


def _in_tasks(packed: DataFrame, fits: int, plan: dict) -> tuple[list, list]:
    """A task per fit, for a table of bounded size that goes to every task."""
    context = packed.sparkSession.sparkContext
    blocks = context.broadcast([r[0] for r in packed.collect()])

    def one(k: int) -> tuple[list, list]:
        fit = _OneFit(blocks.value, k, plan)
        return _rounds(1, plan, fit.level, fit.grow)

    made = context.parallelize(range(fits), fits).map(one).collect()
    blocks.unpersist()
    grown = [([m[0][t][0][0] for m in made], np.stack([m[0][t][1][0] for m in made])) for t in range(plan["trees"])]
    return grown, [np.stack([m[1][t][0] for m in made]) for t in range(plan["trees"] + 1)]


def boost(
    rows: DataFrame,
    fits: int,
    *,
    trees: int = TREES,
    depth: int = TREE_DEPTH,
    rate: float = TREE_RATE,
    row_sample: float = ROW_SAMPLE,
    column_sample: float = COLUMN_SAMPLE,
    bins: int = BINS,
    seed: int = SEED,
) -> list[BoostedTrees]:
    """``fits`` models of the log loss on ``features, label, member array<boolean>`` (which fits a row trains).

    The rarer class of each fit is weighted up.  Cuts between bins are those of
    all rows; everything else of a fit comes from its own rows.  Rows are drawn
    anew for each tree by a hash of their content, so neither their order nor
    their place matters; equal rows are drawn together.  Columns are drawn per
    tree.  A fit does not depend on the other fits of the table.  A fit of one
    class predicts that class as far as its penalty lets it, one without rows
    predicts one half.
    """
    spark = rows.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    x = vector_to_array("features")
    flat = staged(rows.select(x.alias("x"), F.col("label").cast("double").alias("label"), "member", F.xxhash64(x, "label").alias("id")), "boost")
    cuts = bin_cuts(rows.select("features"), bins)
    inside = [F.element_at("member", k + 1).cast("int") for k in range(fits)]
    counts = flat.agg(
        F.count("*").alias("n"),
        *[F.coalesce(F.sum(m * (F.col("label") > 0).cast("int")), F.lit(0)).alias(f"p{k}") for k, m in enumerate(inside)],
        *[F.coalesce(F.sum(m), F.lit(0)).alias(f"a{k}") for k, m in enumerate(inside)],
    ).first()
    positive = [max(1.0, (counts[f"a{k}"] - counts[f"p{k}"]) / max(1, counts[f"p{k}"])) for k in range(fits)]
    sizes = np.array([len(c) + 1 for c in cuts])
    plan = {"starts": np.cumsum(sizes) - sizes, "sizes": sizes, "total": int(sizes.sum()), "positive": positive, "seed": seed, "rows": row_sample}
    # running totals over the bins of all features stay below 2**52 units
    heaviest = [max(1.0, len(cuts) * (counts[f"a{k}"] + (positive[k] - 1) * counts[f"p{k}"])) for k in range(fits)]
    plan["units"] = [2.0 ** (math.ceil(math.log2(w)) - 52) for w in heaviest]
    plan |= {"trees": trees, "depth": depth, "rate": rate, "columns": column_sample}
    small = counts["n"] <= BLOCK_ROWS and counts["n"] * (len(cuts) + fits + 16) <= TASK_BYTES
    plan["bundles"] = _bundles(sizes, counts["n"] // 4 if small else 10_000 // 4)
    if counts["n"] <= PLAIN_ROWS:
        plan |= {"units": [None] * fits, "bundles": [[f] for f in range(len(cuts))]}
        flat = flat.coalesce(1)
    if small:
        grown, losses = _in_tasks(flat.mapInArrow(_blocks(cuts), "block binary"), fits, plan)
    else:
        grown, losses = _over_blocks(flat.repartition(_tasks(counts["n"], context.defaultParallelism)).mapInArrow(_blocks(cuts), "block binary"), fits, plan)
    inner = 2**depth - 1
    means = np.stack([l[:, 0] / np.maximum(l[:, 1], 1e-300) for l in losses])
    out = []
    for k in range(fits):
        feature = np.array([now[k][0] for now, _ in grown], np.int64).reshape(trees, inner)
        upto = np.array([now[k][1] for now, _ in grown], np.int64).reshape(trees, inner)
        cut = np.array([[cuts[f][u] if u < len(cuts[f]) else np.inf for f, u in zip(*t, strict=True)] for t in zip(feature, upto, strict=True)])
        out.append(BoostedTrees(feature, cut.reshape(trees, inner), np.array([v[k] for _, v in grown]).reshape(trees, -1), 0.0, tuple(means[:, k].tolist())))
    return out


def boost_saved(rows: DataFrame, fits: int, **options) -> list[BoostedTrees]:
    """As ``boost``, but a fit that was made before is loaded, and each new one is saved.

    Fits are told by a fingerprint of their options, of all values that decide
    the cuts, and of the rows that train them; they lie below
    ``spark.checkpoint.dir``, so a job that starts again goes on from what is there.
    """
    spark = rows.sparkSession
    rows = staged(rows.select("features", F.col("label").cast("double").alias("label"), "member"), "rows")
    hashed = F.xxhash64(vector_to_array("features"), "label").cast("decimal(38,0)")
    told = rows.select(hashed.alias("h"), "member").agg(
        F.sum("h").alias("all"),
        *[F.sum(F.when(F.element_at("member", k + 1), F.col("h"))).alias(f"s{k}") for k in range(fits)],
        *[F.count_if(F.element_at("member", k + 1)).alias(f"n{k}") for k in range(fits)],
    ).first()
    used = (VERSION, TREES, TREE_DEPTH, TREE_RATE, ROW_SAMPLE, COLUMN_SAMPLE, PENALTY, LEAST_CHILD, BINS, SEED, sorted(options.items()))
    marks = [hashlib.sha256(repr((used, told["all"], told[f"s{k}"], told[f"n{k}"])).encode()).hexdigest()[:32] for k in range(fits)]
    paths = [f"{shared_dir(spark)}/boosted/{m}" for m in marks]
    missing = [k for k in range(fits) if not exists(spark, f"{paths[k]}/base/_SUCCESS")]
    new: dict[int, BoostedTrees] = {}
    if missing:
        chosen = F.array(*[F.element_at("member", k + 1) for k in missing])
        new = dict(zip(missing, boost(rows.withColumn("member", chosen), len(missing), **options), strict=True))

    def settled(k: int) -> BoostedTrees:
        if k not in new:
            return BoostedTrees.load(spark, paths[k])
        new[k].save(spark, paths[k])
        return new[k]

    with ThreadPool(min(8, fits)) as pool:
        return pool.map(inheritable_thread_target(spark)(settled), range(fits))
