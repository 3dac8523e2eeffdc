"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact verification.

Method.  Equal word sequences are one node from the start.  Every node has one
signature; bands of it name buckets.  Pairs of a bucket are compared batch by
batch of signature values, and a pair goes as soon as the posterior probability
(uniform prior) that its similarity reaches the threshold falls below ``miss``.
Survivors are verified on their full shingle sets, so a link is never a guess.

Groups are not expanded.  A bucket first meets one pivot, which joins most of a
group of copies into one component at a linear cost; buckets that still hold
several components meet another.  What is left is compared in blocks: a task holds the signatures of at
most two chunks of a bucket and compares only members of different components,
with longer signatures of one byte a value (made for such members alone); only
survivors leave the task, each
in the first band that its two members share.  A pair is skipped only when it is
in one component already, so components are those of all links that the bands
find.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.bits import bit_table, marked
from cohortlens.functions.storage import Scratch
from cohortlens.llm.graph import components
from cohortlens.llm.words import batches, lower_words_of, scramble, shingles, word_hashes

SHINGLE = 5
PERCENT = 80
BANDS = 24
ROWS = 4
HASHES = 128
BATCH = 32
MISS = 1e-7
#: one-byte values of the long signature, compared so many at a time
LONG_HASHES = 2048
LONG_BATCH = 64
#: members of a bucket per chunk
CHUNK = 2048


def least_matches(hashes: int, batch: int, percent: int, miss: float) -> dict[int, int]:
    """After n compared values: the fewest matches a pair needs to stay.

    With a uniform prior the posterior after m of n matches is Beta(m+1, n-m+1);
    its mass above t equals P(Binomial(n+1, t) <= m).
    """
    t = percent / 100
    out = {}
    for n in range(batch, hashes + 1, batch):
        mass, m = 0.0, -1
        while mass < miss:
            m += 1
            ways = math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
            mass += math.exp(ways + m * math.log(t) + (n + 1 - m) * math.log1p(-t))
        out[n] = m
    return out


def _multipliers(hashes: int) -> np.ndarray:
    return scramble(np.arange(1, hashes + 1, dtype=np.uint64)) | np.uint64(1)


def signature(sets: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """Least value under each hash, as 32-bit numbers; bounded memory for sets of any size.

    The low byte of such a number agrees at least as often as the number does.
    """
    low = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(sets), 1024):
        part = sets[i : i + 1024, None] * multipliers
        np.minimum(low, (part ^ (part >> np.uint64(29))).min(axis=0), out=low)
    return (scramble(low) >> np.uint64(32)).astype("<u4")


def _signatures(key_type: str, width: int, hashes: int):
    mult = _multipliers(hashes)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            seqs, counts, sigs = [], [], []
            for text in b.column("text").to_pylist():
                words = lower_words_of(text)
                found = shingles(word_hashes(words), width)
                seqs.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                counts.append(len(found))
                sigs.append(signature(found, mult).tobytes() if words else None)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc"), b.column("text_hash"), pa.array(seqs, pa.binary()), pa.array(counts, pa.int64()),
                    pa.array(sigs, pa.binary()),
                ],
                names=["doc", "text_hash", "seq", "n", "sig"],
            )

    return run, f"doc {key_type}, text_hash long, seq binary, n long, sig binary"


def _band_keys(sigs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.zeros((len(sigs), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
    for r in range(rows):
        key = scramble(key * np.uint64(0x9E3779B97F4A7C15) + sigs[:, r : bands * rows : rows].astype(np.uint64))
    return key


def _bands(bands: int, rows: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, sigs in batches(parts, "node", "sig"):
            key = _band_keys(np.frombuffer(b"".join(sigs), "<u4").reshape(len(nodes), -1), bands, rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.ravel().view(np.int64)), pa.array(np.tile(np.arange(bands, dtype=np.int32), len(nodes))),
                    pa.array(np.repeat(np.array(nodes, np.int64), bands)),
                ],
                names=["bucket", "band", "node"],
            )

    return run


def _compare_chunks(percent: int, need: dict[int, int]):
    steps = sorted(need)

    def run(group: pa.Table) -> pa.Table:
        band = group["band"][0].as_py()
        node, label, n, chunk = (group[c].to_numpy() for c in ("node", "label", "n", "chunk"))
        keys = np.frombuffer(b"".join(group["band_keys"].to_pylist()), "<u4").reshape(len(node), -1)[:, :band]
        long = np.frombuffer(b"".join(group["long_sig"].to_pylist()), np.uint8).reshape(len(node), -1)
        across = chunk.min() != chunk.max()
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(len(node) - 1):
            rest = np.arange(i + 1, len(node))
            near = (label[rest] != label[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))
            rest = rest[near & (chunk[rest] != chunk[i])] if across else rest[near]
            matches, start = np.zeros(len(rest), np.int64), 0
            for end in steps:
                if not len(rest):
                    break
                matches += (long[rest, start:end] == long[i, start:end]).sum(axis=1)
                alive = matches >= need[end]
                rest, matches, start = rest[alive], matches[alive], end
            rest = rest[~(keys[rest] == keys[i]).any(axis=1)]  # told by an earlier band
            out_a.append(np.minimum(node[rest], node[i]))
            out_b.append(np.maximum(node[rest], node[i]))
        return pa.table({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    return run


def _prune(need: dict[int, int]):
    steps = sorted(need)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            if not b.num_rows:
                continue
            a = np.frombuffer(b"".join(b.column("sig_a").to_pylist()), "<u4").reshape(b.num_rows, -1)
            c = np.frombuffer(b"".join(b.column("sig_b").to_pylist()), "<u4").reshape(b.num_rows, -1)
            alive = np.arange(b.num_rows)
            matches = np.zeros(b.num_rows, np.int64)
            start = 0
            for n in steps:
                matches[alive] += (a[alive, start:n] == c[alive, start:n]).sum(axis=1)
                alive = alive[matches[alive] >= need[n]]
                start = n
            yield b.select(["a", "b"]).take(pa.array(alive))

    return run


def _sets(width: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, seqs, texts in batches(parts, "node", "seq", "text"):
            words = [lower_words_of(t) for t in texts]
            # hashes of texts may agree by chance: another text is not this node
            own = [k for k, w in enumerate(words) if xxhash.xxh3_128_digest(b" ".join(w)) == seqs[k]]
            found = [shingles(word_hashes(words[k]), width) for k in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array([nodes[k] for k in own], pa.int64()), pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))],
                names=["node", "shingles"],
            )

    return run


def _long_signatures(bands: int, rows: int):
    mult = _multipliers(LONG_HASHES)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            if not b.num_rows:
                continue
            long = [
                signature(s.values.to_numpy().view(np.uint64), mult).astype(np.uint8).tobytes() for s in b.column("shingles")
            ]
            keys = _band_keys(np.frombuffer(b"".join(b.column("sig").to_pylist()), "<u4").reshape(b.num_rows, -1), bands, rows)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("node"), b.column("n"), pa.array(long, pa.binary()),
                    pa.array([k.tobytes() for k in keys.astype("<u4")], pa.binary()),
                ],
                names=["node", "n", "long_sig", "band_keys"],
            )

    return run


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    hashes: int = HASHES,
    batch: int = BATCH,
    miss: float = MISS,
) -> DataFrame:
    """One row per input row: ``key, n_shingles, component_id, kept``.

    Words are cut at ASCII blanks, with A-Z in lower case.  A document's set are
    its distinct shingles of ``shingle`` words (a shorter text is one shingle).
    Two documents are linked when ``100 * |A and B| >= percent * |A or B|``.
    ``component_id`` is the smallest key reachable over links and ``kept`` says
    whether it is the row's own key.

    A null or blank text has no shingles and no links: it is its own component.
    A null key never stands for a component; its row has that of its text, or
    null, and is kept only where that is null.  Repeated rows are one node; rows
    of one key with other texts are nodes of their own, however many they are.
    Other columns of ``docs`` are not read, whatever their names.

    Memory: a task holds one Arrow batch; a hash of the multiset of a document
    is as long as the document.  Signatures, buckets and edges are narrow rows.
    Jobs run while the frame is composed; staged tables lie below
    ``spark.checkpoint.dir``.
    """
    if bands * rows > hashes or hashes % batch:
        raise ValueError("bands * rows must fit the signature, and batches divide it")
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    body = F.col(text).cast("string")
    rows_in = docs.select(F.col(key).alias("doc"), F.xxhash64(body).alias("text_hash"), body.alias("text"))
    run, schema = _signatures(rows_in.schema["doc"].dataType.simpleString(), shingle, hashes)
    described = scratch.table(rows_in.mapInArrow(run, schema), "described")
    first = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "text_hash"))  # the least key, null ones last
    nodes = scratch.table(
        described.where("n > 0").groupBy("seq").agg(first.alias("first"), F.first("n").alias("n"), F.first("sig").alias("sig"))
        .select("seq", "first", "n", "sig", F.monotonically_increasing_id().alias("node")),
        "nodes",
    )

    banded = nodes.select("node", "sig").mapInArrow(_bands(bands, rows), "bucket long, band int, node long")
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("pivot")).where("size > 1")
    buckets = scratch.table(banded.join(sizes, "bucket"), "buckets")

    # what comparisons need of the nodes of buckets, and their shingles: a node's text is that of its first row
    met = nodes.join(buckets.select("node").distinct(), "node", "left_semi")
    signed = scratch.table(met.select("node", "n", "sig"), "signed")
    wanted = scratch.table(met.select("node", "seq", F.col("first.doc").alias("first_doc"), F.col("first.text_hash").alias("first_hash")), "wanted")
    table, bits = bit_table(wanted, F.xxhash64("first_doc", "first_hash"))
    likely = marked(rows_in, F.xxhash64("doc", "text_hash"), table, bits, "likely").where("likely")
    same = (F.col("doc").eqNullSafe(F.col("first_doc"))) & (F.col("text_hash") == F.col("first_hash"))
    once = likely.join(wanted, same).groupBy("node").agg(F.first("seq").alias("seq"), F.first("text").alias("text"))
    sets = scratch.table(once.mapInArrow(_sets(shingle), "node long, shingles array<long>"), "sets")
    scratch.drop(wanted)

    def verified(pairs: DataFrame) -> DataFrame:
        both = F.size(F.array_intersect("set_a", "set_b"))
        return (
            pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
            .where(100 * both >= percent * (F.size("set_a") + F.size("set_b") - both))
            .select(F.col("a").alias("u"), F.col("b").alias("v"))
        )

    prune = _prune(least_matches(hashes, batch, percent, miss))

    def near(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(signed.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b")), "b")
            .join(signed.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a")), "a")
            .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
            .select("a", "b", "sig_a", "sig_b").mapInArrow(prune, "a long, b long")
        )

    def mixed_rows(labels: DataFrame) -> DataFrame:
        """Rows of buckets with more than one component, and the number of their members."""
        named = buckets.where("node <> pivot").select("bucket", "band", "node").join(labels, "node", "left").withColumn(
            "label", F.coalesce("label", "node")
        )
        several = named.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("members"))
        return named.join(several.where("lo <> hi").select("bucket", "members"), "bucket")

    pairs = buckets.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    stars = scratch.table(verified(near(pairs)), "stars")
    labels = scratch.table(components(stars, scratch), "labels")

    # the first pivot may be a bad one: another, drawn by a hash
    mixed = scratch.table(mixed_rows(labels), "mixed")
    drawn = F.min_by(F.struct("node", "label"), F.xxhash64("bucket", "node"))
    more = mixed.groupBy("bucket").agg(drawn.alias("p")).select("bucket", F.col("p.node").alias("a"), F.col("p.label").alias("label_a"))
    pairs = mixed.join(more, "bucket").where("label <> label_a").select(
        F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")
    )
    stars = stars.unionByName(scratch.table(verified(near(pairs.distinct())), "stars"))
    newer = scratch.table(components(stars, scratch), "labels")
    scratch.drop(labels, mixed)
    labels = newer

    mixed = scratch.table(mixed_rows(labels), "mixed")
    chunks = F.ceil(F.col("members") / CHUNK).cast("int")
    in_mixed = mixed.select("node").distinct().join(sets, "node").join(signed, "node").select("node", "n", "sig", "shingles")
    longer = in_mixed.mapInArrow(_long_signatures(bands, rows), "node long, n long, long_sig binary, band_keys binary")
    mixed = mixed.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.hash("node"), F.col("chunks")))
    mixed = mixed.join(longer, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    mixed = mixed.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")})
    compare = _compare_chunks(percent, least_matches(LONG_HASHES, LONG_BATCH, percent, miss))
    compared = mixed.groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long")
    fresh = scratch.table(verified(compared), "fresh")
    if not fresh.isEmpty():
        stars = stars.unionByName(fresh)
        labels = scratch.table(components(stars, scratch), "labels")

    grouped = nodes.select("node", "seq", F.col("first.doc").alias("rep")).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = grouped.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_seq = scratch.table(grouped.join(least, "label").select("seq", "component_id"), "of_seq")
    scratch.drop(buckets, sets, signed, nodes, labels)
    own = described.select("doc", "seq", "n").join(of_seq, "seq", "left")
    component = F.coalesce("component_id", "doc")
    return own.select(
        F.col("doc").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc")).alias("kept"),
    )
