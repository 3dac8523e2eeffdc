"""Sharding row by row against brute force; neighbours over several blocks and query passes."""

import random
import zlib

import numpy as np
import pytest

from cohortlens.llm import neighbours, sharding


def test_every_row_of_the_shards(spark):
    rng = random.Random(5)
    rows = [(i if i % 9 else None, "é" * rng.randrange(40) + str(rng.randrange(30))) for i in range(300)]
    rows += [(7, None), (7, ""), (7, "😀"), (8, "same"), (8, "same"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard(docs, shards=7).collect()
    body = [(i, (t or "").encode()) for i, t in rows]
    told = sorted(((i is not None, i or 0, zlib.crc32(b), len(b) + 16) for i, b in body))
    place = sharding.permuted(np.arange(len(rows)), len(rows))
    want = [(k if known else None, size, crc, n, int(place[n]) % 7, int(place[n]) // 7) for n, (known, k, crc, size) in enumerate(told)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("first_round", [1 << 20, 64])
def test_neighbours_over_blocks_passes_and_rounds(spark, first_round):
    rng = np.random.default_rng(8)
    near = rng.standard_normal((40, 16))
    vectors = [near[i % 40] + 0.05 * rng.standard_normal(16) for i in range(900)]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(i, [1.0] * 5) for i in range(2000, 2040)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    asked = df.where("vec_id % 20 = 0")
    got = neighbours.nearest_vectors(df, asked, k=10, block=128, query_bytes=16 * 8 * 7, first_round=first_round).collect()
    hits = 0
    for q in range(0, 900, 20):
        best = sorted(((-float((vectors[q] * vectors[i]).sum()), i) for i in range(900) if i != q))[:10]
        found = sorted((r.rank, r.vec_id) for r in got if r.query_id == q)
        assert [r for r, _ in found] == list(range(1, 11)) and q not in {i for _, i in found}
        hits += len({i for _, i in found} & {i for _, i in best})
    assert hits / 450 >= 0.9
    assert {r.query_id for r in got} - {*range(0, 900, 20)} <= {2000, 2020}


def test_floors_leave_only_hits_that_count(spark):
    """Tasks of a later round give back what reaches the floor, ties too; repeated queries count once."""
    best = neighbours._Best(np.array([2.0, -np.inf]), 2)
    best.offer(0, np.array([5, 6, 7]), np.array([1.9, 2.0, 3.0]))
    assert best.ids[0].tolist() == [7, 6] and best.worst(0) == 2.0 and best.worst(1) == -np.inf
    rows = [(i, [float(i % 7), 1.0]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = df.where("vec_id = 20").union(df.where("vec_id = 20"))
    got = neighbours.nearest_vectors(df, asked, k=4, first_round=16).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(20, n + 1, 7 * n + 6, 37.0) for n in range(2)] + [(20, 3, 27, 37.0), (20, 4, 34, 37.0)]


def test_rounds_are_looked_for_not_walked_through():
    """The hits of a plain walk from round to round, from a few counts per query."""
    rng = np.random.default_rng(3)
    rows, k = rng.standard_normal((600, 24)), 5
    ids, asked = np.arange(600), np.arange(0, 600, 6)
    options = {"threshold": 0.56, "half_width": 1.0, "first_radius": 0.45, "growth": 1.13}
    longest = float(np.sqrt((rows**2).sum(axis=1)).max())
    index = neighbours._Index(ids, rows, longest, 64, 5)
    counted, count = [], index._counts
    index._counts = lambda low, high: counted.append(1) or count(low, high)
    best = neighbours._Best(np.full(len(asked), -np.inf), k)
    for at in (np.arange(10), np.arange(10, len(asked))):
        index.search(asked[at], rows[asked[at]], best, at, options)
    spots = np.column_stack([rows / longest, np.sqrt(1 - ((rows / longest) ** 2).sum(axis=1).clip(max=1))]) @ index.axes
    for n, q in enumerate(asked):
        length, radius, hits = np.sqrt((rows[q] ** 2).sum()), 0.45, []
        centre = rows[q] / length @ index.axes[:-1]
        while True:
            seen = (np.abs(spots - centre) <= radius).sum(axis=1) >= 36
            hits = sorted((-float((rows[i] * rows[q]).sum()), i) for i in np.flatnonzero(seen) if i != q)[:k]
            if seen.all() or len(hits) == k and -hits[-1][0] >= (1 - radius**2 / 2) * length * longest:
                break
            radius *= 1.13
        assert [i for _, i in hits] == best.ids[n].tolist()
    assert len(counted) <= 4 * len(asked)


def test_windows_of_a_whole_block_hold_all_of_it():
    index = neighbours._Index(np.arange(1 << 16), np.ones((1 << 16, 1)), 1.0, 2, 5)
    assert index.places.dtype == np.uint16
    assert set(index._counts(np.array([0, 5]), np.array([1 << 16, 5])).tolist()) == {1}
