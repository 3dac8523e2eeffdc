"""Ranked search against scoring every document for every item."""

import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from cohortlens.llm import lexical

DOCS = "doc_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UP))


def brute(docs, items, top):
    held = [(k, terms(t)) for k, t in docs]
    held = [(k, len(t), collections.Counter(t)) for k, t in held if t]
    total, length = len(held), sum(n for _, n, _ in held)
    df = collections.Counter(t for _, _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for k, n, c in held:
            m = 50 + (50 * n * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if t in c
            )
            if score > 0:
                scored.append((-score, k is None, k or 0, k))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def test_terms():
    text = "Ab-c_d é9\x7f\x00x’y ÄB @[`{ Z"
    assert [t.decode() for t in lexical.terms_of(text)] == terms(text) == ["ab", "c", "d", "é9", "x’y", "Äb", "z"]
    assert lexical.terms_of(None) == lexical.terms_of("") == []


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(4)
    word = lambda: f"w{min(int(rng.expovariate(0.02)), 400)}"
    docs = [(i, " ".join(word() for _ in range(rng.randrange(1, 120)))) for i in range(700)]
    docs += [(1000 + i, docs[5][1]) for i in range(60)] + [(None, docs[5][1]), (8, docs[8][1]), (2000, None), (2001, ""), (2002, " -- ")]
    docs += [(2003, " ".join(word() for _ in range(30_000)))]
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 40)))) for i in range(25)]
    items += [(90, docs[5][1]), (91, None), (92, ""), (93, "unseen"), (90, "w1 w2 W3"), (94, docs[3][1] * 3)]
    return docs, items


@pytest.mark.parametrize("more", [{}, {"top": 7, "head": 64, "bucket": 32, "focus": 3}, {"top": 9, "item_bytes": 300, "focus": 1}])
def test_same_as_scoring_all(spark, tables, more):
    docs, items = tables
    left = spark.createDataFrame(docs, DOCS).withColumns({"item_id": F.lit("x"), "rank": F.lit(0), "terms": F.lit(1), "n": F.lit(2)})
    right = spark.createDataFrame(items, "item_id int, text string").withColumn("doc_id", F.lit(5))
    got = lexical.rank_documents(left, right, **more)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows, key=str) == brute(docs, items, more.get("top", 50))


def test_empty_tables(spark, tables):
    none = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame(tables[1], "item_id int, text string")
    assert lexical.rank_documents(none, items).collect() == []
    assert lexical.rank_documents(spark.createDataFrame(tables[0][:9], DOCS), items.limit(0)).collect() == []


def test_bounds_leave_documents_out():
    """With floors above what a bucket can reach nothing is scored."""
    import numpy as np
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict(
        {"doc": pa.array([1, 2]), "terms": pa.array([[0], [0, 1]], pa.list_(pa.int32())), "impacts": pa.array([[10], [10, 20]], pa.list_(pa.int64()))}
    )
    found = lambda floors: list(lexical._search(lexical._Items([[0, 1]], np.array([3, 4]), floors), 5, 8, 1)(iter([batch])))
    assert found({})[0].column("score").to_pylist() == [110, 30]
    assert found({0: 110})[0].column("score").to_pylist() == [110]
    assert found({0: 111}) == [] and found({0: 10_000}) == []
