"""Mixing against a plain reading of the order, with half of the rows under one key and many equal rows."""

import collections
import hashlib
import random

import pytest

from cohortlens.llm import mixing


def digest(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize("hot", [3, None])
@pytest.mark.parametrize("share", [0.37, 0.5, 1.6])
def test_rows_of_a_hot_key(spark, monkeypatch, hot, share):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 20)
    rng = random.Random(4)
    rows = [(hot if i % 2 else 100 + i, " ".join(["é", *"abc"[: rng.randrange(4)], str(rng.randrange(90))])) for i in range(400)]
    rows += [(hot, "the same words here")] * 150 + [(7, "twice"), (7, "twice"), (8, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = mixing.mix(docs, domain="'d'", weights={}, share=share)

    held = [(i, t, len(t.split())) for i, t in rows if t and t.split()]
    total = sum(n for *_, n in held)
    whole, rest = divmod(int(total * share), total)
    want = collections.Counter((i, n, e) for i, _, n in held for e in range(whole))
    past = 0
    for *_, i, t, n in sorted(
        (digest(":".join(["8", str(whole), *([] if i is None else [str(i)]), digest(t)])), n, str(i), i, t, n) for i, t, n in held
    ):
        if past < rest:
            want[i, n, whole] += 1
        past += n
    assert collections.Counter((r.doc_id, r.n_tokens, r.epoch) for r in got.collect()) == want
