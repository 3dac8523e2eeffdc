"""Null and repeated keys: each row is judged for itself."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_stages_with_null_and_repeated_keys(spark):
    import corpus_pipeline as cp

    rng = random.Random(3)
    text = lambda: " ".join(f"w{rng.randrange(3000)}" for _ in range(150))
    junk = "%%% $$$ " * 100
    clean, twin, alone = [text() for _ in range(120)], text(), text()
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(clean)]
    rows += [(None, alone, "en", "s", 1), (None, junk, "en", "s", 1), (5, junk, "en", "s", 1)]
    rows += [(None, twin, "en", "s", 1), (None, twin + " end", "en", "s", 1), (7, clean[7], "en", "s", 1), (None, clean[9] + " end", "en", "s", 1)]
    kept = cp.reject_outliers(spark, spark.createDataFrame(rows, DOCS), "")
    assert sorted(r.text for r in kept.collect()) == sorted(r[1] for r in rows if r[1] != junk)
    single = sorted(r.text.removesuffix(" end") for r in cp.drop_near_duplicates(spark, kept, "").collect())
    assert single == sorted([*clean, alone, twin])
