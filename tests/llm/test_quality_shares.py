"""Shares of repeated words and of repeated lines reject on their own."""

import random

from cohortlens.llm import quality


def test_repeated_words_or_lines_alone_are_outliers(spark):
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(100, 1000)}" for _ in range(n)]
    clean = ["\n".join(" ".join(words(10)) for _ in range(20)) for _ in range(200)]
    phrase, line = words(3), words(2)
    echoed = [" ".join(words(110) + phrase * 30)]  # 90 of 200 words repeat
    doubled = ["\n".join([" ".join(words(20)) for _ in range(8)] + [" ".join(line)] * 13)]  # 12 of 21 lines repeat
    texts = clean + echoed + doubled
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.quality_rules(df).collect()}
    assert sum(got[i].kept for i in range(200)) >= 198
    assert not got[200].base_failed and not got[200].kept
    assert not got[201].base_failed and not got[201].kept


def test_each_source_has_its_own_usual_words(spark):
    rng = random.Random(9)
    text = lambda size: " ".join(f"{'x' * size}{rng.randrange(1000, 9999)}" for _ in range(120))
    rows = [("en", "long", text(20)) for _ in range(150)] + [("en", "short", text(1)) for _ in range(150)]
    rows += [("en", "short", text(20)), ("en", "long", text(1)), ("en", "long", text(20))]
    df = spark.createDataFrame([(i, t, lang, source) for i, (lang, source, t) in enumerate(rows)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality.quality_rules(df).collect()}
    assert all(got[i] for i in range(300)) and not got[300] and not got[301] and got[302]


def test_few_symbols_and_repeats_are_no_outliers(spark):
    """One sign in a hundred words, a phrase said twice, one line of thirty again: usual; symbols all over are not."""
    rng = random.Random(10)
    line = lambda: " ".join(f"w{rng.randrange(100, 1000)}" for _ in range(20))
    clean = ["\n".join(line() for _ in range(30)) for _ in range(150)]
    phrase = "one usual phrase"
    few = [clean[0] + " 5%", clean[1] + f" {phrase} and {phrase}", clean[2] + "\n" + clean[2].split("\n")[3]]
    junk = clean[3].replace(" w1", " ### $$$ w1").replace(" w2", " <<<>>> w2")
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate([*clean, *few, junk])], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality.quality_rules(df).collect()}
    assert all(got[i] for i in range(153)) and not got[153]
