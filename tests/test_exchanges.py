"""What goes through exchanges: rows that may match, and no others."""

import random
import re

from cohortlens.operators import negation as ng
from cohortlens.operators import text as tx


def records(spark):
    """Records written for exchanges so far."""
    context = spark.sparkContext
    context._jsc.sc().listenerBus().waitUntilEmpty()
    none = context._gateway.new_array(context._jvm.double, 0)
    stages = context._jsc.sc().statusStore().stageList(None, False, False, none, None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def exchanged(spark, df):
    before = records(spark)
    rows = df.collect()
    return rows, records(spark) - before


def test_large_lexicon_exchanges_tokens_that_start_a_phrase(spark):
    rng = random.Random(2)
    texts = [(i, " ".join(f"w{rng.randrange(4000)}" for _ in range(2000))) for i in range(20)]
    notes = spark.createDataFrame(texts, "id int, t string")
    phrases = [f"w{i} w{rng.randrange(4000)}" for i in range(0, 4000, 100)] + [f"w{i}" for i in range(50, 4000, 400)]
    phrases += [f"w{i} w1 w2 w3" for i in range(0, 4000, 500)]
    lexicon = tx.compile_lexicon(spark.createDataFrame([("mention", p) for p in phrases], "kind string, phrase string")).cache()
    lexicon.count()
    columns = ["id", "start", "end", "text"]
    small = sorted(map(tuple, tx.match_phrases(notes, lexicon, ["id"], "t").select(columns).collect()))
    rows, moved = exchanged(spark, tx.match_phrases(notes, lexicon, ["id"], "t", broadcast_rows=0).select(columns))
    assert sorted(map(tuple, rows)) == small and small
    # 40,000 tokens and three phrase lengths: 120,000 records without the bits
    assert moved < 25_000


def test_span_alignment_exchanges_touched_pieces(spark):
    rng = random.Random(4)
    texts = [(i, " ".join(f"word{rng.randrange(900)}" for _ in range(6000)) + ".") for i in range(30)]
    spans = [(i, at, at + 9) for i in range(0, 30, 10) for at in (100, 101, 20_000)]
    notes = spark.createDataFrame(texts, "id int, t string")
    found, moved = exchanged(spark, ng.align_spans(notes, spark.createDataFrame(spans, "id int, start int, end int"), ["id"], "t"))
    assert len(found) == len(spans)
    for r in found:
        met = [t for t in re.finditer(r"\w+|\.", texts[r.id][1]) if t.start() < r.end and t.end() > r.start]
        assert (r.token_start, r.token_end, r.n_tokens) == (met[0].start(), met[-1].end(), len(met))
    pieces = tx.split_pieces(notes, ["id"], "t").count()
    assert pieces > 600 and moved < pieces / 4
