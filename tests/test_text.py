"""Hand-worked notes, and random texts against a plain Python reading of the rules."""

import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from cohortlens.functions.arrays import running_start
from cohortlens.operators import negation as ng
from cohortlens.operators import symptoms as sy
from cohortlens.operators import text as tx

PHENOTYPES = {"p": ["seizures", "hypotonia", "ataxia", "tremor", "absent knee reflexes", "hearing loss", " "]}


def notes_df(spark, notes):
    return spark.createDataFrame([(i, n) for i, n in notes.items()], "id int, t string")


def phenotypes(spark, notes, cues=None):
    found = ng.negated_mentions(
        notes_df(spark, notes), tx.phrase_table(spark, PHENOTYPES, "mention"), cues or ng.cue_table(spark), ["id"], "t"
    )
    return sorted((r.id, r.text, r.start, r.end, r.negated) for r in found.collect())


def symptoms(spark, notes, **how):
    found = sy.symptom_mentions(notes_df(spark, notes), ["id"], "t", **how)
    return sorted((r.id, r.category, r.start, r.end, r.grade, r.negated) for r in found.collect())


def test_tokens(spark):
    note = "Temp 38.5°C. cancer-related  température élevée\nDr. No e.g. end"
    got = [(r.token, r.start) for r in tx.tokenize(notes_df(spark, {1: note}), ["id"], "t").orderBy("start").collect()]
    assert [t for t, _ in got] == [
        "Temp", "38.5", "°", "C", ".", "cancer", "-", "related", "  ", "température", "élevée", "\n", "Dr.", "No", "e.g.", "end",
    ]
    assert all(note[s : s + len(t)] == t for t, s in got)


def test_pieces_put_together_are_the_text(spark):
    texts = {1: "a b. c", 2: " lead", 3: "x" * 50 + ". " * 40, 4: "word " * 2000, 5: "...! ? )) -" * 300, 6: "\n\n \t end.\n"}
    rows = tx.split_pieces(notes_df(spark, texts), ["id"], "t").orderBy("id", "piece_no").collect()
    joined = {}
    for r in rows:
        assert r.offset == len(joined.get(r.id, ""))
        joined[r.id] = joined.get(r.id, "") + r.piece
    assert joined == texts


def test_running_start(spark):
    rows = spark.createDataFrame([([3] * n,) for n in (0, 1, 63, 64, 65, 1000)], "a array<int>")
    for r in rows.select("a", running_start("a").alias("s")).collect():
        assert r.s == [3 * i for i in range(len(r.a))]


def test_preceding_and_following_cues(spark):
    assert phenotypes(
        spark,
        {
            1: "Patient has no seizures.",
            2: "Seizures not present.",
            3: "Patient has hypotonia but no seizures.",
            4: "Without ataxia or tremor.",
            5: "Absent knee reflexes were noted bilaterally.",
            6: "Patient denies hearing loss.",
            7: "Patient presents with seizures.",
        },
    ) == [
        (1, "seizures", 15, 23, True),
        (2, "Seizures", 0, 8, True),
        (3, "hypotonia", 12, 21, False),
        (3, "seizures", 29, 37, True),
        (4, "ataxia", 8, 14, True),
        (4, "tremor", 18, 24, True),
        (5, "Absent knee reflexes", 0, 20, False),
        (6, "hearing loss", 15, 27, True),
        (7, "seizures", 22, 30, False),
    ]


def test_custom_cues(spark):
    notes = {1: "Patient has never had seizures.", 2: "Patient has no seizures.", 3: "Never, but seizures."}
    never = phenotypes(spark, notes, ng.custom_cues(spark, ["never"]))
    assert [r[-1] for r in never] == [True, False, False]
    assert [r[-1] for r in phenotypes(spark, notes, ng.custom_cues(spark, []))] == [False, False, False]


def test_symptoms(spark):
    assert symptoms(
        spark,
        {
            6: "Patient reports severe fatigue and grade 2 peripheral neuropathy. No nausea.",
            7: "Febrile neutropenia suspected.",
            8: "Blood  clot noted.",
            10: "No fever.\nNausea",
            11: "No fever\nNausea",
            12: "Temp 38.5 with no rash",
            13: "",
            14: None,
        },
    ) == [
        (6, "fatigue", 23, 30, 3, False),
        (6, "nausea", 69, 75, 3, True),
        (6, "neuropathy", 43, 64, 3, False),
        (7, "infection", 0, 19, None, False),
        (7, "neutropenia", 0, 19, None, False),
        (8, "thrombosis", 7, 11, None, False),
        (10, "fever", 3, 8, None, True),
        (10, "nausea", 10, 16, None, False),
        (11, "fever", 3, 8, None, True),
        (11, "nausea", 9, 15, None, True),
        (12, "rash", 18, 22, None, True),
    ]


def test_rollup_has_every_note(spark):
    notes = notes_df(spark, {1: "severe fatigue, no nausea", 2: "", 3: None})
    rolled = sy.note_rollup(notes, sy.symptom_mentions(notes, ["id"], "t"), ["id"]).orderBy("id").collect()
    assert [(r.categories_present, r.symptom_count, r.max_grade, r.has_fatigue, r.has_nausea) for r in rolled] == [
        (["fatigue"], 1, 3, True, False), ([], 0, None, False, False), ([], 0, None, False, False),
    ]


def test_grade_window_is_clipped_and_word_bound(spark):
    far = "severe " + "x" * 143 + " pain"  # "severe" starts 151 characters before the mention
    near = "severe " + "x" * 142 + " pain"
    assert [r[4] for r in symptoms(spark, {1: far, 2: near, 3: "severely painful, grade-4 rash", 4: "unmild_ pain"})] == [None, 3, 4, 4, None]


def test_vocabulary_can_grow(spark):
    vocab = tx.extend_vocabulary(sy.vocabulary(spark), tx.phrase_table(spark, {"new": ["hand foot"], "pain": ["ouch"]}, "mention"))
    assert [(r[1]) for r in symptoms(spark, {1: "hand foot, ouch, pain"}, vocab=vocab)] == ["new", "pain", "pain"]
    assert "new" not in sy.VOCABULARY and "ouch" not in sy.VOCABULARY["pain"]


def test_phrases_across_pieces(spark):
    long = "w " * 255 + "burning pain and " + "w " * 300 + "numbness"
    assert [(r[1], r[2]) for r in symptoms(spark, {1: long})] == [("neuropathy", 510 + 17 + 600), ("pain", 510)]
    lexicon = tx.compile_lexicon(tx.phrase_table(spark, {"c": ["hand. No"]}, "mention"))
    hit = tx.match_phrases(notes_df(spark, {1: "in hand. No more"}), lexicon, ["id"], "t").collect()
    assert [(h.start, h.end, h.text, h.split) for h in hit] == [(3, 11, "hand. No", True)]


def test_align_and_negate_free_spans(spark):
    notes = notes_df(spark, {1: "Patient has no seizures.", 2: "a  b", 3: "y" * 5000 + " no pain"})
    spans = spark.createDataFrame([(1, 16, 18), (1, 16, 18), (1, 11, 12), (2, 0, 4), (1, 90, 95), (3, 4998, 5003), (3, 5005, 5006)], "id int, start int, end int")
    got = ng.negate_spans(notes, spans, ng.cue_table(spark), ["id"], "t").collect()
    assert sorted(((r.id, r.start, r.token_start, r.token_end, r.negated) for r in got), key=str) == sorted(
        [
            (1, 16, 15, 23, True), (1, 16, 15, 23, True), (1, 11, None, None, False), (1, 90, None, None, False),
            (2, 0, 0, 4, False), (3, 4998, 0, 5003, False), (3, 5005, 5004, 5008, True),
        ],
        key=str,
    )


# ---- random texts --------------------------------------------------------------------

WORDS = ["no", "pain", "burning", "but", "absent", ".", "!", "(", ")", " ", "\n", "hand", "the", "not present", "3.5", "é", "Dr."]
PHRASES = {"a": ["pain", "burning pain", "the the", "pain the"], "b": ["the hand", "burning pain", "hand. the", "the the the", "pain but the"]}


def random_texts(count, seed):
    rng = random.Random(seed)
    return {i: "".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "", "  "]) for _ in range(rng.randint(0, 40))) for i in range(count)}


TOKEN = regex.compile(r"Dr\.|\p{L}[\p{L}\p{N}]*|\p{N}+(?:[.,]\p{N}+)*|\s+|[^\s\p{L}\p{N}]")


def read_tokens(text):
    """(token, start, sentence) of the tokens that are not a single blank."""
    out, sentence, ended = [], 0, False
    for m in TOKEN.finditer(text):
        token = m.group()
        if token == " ":
            continue
        if ended and not regex.fullmatch(r"\p{P}", token):
            sentence, ended = sentence + 1, False
        ended = ended or token in ".!?"
        out.append((token, m.start(), sentence))
    return out


def find_all(tokens, phrase):
    want = [t.lower() for t, _, _ in read_tokens(phrase.strip())]
    low = [t.lower() for t, _, _ in tokens]
    for i in range(len(low) - len(want) + 1):
        if low[i : i + len(want)] == want:
            last = tokens[i + len(want) - 1]
            yield tokens[i][1], last[1] + len(last[0]), len(want), tokens[i][2], last[2]


def keep_longest(spans):
    kept = []
    for s in sorted(set(spans), key=lambda s: (-s[2], s[0])):
        if all(s[1] <= k[0] or s[0] >= k[1] for k in kept):
            kept.append(s)
    return set(kept)


def brute(text):
    tokens = read_tokens(text)
    rows = [(c, *h) for c, ps in PHRASES.items() for p in ps for h in find_all(tokens, p)]
    survivors = [r for c in PHRASES for r in rows if r[0] == c and r[1:4] in keep_longest([x[1:4] for x in rows if x[0] == c])]
    best = keep_longest([r[1:4] for r in survivors])

    def cues(words):
        return [h for w in words for h in find_all(tokens, w)]

    cuts = sorted(h[0] for h in cues(ng.TERMINATION_WORDS))

    def scope(start, sentence):
        return sentence, sum(1 for c in cuts if c <= start and any(t[1] == c and t[2] == sentence for t in tokens))

    out = set()
    for c, s, e, n, s1, s2 in survivors:
        if (s, e, n) not in best:
            continue
        whole = s1 == s2 and not any(s < x < e for x in cuts)
        pre = any(scope(h[0], h[3]) == scope(s, s1) and h[0] < s for h in cues(ng.PRECEDING_CUES))
        fol = any(scope(h[0], h[3]) == scope(s, s1) and h[1] > e for h in cues(ng.FOLLOWING_CUES))
        out.add((c, s, e, whole and (pre or fol)))
    return out


@pytest.mark.parametrize("partitions", [1, 8])
def test_random_texts(spark, partitions):
    texts = random_texts(400, 7)
    df = notes_df(spark, texts).repartition(partitions)
    found = sy.symptom_mentions(df, ["id"], "t", vocab=tx.phrase_table(spark, PHRASES, "mention"))
    got = {i: set() for i in texts}
    for r in found.collect():
        got[r.id].add((r.category, r.start, r.end, r.negated))
    for i, text in texts.items():
        assert got[i] == brute(text), text


def test_large_lexicon_way_gives_the_same(spark):
    df = notes_df(spark, random_texts(200, 3))
    lexicon = tx.compile_lexicon(tx.phrase_table(spark, PHRASES, "mention"))
    columns = ["id", "category", "start", "end", "text", "sentence", "split"]
    small = tx.match_phrases(df, lexicon, ["id"], "t").select(columns).collect()
    large = tx.match_phrases(df, lexicon, ["id"], "t", broadcast_rows=0).select(columns).collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, large)) and len(small) > 100


def test_kept_spans_are_disjoint_in_one_long_island(spark):
    text = "the the the " * 3000
    lexicon = tx.compile_lexicon(tx.phrase_table(spark, {"a": ["the the", "the the the"]}, "mention"))
    found = sorted((r.start, r.end) for r in tx.find_mentions(notes_df(spark, {1: text}), lexicon, ["id"], "t").collect())
    assert len(found) == 3000 and all(a[1] <= b[0] for a, b in zip(found, found[1:]))
    assert all(re.fullmatch("the the the", text[s:e]) for s, e in found)


def test_overlaps_of_a_repetitive_text_take_time_in_proportion(spark):
    import time

    lexicon = tx.phrase_table(spark, {"m": ["the", "the the", "the the of", "of the", "of"]}, tx.MENTION_KIND)

    def seconds(repeats: int) -> float:
        notes = spark.createDataFrame([(1, "the of the " * repeats)], "id int, text string")
        start = time.perf_counter()
        assert tx.find_mentions(notes, tx.compile_lexicon(lexicon), ["id"], "text").count() >= repeats
        return time.perf_counter() - start

    seconds(100)
    small, large = seconds(10_000), seconds(40_000)
    assert large < 8 * max(small, 1.0)
