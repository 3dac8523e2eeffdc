"""Negation scopes, cue lists and alignment of free spans to tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.arrays import running_start
from ..functions.bits import bit_table, marked
from ..functions.layout import tasks_by_key
from ..functions.storage import staged
from .text import CUT_KIND, MENTION_KIND, _tokens, compile_lexicon, match_phrases, phrase_table, resolve_overlaps, split_pieces

# --- fixed values: cue phrases ----------------------------------------------
PRECEDING_CUES = (
    "no",
    "not",
    "without",
    "denies",
    "absent",
    "negative for",
    "ruled out",
    "no evidence of",
    "no sign of",
    "no history of",
)
FOLLOWING_CUES = (
    "absent",
    "not present",
    "not detected",
    "not found",
    "ruled out",
    "negative",
)
TERMINATION_WORDS = ("but", "however", "though", "except")
# -----------------------------------------------------------------------------

MENTION, PRECEDING, FOLLOWING, TERMINATION = MENTION_KIND, "preceding", "following", CUT_KIND

#: characters per bucket of the span-to-piece range join
ALIGN_BUCKET = 2048


def cue_table(
    spark: SparkSession,
    preceding: Sequence[str] = PRECEDING_CUES,
    following: Sequence[str] = FOLLOWING_CUES,
    termination: Sequence[str] = TERMINATION_WORDS,
) -> DataFrame:
    """Cue phrases as ``kind, category, phrase``; the kind is the category."""
    lists = {PRECEDING: preceding, FOLLOWING: following, TERMINATION: termination}
    tables = [phrase_table(spark, {kind: words}, kind) for kind, words in lists.items() if words]
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def custom_cues(spark: SparkSession, cues: Sequence[str]) -> DataFrame:
    """A caller's list takes the place of both lists; every cue precedes."""
    return cue_table(spark, preceding=cues, following=())


def cue_lexicon_rows(cues: DataFrame) -> DataFrame:
    """Cues read by ``sources.read_cues`` with the fixed termination words."""
    words = phrase_table(cues.sparkSession, {TERMINATION: TERMINATION_WORDS}, TERMINATION)
    return cues.select("kind", F.col("kind").alias("category"), "phrase").unionByName(words).dropDuplicates()


def mark_cut_spans(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sets ``split`` where a termination word starts inside a span.

    For spans that do not come from a lexicon; matching knows it already.
    """
    after = Window.partitionBy(*keys, "sentence").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, -1)
    next_cut = F.min(F.when(F.col("kind") == TERMINATION, F.col("start"))).over(after)
    return events.withColumn("_cut", next_cut).withColumn(
        "split", F.col("split") | F.coalesce(F.col("_cut") < F.col("end"), F.lit(False))
    ).drop("_cut")


def scopes(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``scope``: a sentence cut again where a termination word starts.

    The word opens the new scope.
    """
    upto = Window.partitionBy(*keys, "sentence").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    return events.withColumn("scope", F.sum((F.col("kind") == TERMINATION).cast("int")).over(upto))


def flag_negated(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mentions among the events, with ``negated``.

    A preceding cue must start before the mention and a following cue end after
    it, in the one scope that holds the whole mention.  The earliest preceding
    start and the latest following end of a scope decide for all its mentions.
    """
    inside = Window.partitionBy(*keys, "sentence", "scope")
    first_pre = F.min(F.when(F.col("kind") == PRECEDING, F.col("start"))).over(inside)
    last_fol = F.max(F.when(F.col("kind") == FOLLOWING, F.col("end"))).over(inside)
    hit = F.coalesce(F.col("_pre") < F.col("start"), F.lit(False)) | F.coalesce(F.col("_fol") > F.col("end"), F.lit(False))
    return (
        scopes(events, keys)
        .withColumns({"_pre": first_pre, "_fol": last_fol})
        .where(F.col("kind") == MENTION)
        .withColumn("negated", ~F.col("split") & hit)
        .drop("_pre", "_fol", "scope", "sentence", "split", "kind")
    )


def negated_mentions(
    notes: DataFrame, lexicon_rows: DataFrame, cues: DataFrame, keys: Sequence[str], text: str
) -> DataFrame:
    """Dictionary mentions with their negation flag, in one pass over the text."""
    mentions = lexicon_rows.select(F.lit(MENTION).alias("kind"), F.lit(MENTION).alias("category"), "phrase").distinct()
    lexicon = compile_lexicon(mentions.unionByName(cues.select("kind", "category", "phrase")))
    events = tasks_by_key(match_phrases(notes, lexicon, keys, text), keys, notes)
    return resolve_overlaps(flag_negated(events, keys).drop("category"), keys)


def align_spans(notes: DataFrame, spans: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Widen character spans to all tokens they overlap.

    Adds ``token_start``, ``token_end``, ``n_tokens`` and the first and last
    sentence touched; all null where a span meets no token.  Spans and pieces
    meet by text key and character bucket, so a text with many spans, or a very
    long one, is spread over its buckets.  A set of bits made of the spans
    leaves out the pieces of other buckets before they are exchanged; a piece is
    exchanged as text and cut into tokens where it meets a span, since its tokens
    would take many times the room.
    """
    wanted = spans.select(*keys, F.col("start"), F.col("end")).where(F.col("end") > F.col("start")).distinct()
    wanted = wanted.withColumn("_b", F.explode(F.sequence(_bucket("start"), _bucket("end", -1))))
    wanted = staged(wanted, "spans")
    met = F.xxhash64(*keys, "_b")
    touched, bits = bit_table(wanted.select(*keys, "_b").distinct(), met)
    cut = split_pieces(notes, keys, text).withColumn("_stop", F.col("offset") + F.length("piece")).select(
        *keys, "sentence", "piece", "_stop", F.col("offset").alias("_first"),
        F.explode(F.sequence(_bucket("offset"), _bucket("_stop", -1))).alias("_b"),
    )
    pieces = marked(cut, met, touched, bits, "_met").where("_met").drop("_met")
    here = F.col("_first")
    touching = F.filter(
        "_t",
        lambda t: (t["w"] != " ")
        & (here + t["o"] < F.col("end"))
        & (here + t["o"] + F.length(t["w"]) > F.col("start")),
    )
    aligned = (
        wanted.join(pieces, [*keys, "_b"])
        .where((F.col("_first") < F.col("end")) & (F.col("_stop") > F.col("start")))
        .where(F.col("_b") == F.greatest(_bucket("_first"), _bucket("start")))
        .withColumn("_w", _tokens(F.col("piece"), 1))
        .withColumn("_s", _tokens(F.col("piece"), 0))
        .withColumn("_l", F.expr("transform(_s, s -> length(s))"))
        .withColumn("_o", running_start("_l", chunk=16))
        .withColumn("_t", F.arrays_zip(F.col("_w").alias("w"), F.col("_o").alias("o")))
        .withColumn("_hit", touching)
        .withColumns(
            {"_n": F.size("_hit"), "_head": F.try_element_at("_hit", F.lit(1)), "_tail": F.try_element_at("_hit", F.lit(-1))}
        )
        .groupBy(*keys, "start", "end")
        .agg(
            F.min(here + F.col("_head.o")).cast("int").alias("token_start"),
            F.max(here + F.col("_tail.o") + F.length("_tail.w")).cast("int").alias("token_end"),
            F.nullif(F.sum("_n"), F.lit(0)).cast("int").alias("n_tokens"),
            F.min(F.when(F.col("_n") > 0, F.col("sentence"))).alias("first_sentence"),
            F.max(F.when(F.col("_n") > 0, F.col("sentence"))).alias("last_sentence"),
        )
    )
    return spans.join(aligned, [*keys, "start", "end"], "left")


def _bucket(column: str, shift: int = 0):
    return F.floor((F.col(column) + shift) / ALIGN_BUCKET)


def negate_spans(
    notes: DataFrame, spans: DataFrame, cues: DataFrame, keys: Sequence[str], text: str
) -> DataFrame:
    """Negation for mentions found elsewhere; every input row comes back.

    Spans are aligned to tokens first.  Where aligned spans overlap only the
    longest is judged, the others stay not negated.
    """
    aligned = align_spans(notes, spans, keys, text)
    judged = resolve_overlaps(
        aligned.where(F.col("token_start").isNotNull())
        .select(
            *keys,
            F.col("token_start").alias("start"),
            F.col("token_end").alias("end"),
            "n_tokens",
            F.col("first_sentence").alias("sentence"),
            (F.col("first_sentence") != F.col("last_sentence")).alias("split"),
        )
        .distinct(),
        keys,
    )
    columns = [*keys, "kind", "start", "end", "sentence", "split"]
    lexicon = compile_lexicon(cues.select("kind", "category", "phrase"))
    events = (
        match_phrases(notes, lexicon, keys, text)
        .select(columns)
        .unionByName(judged.withColumn("kind", F.lit(MENTION)).select(columns))
    )
    events = tasks_by_key(events, keys, notes)
    flags = flag_negated(mark_cut_spans(events, keys), keys).select(
        *keys, F.col("start").alias("token_start"), F.col("end").alias("token_end"), "negated"
    )
    return aligned.join(flags, [*keys, "token_start", "token_end"], "left").withColumn(
        "negated", F.coalesce("negated", F.lit(False))
    )
