"""Tokens, dictionary matching and span resolution.

Matching reads each text once, in the task that scanned it.  A text is cut
into sentence pieces of bounded size, tokens of a piece meet the lexicon in a
hash join, and only the hits (a few narrow columns) are shuffled, once, by the
text key.  Everything after that works inside the key's partition.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.arrays import running_start
from ..functions.bits import bit_table, marked
from ..functions.grammar import KEY_SEP, PIECE, PIECE_ENDS, PIECE_TOKENS, SENTENCE_ENDERS, TOKEN
from ..functions.layout import tasks_by_key

#: a lexicon up to this size is probed in a broadcast hash join; beyond it whole
#: phrases are joined by key across the cluster
BROADCAST_LEXICON_ROWS = 500_000
BROADCAST_LEXICON_BYTES = 128 << 20
#: copies of a lexicon row that occurrences of a hot phrase are spread over
PHRASE_SALTS = 8

MENTION_KIND, CUT_KIND = "mention", "termination"
LEXICON_COLUMNS = ("n_tokens", "first_token", "phrase_key", "inner_end")


def _tokens(text: Column, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(group))


def _joined(tokens: Column, first: Column, count: Column, sep: str) -> Column:
    return F.array_join(F.slice(tokens, first, count), sep)


# --------------------------------------------------------------------------
# pieces and tokens
# --------------------------------------------------------------------------


def split_pieces(
    notes: DataFrame,
    keys: Sequence[str],
    text: str,
    before_chars: int = 0,
    ahead_chars: int = 0,
) -> DataFrame:
    """Sentence pieces of every text, without a shuffle.

    Columns: ``keys``, ``piece_no``, ``sentence`` (ordinal in the text),
    ``offset`` (characters before the piece), ``ended`` (the sentence ends
    here), ``piece`` and, when asked for, the ``before`` and ``ahead``
    neighbourhood of the piece.

    Arrays are exploded with the outer form here and below.  For the inner form
    the optimizer adds a not-empty filter on the array and pushes it down, so
    the expressions behind the array would be computed again for the filter.
    """
    ended = f"length(p) < {PIECE_TOKENS} or regexp_like(p, {_quoted(PIECE_ENDS)})"  # a piece cut for its size is long
    cut = notes.select(*keys, F.regexp_extract_all(F.col(text), F.lit(PIECE), F.lit(0)).alias("_p")).select(
        "*", F.expr("transform(_p, p -> length(p))").alias("_len"), F.expr(f"transform(_p, p -> int({ended}))").alias("_end")
    )
    parts = {"piece": F.col("_p"), "offset": running_start("_len"), "sentence": running_start("_end"), "ended": F.col("_end")}
    if before_chars:
        parts["before"] = _neighbours("_p", before_chars, after=False)
    if ahead_chars:
        parts["ahead"] = _neighbours("_p", ahead_chars, after=True)
    return (
        cut.select(*keys, F.arrays_zip(*[c.alias(n) for n, c in parts.items()]).alias("_z"))
        .select(*keys, F.posexplode_outer("_z").alias("piece_no", "_r"))
        .where(F.col("piece_no").isNotNull())
        .select(
            *keys,
            "piece_no",
            F.col("_r.sentence").cast("int").alias("sentence"),
            F.col("_r.offset").cast("int").alias("offset"),
            (F.col("_r.ended") == 1).alias("ended"),
            *[f"_r.{c}" for c in ("piece", "before", "ahead") if c in parts],
        )
    )


def _quoted(text: str) -> str:
    """A raw SQL string literal."""
    return f"r'{text}'"


def _neighbours(pieces: str, chars: int, after: bool) -> Column:
    """Up to ``chars`` characters next to each piece of an array column.

    A piece has at least one character, so ``chars`` pieces always suffice; a
    handful nearly always do and are tried first.
    """
    few = 6
    if after:
        side, rest = "left", f"size({pieces}) - 1 - i"
        window = f"array_join(slice({pieces}, i + 2, {{n}}), '')"
    else:
        side, rest = "right", "i"
        window = f"array_join(slice({pieces}, greatest(i - {{n}}, 0) + 1, least(i, {{n}})), '')"
    near, far = window.format(n=few), window.format(n=chars)
    enough = f"{rest} <= {few} or length({near}) >= {chars}"
    return F.expr(f"transform({pieces}, (p, i) -> {side}(if({enough}, {near}, {far}), {chars}))")


def tokenize(notes: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """One row per token: ``pos``, ``token``, ``start``, ``end`` (end exclusive)."""
    return (
        split_pieces(notes, keys, text)
        .withColumn("_w", _tokens(F.col("piece"), 1))
        .withColumn("_s", _tokens(F.col("piece"), 0))
        .withColumn("_l", F.expr("transform(_s, s -> length(s))"))
        .withColumn("_o", running_start("_l", chunk=16))
        .select(*keys, "piece_no", "offset", F.posexplode_outer(F.arrays_zip(F.col("_w").alias("w"), F.col("_o").alias("o"))).alias("i", "_t"))
        .where(F.col("_t.w") != " ")
        .select(
            *keys,
            F.col("piece_no"),
            F.col("i").alias("piece_pos"),
            F.col("_t.w").alias("token"),
            (F.col("offset") + F.col("_t.o")).cast("int").alias("start"),
            (F.col("offset") + F.col("_t.o") + F.length("_t.w")).cast("int").alias("end"),
        )
    )


# --------------------------------------------------------------------------
# lexicons
# --------------------------------------------------------------------------


def phrase_table(spark: SparkSession, phrases: Mapping[str, Iterable[str]], kind: str) -> DataFrame:
    """A constant table ``kind, category, phrase`` from {category: [phrases]}."""
    rows = [{"kind": kind, "category": c, "phrase": p} for c, ps in phrases.items() for p in ps]
    return constant_table(spark, rows, "kind string, category string, phrase string")


def constant_table(spark: SparkSession, rows: Sequence[Mapping[str, object]], schema: str) -> DataFrame:
    """Rows named in code, as one literal that the optimizer sees whole."""
    parsed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema.replace(' ', ': ').replace(',: ', ', ')}>>")
    return spark.range(0, 1, 1, 1).select(F.inline_outer(parsed)).where(F.col(schema.split()[0]).isNotNull())


def extend_vocabulary(vocabulary: DataFrame, extra: DataFrame) -> DataFrame:
    """Both vocabularies together; new categories are welcome."""
    return vocabulary.unionByName(extra).dropDuplicates()


def compile_lexicon(phrases: DataFrame) -> DataFrame:
    """Tokenise phrases like texts; blank phrases match nothing and are left out.

    Adds ``n_tokens``, ``first_token``, ``phrase_key`` and ``inner_end`` (a
    sentence ends inside the phrase); one row per payload and token sequence.
    """
    others = [c for c in phrases.columns if c != "phrase"]
    words = F.array_remove(_tokens(F.trim("phrase")), " ")
    tokens = F.col("_w")

    def ends_inside(i: Column) -> Column:
        later = F.slice(tokens, i + 1, F.size(tokens))
        return F.element_at(tokens, i).isin(*SENTENCE_ENDERS) & F.exists(
            later, lambda t: ~F.regexp_like(t, F.lit(r"^\p{P}$"))
        )

    return (
        phrases.where(F.length(F.regexp_replace("phrase", r"\s+", "")) > 0)
        .withColumn("_w", words)
        .select(
            *others,
            F.size("_w").alias("n_tokens"),
            F.lower(F.element_at("_w", 1)).alias("first_token"),
            F.lower(F.array_join("_w", KEY_SEP)).alias("phrase_key"),
            F.exists(F.sequence(F.lit(1), F.size("_w")), ends_inside).alias("inner_end"),
        )
        .dropDuplicates([*others, "phrase_key"])
    )


# --------------------------------------------------------------------------
# matching
# --------------------------------------------------------------------------


def match_phrases(
    notes: DataFrame,
    lexicon: DataFrame,
    keys: Sequence[str],
    text: str,
    context_chars: int = 0,
    broadcast_rows: int = BROADCAST_LEXICON_ROWS,
    broadcast_bytes: int = BROADCAST_LEXICON_BYTES,
) -> DataFrame:
    """Every occurrence of every lexicon phrase, overlaps included.

    ``lexicon`` comes from :func:`compile_lexicon`; its payload columns are
    kept.  Adds ``start``, ``end``, ``text`` (as written), ``n_tokens``,
    ``sentence``, ``split`` (the span runs over a sentence end, or a phrase of
    kind ``termination`` starts inside it) and, with ``context_chars``, the text
    around the span as ``context``.
    """
    payload = [c for c in lexicon.columns if c not in LEXICON_COLUMNS]
    texts = [c for c, t in lexicon.dtypes if t == "string" and c in payload]
    size = lexicon.agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.length("phrase_key")).alias("chars"),
        F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in [*texts, "first_token", "phrase_key"]), F.lit(64))).alias("bytes"),
        F.collect_set("n_tokens").alias("lengths"),
        F.collect_set(F.when(F.col("kind") == CUT_KIND, F.struct("n_tokens", "phrase_key")) if "kind" in payload else F.lit(None)).alias("cuts"),
    ).first()
    reach = (size["chars"] or 0) + 1  # a span has as many inner blanks as the key has separators, or fewer

    pieces = split_pieces(notes, keys, text, before_chars=context_chars, ahead_chars=reach + context_chars)
    tokens = (
        pieces.withColumn("_next", F.left("ahead", F.lit(reach)))
        .withColumn("_own", _tokens(F.col("piece"), 1))
        .withColumn("_w", F.concat("_own", _tokens(F.col("_next"), 1)))
        .withColumn("_s", F.concat(_tokens(F.col("piece"), 0), _tokens(F.col("_next"), 0)))
        .select(
            *keys, "sentence", "offset", "ended", "piece", "ahead", "_w", "_s",
            *(["before"] if context_chars else []),
            F.posexplode_outer("_own").alias("_i", "_t"),
        )
    )
    def located(rows: DataFrame, extra: Sequence[Column | str]) -> DataFrame:
        """Spans of ``n_tokens`` tokens from token ``_i`` of a piece."""
        at = F.length(_joined(F.col("_s"), F.lit(1), F.col("_i"), ""))
        span = F.rtrim(_joined(F.col("_s"), F.col("_i") + 1, F.col("n_tokens"), ""))
        placed = rows.withColumn("at", at).withColumn("span", span).withColumn("stop", F.col("at") + F.length("span"))
        columns = [
            *keys,
            *extra,
            (F.col("offset") + F.col("at")).alias("start"),
            (F.col("offset") + F.col("stop")).alias("end"),
            F.col("span").alias("text"),
            "n_tokens",
            "sentence",
            ((F.col("ended") & (F.col("stop") > F.length("piece"))) | _cut_inside(size["cuts"])).alias("split"),
        ]
        if context_chars:
            around = F.concat("before", "piece", "ahead")
            first = F.greatest(F.length("before") + F.col("at") - context_chars, F.lit(0))
            last = F.length("before") + F.col("stop") + context_chars
            columns.append(F.substring(around, first + 1, last - first).alias("context"))
        return placed.select(*columns)

    key_at = F.lower(_joined(F.col("_w"), F.col("_i") + 1, F.col("n_tokens"), KEY_SEP))
    if size["rows"] <= broadcast_rows and (size["bytes"] or 0) <= broadcast_bytes:
        hits = tokens.join(F.broadcast(lexicon), F.lower("_t") == F.col("first_token")).where(key_at == F.col("phrase_key"))
        found = located(hits, [*payload, "inner_end"])
    else:
        # spans of every phrase length go to their phrase as narrow rows; a
        # phrase that is everywhere is spread over copies of its row
        lengths = F.array(*[F.lit(n) for n in sorted(size["lengths"])])
        salt = F.pmod(F.xxhash64(*keys, "offset", "_i"), F.lit(PHRASE_SALTS)).cast("int")
        # most tokens start no phrase, which a set of bits tells before anything is laid out or exchanged
        starts, bits = bit_table(lexicon.select("first_token").distinct(), F.xxhash64("first_token"), size["rows"])
        able = marked(tokens.where(F.col("_t") != " "), F.xxhash64(F.lower("_t")), starts, bits, "_able").where("_able").drop("_able")
        spans = able.select("*", F.explode(lengths).alias("n_tokens"))
        copies = lexicon.drop("first_token").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(PHRASE_SALTS - 1))))
        narrow = located(spans, [key_at.alias("phrase_key"), salt.alias("_salt")])
        # a span at the end of a text has fewer tokens than asked for, so the count is joined too
        found = narrow.join(copies, ["phrase_key", "n_tokens", "_salt"]).drop("phrase_key", "_salt")
    return found.withColumn("split", F.col("split") | F.col("inner_end")).drop("inner_end")


def _cut_inside(cuts: Iterable) -> Column:
    """Whether one of the (n_tokens, phrase_key) phrases starts after the span's first token."""
    out = F.lit(False)
    for tokens, key in sorted(cuts):
        later = _joined(F.col("_w"), F.col("_i") + 2, F.col("n_tokens") + (tokens - 2), KEY_SEP)
        out = out | F.contains(F.lower(F.concat(F.lit(KEY_SEP), later, F.lit(KEY_SEP))), F.lit(f"{KEY_SEP}{key}{KEY_SEP}"))
    return (F.col("n_tokens") > 1) & out


# --------------------------------------------------------------------------
# overlap resolution
# --------------------------------------------------------------------------


def resolve_overlaps(spans: DataFrame, keys: Sequence[str], within: str | None = None) -> DataFrame:
    """Keep the longest spans, earlier first on ties, so that none overlap.

    ``spans`` needs ``start``, ``end`` and ``n_tokens``; a span that occurs
    several times under one key is one candidate and all its rows are kept.
    With ``within`` the spans of each value of that column are resolved first,
    then what is left of all.
    Spans are cut into islands that do not touch each other; inside an island
    the choice is made length by length, each in one pass.
    """
    payload = [c for c in spans.columns if c not in (*keys, "start", "end", "n_tokens")]
    earlier = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    running = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    members = (
        spans.withColumn("_new", (F.coalesce(F.max("end").over(earlier), F.lit(-1)) <= F.col("start")).cast("int"))
        .withColumn("_island", F.sum("_new").over(running))
        .groupBy(*keys, "_island")
        .agg(
            F.min("start").alias("_base"),
            F.max("end").alias("_top"),
            F.collect_list(F.struct("start", "end", "n_tokens", *payload)).alias("_all"),
        )
    )
    if within:
        groups = f"array_distinct(transform(_all, s -> s.{within}))"
        kept = f"flatten(transform({groups}, g -> {_kept_of(f'filter(_all, s -> s.{within} = g)')}))"
        members = members.withColumn("_all", F.expr(f"if(size(_all) = 1, _all, {kept})"))
    return (
        members.withColumn("_kept", F.expr(f"if(size(_all) = 1, _all, {_kept_of('_all')})"))
        .select(*keys, F.explode_outer("_kept").alias("_r"))  # an island keeps at least one span
        .select(*keys, "_r.start", "_r.end", "_r.n_tokens", *[F.col(f"_r.{c}").alias(c) for c in payload])
    )


def _kept_of(spans: str) -> str:
    """SQL array of the spans that are kept; mask and spans are bound once."""
    return f"transform(array({spans}), a -> transform(array({_CHOOSE}), mask -> filter(a, s -> {_CHOSEN}))[0])[0]"


# Spans are chosen by length, longest first.  Of one length, those that touch no
# chosen span are taken from left to right, which needs only the end of the last
# one taken; so a length costs one pass over the island, whatever it holds.  The
# mask of an island has a byte per character: 0 free, 1 first of a chosen span, 2
# further in one.

def _bind(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


# array_distinct compares structs pair by pair, so equals are found as neighbours
_CANDIDATES = _bind(
    "sorted",
    "sort_array(transform(a, s -> struct(s.start as start, s.`end` as `end`, s.n_tokens as n)))",
    "filter(sorted, (s, i) -> i = 0 or s <> get(sorted, i - 1))",
)

_MASK = (
    "cast(concat(array_join(transform(chosen, (s, i) -> concat(repeat('0', s.start - if(i = 0, _base, get(chosen, i - 1).`end`)),"
    " '1', repeat('2', s.`end` - s.start - 1))), ''),"
    " repeat('0', _top - if(size(chosen) = 0, _base, get(chosen, size(chosen) - 1).`end`))) as binary)"
)
#: spans folded at once; appending copies, so a long fold is cut into short ones
_CHUNK = 64
_LEFT_TO_RIGHT = (
    f"aggregate(transform(sequence(0, (size(x) - 1) div {_CHUNK}), i -> slice(x, i * {_CHUNK} + 1, {_CHUNK})),"
    " struct(x[0].start as e, array(slice(x, 1, 0)) as o), (acc, c) -> "
    + _bind(
        "r",
        "aggregate(c, struct(acc.e as e, slice(x, 1, 0) as f),"
        " (t, s) -> if(s.start >= t.e, struct(s.`end` as e, array_append(t.f, s) as f), t))",
        "struct(r.e as e, array_append(acc.o, r.f) as o)",
    )
    + ", acc -> flatten(acc.o))"
)
_FREE = (
    "filter(all, s -> s.n = -minus and"
    " substring(mask, s.start - _base + 1, s.`end` - s.start) = cast(repeat('0', s.`end` - s.start) as binary))"
)
_CHOOSE = _bind(
    "all",
    _CANDIDATES,
    "aggregate(sort_array(array_distinct(transform(all, s -> -s.n))), slice(all, 1, 0), (chosen, minus) -> "
    + _bind(
        "x", _bind("mask", _MASK, _FREE),
        f"if(size(x) = 0, chosen, sort_array(concat(chosen, {_LEFT_TO_RIGHT})))",
    )
    + f", chosen -> {_MASK})",
)
_MARK = "concat('1', repeat('2', s.`end` - s.start - 1))"
_CHOSEN = (
    f"substring(mask, s.start - _base + 1, s.`end` - s.start) = cast({_MARK} as binary)"
    " and substring(mask, s.`end` - _base + 1, 1) <> cast('2' as binary)"
)


def find_mentions(notes: DataFrame, lexicon: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Dictionary mentions of every text, in text order by ``start``."""
    hits = match_phrases(notes, lexicon.select(*LEXICON_COLUMNS).distinct(), keys, text)
    return resolve_overlaps(tasks_by_key(hits, keys, notes), keys)
