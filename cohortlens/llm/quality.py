"""Quality rules for documents: fixed base rules, then robust multivariate outliers.

Method.  Four transformed statistics of a document form a vector.  For each cell
of language and source, location and scatter are the minimum-covariance-
determinant estimates: starting from medians and median absolute deviations,
concentration steps keep the ``SHARE`` of documents nearest to the estimate and
estimate again from them.  A document far from its cell's centre, by Mahalanobis
distance, is rejected.

Most documents have no symbols, no repeated lines and no repeated words at all,
so the nearest ones often agree exactly.  A share has an error by chance even
then: counts are square-rooted and shares are taken by arcsine, after which this
error is the same for all of them, and it is added to the scatter.

Only DataFrame functions are used.  Statistics are integers (thousandths), so
sums do not depend on how rows are laid out.  A step aggregates by cell and
distance bin before anything is shuffled; a cell of a third of all rows is a few
thousand bins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.storage import Scratch

# --- fixed values: the base rules ------------------------------------------------
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# ------------------------------------------------------------------------------------

#: share of a cell's documents that the estimates rest on
SHARE = 0.75
STEPS = 5
#: cells with fewer documents are put together, first by language, then all
MIN_CELL = 100
#: standard deviation that a statistic has by chance in a text of 300 words and 12 lines, in thousandths: words of like
#: mean length; symbols, which come in threes; repeated lines; repeated words, which come in sixes
FLOORS = (30, 50, 144, 71)
#: chance of a regular document to be rejected, were statistics normal
ALPHA = 1e-5
DIMENSIONS = 4
#: distance bins per unit of distance
BINS = 64


def _chi2_4(x: float) -> float:
    return 1 - math.exp(-x / 2) * (1 + x / 2)


def _chi2_6(x: float) -> float:
    return 1 - math.exp(-x / 2) * (1 + x / 2 + x * x / 8)


def _solve(f, p: float) -> float:
    lo, hi = 0.0, 200.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < p else (lo, mid)
    return lo


#: squared distance beyond which a document is rejected
CUTOFF = round(_solve(_chi2_4, 1 - ALPHA), 6)
#: makes the scatter of the nearest SHARE consistent for normal data
CONSISTENCY = round(SHARE / _chi2_6(_solve(_chi2_4, SHARE)), 6)

_BLANK = r"[\\t\\n\\x0B\\f\\r]"


def text_statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` and ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` of whole texts.

    A null text has no words and no lines.  Work on a text of n words takes
    n log n steps; arrays are as long as the text.
    """
    cut = docs.select(
        *keep,
        F.expr(f"array_remove(split(regexp_replace(coalesce(`{text}`, ''), '{_BLANK}', ' '), ' '), '')").alias("words"),
        F.expr(f"length(coalesce(`{text}`, '')) - length(regexp_replace(coalesce(`{text}`, ''), '[{SYMBOLS}]', ''))").alias(
            "n_symbols"
        ),
        F.expr(
            f"filter(split(coalesce(`{text}`, ''), '\\n'), x -> length(trim(BOTH ' \\t\\n\\u000B\\f\\r' FROM x)) > 0)"
        ).alias("lines"),
    )
    hashed = cut.select(
        *keep, "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "case when size(words) < 4 then array() else transform(slice(words, 1, size(words) - 2),"
            " (w, i) -> xxhash64(w, words[i + 1], words[i + 2])) end"
        ).alias("triples"),
    )
    marked = hashed.select(
        *keep, "n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines",
        F.expr(
            "case when size(array_distinct(triples)) = size(triples) then array()"
            " else sort_array(transform(triples, (h, i) -> struct(h, i))) end"
        ).alias("sorted"),
    )
    twice = "filter(sorted, (p, j) -> p.h = get(sorted, j - 1).h or p.h = get(sorted, j + 1).h)"
    return marked.select(
        *keep, "n_words", "word_chars", F.col("n_symbols").cast("long").alias("n_symbols"), "n_lines", "n_dup_lines",
        F.expr(f"size(array_distinct(flatten(transform({twice}, p -> array(p.i, p.i + 1, p.i + 2)))))").cast("long").alias(
            "n_repeat_words"
        ),
    )


def _vector() -> list[Column]:
    """The statistics, transformed so that their error by chance does not depend on their size."""
    words = F.col("n_words")
    share = lambda part, whole: F.round(1000 * F.asin(F.sqrt(F.col(part) / F.col(whole)))).cast("long")
    return [
        F.round(1000 * F.log(F.col("word_chars") / words)).cast("long").alias("x0"),
        F.round(1000 * F.sqrt(F.col("n_symbols") / words)).cast("long").alias("x1"),
        share("n_dup_lines", "n_lines").alias("x2"),
        share("n_repeat_words", "n_words").alias("x3"),
    ]


def _cells(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Which cell each pair of language and source belongs to."""
    own = scratch.table(rows.groupBy("lang", "source").agg(F.count("*").alias("n")), "counts")
    by_lang = own.where(F.col("n") < MIN_CELL).groupBy(F.col("lang").alias("pooled")).agg(F.sum("n").alias("of_lang"))
    level = F.when(F.col("n") >= MIN_CELL, 0).when(F.col("of_lang") >= MIN_CELL, 1).otherwise(2)
    named = (
        level.alias("level"), F.when(level < 2, F.col("lang")).alias("lang"), F.when(level < 1, F.col("source")).alias("source")
    )
    return own.join(by_lang, F.col("lang").eqNullSafe(F.col("pooled")), "left").select(
        F.col("lang").alias("cell_lang"), F.col("source").alias("cell_source"), F.to_json(F.struct(*named)).alias("cell")
    )


def _start(rows: DataFrame) -> DataFrame:
    """Median of each statistic and its median absolute deviation, per cell, as a diagonal estimate."""
    long = rows.select("cell", F.posexplode(F.array(*(f"x{i}" for i in range(DIMENSIONS)))).alias("dim", "value"))
    counted = long.groupBy("cell", "dim", "value").agg(F.count("*").alias("n"))

    def middle(frame: DataFrame, value: str) -> DataFrame:
        grouped = frame.groupBy("cell", "dim", value).agg(F.sum("n").alias("n"))
        w = Window.partitionBy("cell", "dim")
        up_to = F.sum("n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
        return grouped.select("cell", "dim", value, up_to.alias("up_to"), F.sum("n").over(w).alias("of")).where(
            "2 * up_to >= of"
        ).groupBy("cell", "dim").agg(F.min(value).alias("middle"))

    med = middle(counted, "value")
    away = counted.join(med, ["cell", "dim"]).select("cell", "dim", F.abs(F.col("value") - F.col("middle")).alias("away"), "n")
    mad = middle(away, "away").withColumnRenamed("middle", "mad")
    floors = F.element_at(F.array(*map(F.lit, FLOORS)), F.col("dim") + 1)
    one = med.join(mad, ["cell", "dim"]).select(
        "cell", "dim", F.col("middle").cast("double").alias("m"), F.greatest(1.4826 * F.col("mad"), floors.cast("double")).alias("s")
    )
    at = [F.max(F.when(F.col("dim") == i, F.col(c))).alias(f"{c}{i}") for i in range(DIMENSIONS) for c in ("m", "s")]
    flat = one.groupBy("cell").agg(*at)
    root = [
        (F.col(f"s{i}") if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i in range(DIMENSIONS) for j in range(i + 1)
    ]
    return flat.select("cell", *(f"m{i}" for i in range(DIMENSIONS)), *root)


def _with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance, by forward substitution with the Cholesky root."""
    out = rows.join(estimates, "cell")
    for i in range(DIMENSIONS):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"y{j}")
        out = out.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    d = F.lit(0.0)
    for i in range(DIMENSIONS):
        d = d + F.col(f"y{i}") * F.col(f"y{i}")
    return out.withColumn("d2", d)


def _concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One step: estimates from the SHARE of each cell that is nearest to the given ones."""
    pairs = [(i, j) for i in range(DIMENSIONS) for j in range(i + 1)]
    sums = [F.sum(f"x{i}").alias(f"t{i}") for i in range(DIMENSIONS)]
    sums += [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in pairs]
    bin_of = F.floor(F.least(F.sqrt("d2"), F.lit(10000.0)) * BINS).cast("int")
    binned = _with_distance(rows, estimates).groupBy("cell", bin_of.alias("bin")).agg(F.count("*").alias("n"), *sums)
    w = Window.partitionBy("cell")
    before = F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    near = binned.withColumns({"before": F.coalesce(before, F.lit(0)), "of": F.sum("n").over(w)}).where(
        F.col("before") < F.ceil(SHARE * F.col("of"))
    )
    names = ["n"] + [f"t{i}" for i in range(DIMENSIONS)] + [f"q{i}{j}" for i, j in pairs]
    out = near.groupBy("cell").agg(*(F.sum(c).cast("double").alias(c) for c in names))
    out = out.select(
        "cell", *((F.col(f"t{i}") / F.col("n")).alias(f"m{i}") for i in range(DIMENSIONS)),
        *(
            (
                CONSISTENCY * (F.col(f"q{i}{j}") / F.col("n") - (F.col(f"t{i}") / F.col("n")) * (F.col(f"t{j}") / F.col("n")))
                + (FLOORS[i] ** 2 if i == j else 0)
            ).alias(f"c{i}{j}")
            for i, j in pairs
        ),
    )
    for i, j in pairs:  # Cholesky root, row by row
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    return out.select("cell", *(f"m{i}" for i in range(DIMENSIONS)), *(f"l{i}{j}" for i, j in pairs))


def quality_rules(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """One row per input row: ``key``, the base statistics, ``base_failed``, ``distance2``, ``kept``.

    Base statistics are those of ``text_statistics``.  ``base_failed`` when there
    are fewer than 50 words, or more than half of the words lie in repeated
    windows of three.  Other documents are judged by their squared distance in
    the cell of their language and source; ``distance2`` is null for failed ones.

    A null text has no words and fails.  A null language or source is a value of
    its own.  Cells under ``MIN_CELL`` documents are put together by language,
    and if that is not enough with those of all languages, however few.
    Repeated rows are judged each for itself, null keys like others; other
    columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    rows = docs.select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("body"), F.col(lang).cast("string").alias("lang"),
        F.col(source).cast("string").alias("source"),
    )
    stats = text_statistics(rows, "body", ("key", "lang", "source"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    stats = scratch.table(stats.withColumn("base_failed", failed), "statistics")
    passed = stats.where("not base_failed")
    cells = _cells(passed, scratch)
    in_cells = (F.col("lang").eqNullSafe(F.col("cell_lang"))) & (F.col("source").eqNullSafe(F.col("cell_source")))
    vectors = scratch.table(
        passed.join(cells, in_cells).select("key", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                                            "n_repeat_words", "cell", *_vector()),
        "vectors",
    )
    estimates = scratch.table(_start(vectors), "estimates")
    for _ in range(STEPS):
        nearer = scratch.table(_concentrate(vectors, estimates), "estimates")
        scratch.drop(estimates)
        estimates = nearer
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = _with_distance(vectors, estimates).select(
        "key", *names, F.lit(False).alias("base_failed"), F.col("d2").alias("distance2"), (F.col("d2") <= CUTOFF).alias("kept")
    )
    out = stats.where("base_failed").select(
        "key", *names, "base_failed", F.lit(None).cast("double").alias("distance2"), F.lit(False).alias("kept")
    )
    return judged.unionByName(out).withColumnRenamed("key", key)
