"""License notices in texts: MinHash bands over overlapping windows, then exact containment.

Method.  A template of L words is sought in windows of 2 L words that start every
L + 1 words, so wherever it stands one window holds it whole.  Windows and
templates have signatures of ``BANDS`` least values; a band is one value.  A
window that holds a whole template shares at least (L - 4) / (2 L - 4) of its
shingles, and the chance that no band agrees is below 2e-4 (``missed``).
Templates that a window meets in a band are verified: the share of their
shingles in the window, exactly.

Only DataFrame functions are used.  A document none of whose shingles is in any
template cannot agree in a band and is left before windows are cut; this loses
nothing.  Templates are a parameter of bounded size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.storage import Scratch

SHINGLE = 5
PERCENT = 80
BANDS = 48
#: words in all templates together, so that they fit a plan and a broadcast
MAX_TEMPLATE_WORDS = 100_000

# --- fixed values: notices sought by default ------------------------------------------
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    " documentation files",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
    " the following conditions are met",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
# ---------------------------------------------------------------------------------------


def missed(words: int, bands: int = BANDS, shingle: int = SHINGLE) -> float:
    """Chance that a whole template of so many words meets its window in no band."""
    own = max(1, words - shingle + 1)
    return (1 - own / max(own, 2 * words - shingle + 1)) ** bands


def plain_words(text: str) -> Column:
    """Runs of letters and digits, A-Z in lower case; punctuation separates."""
    lower = f"translate(coalesce(`{text}`, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return F.expr(f"array_remove(split(regexp_replace({lower}, '[^\\\\p{{L}}\\\\p{{N}}]+', ' '), ' '), '')")


def _shingles(words: str) -> Column:
    rest = ", ".join(f"{words}[i + {k}]" for k in range(1, SHINGLE))
    return F.expr(
        f"case when size({words}) < {SHINGLE} then cast(array() as array<bigint>)"
        f" else transform(slice({words}, 1, size({words}) - {SHINGLE - 1}), (w, i) -> xxhash64(w, {rest})) end"
    )


def _bands(shingles: str, bands: int) -> Column:
    return F.expr(f"transform(sequence(1, {bands}), b -> array_min(transform({shingles}, s -> xxhash64(s, b))))")


def find_licenses(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    templates: Mapping[str, str] = TEMPLATES,
    bands: int = BANDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per document and license found in it: ``key, license, n_windows, first_word, percent``.

    A window holds a license when it has at least ``percent`` of the distinct
    5-word shingles of its template.  ``n_windows`` counts such windows (two may
    share one notice), ``first_word`` is where the first of them starts, from 0,
    and ``percent`` the best share, rounded down.

    Null and empty texts, and those of fewer than five words, hold nothing.
    Repeated rows and equal keys give one row: windows of one key count together.
    Null keys are a key.  Other columns are not read.
    """
    if sum(len(t.split()) for t in templates.values()) > MAX_TEMPLATE_WORDS:
        raise ValueError("too many template words; scan in several runs")
    spark = docs.sparkSession
    scratch = Scratch(spark, "licenses")
    sought = spark.createDataFrame(list(templates.items()), "license string, notice string")
    sought = sought.select("license", plain_words("notice").alias("words")).withColumn("shingles", F.array_distinct(_shingles("words")))
    sought = scratch.table(sought.where("size(shingles) > 0").select("license", F.size("words").alias("length"), "shingles"), "templates")
    known = sorted({s for r in sought.select("length", "shingles").collect() for s in r["shingles"]})  # bounded above
    lengths = sorted({r["length"] for r in sought.select("length").distinct().collect()})
    if not known:
        return spark.createDataFrame([], f"`{key}` {docs.schema[key].dataType.simpleString()}, license string, n_windows long, first_word long, percent long")

    # exploded, not filtered: a filter would be moved below the arrays and compute them anew
    known_here = F.array(*map(F.lit, known))
    rows = docs.select(F.col(key).alias("key"), plain_words(text).alias("words")).select("key", _shingles("words").alias("shingles"))
    on = F.explode(F.filter(F.array("shingles"), lambda s: F.arrays_overlap(s, known_here)))
    rows = scratch.table(rows.select("key", on.alias("shingles")), "candidates")
    each = F.explode(F.array(*(F.lit(n) for n in lengths))).alias("length")
    starts = F.explode(F.expr("sequence(0, greatest(size(shingles) - 1, 0), length + 1)")).alias("first_word")
    windows = rows.select("key", "shingles", each).select("key", "length", "shingles", starts).select(
        "key", "length", "first_word",
        F.expr(f"slice(shingles, first_word + 1, 2 * length - {SHINGLE - 1})").alias("held"),
    )
    windows = windows.where(F.arrays_overlap("held", known_here)).withColumn(
        "window", F.monotonically_increasing_id()
    )
    windows = scratch.table(windows.withColumn("signature", _bands("held", bands)), "windows")
    banded = windows.select("window", "length", F.posexplode("signature").alias("band", "value"))
    met = banded.join(
        sought.select("license", F.col("length"), F.posexplode(_bands("shingles", bands)).alias("band", "value")),
        ["length", "band", "value"],
    ).select("window", "license").distinct()
    checked = windows.select("window", "key", "first_word", "held").join(met, "window").join(
        sought.select("license", "shingles"), "license"
    )
    common = F.size(F.array_intersect("held", "shingles"))
    checked = checked.select(
        "key", "license", "first_word", common.alias("common"), F.size("shingles").alias("of")
    ).where(100 * F.col("common") >= percent * F.col("of"))
    return checked.groupBy(F.col("key").alias(key), "license").agg(
        F.count("*").alias("n_windows"), F.min("first_word").cast("long").alias("first_word"),
        F.max(F.floor(100 * F.col("common") / F.col("of"))).cast("long").alias("percent"),
    )
