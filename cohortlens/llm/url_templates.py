"""URL filter: fixed rules first, then a tree of path templates per host.

Method.  The segments of a path lead down a tree below its host; digits of a
segment count as one shape from the start.  Level by level, a segment whose
labelled share of bad pages differs significantly from that of its siblings
together stays as it is, digits or not and however rare; any other becomes a
wildcard, but for an only child without digits.  What is merged goes down as one
branch.  The template at the end of a path is rejected when its bad
share, smoothed towards that of all labelled pages, reaches a threshold.

Only DataFrame functions are used.  Pages are counted by host and shape before
anything is shuffled, so a host of a third of all pages is a few shapes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.storage import Scratch

#: standard errors by which a branch must differ from its siblings
DIFFERENT = 3.0
#: labelled pages a branch must have to stand for itself
LABELLED = 20
#: strength of the prior, in pages, and the share of bad pages to reject
PRIOR, REJECT = 20.0, 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: str) -> tuple[Column, Column]:
    """Host and path of a URL column; both empty for a null URL or one without ``://``."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule and verdict for columns ``host`` and ``path``, both null where none fits.

    A rule (verdict, host, path) fits its host and every subdomain when the path
    starts with the rule's; the longest one wins.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name, verdict = F.when(fits, host + path).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def shape_of(path: str) -> Column:
    """Segments of a path with each run of digits as ``#``, at any depth."""
    return F.filter(F.split(F.regexp_replace(F.col(path), r"[0-9]+", "#"), "/"), lambda s: s != "")


def templates(shapes: DataFrame, scratch: Scratch) -> DataFrame:
    """``host, shape, template`` for the shapes ``host, shape, labelled, bad`` of all pages."""
    now = shapes.withColumns({"template": F.array().cast("array<string>"), "ends": F.size("shape")})
    level, before = 0, None
    while (now.agg(F.max("ends")).first()[0] or 0) > level:
        now = now.withColumn("segment", F.when(F.col("ends") > level, F.get("shape", F.lit(level))))
        child = now.where("segment is not null").groupBy("host", "template", "segment").agg(
            F.count("*").alias("shapes"), F.sum("labelled").alias("l"), F.sum("bad").alias("b")
        )
        parent = child.groupBy("host", "template").agg(
            F.count("*").alias("children"), F.sum("l").alias("all_l"), F.sum("b").alias("all_b")
        )
        both = child.join(parent, ["host", "template"])
        share = lambda a, b: F.try_divide(a.cast("double"), b)  # noqa: E731  null where nothing is labelled
        rest_l, pooled = F.col("all_l") - F.col("l"), share(F.col("all_b"), F.col("all_l"))
        error = F.sqrt(pooled * (1 - pooled) * (share(F.lit(1), F.col("l")) + share(F.lit(1), rest_l)))
        gap = F.abs(share(F.col("b"), F.col("l")) - share(F.col("all_b") - F.col("b"), rest_l))
        # of an only child there is nothing to tell apart
        differs = (F.col("l") >= LABELLED) & (rest_l >= LABELLED) & (gap > DIFFERENT * error)
        only = (F.col("children") == 1) & ~F.col("segment").contains("#")
        stays = F.coalesce(differs, F.lit(False)) | only
        # a shape alone in its branch meets only children from here on
        alone = (F.col("shapes") == 1) & (stays | (F.col("children") == 1))
        named = both.select(
            "host", "template", "segment", F.when(stays, F.col("segment")).otherwise("*").alias("as"), alone.alias("alone")
        )
        tail = F.transform(F.slice("shape", level + 2, F.greatest(F.size("shape"), F.lit(1))), lambda s: F.when(s.contains("#"), "*").otherwise(s))
        now = now.join(named, ["host", "template", "segment"], "left").select(
            "host", "shape", "labelled", "bad", F.when(F.col("alone"), 0).otherwise(F.col("ends")).alias("ends"),
            F.when(F.col("as").isNull(), F.col("template")).when(F.col("alone"), F.concat("template", F.array("as"), tail))
            .otherwise(F.concat("template", F.array("as"))).alias("template"),
        )
        now = scratch.table(now, "level")
        if before is not None:
            scratch.drop(before)
        before, level = now, level + 1
    return now


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per page: ``key, host, path, rule, verdict, template, purity``.

    ``labels`` has ``key, bad`` (boolean) for some pages; of several labels of a
    page any bad one counts.  ``rules`` are (verdict, host, path) triples and
    come first; other pages are blocked when the smoothed bad share of their
    template is ``REJECT`` or more.  Templates are learnt from all pages.

    A null URL, or one without ``://``, has an empty host and path and is judged
    like any other; so are pages with a null key, which have no label.  Repeated
    rows get one verdict each and count each.  Other columns are not read.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    host, path = url_parts("_url")
    parts = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("_url")).select(
        "key", host.alias("host"), path.alias("path")
    )
    rows = scratch.table(parts.withColumn("shape", shape_of("path")), "pages")
    marked = labels.where(F.col("bad").isNotNull()).groupBy(F.col(key).alias("label_key")).agg(
        F.max(F.col("bad").cast("int")).alias("bad")
    )
    counted = rows.join(marked, F.col("key") == F.col("label_key"), "left").groupBy("host", "shape").agg(
        F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    counted = scratch.table(counted, "shapes")
    all_bad, all_labelled = counted.agg(F.sum("bad"), F.sum("labelled")).first()
    base = (all_bad or 0) / all_labelled if all_labelled else 0.0
    found = templates(counted, scratch)
    judged = found.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    purity = (F.col("bad") + PRIOR * base) / (F.col("labelled") + PRIOR)
    judged = found.select("host", "shape", "template").join(
        judged.select("host", "template", purity.alias("purity")), ["host", "template"]
    )
    rule, verdict = rule_of(rules)
    method = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return rows.join(judged, ["host", "shape"]).select(
        F.col("key").alias(key), "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity",
    )
