"""Ontology graph to term table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import Scratch

# --- fixed values -----------------------------------------------------------------
ROOT = "HP:0000118"
IS_A = "is_a"
TERM_TYPE = "CLASS"
UNKNOWN_VERSION = "unknown"
# ----------------------------------------------------------------------------------


def node_id(uri: Column) -> Column:
    """Last path part, its first ``HP_`` written ``HP:``."""
    return F.regexp_replace(F.substring_index(uri, "/", -1), r"^(.*?)HP_", "$1HP:")


def release_version(url: Column) -> Column:
    """Release date in the URL, else the URL, else ``unknown``."""
    date = F.regexp_extract(url, r"/releases/(\d{4}-\d{2}-\d{2})/", 1)
    return F.coalesce(F.when(date != "", date).otherwise(url), F.lit(UNKNOWN_VERSION))


def subtree(edges: DataFrame, root: str = ROOT) -> DataFrame:
    """All ids below ``root`` over ``is_a`` edges, the root included.

    Every id that is left picks one parent, one that is in the subtree if it
    has any.  Along the picks ids jump to the parent of their parent, then twice
    as far, so a chain takes as many rounds as its length has binary digits.
    Who arrives at the root is in; who jumps to an id without a parent is out
    for this pick.  Ids whose pick led elsewhere pick anew, until no edge leads
    from the subtree to an id outside.  Cycles end, since no further id arrives;
    shared children count once; null ids and edges to oneself do not count.
    Joins are merges: compressed ids look small enough to broadcast when they
    are not, and every broadcast passes through the driver.
    """
    scratch = Scratch(edges.sparkSession, "subtree")
    child, parent = node_id(F.col("sub")), node_id(F.col("obj"))
    links = scratch.table(
        edges.where(F.col("pred") == IS_A).select(parent.alias("parent"), child.alias("id"))
        .where((F.col("parent") != F.col("id")) & (F.col("id") != root)).distinct(),
        "links",
    )
    inside = scratch.table(edges.sparkSession.range(0, 1, 1, 1).select(F.lit(root).alias("id")), "inside")
    at_root = F.col("top") == root
    while True:
        known = inside.select(F.col("id").alias("parent"), F.lit(True).alias("known"))
        choice = F.min(F.struct(F.col("known").isNull().alias("open"), "parent"))
        picked = (
            links.join(inside.hint("merge"), "id", "left_anti").join(known.hint("merge"), "parent", "left").groupBy("id").agg(choice.alias("p"))
            .select("id", F.when(~F.col("p.open"), root).otherwise(F.col("p.parent")).alias("top"))
        )
        jumps = scratch.table(picked, "jumps")
        arrived, under_way = _arrivals(jumps, at_root)
        if not arrived:
            scratch.drop(links, jumps)
            return inside
        while under_way:
            further = jumps.select(F.col("id").alias("top"), F.col("top").alias("beyond"))
            longer = jumps.where(~at_root).join(further.hint("merge"), "top").select("id", F.col("beyond").alias("top"))
            jumped = scratch.table(jumps.where(at_root).unionByName(longer), "jumps")
            scratch.drop(jumps)
            jumps, before = jumped, arrived
            arrived, under_way = _arrivals(jumps, at_root)
            if arrived == before:
                break
        grown = scratch.table(inside.unionByName(jumps.where(at_root).select("id")), "inside")
        scratch.drop(inside, jumps)
        inside = grown


def _arrivals(jumps: DataFrame, at_root: Column) -> tuple[int, int]:
    """How many ids point to the root, and how many elsewhere."""
    counted = jumps.agg(F.count_if(at_root), F.count_if(~at_root)).first()
    return counted[0], counted[1]


def build_terms(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Labelled class nodes of the subtree as ``ord, id, label, synonyms, definition``."""
    label = F.regexp_replace(F.coalesce("lbl", F.lit("")), r"^\s+|\s+$", "")
    values = F.transform(F.coalesce("meta.synonyms", F.array().cast("array<struct<pred:string,val:string>>")), lambda s: s["val"])
    return (
        nodes.where(F.col("type") == TERM_TYPE)
        .select(
            "ord",
            node_id(F.coalesce("id", F.lit(""))).alias("id"),
            label.alias("label"),
            F.filter(values, lambda v: v.isNotNull() & (v != "")).alias("synonyms"),
            F.coalesce("meta.definition.val", F.lit("")).alias("definition"),
        )
        .where(F.col("label") != "")
        .join(members.hint("merge"), "id", "left_semi")  # no broadcast, see subtree
    )


def label_synonym_pairs(terms: DataFrame, order: str = "ord", buckets: int = 1024) -> DataFrame:
    """``vector_idx, hpo_id, text``: each label, then its synonyms, in term order.

    ``order`` must be unique.  The dense index is counted per range of the
    order first, so no single task sees all pairs.
    """
    pairs = terms.select(
        F.col(order).alias("_ord"),
        F.col("id").alias("hpo_id"),
        F.posexplode(F.concat(F.array("label"), F.coalesce("synonyms", F.array().cast("array<string>")))).alias("_pos", "text"),
    )
    span = pairs.agg(F.min("_ord").alias("low"), F.max("_ord").alias("high")).first()
    if span["low"] is None:
        return pairs.select(F.lit(None).cast("bigint").alias("vector_idx"), "hpo_id", "text")
    width = max(1, -(-(span["high"] - span["low"] + 1) // buckets))
    pairs = pairs.withColumn("_b", F.floor((F.col("_ord") - span["low"]) / width))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # at most `buckets` rows
    bases = pairs.groupBy("_b").count().select("_b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_ord", "_pos"))
    return pairs.join(F.broadcast(bases), "_b").select((F.col("_base") + rank - 1).alias("vector_idx"), "hpo_id", "text")


def lookup_terms(requests: DataFrame, terms: DataFrame, key: str = "hpo_id") -> DataFrame:
    """Requested ids with their term, nulls where there is none."""
    return requests.join(
        terms.select(F.col("id").alias(key), "label", "synonyms", "definition").hint("merge"), key, "left"
    )


def ontology_stats(terms: DataFrame, version_url: DataFrame) -> DataFrame:
    """One row: version, number of terms, number of label and synonym texts."""
    counts = terms.agg(
        F.count(F.lit(1)).alias("term_count"),
        F.coalesce(F.sum(1 + F.size("synonyms")), F.lit(0)).alias("vector_count"),
    )
    version = version_url.agg(F.first("version_url").alias("u")).select(release_version(F.col("u")).alias("version"))
    return counts.select(version.scalar().alias("version"), "term_count", "vector_count")

