"""Not-modified revisits of a crawl, resolved to the response they stand for.

Method.  An as-of join by canonical URL gives each revisit the latest earlier
full response.  Its validators are compared, and if they agree the headers of
the revisit that may change are put over those of the response.

All records are sorted by URL and time in ranges, so one URL may span many
tasks.  A task looks back within its range; the last response of each URL in
each range is carried to the ranges behind it.  Only URL, time, id and kind of a
record are sorted; headers are fetched for revisits and their responses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.storage import Scratch

# --- fixed values: header names a not-modified response may renew (RFC 9110, 15.4.5) ---
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: query parameters that do not name a resource
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)="
# -----------------------------------------------------------------------------------------


def canonical_url(url: str) -> Column:
    """Without scheme, ``www.``, default port, fragment, tracking parameters and final slash; parameters sorted.

    Host names are lower-cased (A-Z).  A null URL stays null.
    """
    bare = F.regexp_replace(F.regexp_replace(F.col(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.translate(F.regexp_extract(bare, r"^([^/?]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    asked = F.regexp_extract(bare, r"^[^?]*\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def merged_headers(old: str, new: str) -> Column:
    """The response's headers with the permitted ones of the revisit put over them."""
    renewed = F.map_filter(F.coalesce(F.col(new), F.create_map().cast("map<string,string>")), lambda k, _: k.isin(*PERMITTED))
    stays = F.map_filter(
        F.coalesce(F.col(old), F.create_map().cast("map<string,string>")), lambda k, _: ~F.array_contains(F.map_keys(renewed), k)
    )
    return F.map_concat(stays, renewed)


def latest_before(events: DataFrame, scratch: Scratch) -> DataFrame:
    """``row, response_row`` of the events ``url, at, id, row, full`` that are not full: the latest full one before."""
    order = ["url", "at", "full", "id", "row"]
    # at one time a revisit looks at what was there before: it sorts ahead of responses
    ranged = events.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = scratch.table(ranged.withColumn("place", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("part", F.shiftright("place", 33))
    here = Window.partitionBy("part", "url").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.last(F.when(F.col("full"), F.col("row")), ignorenulls=True).over(here)
    looked = ranged.withColumn("inside", inside)
    ends = ranged.groupBy("url", "part").agg(F.max_by("row", F.when(F.col("full"), F.col("place"))).alias("end"))
    # as many rows per URL as ranges it spans
    before = Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("url").alias("_url"), F.col("part").alias("_part"), F.last("end", ignorenulls=True).over(before).alias("carried"))
    carried = carried.where("carried is not null")
    asked = looked.where("not full").join(carried, (F.col("url") == F.col("_url")) & (F.col("part") == F.col("_part")), "left")
    return asked.select("row", F.coalesce("inside", "carried").alias("response_row"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: ``record_id, url, outcome, response_id, headers, digest, length``.

    ``records``: ``record_id, url, at, kind ('response' or 'revisit'), etag,
    last_modified, digest, length, headers map<string,string>`` with header
    names in lower case.

    Record ids are only carried along and may repeat or be null: each row is a
    record, so a revisit given k times has k rows, each with one response, and
    ``response_id`` is null where the response found has no id (``outcome`` then
    still tells that there is one).  Of responses to one URL at one time the one
    of the greatest id serves, a null id being the least; of equal ids any one.

    ``outcome`` is ``resolved`` when a validator that both sides have agrees
    (entity tags first, then modification dates, then payload digests);
    ``mismatch`` when it does not; ``unverified`` when they share none; and
    ``no response`` when nothing full came earlier.  Digest, length and merged
    headers are given for resolved revisits only.

    At equal times a response does not count as earlier.  Revisits with a null
    URL or time have no earlier response, and such responses serve nobody; other
    kinds are left out.  Other columns are not read.
    """
    scratch = Scratch(records.sparkSession, "revisits")
    named = records.where("kind in ('response', 'revisit')").select(
        "record_id", canonical_url("url").alias("url"), "at", (F.col("kind") == "response").alias("full"), "etag",
        "last_modified", "digest", "length", "headers",
    )
    named = scratch.table(named.withColumn("row", F.monotonically_increasing_id()), "records")
    events = named.select("url", "at", "full", F.col("record_id").alias("id"), "row").where("url is not null and at is not null")
    found = latest_before(events, scratch).withColumnRenamed("row", "asked_row")
    asked = named.where("not full").drop("length", "full", "at")
    base = named.where("full").select(
        F.col("row").alias("base_row"), F.col("record_id").alias("response_id"), F.col("etag").alias("base_etag"), F.col("last_modified").alias("base_modified"),
        F.col("digest").alias("base_digest"), F.col("length").alias("base_length"), F.col("headers").alias("base_headers"),
    )
    joined = asked.join(found, F.col("row") == F.col("asked_row"), "left").join(
        base, F.col("response_row") == F.col("base_row"), "left"
    )
    agrees = F.coalesce(
        F.col("etag") == F.col("base_etag"), F.col("last_modified") == F.col("base_modified"), F.col("digest") == F.col("base_digest")
    )
    outcome = (
        F.when(F.col("base_row").isNull(), "no response").when(agrees.isNull(), "unverified").when(agrees, "resolved").otherwise("mismatch")
    )
    good = F.col("outcome") == "resolved"
    return joined.withColumn("outcome", outcome).select(
        "record_id", "url", "outcome", "response_id", F.when(good, merged_headers("base_headers", "headers")).alias("headers"),
        F.when(good, F.col("base_digest")).alias("digest"), F.when(good, F.col("base_length")).alias("length"),
    )
