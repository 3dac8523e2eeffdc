"""The operators over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.lexical import rank_documents
from cohortlens.llm.licenses import find_licenses
from cohortlens.llm.mixing import mix
from cohortlens.llm.near_duplicates import near_duplicates
from cohortlens.llm.neighbours import nearest_vectors
from cohortlens.llm.packing import pack
from cohortlens.llm.pieces import decode_pieces, encode_pieces
from cohortlens.llm.quality import quality_rules
from cohortlens.llm.revisits import resolve_revisits
from cohortlens.llm.sharding import shard
from cohortlens.llm.substrings import drop_repeats
from cohortlens.llm.url_templates import filter_urls, url_parts
from cohortlens.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crawl_records(pages: DataFrame) -> DataFrame:
    """Crawl records made from pages: a response and three revisits each, and one of the host's front page.

    The revisits of a page carry its validator, a stale one and a date only; of
    a front page every fiftieth record is a full response, the others are
    revisits, so front pages of large sites have very many records.
    """
    host, _ = url_parts("url")
    at = F.col("page_id") * 1000
    etag = F.md5("html")
    headers = lambda *more: F.create_map(*map(F.lit, ("content-type", "text/html")), F.lit("date"), F.col("at").cast("string"), *more)
    front = F.concat(F.lit("v"), F.pmod(F.expr("page_id div 50"), F.lit(4)))

    def record(no: int, kind, url, when, tag, modified) -> DataFrame:
        full = kind == "response" if isinstance(kind, str) else None
        kind = F.lit(kind) if isinstance(kind, str) else kind
        out = pages.select(
            (F.col("page_id") * 5 + no).alias("record_id"), url.alias("url"), when.alias("at"), kind.alias("kind"), tag.alias("etag"),
            modified.alias("last_modified"), F.when(kind == "response", etag).alias("digest"),
            F.when(kind == "response", F.octet_length("html")).cast("long").alias("length"),
        )
        more = [F.lit("server"), F.lit("a")] if full else [F.lit("cache-control"), F.lit("no-cache")]
        return out.withColumn("headers", headers(*more))

    none = F.lit(None).cast("string")
    day = F.concat(F.lit("day "), F.pmod(F.col("page_id"), F.lit(7)).cast("string"))
    url = F.col("url")
    return (
        record(0, "response", url, at, etag, day)
        .unionByName(record(1, "revisit", F.regexp_replace(url, "^http:", "https:"), at + 500, etag, none))
        .unionByName(record(2, "revisit", F.concat(url, F.lit("#top")), at + 700, F.lit("stale"), day))
        .unionByName(record(3, "revisit", url, at - 1, none, day))
        .unionByName(record(
            4, F.when(F.col("page_id") % 50 == 0, "response").otherwise("revisit"), F.concat(F.lit("http://"), host, F.lit("/")),
            at + 250, front, none,
        ))
    )


def op3_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(crawl_records(_table(spark, sf_dir, "pages")))
    told = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.withColumn("headers", F.array_join(told, ";"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op7_drop_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = drop_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents")).drop("distance2")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest_vectors(vectors, vectors.where("vec_id % 20 = 0"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


#: sources by the last digit of their number; weights of domains and languages
MIX = {
    "domain": "case when source rlike '[0-3]$' then 'web' when source rlike '[4-6]$' then 'books' else 'forum' end",
    "weights": {"domain": {"web": 2, "books": 2, "forum": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}},
    "share": 0.8,
    "epochs": 2,
}


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"), **MIX).drop("text_crc32")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(_table(spark, sf_dir, "documents"))


URL_RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op10_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document whose number its path names: bad if of low quality or toxic."""
    pages = _table(spark, sf_dir, "pages")
    _, path = url_parts("url")
    number = F.regexp_extract(path, r"([0-9]+)", 1).try_cast("long")
    labels = pages.select("page_id", number.alias("doc_id")).join(_table(spark, sf_dir, "labels"), "doc_id")
    labels = labels.select("page_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return filter_urls(pages, labels, URL_RULES).drop("template", "purity")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_pieces(_table(spark, sf_dir, "documents"), model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), "ids",
    )
    decoded = decode_pieces(encoded, model)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_quality_rules": op2_quality_rules,
    "op3_revisits": op3_revisits,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_neighbours": op5_neighbours,
    "op6_sharding": op6_sharding,
    "op7_drop_repeats": op7_drop_repeats,
    "op8_mixing": op8_mixing,
    "op9_licenses": op9_licenses,
    "op10_url_templates": op10_url_templates,
    "op11_lexical_search": op11_lexical_search,
    "op12_whitening": op12_whitening,
    "op13_pieces": op13_pieces,
}
