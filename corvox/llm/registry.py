"""Queries of the training-data operators over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvox.llm.audio import audio_digests
from corvox.llm.exact_dedup import exact_dedup
from corvox.llm.langid import identify
from corvox.llm.mixing import mixing_rates
from corvox.llm.ngram_join import ngram_components
from corvox.llm.packing import pack
from corvox.llm.sharding import rewritten
from corvox.llm.toxicity import toxicity
from corvox.llm.url_filter import filter_urls
from corvox.llm.warc import resolve_revisits


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(-1))


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a full response and as a later visit that found it not modified.

    A page is captured at second 1000 * page_id, with its body's MD5 as ETag; the second
    visit is 500 seconds later, or 500 earlier for every fifth id, and every fourth has the
    ETag of another body.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("md5"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string").alias("size"))
    page = F.col("page_id")
    first = pages.select(
        (2 * page).alias("record_id"), "url", F.lit("response").alias("type"), F.lit(200).alias("status"), (1000 * page).alias("t"),
        F.create_map(F.lit("etag"), F.concat(F.lit('W/"'), "md5", F.lit('"')), F.lit("content-length"), F.col("size"), F.lit("date"), (1000 * page).cast("string"), F.lit("server"), F.lit("a")).alias("headers"),
    )
    tag = F.when(page % 4 == 0, F.md5(F.concat("md5", F.lit("+")))).otherwise(F.col("md5"))
    later = F.when(page % 5 == 0, 1000 * page - 500).otherwise(1000 * page + 500)
    second = pages.select(
        (2 * page + 1).alias("record_id"), "url", F.lit("revisit").alias("type"), F.lit(304).alias("status"), later.alias("t"),
        F.create_map(F.lit("etag"), F.concat(F.lit('"'), tag, F.lit('"')), F.lit("content-length"), F.lit("0"), F.lit("date"), later.cast("string"), F.lit("cache-control"), F.lit("no-cache")).alias("headers"),
    )
    found = resolve_revisits(first.unionByName(second), "t")
    names = ("etag", "content-length", "date", "server", "cache-control")
    return found.select("record_id", "canonical_url", "source_id", "outcome", *(F.element_at("headers", n).alias(n.replace("-", "_")) for n in names))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 32 shards by a hash of the id to 40 shards of equal row counts; affected shards are
    written, and their rows read back from the files."""
    placed = rewritten(table(spark, sf_dir, "documents"), remainder("doc_id", 32), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op4_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio_digests(table(spark, sf_dir, "documents"))


def domain() -> Column:
    """Domain of a row of ``labels``."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean").when(F.col("quality") == 0, "junk")


MIXTURE = {"clean": 0.88, "junk": 0.07, "toxic": 0.05}


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), domain(), MIXTURE)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 3) == 1
    found = identify(table(spark, sf_dir, "documents"), held_out=held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", remainder("doc_id", 5) == 0)
    scored = toxicity(docs, table(spark, sf_dir, "labels"), held_out=remainder("doc_id", 5) == 0)
    return scored.select("doc_id", "held_out", "score", "predicted")


QUERIES = {
    "op1_warc_revisits": op1_warc_revisits,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_flow_resharding": op3_flow_resharding,
    "op4_audio_features": op4_audio_features,
    "op5_soft_mixing": op5_soft_mixing,
    "op6_ngram_join": op6_ngram_join,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_language_id": op8_language_id,
    "op9_url_filter": op9_url_filter,
    "op10_toxicity": op10_toxicity,
}

_CANONICAL = r"""
        WITH a AS (SELECT page_id, url, md5(coalesce(html, '')) AS md5, strlen(coalesce(html, '')) AS size, regexp_replace(url, '#[\s\S]*$', '') AS plain FROM pages),
        b AS (SELECT *, regexp_extract(plain, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*') AS host FROM a),
        c AS (SELECT *, substr(plain, length(host) + 1) AS rest FROM b),
        d AS (SELECT *, regexp_extract(rest, '^[^?]*') AS path FROM c),
        e AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(substr(rest, length(path) + 1), '([?&])utm_[^&]*', '\1', 'g'), '&+', '&', 'g'), '^\?&', '?'), '[?&]$', '') AS query FROM d),
        p AS (SELECT page_id, md5, size, CASE WHEN host = '' THEN url ELSE
            regexp_replace(regexp_replace(lower(host), '^(http://[^/?]*):80$', '\1'), '^(https://[^/?]*):443$', '\1')
            || CASE WHEN path = '' THEN '/' ELSE path END || query END AS canonical_url FROM e)"""

ORACLE = {
    "op1_warc_revisits": _CANONICAL + """,
        r AS (SELECT 2 * page_id AS id, canonical_url, 1000 * page_id AS t, 'W/"' || md5 || '"' AS etag, md5, size FROM p),
        v AS (SELECT 2 * page_id + 1 AS record_id, canonical_url, CASE WHEN page_id % 5 = 0 THEN 1000 * page_id - 500 ELSE 1000 * page_id + 500 END AS t,
            CASE WHEN page_id % 4 = 0 THEN md5(md5 || '+') ELSE md5 END AS tag FROM p),
        j AS (SELECT v.*, r.id AS source_id, r.md5, r.size FROM v ASOF LEFT JOIN r ON v.canonical_url = r.canonical_url AND v.t > r.t)
        SELECT record_id, canonical_url, source_id, CASE WHEN source_id IS NULL THEN 'orphan' WHEN tag = md5 THEN 'merged' ELSE 'mismatch' END AS outcome,
            CASE WHEN tag = md5 THEN '"' || tag || '"' END AS etag, CASE WHEN tag = md5 THEN size::VARCHAR END AS content_length, CASE WHEN tag = md5 THEN t::VARCHAR END AS date,
            CASE WHEN tag = md5 THEN 'a' END AS server, CASE WHEN tag = md5 THEN 'no-cache' END AS cache_control FROM j""",
    "op7_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g USING (t)""",
}
