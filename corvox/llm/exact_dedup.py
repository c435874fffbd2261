"""Exact dedup by an extendible-hash index on shared files (DataFrame functions only).

1. *Postings*: (id, 64-bit hash, SHA-256) of every row go to a shared file.
2. *Directory*: rows are counted by hash prefix. Starting from one bucket, the directory
   doubles and overfull buckets split by one more hash bit until each holds at most
   ``bucket_rows`` rows or ``max_depth`` is reached. It has at most 2**max_depth entries,
   which bounds what is broadcast. A bucket that is still overfull (one hot key cannot be
   split) gets a chain of overflow pages.
3. *Owner tasks*: a bucket is a contiguous range of hash keys; each row goes, with its text, to
   the task that owns its page of its bucket (a task owns several). There, rows of equal hash are compared byte by byte
   (grouping by the text itself), and different texts of one hash are chained.
   Overflow pages of a bucket are merged afterwards, again by bytes.
4. The index (bucket, hash, chain place, SHA-256, kept id, count) is written to a shared
   file, and postings look their entry up in it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvox.llm._shared import materialize, width

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def directory(postings: DataFrame, bucket_rows: int, depth: int) -> DataFrame:
    """(leaf, bucket, pages) for each of the 2**depth hash prefixes, by repeated doubling."""
    spark = postings.sparkSession
    counts = [0] * (1 << depth)
    for leaf, n in postings.groupBy(leaf_of("_h", depth).alias("leaf")).count().collect():  # at most 2**depth rows
        counts[leaf] = n
    rows, bucket = [], 0
    open_buckets = [(0, 0)]  # (local depth, prefix), in order of keys
    while open_buckets:
        local, prefix = open_buckets.pop()
        first, size = prefix << (depth - local), 1 << (depth - local)
        n = sum(counts[first : first + size])
        if n > bucket_rows and local < depth:
            open_buckets += [(local + 1, 2 * prefix + 1), (local + 1, 2 * prefix)]
            continue
        pages = max(1, math.ceil(n / bucket_rows))
        rows += [(leaf, bucket, pages) for leaf in range(first, first + size)]
        bucket += 1
    return materialize(spark.createDataFrame(rows, "leaf long, bucket long, pages int"), "exact-directory")


def leaf_of(hash_col: str, depth: int) -> Column:
    return F.shiftrightunsigned(F.shiftrightunsigned(F.col(hash_col), 63 - depth), 1)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int | None = None, max_depth: int = 20) -> tuple[DataFrame, DataFrame]:
    """Return (postings, index): postings are _id, _h, _sha for every row; index has one
    row for each different normalised text: bucket, _h, chain, _sha, keep_id, group_size.

    ``bucket_rows`` defaults to a quarter of the rows of an average shuffle partition, so
    that the directory grows with the number of tasks and not with the data.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_t")).withColumn("_h", F.xxhash64("_t"))
    postings = materialize(base.select("_id", "_h", F.sha2("_t", 256).alias("_sha")), "exact-postings")
    rows, tasks = postings.count(), width(spark)
    bucket_rows = bucket_rows or max(64, math.ceil(rows / (4 * tasks)))
    depth = min(max_depth, 3 + max(0, math.ceil(math.log2(max(1, rows / bucket_rows)))))
    where = F.broadcast(directory(postings, bucket_rows, depth))  # at most 2**max_depth rows of 20 bytes

    owned = (
        base.withColumn("leaf", leaf_of("_h", depth)).join(where, "leaf")
        .withColumn("page", F.pmod(F.xxhash64("_id"), F.col("pages")))
        .select("bucket", "page", "pages", "_h", "_t", "_id")
        .repartition(tasks, "bucket", "page")
    )
    in_page = (
        owned.groupBy("bucket", "page", "pages", "_h", "_t")
        .agg(F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        .select("bucket", "page", "_h", F.sha2("_t", 256).alias("_sha"), F.when(F.col("pages") > 1, F.col("_t")).alias("_paged"), "keep_id", "n")
        .withColumn("_place", F.when(F.col("_paged").isNotNull(), 0).otherwise(
            F.row_number().over(Window.partitionBy("bucket", "page", "_h").orderBy("_sha", "keep_id"))))
    )
    chain = Window.partitionBy("_h").orderBy("_sha")
    index = (
        in_page.repartition(tasks, "_h")
        .groupBy("bucket", "_h", "_sha", "_paged", "_place")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
        .withColumn("chain", F.when(F.lag("_sha").over(chain) == F.col("_sha"), F.raise_error(F.lit("two texts share a SHA-256"))).otherwise(F.row_number().over(chain)).cast("int"))
        .select("bucket", "_h", "chain", "_sha", "keep_id", "group_size")
    )
    return postings, materialize(index, "exact-index")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **index) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, bucket, chain.

    Null text counts as empty, and all empty texts are one group. Of equal texts the row
    with the largest id stays; rows that repeat an id and its text share its decision
    (``dedup_rows`` keeps one of them). A null id is kept only where its group has no
    other. Other columns are not read. An empty table gives no rows.
    """
    postings, entries = build_index(docs, id_col, text_col, **index)
    return postings.join(entries, ["_h", "_sha"]).select(
        F.col("_id").alias(id_col), "keep_id", "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("_sha").alias("text_sha256"), "bucket", "chain",
    )


def dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **index) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names; one row of
    each text."""
    _, entries = build_index(docs, id_col, text_col, **index)
    stay = entries.select(F.col("keep_id").alias("_k"), F.col("_sha").alias("_s"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.sha2(normalised(F.col(text_col)), 256).alias("sha"))
    kept = keyed.join(stay, F.col("id").eqNullSafe(F.col("_k")) & (F.col("sha") == F.col("_s")), "left_semi")
    return kept.dropDuplicates(["id", "sha"]).select("row.*")
