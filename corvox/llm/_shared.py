"""Helpers that the operators of this subpackage share: the shared folder, written
intermediate tables and skew-free ranks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: ``spark.checkpoint.dir`` of the session.
    Only a local master may go without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return "/tmp/checkpoints"


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/corvox-{label}-{uuid.uuid4().hex}"


def remove_at_end(spark: SparkSession, path: str) -> None:
    """The driver removes what is written at ``path`` when it ends."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, so a lost
    executor costs a re-read and not a re-run. The driver removes the table when it ends."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    remove_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(name: str, df: DataFrame) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def own(df: DataFrame) -> DataFrame:
    """``df`` with columns of its own: a join with the table it comes from is never ambiguous."""
    return df.toDF(*df.columns)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python operators of this session get: long texts come few
    at a time. Results don't depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def salted(df: DataFrame) -> DataFrame:
    """Add ``_salt``, one of a few numbers per shuffle partition, to a table that is about to be
    written. Rows are dealt in turn, so that rows alike in all columns get different ones."""
    return df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(4 * width(df.sparkSession))).cast("int"))


def distributed_rank(df: DataFrame, keys: list[str], order: list[str | Column], out: str) -> DataFrame:
    """Add ``out``: a gapless rank from 0 within ``keys``, in order of (``_salt``, ``order``).

    A key may hold any share of the rows: rows are numbered within (key, salt), and each salt
    starts where the ones before it end. Only counts, one row per (key, salt), come together by
    key. ``df`` must be a written table with ``_salt``, which goes.
    """
    starts = (
        df.groupBy(*keys, "_salt").count()
        .withColumn("_start", F.coalesce(F.sum("count").over(
            Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("count")
    )
    local = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order))
    return (
        df.withColumn("_local", local)
        .join(starts, [*keys, "_salt"])
        .withColumn(out, F.col("_start") + F.col("_local") - 1)
        .drop("_salt", "_start", "_local")
    )
