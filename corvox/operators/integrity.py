"""Missing and orphaned files, and integrity statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def presence(manifest: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """Every key of either side with ``status``: OK, MISSING (no file) or ORPHAN (no manifest row)."""
    a = manifest.select(*keys).distinct().withColumn("_m", F.lit(True))
    b = files.select(*keys).distinct().withColumn("_f", F.lit(True))
    status = F.when(F.col("_m").isNull(), "ORPHAN").when(F.col("_f").isNull(), "MISSING").otherwise("OK")
    return a.join(b, keys, "full_outer").withColumn("status", status).drop("_m", "_f")


def integrity_stats(found: DataFrame, by: str) -> DataFrame:
    """Manifest rows, files, orphans and missing by script, and PASS where there are none of the last two."""
    of = lambda *s: F.count_if(F.col("status").isin(*s))
    stats = found.groupBy(by).agg(of("OK", "MISSING").alias("meta"), of("OK", "ORPHAN").alias("wav"), of("ORPHAN").alias("orphan"), of("MISSING").alias("missing"))
    return stats.withColumn("verdict", F.when((F.col("orphan") == 0) & (F.col("missing") == 0), "PASS").otherwise("FAIL"))


def found_missing(manifest: DataFrame, files: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Files found and missing by script."""
    b = files.select(*keys).distinct().withColumn("_f", F.lit(True))
    return manifest.join(b, keys, "left").groupBy(by).agg(F.count_if("_f").alias("found"), F.count_if(F.col("_f").isNull()).alias("missing"))


def quarantine(found: DataFrame) -> DataFrame:
    """Orphans as rows to move, a logical move that a partitioned write carries out."""
    return found.withColumn("place", F.when(F.col("status") == "ORPHAN", "quarantine").otherwise("dataset"))
