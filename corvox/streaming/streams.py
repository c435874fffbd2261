"""Structured Streaming forms of incremental work."""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvox.operators.align import AlignConfig, align


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions by user with late data up to ``late``: start, end, events, value. Works on a stream and on a table."""
    session = F.session_window("ts", gap)
    found = events.withWatermark("ts", late).groupBy("user_id", session).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    return found.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n", "value")


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts by type and window."""
    w = F.window("ts", width)
    return events.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")


def incremental(stream: DataFrame, work, path: str, checkpoint: str):
    """Work on new rows only; what is done is kept by the query's checkpoint, and each
    micro-batch writes its own folder, so that a repeated batch replaces itself."""

    def run(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def align_stream(stream: DataFrame, lines: DataFrame, files: DataFrame, path: str, checkpoint: str, config: AlignConfig = AlignConfig()):
    """J1 on recordings as they arrive: a micro-batch holds segments of whole recordings, goes on
    from the pointers that the batches before left as checkpoint rows, and writes its own
    folder. What the pointer passes is logged; the tail of a script isn't, as more may come."""
    spark, kept = stream.sparkSession, replace(config, checkpoints=True, log_tail=False)
    keys = ["script_id", "file_idx"]

    def run(batch: DataFrame, number: int) -> None:
        try:
            before = spark.read.parquet(path).where((F.col("batch") < number) & (F.col("kind") == "checkpoint"))
        except AnalysisException:  # the first batch
            before = None
        came = batch.select(*keys).distinct()
        align(batch, lines, files.join(came, keys, "left_semi"), kept, before).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
