"""Aggregate reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvox.functions.constants import FAILURE_TYPES, GATE_PCT, PASS_AT, PREATTACK_LEAST_MS, TAIL_LEAST_MS


def _pct(n: Column, total: Column) -> Column:
    """Percentage at two places; null over nothing."""
    return F.when(total > 0, F.round(100.0 * n / total, 2))


def evaluation_report(rows: DataFrame) -> DataFrame:
    """One row of totals, R1/R2/R3/R6 percentages and silence statistics, in one pass.
    Without rows all counts are 0 and rates null (T19)."""
    total = F.count(F.lit(1))
    of = lambda c: _pct(F.count_if(c), total)
    return rows.agg(
        total.alias("total"), F.count_if(F.col("verdict") == "PASS").alias("passed"), F.count_if(F.col("verdict") != "PASS").alias("failed"),
        of(F.round("similarity", 4) >= PASS_AT).alias("r1_pct"), of(F.col("boundary_pass")).alias("r2_pct"), of(F.col("verdict") == "PASS").alias("r3_pct"), of(F.col("envelope_pass")).alias("r6_pct"),
        F.min("preattack_ms").alias("preattack_min"), F.max("preattack_ms").alias("preattack_max"), F.avg("preattack_ms").alias("preattack_mean"), F.count_if(F.col("preattack_ms") < PREATTACK_LEAST_MS).alias("preattack_short"),
        F.min("tail_silence_ms").alias("tail_min"), F.max("tail_silence_ms").alias("tail_max"), F.avg("tail_silence_ms").alias("tail_mean"), F.count_if(F.col("tail_silence_ms") < TAIL_LEAST_MS).alias("tail_short"),
    )


def per_script(rows: DataFrame, by: str) -> DataFrame:
    """G3."""
    passed, total = F.count_if(F.col("verdict") == "PASS"), F.count(F.lit(1))
    return rows.groupBy(by).agg(total.alias("total"), passed.alias("passed"), _pct(passed, total).alias("rate"))


def failure_types(rows: DataFrame) -> DataFrame:
    """Counts of types A to F, those without a row included; other types are ignored."""
    keys = rows.sparkSession.createDataFrame([(t,) for t in FAILURE_TYPES], "failure_type string")
    # explode_outer: explode would have a filter inferred below it that computes the array once more
    counted = rows.select(F.explode_outer("failure_types").alias("failure_type")).groupBy("failure_type").agg(F.count(F.lit(1)).alias("n"))
    return keys.join(counted, "failure_type", "left").select("failure_type", F.coalesce("n", F.lit(0)).alias("n"))


def failed_rows(rows: DataFrame) -> DataFrame:
    """G5."""
    named = lambda c, sep: F.when(F.size(c) > 0, F.array_join(c, sep)).otherwise("Unknown")
    return rows.where("verdict = 'FAIL'").select("filename", "similarity", named("failure_reasons", "; ").alias("reasons"), named("failure_types", ", ").alias("types"))


def gate(report: DataFrame, types: DataFrame) -> DataFrame:
    """Whether R1, R2, R3 and R6 are at the gate, and the most frequent type, the first of equals."""
    first = types.agg(F.max_by("failure_type", F.struct("n", (-F.ascii("failure_type")).alias("o"))).alias("dominant"), F.sum("n").alias("_all"))
    ok = F.lit(True)
    for c in ("r1_pct", "r2_pct", "r3_pct", "r6_pct"):
        ok = ok & F.coalesce(F.col(c) >= GATE_PCT, F.lit(False))
    return report.join(F.broadcast(first)).select(ok.alias("passed_gate"), F.when(F.col("_all") > 0, F.col("dominant")).alias("dominant"))  # one row each


def alignment_rollup(rows: DataFrame, by: str) -> DataFrame:
    """Matched, skipped and rate by script, and in all (``by`` null)."""
    matched, total = F.count_if(F.col("kind") == "match"), F.count(F.lit(1))
    return rows.rollup(by).agg(matched.alias("matched"), (total - matched).alias("skipped"), _pct(matched, total).alias("rate"))


def manager_rollup(rows: DataFrame, lines: DataFrame, files: DataFrame) -> DataFrame:
    """G8 as the manager has it: matched lines over all lines of a script, its skip rows and recordings."""
    of = lambda k: F.count_if(F.col("kind") == k)
    found = rows.groupBy("script_id").agg(of("match").alias("matched"), of("skip").alias("skipped"))
    total = lines.groupBy("script_id").agg(F.count(F.lit(1)).alias("total_lines"))
    audio = files.groupBy("script_id").agg(F.count(F.lit(1)).alias("audio_files"))
    joined = audio.join(total, "script_id").join(found, "script_id", "left").na.fill(0, ["matched", "skipped"])
    return joined.withColumn("rate", F.round(100.0 * F.col("matched") / F.col("total_lines"), 1))


def score_stats(rows: DataFrame, score: str) -> DataFrame:
    """Mean, median, least, largest and population deviation; G11: four bands."""
    c = F.col(score)
    return rows.agg(
        F.avg(c).alias("mean"), F.median(c).alias("median"), F.min(c).alias("least"), F.max(c).alias("largest"), F.stddev_pop(c).alias("deviation"),
        F.count_if(c >= 1).alias("perfect"), F.count_if((c >= 0.95) & (c < 1)).alias("high"), F.count_if((c >= 0.8) & (c < 0.95)).alias("middle"), F.count_if(c < 0.8).alias("low"),
    )


def bucket_means(rows: DataFrame, bucket: Column, score: str) -> DataFrame:
    """G12."""
    return rows.groupBy(bucket.alias("bucket")).agg(F.avg(score).alias("mean"), F.count(F.lit(1)).alias("n"))


def worst(rows: DataFrame, score: str, order: str, n: int = 15) -> DataFrame:
    """The n lowest, earlier rows first among equals."""
    return rows.orderBy(score, order).limit(n)


def files_of(files: DataFrame) -> DataFrame:
    """A script's recordings in order of their first line."""
    return files.groupBy("script_id").agg(F.array_sort(F.collect_list(F.struct("start_line", "end_line", "path"))).alias("files"))


def skip_report(rows: DataFrame, file: str = "audio_file") -> DataFrame:
    """By recording and reason, with totals (null)."""
    return rows.where("kind = 'skip'").rollup(file, "reason").agg(F.count(F.lit(1)).alias("n"))


def missed_lines(rows: DataFrame) -> DataFrame:
    """Skipped lines by script in order."""
    return rows.where("kind = 'skip'").select("script_id", "line_no", "reason", "text").repartition("script_id").sortWithinPartitions("script_id", "line_no")


def durations(clips: DataFrame, seconds: str, kept: Column) -> DataFrame:
    """G18."""
    s = F.col(seconds)
    return clips.agg(
        F.count(F.lit(1)).alias("files"), F.sum(s).alias("total_s"), F.avg(s).alias("mean_s"), F.count_if(kept).alias("kept_files"), F.sum(F.when(kept, s)).alias("kept_s"),
        _pct(F.sum(F.when(kept, s)), F.sum(s)).alias("kept_pct"),
    )


def similarity_bands(rows: DataFrame, score: str, edges: list[float]) -> DataFrame:
    """Rows by band; band k is at or over edge k."""
    band = F.lit(0)
    for k, e in enumerate(sorted(edges), 1):
        band = F.when(F.col(score) >= e, k).otherwise(band)
    return rows.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


def iteration_delta(rows: DataFrame, order: str, score: str) -> DataFrame:
    """Change from one iteration to the next; one row an iteration, so one task orders them."""
    return rows.withColumn("delta", F.col(score) - F.lag(score).over(Window.orderBy(order)))


def text_report(title: str, rows: DataFrame, line: Column, first: int = 20) -> str:
    """K9: the first lines and how many more there are; at most first + 1 rows come to the driver."""
    shown = [r[0] for r in rows.select(line.cast("string")).limit(first + 1).collect()]
    more = [f"... and {rows.count() - first} more"] if len(shown) > first else []
    return "\n".join([title, "=" * len(title), *shown[:first], *more]) + "\n"
