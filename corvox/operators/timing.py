"""Gaps, padding and runs over ordered rows (W5-W10, D13, D14, D15, D17, D18) and time series by rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvox.functions.constants import FORMAL_PAD_MS, GAP_MARGIN_MS, MIN_GAP_MS, PAD_MS, TAIL_MAX_MS


def numbered(rows: DataFrame, within: str, order: str, out: str = "line_no") -> DataFrame:
    """Dense numbers from 1 within a script, after blanks are dropped."""
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(within).orderBy(order)))


def gaps(segments: DataFrame, within: str, order: str) -> DataFrame:
    """Gap in ms to the segment before and after (null at the ends); starts and ends in ms."""
    w = Window.partitionBy(within).orderBy(order)
    return segments.withColumn("left_gap", F.col("start_ms") - F.lag("end_ms").over(w)).withColumn("right_gap", F.lead("start_ms").over(w) - F.col("end_ms"))


def left_pad(gap: Column) -> Column:
    """50, or 0 where the segment before is nearer than 30."""
    return F.when(gap.isNull() | (gap >= MIN_GAP_MS), PAD_MS).otherwise(0)


def right_pad(gap: Column, formal: Column, formal_pad: int = FORMAL_PAD_MS, least: int = 0) -> Column:
    """Last 400; formal ending 650; nearer than 30: 0; else the gap less 20, 0 to 400. W7c: other
    ``formal_pad`` and ``least``."""
    open_gap = F.greatest(F.lit(least), F.least(F.lit(TAIL_MAX_MS), F.greatest(F.lit(0), gap - GAP_MARGIN_MS)))
    return F.when(gap.isNull(), TAIL_MAX_MS).when(formal, formal_pad).when(gap < MIN_GAP_MS, least).otherwise(open_gap)


def clamped(start: Column, end: Column, length: Column, before: Column | int = PAD_MS, after: Column | int = PAD_MS) -> tuple[Column, Column]:
    """Padded span inside the recording."""
    return F.greatest(start - before, F.lit(0)), F.least(end + after, length)


def skipped_lines(matches: DataFrame, within: str, first: Column | int = 1) -> DataFrame:
    """Lines jumped between one match and the next (and before the first)."""
    w = Window.partitionBy(within).orderBy("line_no")
    start = F.lag("line_no").over(w)
    spans = matches.select(within, (F.coalesce(start, (F.lit(first) if isinstance(first, int) else first) - 1) + 1).alias("_a"), (F.col("line_no") - 1).alias("_b"))
    return spans.where("_a <= _b").select(within, F.explode(F.sequence("_a", "_b")).alias("line_no"))


def tail_lines(matches: DataFrame, bounds: DataFrame, within: str) -> DataFrame:
    """Lines after the last match up to ``max_line``; all from ``min_line`` without a match."""
    last = matches.groupBy(within).agg(F.max("line_no").alias("_last"))
    spans = bounds.join(last, within, "left").select(within, F.coalesce(F.col("_last") + 1, "min_line").alias("_a"), F.col("max_line").alias("_b"))
    return spans.where("_a <= _b").select(within, F.explode(F.sequence("_a", "_b")).alias("line_no"))


def covered_lines(lines: DataFrame, files: DataFrame) -> DataFrame:
    """lines between a script's first and last recorded line."""
    span = files.groupBy("script_id").agg(F.min("start_line").alias("_a"), F.max("end_line").alias("_b"))
    return lines.join(span, "script_id").where(F.col("line_no").between(F.col("_a"), F.col("_b"))).drop("_a", "_b")


def series_windows(samples: DataFrame, within: str, position: str, value: str, window: int, floor: float = 1e-10) -> DataFrame:
    """D1 by rows: dB of each full window of a long series (``position`` counts from 0)."""
    w = F.floor(F.col(position) / window).alias("win_idx")
    mean = F.avg(F.col(value) * F.col(value))
    return samples.groupBy(within, w).agg((20 * F.log10(F.greatest(F.sqrt(mean), F.lit(floor)))).alias("rms_db"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") == window).drop("_n")


def runs(rows: DataFrame, within: str, order: str, flag: Column) -> DataFrame:
    """Gaps and islands: each run of consecutive rows with one flag: first, last, n, flag."""
    w = Window.partitionBy(within).orderBy(order)
    marked = rows.withColumn("_f", flag).withColumn("_new", F.coalesce((F.col("_f") != F.lag("_f").over(w)).cast("int"), F.lit(1)))
    grouped = marked.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(within, "_run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"), F.first("_f").alias("flag")).drop("_run")


def silence_split(windows: DataFrame, within: str, threshold: float, least_silence: int, keep: int, least_clip: int) -> DataFrame:
    """Clips between silences of at least ``least_silence`` windows, ``keep`` windows of silence kept
    at each side, clips shorter than ``least_clip`` dropped, numbered over all in order."""
    found = runs(windows, within, "win_idx", F.col("rms_db") < threshold)
    cut = found.withColumn("_cut", F.col("flag") & (F.col("n") >= least_silence))
    w = Window.partitionBy(within).orderBy("first")
    piece = cut.withColumn("_piece", F.sum(F.col("_cut").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where(~F.col("_cut"))
    ends = windows.groupBy(within).agg(F.max("win_idx").alias("_end"))
    clips = piece.groupBy(within, "_piece").agg(F.min("first").alias("_a"), F.max("last").alias("_b")).join(ends, within)
    spans = clips.select(within, F.greatest(F.col("_a") - keep, F.lit(0)).alias("start_win"), F.least(F.col("_b") + keep, F.col("_end")).alias("end_win"))
    return spans.where(F.col("end_win") - F.col("start_win") + 1 >= least_clip)


def clip_numbers(clips: DataFrame, within: str) -> DataFrame:
    """``%05d`` names over all recordings: counts by recording come together, not clips."""
    counts = clips.groupBy(within).count().withColumn("_base", F.coalesce(F.sum("count").over(Window.orderBy(within).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    local = F.row_number().over(Window.partitionBy(within).orderBy("start_win"))
    return clips.withColumn("_k", local).join(counts.drop("count"), within).withColumn("name", F.format_string("%05d", F.col("_base") + F.col("_k"))).drop("_k", "_base")


def energy_valleys(windows: DataFrame, within: str, share: float = 0.40, depth: float = 15.0, least: int = 3) -> DataFrame:
    """Runs of at least ``least`` windows in the last ``share`` of a clip that lie ``depth`` dB below the
    running maximum. The maximum restarts when a valley closes, so a clip is folded in order
    with its state in an array expression."""
    ordered = windows.groupBy(within).agg(F.array_sort(F.collect_list(F.struct("win_idx", "rms_db"))).alias("_w"))  # one clip's windows
    start = F.floor(F.size("_w") * (1 - share)).cast("int")
    state = F.struct(F.lit(-1e9).alias("top"), F.lit(-1).alias("open"), F.array().cast("array<struct<first:int,last:int>>").alias("found"))

    def step(s: Column, x: Column) -> Column:
        low = x["rms_db"] <= s["top"] - depth
        closes = ~low & (s["open"] >= 0)
        long = closes & (x["win_idx"] - s["open"] >= least)
        found = F.when(long, F.concat(s["found"], F.array(F.struct(s["open"].cast("int").alias("first"), (x["win_idx"] - 1).cast("int").alias("last"))))).otherwise(s["found"])
        top = F.when(closes, x["rms_db"]).when(low, s["top"]).otherwise(F.greatest(s["top"], x["rms_db"]))
        return F.struct(top.alias("top"), F.when(low, F.when(s["open"] >= 0, s["open"]).otherwise(x["win_idx"].cast("int"))).otherwise(F.lit(-1)).alias("open"), found.alias("found"))

    tail = F.slice("_w", start + 1, F.size("_w"))
    folded = ordered.withColumn("_s", F.aggregate(tail, state, step)).withColumn("_last", F.element_at("_w", -1)["win_idx"].cast("int"))
    still = (F.col("_s.open") >= 0) & (F.col("_last") - F.col("_s.open") + 1 >= least)
    found = F.when(still, F.concat("_s.found", F.array(F.struct(F.col("_s.open").alias("first"), F.col("_last").alias("last"))))).otherwise(F.col("_s.found"))
    return folded.select(within, F.explode(found).alias("v")).select(within, "v.first", "v.last")


def safety_sweep(rows: DataFrame, offsets: list[int]) -> DataFrame:
    """Every row with every setting of a short parameter list, as an array explode."""
    return rows.withColumn("safety_ms", F.explode(F.array(*map(F.lit, offsets))))


def coarse_profile(windows: DataFrame, within: str, per: int = 5, threshold: float = -40.0) -> DataFrame:
    """Mean dB of each ``per`` windows, with a marker below the threshold."""
    block = F.floor(F.col("win_idx") / per).alias("block")
    mean = F.avg("rms_db")
    return windows.groupBy(within, block).agg(mean.alias("mean_db"), (mean < threshold).alias("silent"))


def shift_class(before: Column, after: Column, limit_ms: float = 50) -> Column:
    """How a timestamp moved between two runs."""
    return F.when(after - before > limit_ms, "later").when(after - before < -limit_ms, "earlier").otherwise("similar")
