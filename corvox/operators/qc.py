"""Independent quality control with neighbours (C3, W1-W4, G9) and the truncation audit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvox.functions.constants import FORMAL_ENDINGS_DETECTOR
from corvox.functions.similarity import guarded_ratio, missing_suffix, tails_equal
from corvox.functions.text import first_suffix, head_chars, head_words, tail_chars, tail_words, word_list

Score = Callable[[Column, Column], Column]


def start_bleed(heard: Column, before: Column, score: Score = guarded_ratio, n: int = 8, at: float = 0.75) -> Column:
    """The heard start resembles the end of the line before."""
    return (F.length(heard) >= n) & (F.length(before) >= n) & (score(head_chars(heard, n), tail_chars(before, n)) >= at)


def end_bleed(heard: Column, after: Column, score: Score = guarded_ratio, n: int = 8, at: float = 0.75) -> Column:
    """The heard end resembles the start of the next line."""
    return (F.length(heard) >= n) & (F.length(after) >= n) & (score(tail_chars(heard, n), head_chars(after, n)) >= at)


def truncated_start(heard: Column, expected: Column, score: Score = guarded_ratio, at: float = 0.5) -> Column:
    """W3, on word lists: the first three expected words aren't among the first five heard. False
    without a heard word."""
    return (F.size(expected) >= 3) & (F.size(heard) > 0) & (score(head_words(expected, 3), head_words(heard, 5)) < at)


def truncated_end(heard: Column, expected: Column, score: Score = guarded_ratio, at: float = 0.5) -> Column:
    """W4, on word lists: the last three expected against the last five heard, all heard if under
    three. False without a heard word."""
    spoken = F.when(F.size(heard) < 3, F.array_join(heard, " ")).otherwise(tail_words(heard, 5))
    return (F.size(expected) >= 3) & (F.size(heard) > 0) & (score(tail_words(expected, 3), spoken) < at)


def quality(rows: DataFrame, score: Score = guarded_ratio, words: Callable[[Column], Column] = word_list) -> DataFrame:
    """Issues and verdict of rows with heard, expected, prev_text, next_text (all through N4),
    ``raw_heard`` (as transcribed; without it ``heard`` stands for it), ``status`` (OK, FILE_MISSING,
    TRANSCRIPTION_ERROR; null: not checked yet) and similarity. A transcription of blanks alone
    is EMPTY_TRANSCRIPTION and has no other issue; one of punctuation alone is judged."""
    rows = rows.withColumns({"_spoken": words(F.col("heard")), "_told": words(F.col("expected"))})  # once a row, not in each of their uses
    spoken, told = F.col("_spoken"), F.col("_told")
    empty = F.trim(F.coalesce("raw_heard" if "raw_heard" in rows.columns else "heard", F.lit(""))) == ""
    found = F.array_compact(F.array(
        F.when(start_bleed(F.col("heard"), F.col("prev_text"), score), "START_BLEED"), F.when(end_bleed(F.col("heard"), F.col("next_text"), score), "END_BLEED"),
        F.when(truncated_start(spoken, told, score), "TRUNCATED_START"), F.when(truncated_end(spoken, told, score), "TRUNCATED_END"),
        F.when(F.col("similarity") < 0.70, "LOW_SIMILARITY"),
    ))
    issues = F.when(F.col("status").isNull(), F.array().cast("array<string>")).when(F.col("status") != "OK", F.array("status")).when(empty, F.array(F.lit("EMPTY_TRANSCRIPTION"))).otherwise(found)
    checked = rows.withColumn("issues", issues).drop("_spoken", "_told")
    return checked.withColumn("verdict", F.when(F.col("status").isNull(), "UNKNOWN").when(F.size("issues") == 0, "GOOD").otherwise("PROBLEMATIC"))


def issue_histogram(rows: DataFrame) -> DataFrame:
    """Rows by issue, most first (ties by name)."""
    return rows.select(F.explode_outer("issues").alias("issue")).where("issue is not null").groupBy("issue").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "issue")


def verdict_counts(rows: DataFrame) -> DataFrame:
    """Good and problem counts; what isn't GOOD, UNKNOWN included, is a problem."""
    return rows.agg(F.count_if(F.col("verdict") == "GOOD").alias("good"), F.count_if(F.col("verdict") != "GOOD").alias("problems"))


def truncation(rows: DataFrame, patterns: list[str] | None = None, least: int = 6, max_items: int | None = None, order: str = "filename") -> DataFrame:
    """Rows (filename, truth, heard; normalised; heard null: no file or no text, by ``status``)
    whose truth ends in a listed pattern, with ending_pattern, status and missing_chars.
    ``max_items`` (O7): only the first of these rows in ``order``."""
    listed = FORMAL_ENDINGS_DETECTOR if patterns is None else patterns
    found = rows.withColumn("ending_pattern", first_suffix(F.col("truth"), listed)).where((F.length("truth") >= least) & F.col("ending_pattern").isNotNull())
    found = found if max_items is None else found.orderBy(order).limit(max_items)
    heard = F.coalesce("heard", F.lit(""))
    state = (
        F.when(F.col("status").isin("FILE_NOT_FOUND", "TRANSCRIBE_ERROR"), F.col("status"))
        .when(F.endswith(heard, F.col("ending_pattern")), "OK").when(tails_equal(F.col("truth"), heard), "OK_TAIL_MATCH").otherwise("TRUNCATED")
    )
    checked = found.withColumn("status", state)
    return checked.withColumn("missing_chars", F.when(F.col("status") == "TRUNCATED", missing_suffix(F.col("truth"), heard, F.col("ending_pattern"))).otherwise(F.lit(0)))


def recount(rows: DataFrame, patterns: list[str]) -> DataFrame:
    """By pattern, how many have it in the truth and lack it in what was heard; rows without a file are left out."""
    found = rows.where(F.col("heard").isNotNull()).withColumn("ending_pattern", first_suffix(F.col("truth"), patterns)).where("ending_pattern is not null")
    return found.groupBy("ending_pattern").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.endswith("heard", F.col("ending_pattern"))).alias("truncated"))


def pattern_histogram(rows: DataFrame) -> DataFrame:
    """G13."""
    return rows.groupBy("ending_pattern").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "ending_pattern")


def truncation_rate(rows: DataFrame) -> DataFrame:
    """Checked, truncated and their rate as text, N/A if nothing could be checked."""
    counted = rows.agg(F.count_if(~F.col("status").isin("FILE_NOT_FOUND", "TRANSCRIBE_ERROR")).alias("checked"), F.count_if(F.col("status") == "TRUNCATED").alias("truncated"))
    return counted.withColumn("rate", F.when(F.col("checked") > 0, F.concat(F.format_string("%.1f", 100 * F.col("truncated") / F.col("checked")), F.lit("%"))).otherwise("N/A"))
