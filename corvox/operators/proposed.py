"""Capabilities that the specification documents describe without code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvox.operators.timing import runs


def split_lines(rows: DataFrame, within: str, order: str, pieces: int = 3, low: float = 0.80) -> DataFrame:
    """Rows scored below ``low`` whose heard text begins the expected one and whose remainder the
    next one to ``pieces`` - 1 heard texts make up: (order, n_pieces). Texts are normalised."""
    w = Window.partitionBy(within).orderBy(order)
    rest = F.substring(F.col("expected"), F.length("heard") + 1, F.length("expected"))
    n, joined = F.lit(None).cast("int"), F.lit("")
    for k in range(1, pieces):
        joined = F.concat(joined, F.coalesce(F.lead("heard", k).over(w), F.lit("")))
        n = F.coalesce(n, F.when(joined == rest, k + 1))
    split = (F.col("score") < low) & (F.length("heard") > 0) & (F.length("heard") < F.length("expected")) & F.startswith("expected", F.col("heard"))
    return rows.withColumn("_n", n).where(split & F.col("_n").isNotNull()).select(within, order, F.col("_n").alias("n_pieces"))


def cascades(rows: DataFrame, within: str, order: str, score: str, low: float = 0.05, least: int = 3) -> DataFrame:
    """Runs of at least ``least`` rows in order that score about 0."""
    return runs(rows, within, order, F.col(score) <= low).where(F.col("flag") & (F.col("n") >= least)).drop("flag")


def grade(similarity: Column) -> Column:
    """Z3."""
    return F.when(similarity >= 0.95, "PASS").when(similarity >= 0.85, "MARGINAL").otherwise("FAIL")


def word_band(score: Column) -> Column:
    """Z4."""
    return F.when(score >= 0.95, "95").when(score >= 0.90, "90").when(score >= 0.80, "80").otherwise("below")


def top_hypotheses(scored: DataFrame, key: str, score: str, tie: str, k: int = 3) -> DataFrame:
    """The k best of each key, the lower ``tie`` first of equals."""
    w = Window.partitionBy(key).orderBy(F.desc(score), tie)
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def stability(decodes: DataFrame, key: str, text: str) -> DataFrame:
    """How far several decodings agree: decodings, different texts, share of the most frequent."""
    counts = decodes.groupBy(key, text).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(F.sum("_n").alias("decodes"), F.count(F.lit(1)).alias("texts"), (F.max("_n") / F.sum("_n")).alias("agreement"))


def duration_bounds(clips: DataFrame, ms: str, least: int = 300, most: int = 15_000) -> DataFrame:
    """Z7."""
    return clips.where(F.col(ms).between(least, most))


def edges_silent(first_text: Column, last_text: Column) -> Column:
    """Nothing is recognised in the first and last 100 ms (input columns)."""
    return (F.coalesce(first_text, F.lit("")) == "") & (F.coalesce(last_text, F.lit("")) == "")


def prompt_gap_penalty(prompted: Column, plain: Column, weight: float = 0.5) -> Column:
    """A prompted score less a part of its lead over the unprompted one."""
    return prompted - weight * F.greatest(prompted - plain, F.lit(0.0))
