"""Evaluation of clips: rules, tiers, curation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvox.functions.constants import CURATION_FLOOR, CURATION_MAX_SHARE, PASS_AT, TIER2_FLOOR, TYPE_D_HIGH, TYPE_D_LOW


def alignment_type(similarity: Column, heard: Column) -> Column:
    """D for an empty text or a similarity at most .15 or at least .70, else A; null when passed."""
    d = (F.coalesce(heard, F.lit("")) == "") | (similarity <= TYPE_D_LOW) | (similarity >= TYPE_D_HIGH)
    return F.when(similarity < PASS_AT, F.when(d, "D").otherwise("A"))


def similarity_reason(similarity: Column) -> Column:
    return F.when(similarity < PASS_AT, F.lit("Similarity below 0.95"))


def evaluate(clips: DataFrame) -> DataFrame:
    """Verdict, failure_reasons and failure_types of clips with similarity, heard, boundary_pass,
    envelope_pass and readable.

    The verdict looks at the similarity rounded to four places, the reason at the similarity
    itself (T6), so a clip just below the mark passes with a reason. Reasons come in the
    order: read error or boundary, envelope, similarity.
    """
    good = F.col("readable")
    kinds = F.array_compact(F.array(
        F.when(~good, "E"), F.when(good & ~F.col("boundary_pass"), "C"), F.when(good & ~F.col("envelope_pass"), "F"),
        F.when(good, alignment_type(F.col("similarity"), F.col("heard"))),
    ))
    reasons = F.array_compact(F.array(
        F.when(~good, "Unreadable audio"), F.when(good & ~F.col("boundary_pass"), "Boundary noise"), F.when(good & ~F.col("envelope_pass"), "Envelope"),
        F.when(good, similarity_reason(F.col("similarity"))),
    ))
    passed = good & (F.round("similarity", 4) >= PASS_AT) & F.col("boundary_pass") & F.col("envelope_pass")
    return clips.withColumn("failure_types", kinds).withColumn("failure_reasons", reasons).withColumn("verdict", F.when(passed, "PASS").otherwise("FAIL"))


def quick(clips: DataFrame) -> DataFrame:
    """Without recognition every clip counts as understood."""
    return clips.withColumn("similarity", F.lit(1.0)).withColumn("cer", F.lit(0.0))


def tier2_eligible(rows: DataFrame) -> DataFrame:
    """F8: failed with a similarity of at least .50, whatever the rule that failed them."""
    return rows.where((F.col("verdict") == "FAIL") & (F.col("similarity") >= TIER2_FLOOR))


def merge_tier2(rows: DataFrame, again: DataFrame) -> DataFrame:
    """C4: take over a better second score (``again``: filename, similarity2, heard2). At the pass
    mark alignment types and similarity reasons go and the verdict is made anew; below it
    types stay as they are."""
    joined = rows.join(again.select("filename", "similarity2", "heard2"), "filename", "left")
    joined = joined.withColumn("_better", F.coalesce((F.col("similarity2") > F.col("similarity")) & (F.col("verdict") == "FAIL") & (F.col("similarity") >= TIER2_FLOOR), F.lit(False)))
    joined = joined.withColumn("recovered", F.col("_better") & (F.col("similarity2") >= PASS_AT))
    better, passed = F.col("_better"), F.col("recovered")
    kinds = F.when(passed, F.filter("failure_types", lambda t: ~t.isin("A", "D"))).otherwise(F.col("failure_types"))
    reasons = F.when(passed, F.filter("failure_reasons", lambda r: ~F.startswith(r, F.lit("Similarity")))).otherwise(F.col("failure_reasons"))
    return (
        joined.withColumn("failure_types", kinds).withColumn("failure_reasons", reasons)
        .withColumn("verdict", F.when(passed & F.col("boundary_pass") & F.col("envelope_pass"), "PASS").otherwise(F.col("verdict")))
        .withColumn("heard", F.when(better, F.col("heard2")).otherwise(F.col("heard")))
        .withColumn("similarity", F.when(better, F.col("similarity2")).otherwise(F.col("similarity")))
        .drop("similarity2", "heard2", "_better")
    )


def curation_gate(rows: DataFrame, floor: float = CURATION_FLOOR, most: float = CURATION_MAX_SHARE) -> DataFrame:
    """one row: total, removed, proceeds. More than ``most`` removed aborts; exactly as much doesn't."""
    counted = rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("similarity") < floor).alias("removed"))
    return counted.withColumn("proceeds", F.col("removed") * 100 <= F.lit(round(most * 100)) * F.col("total"))


def curate(rows: DataFrame, floor: float = CURATION_FLOOR, most: float = CURATION_MAX_SHARE) -> DataFrame:
    """Rows that stay, all of them if the gate aborts. One pass counts, one filters."""
    gate = F.broadcast(curation_gate(rows, floor, most).select("proceeds"))  # one row
    return rows.join(gate).where(~F.col("proceeds") | (F.col("similarity") >= floor)).drop("proceeds")
