"""Joins and matching beside the aligners (J5-J13), neighbours and set operations."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def best_match(queries: DataFrame, segments: DataFrame, score: Column, query_id: str, order: list[str], max_queries: int = 10_000) -> DataFrame:
    """Of all segments the best for each query, the first in ``order`` of equals. Queries are
    broadcast behind a check of their number; more are refused, as the reference of this
    search is a handful of target lines against all segments."""
    if queries.limit(max_queries + 1).count() > max_queries:
        raise ValueError(f"more than {max_queries} queries: search them in blocks")
    rated = segments.crossJoin(F.broadcast(queries)).withColumn("score", score)
    rank = F.struct(F.col("score"), *((-F.col(c)).alias(f"o{k}") for k, c in enumerate(order)))
    return rated.groupBy(query_id).agg(F.max_by(F.struct(*order, "score"), rank).alias("best")).select(query_id, *(f"best.{c}" for c in order), "best.score")


def best_match_words(queries: DataFrame, segments: DataFrame, query_id: str, text: str, order: list[str], max_queries: int = 10_000) -> DataFrame:
    """J5 scored by shared words: the share of a query's distinct words (split at blanks, lower case)
    that a segment has; the first in ``order`` of equals. Queries (``query_id``, ``text``) come to the
    driver behind a check of their number.

    A segment's words are looked up in lists of the queries that have them, so a pair without a
    common word costs nothing; a task gives its best segment for each query, and its first one for
    queries that none resembles.
    """
    asked = queries.select(query_id, F.lower(text).alias("text")).limit(max_queries + 1).collect()
    if len(asked) > max_queries:
        raise ValueError(f"more than {max_queries} queries: search them in blocks")
    having: dict[str, list[int]] = {}
    sizes = np.ones(len(asked))
    for k, row in enumerate(asked):
        words = set() if row["text"] is None else set(row["text"].split(" "))
        sizes[k] = max(1, len(words))
        for w in words:
            having.setdefault(w, []).append(k)
    lists = {w: np.array(ks) for w, ks in having.items()}
    rows = segments.select(*order, F.lower(text).alias("text"))

    def run(batches):
        best, at, first = np.zeros(len(asked), np.int64), [None] * len(asked), None
        for batch in batches:
            *places, texts = (c.to_pylist() for c in batch.columns)
            for place, said in zip(zip(*places, strict=True), texts, strict=True):
                first = place if first is None or place < first else first
                found = [lists[w] for w in set((said or "").split(" ")) if w in lists] if said is not None else []
                if not found:
                    continue
                shared = np.bincount(np.concatenate(found), minlength=len(asked))
                for k in np.flatnonzero((shared >= best) & (shared > 0)):
                    if shared[k] > best[k] or at[k] is None or place < at[k]:
                        best[k], at[k] = shared[k], place
        if first is not None:
            out = [(k, *(p or first), int(n)) for k, (p, n) in enumerate(zip(at, best, strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["_query", *order, "shared"]) if out else pa.RecordBatch.from_pylist([], pa.schema([(c, pa.int64()) for c in ("_query", *order, "shared")]))

    kinds = ", ".join(f"`{c}` long" for c in ("_query", *order, "shared"))
    rank = F.struct(F.col("shared"), *((-F.col(c)).alias(f"o{k}") for k, c in enumerate(order)))
    best = rows.mapInArrow(run, kinds).groupBy("_query").agg(F.max_by(F.struct(*order, "shared"), rank).alias("best"))
    known = queries.sparkSession.createDataFrame([(k, row[query_id], None if row["text"] is None else float(sizes[k])) for k, row in enumerate(asked)], f"_query long, `{query_id}` {queries.schema[query_id].dataType.simpleString()}, _size double")
    return best.join(F.broadcast(known), "_query").select(query_id, *(f"best.{c}" for c in order), (F.col("best.shared") / F.col("_size")).alias("score"))  # at most max_queries rows


def script_audio(audio: DataFrame, scripts: DataFrame) -> DataFrame:
    """Recordings with their script; ``status`` tells those whose script is missing."""
    known = scripts.select("script_id").distinct().withColumn("_known", F.lit(True))
    return audio.join(known, "script_id", "left").withColumn("status", F.when(F.col("_known"), "OK").otherwise("NO_SCRIPT")).drop("_known")


def lookup(results: DataFrame, manifest: DataFrame, default: str = "") -> DataFrame:
    """Results with the manifest's text, or the default."""
    return results.join(manifest.select("filename", "text"), "filename", "left").withColumn("text", F.coalesce("text", F.lit(default)))


def answers(results: DataFrame, key: DataFrame, line: str = "line_no") -> DataFrame:
    """The answer by raw line number; '' out of range."""
    return results.join(key.select(F.col("line_no").alias(line), F.col("text").alias("answer")), line, "left").withColumn("answer", F.coalesce("answer", F.lit("")))


def with_neighbours(rows: DataFrame, text: str, order: list[str], within: list[str] | None = None, block: Column | None = None) -> DataFrame:
    """The texts before and after in order; '' at the edges.

    Over all rows (``within`` None) the order is global, as in the manifest. ``block`` is then a
    whole number that never falls in that order, such as ``floor(pos / 100000)``: rows are
    ordered within their block, and only a first and a last text a block are ordered together.
    """
    if within:
        w = Window.partitionBy(*within).orderBy(*order)
        return rows.withColumn("prev_text", F.lag(text, 1, "").over(w)).withColumn("next_text", F.lead(text, 1, "").over(w))
    placed = rows.withColumn("_block", F.floor(F.col(order[0]) / 100_000) if block is None else block).where("_block is not null").repartition("_block")  # both uses read one exchange
    w = Window.partitionBy("_block").orderBy(*order)
    inside = placed.withColumn("prev_text", F.lag(text).over(w)).withColumn("next_text", F.lead(text).over(w)).withColumn("_at", F.row_number().over(w))
    inside = inside.withColumn("_end", F.count(F.lit(1)).over(Window.partitionBy("_block")))
    key = F.struct(*order)
    edges = placed.groupBy("_block").agg(F.min_by(text, key).alias("_first"), F.max_by(text, key).alias("_last"))  # a row a block
    across = Window.orderBy("_block")
    edges = edges.select("_block", F.lag("_last", 1, "").over(across).alias("_before"), F.lead("_first", 1, "").over(across).alias("_after"))
    joined = inside.join(edges, "_block")
    before = F.when(F.col("_at") == 1, F.col("_before")).otherwise(F.col("prev_text"))
    after = F.when(F.col("_at") == F.col("_end"), F.col("_after")).otherwise(F.col("next_text"))
    return joined.withColumn("prev_text", before).withColumn("next_text", after).drop("_block", "_at", "_end", "_before", "_after")


def locate(clip: np.ndarray, raw: np.ndarray, rate: int, centre_s: float, radius_s: float = 5.0) -> tuple[float, float]:
    """(seconds, correlation) where the clip fits the recording best near ``centre_s``."""
    low = max(0, int((centre_s - radius_s) * rate))
    part = np.asarray(raw[low : int((centre_s + radius_s) * rate) + len(clip)], np.float64)
    clip = np.asarray(clip, np.float64)
    if not len(clip) or len(part) < len(clip):
        return float("nan"), 0.0
    n = 1 << (len(part) + len(clip) - 1).bit_length()
    cross = np.fft.irfft(np.fft.rfft(part, n) * np.conj(np.fft.rfft(clip, n)), n)[: len(part) - len(clip) + 1]
    energy = np.concatenate([[0.0], np.cumsum(part * part)])
    norm = np.sqrt(np.maximum(energy[len(clip) :] - energy[: -len(clip)], 0) * (clip @ clip))
    value = np.divide(cross, norm, out=np.zeros_like(cross), where=norm > 1e-12)
    best = int(np.argmax(value))
    return (low + best) / rate, float(value[best])


@F.pandas_udf(T.StructType([T.StructField("at_s", T.DoubleType()), T.StructField("correlation", T.DoubleType())]))
def located(clip: pd.Series, raw: pd.Series, rate: pd.Series, centre_s: pd.Series) -> pd.DataFrame:
    """J13 over batches."""
    return pd.DataFrame([locate(*row) for row in zip(clip, raw, rate, centre_s, strict=True)], columns=["at_s", "correlation"])


def only_in(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``a`` whose key ``b`` lacks; order columns and repeats stay."""
    return a.join(b.select(*keys).distinct(), keys, "left_anti")


def script_diff(v1: DataFrame, v2: DataFrame, first: int = 50) -> DataFrame:
    """Lines that the other version lacks, as sets, blanks ignored: the first ``first`` of each side in order."""
    filled = [v.where(F.trim("text") != "") for v in (v1, v2)]
    sides = [only_in(a, b, ["text"]).orderBy("line_no").limit(first).withColumn("side", F.lit(s)) for a, b, s in ((*filled, "removed"), (*filled[::-1], "added"))]
    return sides[0].unionByName(sides[1])


def all_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """U2."""
    return a.select(key).union(b.select(key)).distinct()


def append_new(manifest: DataFrame, new: DataFrame, key: str = "filename") -> DataFrame:
    """The manifest and the new rows whose keys it lacks."""
    return manifest.unionByName(only_in(new, manifest, [key]))


def dedupe(manifest: DataFrame, policy: str = "min") -> DataFrame:
    """One text a filename: the least (``min``), ``last`` or ``first`` by ``pos``, or ``all``."""
    if policy == "all":
        return manifest.select("filename", "text")
    pick = {"min": F.min("text"), "last": F.max_by("text", "pos"), "first": F.min_by("text", "pos")}[policy]
    return manifest.groupBy("filename").agg(pick.alias("text"))
