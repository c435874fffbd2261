"""Adapters: how the driver's tables stand in for speech corpora, in Spark and in SQL.

A document is a script, its non-blank lines the sentences; what a recogniser heard is a
line with characters left out at a rate that depends on the line's number; a conversation
is a recording whose turns are segments; an embedding is a short clip, a user's events are
a long one.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvox.functions.similarity import with_edit_similarity
from corvox.functions.text import composed_eval_text
from corvox.operators.verdict import evaluate
from corvox.sources.readers import script_lines


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Small files are read by few tasks; heavy work per row is dealt to all cores first. Larger
    inputs already have more tasks than cores and stay as they are. Not for rows that were
    shuffled: to count their tasks Spark runs all the shuffles, and again for the result."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame) -> DataFrame:
    """Rows that were shuffled, dealt to all cores."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def lines(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, source, line_no, text."""
    docs = table(spark, d, "documents").select(F.struct("doc_id", "source").alias("k"), "text")
    return script_lines(docs, "k", "text").select("k.doc_id", "k.source", "line_no", "text")


LINES = r"""l0 AS (SELECT doc_id, source, regexp_split_to_array(text, '\r\n|\r|\n') AS a FROM documents),
l1 AS (SELECT doc_id, source, unnest(a) AS raw, generate_subscripts(a, 1) AS p FROM l0),
l2 AS (SELECT doc_id, source, p, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS text FROM l1),
lines AS (SELECT doc_id, source, text, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS line_no FROM l2 WHERE text <> '')"""


def left_out(text: str, n: int) -> str:
    """``text`` without every ``n``-th character."""
    kept = bytearray(text, "ascii") if text.isascii() else list(text)
    del kept[n - 1 :: n]
    return kept.decode("ascii") if isinstance(kept, bytearray) else "".join(kept)


@F.pandas_udf(T.StructType().add("truth", T.StringType()).add("heard", T.StringType()))
def hearing(text: pd.Series, line_no: pd.Series) -> pd.DataFrame:
    truths = [None if t is None else composed_eval_text(t) for t in text]
    heard = [t if not t or n % 4 == 0 and n % 40 else left_out(t, (1, 25, 12, 3)[n % 4]) for t, n in zip(truths, line_no, strict=True)]
    return pd.DataFrame({"truth": truths, "heard": heard})


hearing = hearing.asNondeterministic()  # it isn't; but a filter on it would be moved before it, and compute it twice


def pairs(spark: SparkSession, d: str) -> DataFrame:
    """Lines with truth (N2) and two hearings: prompted, and plain with fewer characters left out."""
    told = spread(lines(spark, d)).withColumn("h", hearing("text", "line_no"))
    k = F.col("line_no") % 4
    cut = lambda c, n: F.regexp_replace(c, f"(.{{{n - 1}}}).", "$1")
    plain = F.when(k == 2, cut(F.col("truth"), 30)).when(k == 3, cut(F.col("truth"), 2)).otherwise(F.col("heard"))
    return told.select("*", "h.truth", "h.heard").drop("h").withColumn("plain", plain)


PAIRS = LINES + r""",
p0 AS (SELECT doc_id, source, line_no, text, lower(regexp_replace(text, '[^가-힣a-zA-Z0-9]', '', 'g')) AS truth FROM lines),
p1 AS (SELECT *, CASE line_no % 4 WHEN 1 THEN regexp_replace(truth, '(.{24}).', '\1', 'g') WHEN 2 THEN regexp_replace(truth, '(.{11}).', '\1', 'g')
    WHEN 3 THEN regexp_replace(truth, '(.{2}).', '\1', 'g') ELSE CASE WHEN line_no % 40 = 0 THEN '' ELSE truth END END AS heard FROM p0),
pairs AS (SELECT *, CASE line_no % 4 WHEN 2 THEN regexp_replace(truth, '(.{29}).', '\1', 'g') WHEN 3 THEN regexp_replace(truth, '(.{1}).', '\1', 'g') ELSE heard END AS plain FROM p1)"""


def scored(spark: SparkSession, d: str) -> DataFrame:
    return with_edit_similarity(pairs(spark, d), "truth", "heard")


SCORED = PAIRS + """,
s0 AS (SELECT *, levenshtein(truth, heard) AS dist, greatest(length(truth), length(heard)) AS max_len FROM pairs),
s1 AS (SELECT *, CASE WHEN max_len = 0 THEN 0.0::DOUBLE ELSE dist::DOUBLE / max_len END AS cer FROM s0),
scored AS (SELECT *, 1 - cer AS similarity FROM s1)"""


def evaluated(spark: SparkSession, d: str) -> DataFrame:
    """Evaluation rows: boundary, envelope and readability follow from the line's number."""
    n = F.col("line_no")
    clips = scored(spark, d).withColumns({
        "filename": F.concat(F.lit("Script_"), F.col("doc_id").cast("string"), F.lit("_"), F.lpad(n.cast("string"), 4, "0"), F.lit(".wav")),
        "boundary_pass": n % 23 != 0, "envelope_pass": n % 29 != 0, "readable": n % 37 != 0,
        "preattack_ms": (380 + n % 40).cast("double"), "tail_silence_ms": (710 + n % 50).cast("double"),
    })
    return evaluate(clips)


EVALUATED = SCORED + """,
e0 AS (SELECT *, 'Script_' || doc_id || '_' || lpad(line_no::VARCHAR, 4, '0') || '.wav' AS filename, line_no % 23 <> 0 AS boundary_pass, line_no % 29 <> 0 AS envelope_pass,
    line_no % 37 <> 0 AS readable, (380 + line_no % 40)::DOUBLE AS preattack_ms, (710 + line_no % 50)::DOUBLE AS tail_silence_ms FROM scored),
e1 AS (SELECT *, readable AND round(similarity, 4) >= 0.95 AND boundary_pass AND envelope_pass AS passed,
    CASE WHEN readable AND similarity < 0.95 THEN CASE WHEN heard = '' OR similarity <= 0.15 OR similarity >= 0.70 THEN 'D' ELSE 'A' END END AS kind FROM e0),
evaluated AS (SELECT *, CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS verdict,
    list_filter([CASE WHEN NOT readable THEN 'E' END, CASE WHEN readable AND NOT boundary_pass THEN 'C' END, CASE WHEN readable AND NOT envelope_pass THEN 'F' END, kind], lambda x: x IS NOT NULL) AS failure_types,
    list_filter([CASE WHEN NOT readable THEN 'Unreadable audio' END, CASE WHEN readable AND NOT boundary_pass THEN 'Boundary noise' END, CASE WHEN readable AND NOT envelope_pass THEN 'Envelope' END,
        CASE WHEN readable AND similarity < 0.95 THEN 'Similarity below 0.95' END], lambda x: x IS NOT NULL) AS failure_reasons FROM e1)"""


def turns(spark: SparkSession, d: str) -> DataFrame:
    """Conversation turns as segments: 50 ms a character, then a gap by the turn's number."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = table(spark, d, "conversations").withColumn("ms", 50 * F.length("text"))
    gap = F.element_at(F.array(F.lit(10), F.lit(29), F.lit(120), F.lit(900)), (F.col("turn") % 4 + 1).cast("int"))
    t = t.withColumn("gap", gap).withColumn("end_all", F.sum(F.col("ms") + F.col("gap")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return t.withColumn("end_ms", F.col("end_all") - F.col("gap")).withColumn("start_ms", F.col("end_ms") - F.col("ms"))


TURNS = """t0 AS (SELECT *, 50 * length(text) AS ms, [10, 29, 120, 900][(turn % 4 + 1)::INT] AS gap FROM conversations),
t1 AS (SELECT *, sum(ms + gap) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS end_all FROM t0),
turns AS (SELECT *, end_all - gap AS end_ms, end_all - gap - ms AS start_ms FROM t1)"""


def clips(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("samples"))


CLIPS = """clips AS (SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS samples FROM embeddings),
samples AS (SELECT vec_id, unnest(samples) AS x, generate_subscripts(samples, 1) - 1 AS i FROM clips),
windows AS (SELECT vec_id, i // 8 AS win, 20 * log10(greatest(sqrt(avg(x * x)), 1e-10)) AS db FROM samples GROUP BY ALL)"""


def series(spark: SparkSession, d: str) -> DataFrame:
    """A user's events as one series: user_id, i, value."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, d, "events").select("user_id", (F.row_number().over(w) - 1).alias("i"), (F.col("value") / 1000).alias("value"))


SERIES = """series AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, value / 1000 AS value FROM events),
swin AS (SELECT user_id, i // 4 AS win_idx, 20 * log10(greatest(sqrt(avg(value * value)), 1e-10)) AS rms_db FROM series GROUP BY ALL HAVING count(*) = 4)"""


def recordings(spark: SparkSession, d: str) -> DataFrame:
    """Two recordings of each document's lines, by line range."""
    top = lines(spark, d).groupBy("doc_id").agg(F.max("line_no").alias("n"))
    half = F.floor(F.col("n") / 2)
    each = F.array(F.struct(F.lit(0).alias("f"), F.lit(1).cast("long").alias("a"), F.greatest(half, F.lit(1)).alias("b")), F.struct(F.lit(1).alias("f"), F.least(half + 1, F.col("n")).alias("a"), (F.col("n") - F.col("n") % 3 % 2).alias("b")))
    spans = top.select("doc_id", F.explode(each).alias("r"))
    return spans.select(F.col("doc_id").cast("int").alias("script_id"), F.col("r.f").alias("file_idx"), F.col("r.a").cast("int").alias("start_line"), F.greatest("r.a", "r.b").cast("int").alias("end_line"))


RECORDINGS = """tops AS (SELECT doc_id, max(line_no) AS n FROM lines GROUP BY doc_id),
recordings AS (SELECT doc_id AS script_id, 0 AS file_idx, 1 AS start_line, greatest(n // 2, 1) AS end_line FROM tops
    UNION ALL SELECT doc_id, 1, least(n // 2 + 1, n), greatest(least(n // 2 + 1, n), n - n % 3 % 2) FROM tops)"""


def heard_segments(spark: SparkSession, d: str) -> DataFrame:
    """Segments that a recogniser gave for the recordings: lines as heard, long ones in two, every
    seventh left out."""
    p = pairs(spark, d).withColumn("script_id", F.col("doc_id").cast("int")).where(F.col("line_no") % 7 != 0)
    f = recordings(spark, d)
    inside = p.join(f, "script_id").where(F.col("line_no").between(F.col("start_line"), F.col("end_line")))
    half = F.floor(F.length("heard") / 2).cast("int")
    parts = F.when(F.length("heard") > 60, F.array(F.substring("heard", F.lit(1), half), F.substring("heard", half + 1, F.length("heard")))).otherwise(F.array("heard"))
    each = inside.select("script_id", "file_idx", "line_no", F.posexplode(parts).alias("k", "text"))
    return each.select("script_id", "file_idx", (2 * F.col("line_no") + F.col("k")).cast("int").alias("seg_idx"), "text")


def exact_scripts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(segments, lines, files) on which an alignment is certain: a line is a digest that resembles
    no other, every fifth with a formal ending; every seventh line isn't spoken, nor the last of
    every third script. Two recordings a script, of which the second has a name that claims too
    few lines. Every third spoken line begins with a foreign word."""
    base = lines(spark, d).select(F.col("doc_id").cast("int").alias("script_id"), F.col("line_no").cast("int").alias("line_no"))
    base = base.withColumn("n", F.max("line_no").over(Window.partitionBy("script_id")))
    n, k = F.col("n"), F.col("line_no")
    half = F.floor((n + 1) / 2).cast("int")
    digest = F.md5(F.concat_ws(":", "script_id", "line_no"))
    ending = F.when(k % 5 == 0, "습니다").otherwise("")
    script = base.select("script_id", "line_no", "n", digest.alias("digest"), ending.alias("ending"), F.concat(digest, ending).alias("text"))
    at = lambda quarters: (10 * k + F.element_at(F.array(*map(F.lit, (0, 1, 2, 3))), (k % 4 + 1).cast("int")) + quarters) / 4
    word = lambda text, a, b: F.struct(text.alias("word"), at(a).alias("start"), at(b).alias("end"))
    pair = [word(F.substring("digest", 1, 16), 2, 4), word(F.concat(F.substring("digest", 17, 16), F.col("ending")), 4, 7)]
    words = F.when(k % 3 == 0, F.array(word(F.lit("xq"), 0, 2), *pair)).otherwise(F.array(*pair))
    spoken = script.where((k % 7 != 0) & ~((F.col("script_id") % 3 == 0) & (k == n)))
    segments = spoken.select(
        "script_id", F.when(k <= half, 0).otherwise(1).alias("file_idx"), k.alias("seg_idx"), F.concat(F.when(k % 3 == 0, "xq ").otherwise(""), "text").alias("text"),
        F.when(k % 3 == 0, at(0)).otherwise(at(2)).alias("start"), at(7).alias("end"), words.alias("words"),
    )
    tops = script.select("script_id", "n").distinct()
    files = tops.select("script_id", F.lit(0).alias("file_idx"), F.lit(1).alias("start_line"), half.alias("end_line"), (2500 * n + 2000).cast("long").alias("length_ms"))
    later = tops.where(n > half).select("script_id", F.lit(1), half + 1, F.greatest(half + 1, n - 1), (2500 * n + 2000).cast("long"))
    return segments, script.select("script_id", "line_no", "text"), files.union(later)


EXACT = LINES + """,
x0 AS (SELECT doc_id AS script_id, line_no, max(line_no) OVER (PARTITION BY doc_id) AS n FROM lines),
x1 AS (SELECT *, (n + 1) // 2 AS half, line_no % 7 <> 0 AND NOT (script_id % 3 = 0 AND line_no = n) AS spoken, line_no % 5 = 0 AS formal, line_no % 3 = 0 AS led,
    250 * (10 * line_no + line_no % 4) AS t0 FROM x0),
x2 AS (SELECT *, CASE WHEN line_no <= half THEN 0 ELSE 1 END AS file_idx, greatest(half + 1, n - 1) AS last FROM x1),
x3 AS (SELECT *, t0 + 500 AS a, t0 + 1750 AS b, CASE WHEN led THEN t0 ELSE t0 + 500 END AS seg_a FROM x2 WHERE spoken),
x4 AS (SELECT *, a - lag(b) OVER w AS left_gap, lead(seg_a) OVER w - b AS right_gap, line_no - 1 - coalesce(lag(line_no) OVER (PARTITION BY script_id ORDER BY line_no), 0) AS jumped,
    32 + CASE WHEN formal THEN 3 ELSE 0 END AS chars FROM x3 WINDOW w AS (PARTITION BY script_id, file_idx ORDER BY line_no)),
x5 AS (SELECT *, CASE WHEN left_gap IS NULL OR left_gap >= 30 THEN 50 ELSE 0 END AS left_pad,
    CASE WHEN right_gap IS NULL THEN 400 WHEN formal THEN formal_pad WHEN right_gap < 30 THEN 0 ELSE least(400, greatest(0, right_gap - 20)) END AS right_pad,
    CASE WHEN led THEN 2.0 * chars / (2 * chars + 2) ELSE 1.0 END AS ratio FROM x4, (SELECT {pad} AS formal_pad)),
heard AS (SELECT script_id, max(line_no) AS top FROM x3 GROUP BY script_id),
missed AS (SELECT x2.*, coalesce(top, 0) AS top FROM x2 LEFT JOIN heard USING (script_id) WHERE NOT spoken)"""
