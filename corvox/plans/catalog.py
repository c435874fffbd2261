"""Registered queries over the driver's tables, and SQL for those that SQL can express.

Every query runs over whole tables. Columns are cast to the declared types on both sides,
doubles at six places.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvox.functions import signal as S
from corvox.functions import text as X
from corvox.functions.constants import FORMAL_ENDINGS_DETECTOR, FORMAL_ENDINGS_LONGEST_FIRST, FORMAL_ENDINGS_RECOUNT
from corvox.functions.similarity import best_of_two, edit_ceiling, edit_distance, error_rate, guarded_ratio, ratio, ratio_ceiling, with_edit_score, with_edit_similarity, word_block_score, word_membership_score
from corvox.operators import align as A
from corvox.operators import integrity as I
from corvox.operators import matching as M
from corvox.operators import proposed as Z
from corvox.operators import qc as Q
from corvox.operators import report as R
from corvox.operators import timing as W
from corvox.operators import verdict as V
from corvox.plans import fixtures as X0
from corvox.plans.fixtures import CLIPS, EVALUATED, EXACT, LINES, PAIRS, RECORDINGS, SCORED, SERIES, TURNS, clips, evaluated, lines, pairs, recordings, scored, series, table, turns
from corvox.operators.lifecycle import dry_run, labels_from
from corvox.sources.readers import answer_lines, not_done, read_checkpoint, read_manifest, read_segments, read_transcriptions, wav_column
from corvox.sources.writers import append_checkpoint, append_manifest, qc_rows, validation_rows, wav_files, write_manifest
from corvox.streaming import streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DUCK = {"long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


def register(name: str, types: str, sql: str | None = None):
    """Add a query whose columns are ``types``: ``name type, ...``."""
    columns = [c.split() for c in types.split(",")]

    def add(query: Callable[[SparkSession, str], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            found = query(spark, sf_dir)
            return found.select(*((F.round(F.col(c), 6) + F.lit(0.0) if t == "double" else F.col(c).cast(t)).alias(c) for c, t in columns))

        run.__doc__ = query.__doc__
        QUERIES[name] = run
        if sql:
            cast = ", ".join((f"round(CAST({c} AS DOUBLE), 6) + 0.0" if t == "double" else f"CAST({c} AS {DUCK[t]})") + f" AS {c}" for c, t in columns)
            head, _, tail = sql.rpartition("FINAL")
            ORACLE[name] = f"{head}{',' if head.strip() and not head.strip().endswith('WITH') else ''} final_rows AS ({tail}) SELECT {cast} FROM final_rows" if head.strip() else f"WITH final_rows AS ({tail or sql}) SELECT {cast} FROM final_rows"
        return query

    return add


# -- scans and parsing ------------------------------------------------------------------


@register("script_scan_lines", "doc_id long, source string, line_no long, text string", f"WITH {LINES} FINAL SELECT doc_id, source, line_no, text FROM lines")
def script_scan_lines(s, d):
    """S1, W5, P1, F5."""
    return lines(s, d)


@register("answer_key_lines", "doc_id long, line_no long, text string", r"WITH a AS (SELECT doc_id, regexp_split_to_array(regexp_replace(text, '\n$', ''), '\n') AS p FROM documents) FINAL SELECT doc_id, generate_subscripts(p, 1) AS line_no, unnest(p) AS text FROM a")
def answer_key_lines(s, d):
    """Raw lines, blanks kept."""
    return answer_lines(table(s, d, "documents"), "text", "doc_id")


@register(
    "normalize_variants", "doc_id long, n1 string, n2 string, n3 string, n4 string, n_words long",
    r"""WITH n AS (SELECT doc_id, regexp_replace(text, '[^가-힣a-zA-Z0-9]', '', 'g') AS n1, regexp_replace(nfc_normalize(text), '[^가-힣a-zA-Z0-9]', '', 'g') AS n3,
    trim(regexp_replace(regexp_replace(text, '[^\p{L}\p{N}_\s가-힣ㄱ-ㅎㅏ-ㅣ]', '', 'g'), '\s+', ' ', 'g')) AS n4 FROM documents)
    FINAL SELECT doc_id, n1, lower(n3) AS n2, n3, n4, CASE WHEN n4 = '' THEN 0 ELSE len(string_split(n4, ' ')) END AS n_words FROM n""",
)
def normalize_variants(s, d):
    """N1-N5."""
    t = F.col("text")
    return X0.spread(table(s, d, "documents")).select("doc_id", X.letters_only(t).alias("n1"), X.eval_text(t).alias("n2"), X.detector_text(t).alias("n3"), X.spoken_text(t).alias("n4"), F.size(X.word_list(t)).alias("n_words"))


@register(
    "parse_names", "s_suppkey long, clip string, script string, part1 string, part2 string, script_number long, line long, audio_script long, audio_start long, audio_end long, bucket string, ms long, supplier_number long",
    r"""WITH c AS (SELECT *, 'Script_' || s_nationkey || '_' || CASE WHEN s_suppkey < 10000 THEN lpad(s_suppkey::VARCHAR, 4, '0') ELSE s_suppkey::VARCHAR END || '.wav' AS clip FROM supplier)
    FINAL SELECT s_suppkey, clip, regexp_extract(clip, '^(Script_\d+)_', 1) AS script, s_nationkey::VARCHAR AS part1, regexp_extract(clip, '(\d+)\.wav$', 1) AS part2, s_nationkey AS script_number,
    s_suppkey AS line, s_nationkey AS audio_script, s_suppkey AS audio_start, s_suppkey + 9 AS audio_end, (s_suppkey // 50 * 50) || '-' || (s_suppkey // 50 * 50 + 49) AS bucket,
    trunc(s_acctbal * 1000) AS ms, regexp_extract(s_name, '(\d+)$', 1)::BIGINT AS supplier_number FROM c""",
)
def parse_names(s, d):
    """P2-P7, P9, S4."""
    t = table(s, d, "supplier").withColumn("clip", X.clip_name(F.col("s_nationkey"), F.col("s_suppkey")))
    one, two = X.name_parts(F.col("clip"))
    audio = F.format_string("Script_%d_%d-%d.wav", F.col("s_nationkey"), F.col("s_suppkey"), F.col("s_suppkey") + 9)
    fields = X.audio_name_fields(audio, "wav")
    return t.select(
        "s_suppkey", "clip", X.script_key(F.col("clip")).alias("script"), one.alias("part1"), two.alias("part2"), X.script_number(F.col("clip")).alias("script_number"), X.trailing_line(F.col("clip")).alias("line"),
        *(f.alias(n) for f, n in zip(fields, ("audio_script", "audio_start", "audio_end"), strict=True)), X.bucket_label(F.col("s_suppkey")).alias("bucket"), (F.col("s_acctbal") * 1000).cast("long").alias("ms"),
        X.trailing_line(F.col("s_name"), "").alias("supplier_number"),
    )


@register("head_tail_parts", "doc_id long, head string, tail string, first_words string, last_words string", r"""WITH w AS (SELECT doc_id, text, trim(regexp_replace(regexp_replace(text, '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')) AS n4 FROM documents),
    v AS (SELECT *, list_filter(string_split(n4, ' '), lambda x: x <> '') AS words FROM w)
    FINAL SELECT doc_id, left(n4, 8) AS head, right(n4, 8) AS tail, array_to_string(words[1:3], ' ') AS first_words, array_to_string(words[greatest(len(words) - 4, 1):], ' ') AS last_words FROM v""")
def head_tail_parts(s, d):
    """P10, P11."""
    t = table(s, d, "documents").withColumn("n4", X.spoken_text(F.col("text"))).withColumn("words", X.word_list(F.col("text")))
    return t.select("doc_id", X.head_chars(F.col("n4"), 8).alias("head"), X.tail_chars(F.col("n4"), 8).alias("tail"), X.head_words(F.col("words"), 3).alias("first_words"), X.tail_words(F.col("words"), 5).alias("last_words"))


@register("covered_lines", "script_id long, line_no long", f"WITH {LINES}, {RECORDINGS}, b AS (SELECT script_id, min(start_line) AS a, max(end_line) AS z FROM recordings GROUP BY 1) FINAL SELECT script_id, line_no FROM lines JOIN b ON doc_id = script_id AND line_no BETWEEN a AND z")
def covered_lines(s, d):
    """F3."""
    return W.covered_lines(lines(s, d).withColumnRenamed("doc_id", "script_id"), recordings(s, d))


@register("page_hosts", "page_id long, scheme string, host string, top string", r"FINAL SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '://([^/]+)', 1) AS host, regexp_extract(url, '://[^/]+/([^/?#]+)', 1) AS top FROM pages")
def page_hosts(s, d):
    """Name parsing on URLs."""
    u = F.col("url")
    return table(s, d, "pages").select("page_id", F.regexp_extract(u, "^([a-z]+)://", 1).alias("scheme"), F.regexp_extract(u, "://([^/]+)", 1).alias("host"), F.regexp_extract(u, "://[^/]+/([^/?#]+)", 1).alias("top"))


# -- similarity and verdicts ------------------------------------------------------------


@register("cer_similarity", "doc_id long, line_no long, dist long, max_len long, similarity double", f"WITH {SCORED} FINAL SELECT doc_id, line_no, dist, max_len, similarity FROM scored")
def cer_similarity(s, d):
    """Y1, Y2, N2."""
    return scored(s, d)


@register(
    "best_of_two_tier", "doc_id long, line_no long, best double, won_plain boolean, tier2 boolean",
    f"""WITH {SCORED}, b AS (SELECT *, CASE WHEN similarity < 0.95 THEN CASE WHEN greatest(length(truth), length(plain)) = 0 THEN 1.0 ELSE 1 - levenshtein(truth, plain)::DOUBLE / greatest(length(truth), length(plain)) END ELSE 0.0 END AS p FROM scored)
    FINAL SELECT doc_id, line_no, greatest(similarity, p) AS best, p > similarity AS won_plain, greatest(similarity, p) < 0.95 AND greatest(similarity, p) >= 0.5 AS tier2 FROM b""",
)
def best_of_two_tier(s, d):
    """Y9, F8. The second distance is computed where the first fails only."""
    t = scored(s, d)
    t = t.withColumn("plain_dist", edit_distance(F.when(F.col("similarity") < 0.95, F.col("truth")), F.col("plain")))
    plain = 1 - error_rate(F.col("plain_dist"), F.greatest(F.length("truth"), F.length("plain")))
    score, text = best_of_two(F.col("similarity"), plain, F.lit("prompted"), F.lit("plain"))
    return t.select("doc_id", "line_no", score.alias("best"), (text == "plain").alias("won_plain")).withColumn("tier2", (F.col("best") < 0.95) & (F.col("best") >= 0.5))


@register("verdict_rules", "filename string, verdict string, kinds string, reasons string", f"WITH {EVALUATED} FINAL SELECT filename, verdict, array_to_string(failure_types, ',') AS kinds, array_to_string(failure_reasons, '; ') AS reasons FROM evaluated")
def verdict_rules(s, d):
    """C1, C2, T6."""
    return evaluated(s, d).select("filename", "verdict", F.array_join("failure_types", ",").alias("kinds"), F.array_join("failure_reasons", "; ").alias("reasons"))


REPORT = """SELECT count(*) AS total, count_if(verdict = 'PASS') AS passed, count_if(verdict <> 'PASS') AS failed,
    round(100.0::DOUBLE * count_if(round(similarity, 4) >= 0.95) / count(*), 2) AS r1_pct, round(100.0::DOUBLE * count_if(boundary_pass) / count(*), 2) AS r2_pct,
    round(100.0::DOUBLE * count_if(verdict = 'PASS') / count(*), 2) AS r3_pct, round(100.0::DOUBLE * count_if(envelope_pass) / count(*), 2) AS r6_pct,
    min(preattack_ms) AS preattack_min, max(preattack_ms) AS preattack_max, avg(preattack_ms) AS preattack_mean, count_if(preattack_ms < 395) AS preattack_short,
    min(tail_silence_ms) AS tail_min, max(tail_silence_ms) AS tail_max, avg(tail_silence_ms) AS tail_mean, count_if(tail_silence_ms < 725) AS tail_short FROM evaluated"""


@register(
    "evaluation_report", "total long, passed long, failed long, r1_pct double, r2_pct double, r3_pct double, r6_pct double, preattack_min double, preattack_max double, preattack_mean double, preattack_short long, tail_min double, tail_max double, tail_mean double, tail_short long",
    f"WITH {EVALUATED} FINAL {REPORT}",
)
def evaluation_report(s, d):
    """G1, G2."""
    return R.evaluation_report(evaluated(s, d))


@register("evaluation_per_script", "source string, total long, passed long, rate double", f"WITH {EVALUATED} FINAL SELECT source, count(*) AS total, count_if(passed) AS passed, round(100.0::DOUBLE * count_if(passed) / count(*), 2) AS rate FROM evaluated GROUP BY source")
def evaluation_per_script(s, d):
    """G3, the flagship: documents to lines, normalised, scored, judged, by source."""
    return R.per_script(evaluated(s, d), "source")


TYPES = "t AS (SELECT unnest(failure_types) AS failure_type FROM evaluated), tc AS (SELECT k AS failure_type, (SELECT count(*) FROM t WHERE t.failure_type = k) AS n FROM (SELECT unnest(['A', 'B', 'C', 'D', 'E', 'F']) AS k))"


@register("failure_type_counts", "failure_type string, n long", f"WITH {EVALUATED}, {TYPES} FINAL SELECT * FROM tc")
def failure_type_counts(s, d):
    """G4."""
    return R.failure_types(evaluated(s, d))


@register("failed_rows", "filename string, similarity double, reasons string, types string", f"""WITH {EVALUATED} FINAL SELECT filename, similarity, CASE WHEN len(failure_reasons) > 0 THEN array_to_string(failure_reasons, '; ') ELSE 'Unknown' END AS reasons,
    CASE WHEN len(failure_types) > 0 THEN array_to_string(failure_types, ', ') ELSE 'Unknown' END AS types FROM evaluated WHERE verdict = 'FAIL'""")
def failed_rows(s, d):
    """G5."""
    return R.failed_rows(evaluated(s, d))


@register("quality_gate", "passed_gate boolean, dominant string", f"""WITH {EVALUATED}, {TYPES}, r AS ({REPORT})
    FINAL SELECT r1_pct >= 95 AND r2_pct >= 95 AND r3_pct >= 95 AND r6_pct >= 95 AS passed_gate, (SELECT failure_type FROM tc ORDER BY n DESC, failure_type LIMIT 1) AS dominant FROM r""")
def quality_gate(s, d):
    """G6."""
    rows = evaluated(s, d)
    return R.gate(R.evaluation_report(rows), R.failure_types(rows))


@register("quick_mode", "filename string, similarity double, verdict string", f"WITH {LINES} FINAL SELECT 'Script_' || doc_id || '_' || line_no || '.wav' AS filename, 1.0 AS similarity, CASE WHEN line_no % 23 <> 0 AND line_no % 29 <> 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM lines")
def quick_mode(s, d):
    """C5."""
    n = F.col("line_no")
    rows = lines(s, d).select(F.concat(F.lit("Script_"), "doc_id", F.lit("_"), n, F.lit(".wav")).alias("filename"), F.lit("x").alias("heard"), (n % 23 != 0).alias("boundary_pass"), (n % 29 != 0).alias("envelope_pass"), F.lit(True).alias("readable"))
    return V.evaluate(V.quick(rows))


TIER2 = EVALUATED + """, again AS (SELECT *, CASE WHEN line_no % 3 = 0 THEN 0.97 ELSE similarity + 0.01 END AS similarity2 FROM evaluated),
    merged AS (SELECT *, NOT passed AND similarity >= 0.5 AND similarity2 > similarity AS better, NOT passed AND similarity >= 0.5 AND similarity2 > similarity AND similarity2 >= 0.95 AS cured FROM again)"""


@register("tier2_merge", "filename string, similarity double, verdict string, kinds string, recovered boolean", f"""WITH {TIER2} FINAL SELECT filename, CASE WHEN better THEN similarity2 ELSE similarity END AS similarity,
    CASE WHEN cured AND boundary_pass AND envelope_pass THEN 'PASS' ELSE verdict END AS verdict, array_to_string(CASE WHEN cured THEN list_filter(failure_types, lambda x: x NOT IN ('A', 'D')) ELSE failure_types END, ',') AS kinds, cured AS recovered FROM merged""")
def tier2_merge(s, d):
    """C4, F8: a second score for every third line passes, for others it is a little better."""
    rows = evaluated(s, d)
    again = rows.select("filename", F.when(F.col("line_no") % 3 == 0, 0.97).otherwise(F.col("similarity") + 0.01).alias("similarity2"), F.col("heard").alias("heard2"))
    return V.merge_tier2(rows, again).withColumn("kinds", F.array_join("failure_types", ","))


@register("curation", "filename string, similarity double", f"WITH {EVALUATED}, g AS (SELECT count_if(similarity < 0.3) * 100 <= 20 * count(*) AS proceeds FROM evaluated) FINAL SELECT filename, similarity FROM evaluated, g WHERE NOT proceeds OR similarity >= 0.3")
def curation(s, d):
    """C6, F9, U4."""
    return V.curate(evaluated(s, d))


@register("curation_gate", "total long, removed long, proceeds boolean", f"WITH {EVALUATED} FINAL SELECT count(*) AS total, count_if(similarity < 0.3) AS removed, count_if(similarity < 0.3) * 100 <= 20 * count(*) AS proceeds FROM evaluated")
def curation_gate(s, d):
    """F9."""
    return V.curation_gate(evaluated(s, d))


@register("validation_csv_rows", "filename string, similarity string, cer string, preattack_ms string, failure_types string", f"WITH {EVALUATED} FINAL SELECT filename, printf('%.4f', similarity) AS similarity, printf('%.4f', cer) AS cer, printf('%.2f', preattack_ms) AS preattack_ms, array_to_string(failure_types, ',') AS failure_types FROM evaluated")
def validation_csv_rows(s, d):
    """K5."""
    return validation_rows(evaluated(s, d))


# -- manifests, integrity, sets ---------------------------------------------------------

MANIFEST = "m AS (SELECT doc_id AS pos, source || '_' || lang AS filename, text FROM documents)"


def manifest(s, d):
    return table(s, d, "documents").select(F.col("doc_id").alias("pos"), F.concat_ws("_", "source", "lang").alias("filename"), "text")


for _policy, _pick in (("min", "min(text)"), ("last", "arg_max(text, pos)"), ("first", "arg_min(text, pos)")):

    @register(f"manifest_dedupe_{_policy}", "filename string, text string", f"WITH {MANIFEST} FINAL SELECT filename, {_pick} AS text FROM m GROUP BY filename")
    def manifest_dedupe(s, d, policy=_policy):
        """G16, S2, S3, T8."""
        return M.dedupe(manifest(s, d), policy)


PRESENCE = "p AS (SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'ORPHAN' WHEN l.doc_id IS NULL THEN 'MISSING' ELSE 'OK' END AS status FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id + 3 AS doc_id FROM labels) l USING (doc_id))"


def present(s, d):
    """Files are the labelled ids moved by three, so that some have no document."""
    return I.presence(table(s, d, "documents"), table(s, d, "labels").select((F.col("doc_id") + 3).alias("doc_id")), ["doc_id"])


@register("integrity_missing_orphan", "doc_id long, status string", f"WITH {PRESENCE} FINAL SELECT * FROM p")
def integrity_missing_orphan(s, d):
    """J8, U1."""
    return present(s, d)


@register("integrity_stats", "script long, meta long, wav long, orphan long, missing long, verdict string", f"""WITH {PRESENCE} FINAL SELECT doc_id // 100 AS script, count_if(status <> 'ORPHAN') AS meta, count_if(status <> 'MISSING') AS wav, count_if(status = 'ORPHAN') AS orphan,
    count_if(status = 'MISSING') AS missing, CASE WHEN count_if(status <> 'OK') = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM p GROUP BY 1""")
def integrity_stats(s, d):
    """G7."""
    return I.integrity_stats(present(s, d).withColumn("script", F.floor(F.col("doc_id") / 100)), "script")


@register("found_missing", "source string, found long, missing long", "FINAL SELECT source, count_if(l.doc_id IS NOT NULL) AS found, count_if(l.doc_id IS NULL) AS missing FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY source")
def found_missing(s, d):
    """J9."""
    return I.found_missing(table(s, d, "documents"), table(s, d, "labels"), ["doc_id"], "source")


@register("quarantine_orphans", "doc_id long, place string", f"WITH {PRESENCE} FINAL SELECT doc_id, CASE WHEN status = 'ORPHAN' THEN 'quarantine' ELSE 'dataset' END AS place FROM p")
def quarantine_orphans(s, d):
    """K14."""
    return I.quarantine(present(s, d))


@register("exists_on_disk", "doc_id long", "FINAL SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def exists_on_disk(s, d):
    """F6."""
    return table(s, d, "documents").join(table(s, d, "labels"), "doc_id", "left_semi")


@register("not_processed", "doc_id long", "FINAL SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def not_processed(s, d):
    """F7, C9, K13."""
    return not_done(table(s, d, "documents"), table(s, d, "labels"), ["doc_id"])


@register("all_keys", "doc_id long", "FINAL SELECT doc_id FROM documents UNION SELECT doc_id + 3 FROM labels")
def all_keys(s, d):
    """U2."""
    return M.all_keys(table(s, d, "documents"), table(s, d, "labels").select((F.col("doc_id") + 3).alias("doc_id")), "doc_id")


@register("append_new_rows", "filename string, text string", f"WITH {MANIFEST}, k AS (SELECT * FROM m WHERE filename LIKE '%en') FINAL SELECT filename, text FROM k UNION ALL SELECT filename, text FROM m WHERE filename NOT IN (SELECT filename FROM k)")
def append_new_rows(s, d):
    """The English part is there; of the whole, what it lacks comes in."""
    whole = manifest(s, d).select("filename", "text")
    return M.append_new(whole.where(F.col("filename").endswith("en")), whole)


DIFF = LINES + ", a AS (SELECT * FROM lines WHERE source = 'src0'), b AS (SELECT * FROM lines WHERE source = 'src1'), x AS (SELECT doc_id * 100000 + line_no AS line_no, text FROM a WHERE text NOT IN (SELECT text FROM b) ORDER BY 1 LIMIT 50), y AS (SELECT doc_id * 100000 + line_no AS line_no, text FROM b WHERE text NOT IN (SELECT text FROM a) ORDER BY 1 LIMIT 50)"


@register("script_diff", "side string, line_no long, text string", f"WITH {DIFF} FINAL SELECT 'removed' AS side, * FROM x UNION ALL SELECT 'added', * FROM y")
def script_diff(s, d):
    """Two sources as two versions; the first 50 of each side."""
    t = lines(s, d).withColumn("line_no", F.col("doc_id") * 100_000 + F.col("line_no"))
    return M.script_diff(t.where("source = 'src0'"), t.where("source = 'src1'"))


@register("script_audio_join", "script_id long, file_idx long, status string", f"WITH {LINES}, {RECORDINGS} FINAL SELECT script_id, file_idx, CASE WHEN l.doc_id IS NULL THEN 'NO_SCRIPT' ELSE 'OK' END AS status FROM recordings r LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = script_id")
def script_audio_join(s, d):
    """J6."""
    return M.script_audio(recordings(s, d), table(s, d, "labels").select(F.col("doc_id").cast("int").alias("script_id")))


@register("result_lookup", "filename string, toxic long, text string", "FINAL SELECT l.doc_id::VARCHAR AS filename, toxic, coalesce(text, '') AS text FROM labels l LEFT JOIN (SELECT doc_id + 7 AS doc_id, text FROM documents) d USING (doc_id)")
def result_lookup(s, d):
    """J7."""
    docs = table(s, d, "documents").select((F.col("doc_id") + 7).cast("string").alias("filename"), "text")
    return M.lookup(table(s, d, "labels").select(F.col("doc_id").cast("string").alias("filename"), "toxic"), docs)


@register("recordings_in_order", "script_id long, n long, spans string", f"WITH {LINES}, {RECORDINGS} FINAL SELECT script_id, count(*) AS n, string_agg(start_line || '-' || end_line, ',' ORDER BY start_line, end_line) AS spans FROM recordings GROUP BY script_id")
def recordings_in_order(s, d):
    """G15, O1, O9."""
    found = R.files_of(recordings(s, d).withColumn("path", F.col("file_idx").cast("string")))
    return found.select("script_id", F.size("files").alias("n"), F.array_join(F.transform("files", lambda f: F.concat(f["start_line"], F.lit("-"), f["end_line"])), ",").alias("spans"))


# -- scores -----------------------------------------------------------------------------

WORDS = PAIRS + r""", w0 AS (SELECT *, string_split(trim(regexp_replace(regexp_replace(text, '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')), ' ') AS k0 FROM pairs),
    w1 AS (SELECT *, list_filter(k0, lambda x: x <> '') AS key FROM w0), w2 AS (SELECT *, list_filter(key, lambda x, i: i % (3 + line_no % 5) <> 0) AS said FROM w1),
    words AS (SELECT doc_id, line_no, CASE WHEN len(said) > 0 THEN len(list_filter(said, lambda w: list_contains(key, w)))::DOUBLE / len(said) ELSE 0.0 END AS member, CASE WHEN len(key) > 0 THEN len(said)::DOUBLE / len(key) ELSE 1.0 END AS score FROM w2)"""


def word_scores(s, d):
    """Lines whose heard words lack every 3rd to 7th: membership (Y8) and share of the key."""
    t = lines(s, d).withColumn("key", X.word_list(F.col("text")))
    t = t.withColumn("said", F.filter("key", lambda w, i: (i + 1) % (F.col("line_no") % 5 + 3) != 0))
    return t.select("doc_id", "line_no", "key", "said", F.coalesce(word_membership_score(F.col("said"), F.col("key")), F.lit(0.0)).alias("member"), F.when(F.size("key") > 0, F.size("said") / F.size("key")).otherwise(F.lit(1.0)).alias("score"))


@register("word_membership", "doc_id long, line_no long, member double, score double", f"WITH {WORDS} FINAL SELECT * FROM words")
def word_membership(s, d):
    """Y8, T11."""
    return word_scores(s, d)


@register("word_blocks", "doc_id long, line_no long, blocks double")
def word_blocks(s, d):
    """Matching blocks of word lists (the standard library's, so rows only)."""
    return X0.spread(word_scores(s, d)).select("doc_id", "line_no", word_block_score("said", "key").alias("blocks"))


@register("answer_key_join", "doc_id long, line_no long, answer string", f"WITH {LINES}, r AS (SELECT doc_id, (line_no + 1) AS line_no FROM lines) FINAL SELECT r.doc_id, r.line_no, coalesce(l.text, '') AS answer FROM r LEFT JOIN lines l ON l.doc_id = r.doc_id AND l.line_no = r.line_no")
def answer_key_join(s, d):
    """The line after each; '' behind the last."""
    t = lines(s, d).withColumn("k", F.concat_ws("#", "doc_id", "line_no"))
    after = t.select("doc_id", (F.col("line_no") + 1).alias("line_no")).withColumn("k", F.concat_ws("#", "doc_id", "line_no"))
    return M.answers(after, t.select(F.col("k").alias("line_no"), "text"), "k")


@register("bucket_stats", "bucket string, mean double, n long", f"WITH {WORDS} FINAL SELECT (line_no // 50 * 50) || '-' || (line_no // 50 * 50 + 49) AS bucket, avg(score) AS mean, count(*) AS n FROM words GROUP BY 1")
def bucket_stats(s, d):
    """G12, P9."""
    return R.bucket_means(word_scores(s, d), X.bucket_label(F.col("line_no")), "score")


@register(
    "score_stats", "mean double, median double, least double, largest double, deviation double, perfect long, high long, middle long, low long",
    f"WITH {WORDS} FINAL SELECT avg(score) AS mean, median(score) AS median, min(score) AS least, max(score) AS largest, stddev_pop(score) AS deviation, count_if(score >= 1) AS perfect, count_if(score >= 0.95 AND score < 1) AS high, count_if(score >= 0.8 AND score < 0.95) AS middle, count_if(score < 0.8) AS low FROM words",
)
def score_stats(s, d):
    """G10, G11."""
    return R.score_stats(word_scores(s, d), "score")


@register("worst_fifteen", "pos long, score double", f"WITH {WORDS} FINAL SELECT doc_id * 100000 + line_no AS pos, score FROM words ORDER BY score, pos LIMIT 15")
def worst_fifteen(s, d):
    """O4."""
    return R.worst(word_scores(s, d).withColumn("pos", F.col("doc_id") * 100_000 + F.col("line_no")), "score", "pos")


@register("similarity_bands", "band long, n long", f"WITH {WORDS} FINAL SELECT CASE WHEN score >= 0.95 THEN 4 WHEN score >= 0.85 THEN 3 WHEN score >= 0.7 THEN 2 WHEN score >= 0.5 THEN 1 ELSE 0 END AS band, count(*) AS n FROM words GROUP BY 1")
def similarity_bands(s, d):
    """G19."""
    return R.similarity_bands(word_scores(s, d), "score", [0.5, 0.7, 0.85, 0.95])


@register("iteration_delta", "k long, mean double, delta double", f"WITH {WORDS}, i AS (SELECT line_no % 5 AS k, avg(score) AS mean FROM words GROUP BY 1) FINAL SELECT k, mean, mean - lag(mean) OVER (ORDER BY k) AS delta FROM i")
def iteration_delta(s, d):
    """G20."""
    means = word_scores(s, d).groupBy((F.col("line_no") % 5).alias("k")).agg(F.avg("score").alias("mean"))
    return R.iteration_delta(means, "k", "mean")


@register("similarity_grades", "doc_id long, line_no long, grade string, band string", f"WITH {WORDS} FINAL SELECT doc_id, line_no, CASE WHEN score >= 0.95 THEN 'PASS' WHEN score >= 0.85 THEN 'MARGINAL' ELSE 'FAIL' END AS grade, CASE WHEN score >= 0.95 THEN '95' WHEN score >= 0.9 THEN '90' WHEN score >= 0.8 THEN '80' ELSE 'below' END AS band FROM words")
def similarity_grades(s, d):
    """Z3, Z4."""
    return word_scores(s, d).select("doc_id", "line_no", Z.grade(F.col("score")).alias("grade"), Z.word_band(F.col("score")).alias("band"))


@register("top_hypotheses", "doc_id long, line_no long, score double, rank long", f"WITH {WORDS}, r AS (SELECT doc_id, line_no, score, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, line_no) AS rank FROM words) FINAL SELECT * FROM r WHERE rank <= 3")
def top_hypotheses(s, d):
    """Z5, O8."""
    return Z.top_hypotheses(word_scores(s, d), "doc_id", "score", "line_no")


@register("prompt_gap_penalty", "doc_id long, line_no long, value double", f"WITH {WORDS} FINAL SELECT doc_id, line_no, member - 0.5 * greatest(member - score, 0) AS value FROM words")
def prompt_gap_penalty(s, d):
    """Z10."""
    return word_scores(s, d).select("doc_id", "line_no", Z.prompt_gap_penalty(F.col("member"), F.col("score")).alias("value"))


@register("stability", "key string, decodes long, texts long, agreement double", r"WITH c AS (SELECT left(text, 20) AS key, regexp_replace(text, '[^가-힣a-zA-Z0-9]', '', 'g') AS t, count(*) AS n FROM documents GROUP BY ALL) FINAL SELECT key, sum(n) AS decodes, count(*) AS texts, max(n)::DOUBLE / sum(n) AS agreement FROM c GROUP BY key")
def stability(s, d):
    """Documents that begin alike as decodings of one recording."""
    return Z.stability(table(s, d, "documents").select(F.left("text", F.lit(20)).alias("key"), X.letters_only(F.col("text")).alias("t")), "key", "t")


# -- neighbours and quality control -----------------------------------------------------


def with_context(s, d):
    """Turns with N4 texts, the turns around them in global order, and what was heard: every
    third turn begins with the end of the one before, every fourth lacks its end."""
    t = X0.spread(table(s, d, "conversations")).withColumn("expected", X.spoken_text(F.col("text")))
    t = M.with_neighbours(t.select("conv_id", "turn", "expected"), "expected", ["conv_id", "turn"], block=F.floor(F.col("conv_id") / 1000))
    n = F.col("conv_id") + F.col("turn")
    heard = F.when(n % 3 == 0, F.concat(F.right("prev_text", F.lit(8)), "expected")).when(n % 4 == 0, F.left("expected", F.floor(F.length("expected") / 2).cast("int"))).when(n % 31 == 0, "").otherwise(F.col("expected"))
    return t.withColumn("heard", heard).withColumn("status", F.when(n % 41 == 0, "FILE_MISSING").otherwise("OK"))


CONTEXT = r"""c0 AS (SELECT conv_id, turn, trim(regexp_replace(regexp_replace(text, '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')) AS expected FROM conversations),
    c1 AS (SELECT *, lag(expected, 1, '') OVER (ORDER BY conv_id, turn) AS prev_text, lead(expected, 1, '') OVER (ORDER BY conv_id, turn) AS next_text FROM c0),
    ctx AS (SELECT *, CASE WHEN (conv_id + turn) % 3 = 0 THEN right(prev_text, 8) || expected WHEN (conv_id + turn) % 4 = 0 THEN left(expected, length(expected) // 2) WHEN (conv_id + turn) % 31 = 0 THEN '' ELSE expected END AS heard FROM c1)"""


@register("neighbour_context", "conv_id long, turn long, prev_text string, next_text string", f"WITH {CONTEXT} FINAL SELECT conv_id, turn, prev_text, next_text FROM ctx")
def neighbour_context(s, d):
    """J12."""
    return with_context(s, d)


ASCII8 = "regexp_replace({}, '[^a-zA-Z0-9 ]', '-', 'g')"


@register(
    "neighbour_bleed_cer", "conv_id long, turn long, start_bleed boolean, end_bleed boolean",
    f"""WITH {CONTEXT}, a AS (SELECT conv_id, turn, {ASCII8.format('heard')} AS h, {ASCII8.format('prev_text')} AS p, {ASCII8.format('next_text')} AS x FROM ctx)
    FINAL SELECT conv_id, turn, length(h) >= 8 AND length(p) >= 8 AND 1 - levenshtein(left(h, 8), right(p, 8)) / 8.0 >= 0.75 AS start_bleed, length(h) >= 8 AND length(x) >= 8 AND 1 - levenshtein(right(h, 8), left(x, 8)) / 8.0 >= 0.75 AS end_bleed FROM a""",
)
def neighbour_bleed_cer(s, d):
    """J12, W1, W2 scored by edit distance on ASCII."""
    plain = lambda c: F.regexp_replace(c, f"[^{X.ASCII} ]", "-")
    score = lambda a, b: 1 - error_rate(F.levenshtein(a, b), F.greatest(F.length(a), F.length(b)))
    t = with_context(s, d).select("conv_id", "turn", plain("heard").alias("heard"), plain("prev_text").alias("p"), plain("next_text").alias("x"))
    return t.select("conv_id", "turn", Q.start_bleed(F.col("heard"), F.col("p"), score).alias("start_bleed"), Q.end_bleed(F.col("heard"), F.col("x"), score).alias("end_bleed"))


@register("neighbour_bleed_ratio", "conv_id long, turn long, start_bleed boolean, end_bleed boolean")
def neighbour_bleed_ratio(s, d):
    """W1, W2 with the block ratio."""
    t = with_context(s, d)
    return t.select("conv_id", "turn", Q.start_bleed(F.col("heard"), F.col("prev_text")).alias("start_bleed"), Q.end_bleed(F.col("heard"), F.col("next_text")).alias("end_bleed"))


@register("truncation_words", "conv_id long, turn long, cut_start boolean, cut_end boolean")
def truncation_words(s, d):
    """W3, W4 with the block ratio."""
    t = with_context(s, d).withColumns({"h": X.word_list(F.col("heard")), "e": X.word_list(F.col("expected"))})
    return t.select("conv_id", "turn", Q.truncated_start(F.col("h"), F.col("e")).alias("cut_start"), Q.truncated_end(F.col("h"), F.col("e")).alias("cut_end"))


def edit_score(a, b):
    """Y2 of two texts as they are."""
    return 1 - error_rate(F.levenshtein(a, b), F.greatest(F.length(a), F.length(b)))


WORDED = CONTEXT + f""", w0 AS (SELECT *, {ASCII8.format('heard')} AS hh, {ASCII8.format('expected')} AS ee, {ASCII8.format('prev_text')} AS pp, {ASCII8.format('next_text')} AS xx, (conv_id + turn) % 41 = 0 AS gone FROM ctx),
    w1 AS (SELECT *, list_filter(string_split(hh, ' '), lambda w: w <> '') AS h, list_filter(string_split(ee, ' '), lambda w: w <> '') AS e FROM w0),
    w2 AS (SELECT *, array_to_string(e[1:3], ' ') AS e3, array_to_string(h[1:5], ' ') AS h5, array_to_string(e[greatest(len(e) - 2, 1):], ' ') AS t3, array_to_string(h[greatest(len(h) - 4, 1):], ' ') AS t5 FROM w1),
    w3 AS (SELECT *, len(e) >= 3 AND len(h) > 0 AND 1 - levenshtein(e3, h5)::DOUBLE / greatest(length(e3), length(h5), 1) < 0.5 AS cut_start, len(e) >= 3 AND len(h) > 0 AND 1 - levenshtein(t3, t5)::DOUBLE / greatest(length(t3), length(t5), 1) < 0.5 AS cut_end,
        length(hh) >= 8 AND length(pp) >= 8 AND 1 - levenshtein(left(hh, 8), right(pp, 8)) / 8.0 >= 0.75 AS start_bleed, length(hh) >= 8 AND length(xx) >= 8 AND 1 - levenshtein(right(hh, 8), left(xx, 8)) / 8.0 >= 0.75 AS end_bleed,
        CASE WHEN hh = '' AND ee = '' THEN 1 WHEN hh = '' OR ee = '' THEN 0 ELSE 1 - levenshtein(hh, ee)::DOUBLE / greatest(length(hh), length(ee)) END AS similarity FROM w2),
    w4 AS (SELECT *, 'Script_' || conv_id || '_' || lpad(turn::VARCHAR, greatest(4, length(turn::VARCHAR))::INTEGER, '0') || '.wav' AS filename, CASE WHEN gone THEN ['FILE_MISSING'] WHEN trim(heard) = '' THEN ['EMPTY_TRANSCRIPTION'] ELSE
        list_filter([CASE WHEN start_bleed THEN 'START_BLEED' END, CASE WHEN end_bleed THEN 'END_BLEED' END, CASE WHEN cut_start THEN 'TRUNCATED_START' END, CASE WHEN cut_end THEN 'TRUNCATED_END' END, CASE WHEN similarity < 0.70 THEN 'LOW_SIMILARITY' END], lambda x: x IS NOT NULL) END AS issues FROM w3)"""


def ascii_context(s, d):
    plain = lambda c: F.regexp_replace(c, f"[^{X.ASCII} ]", "-")
    near = {"prev_text": F.right("prev_text", F.lit(8)), "next_text": F.left("next_text", F.lit(8))}  # no more of them is looked at
    return X0.dealt(with_context(s, d).withColumns(near)).withColumn("raw_heard", F.col("heard")).withColumns({c: plain(c) for c in ("heard", "expected", "prev_text", "next_text")})


@register("truncation_words_cer", "conv_id long, turn long, cut_start boolean, cut_end boolean", f"WITH {WORDED} FINAL SELECT conv_id, turn, cut_start, cut_end FROM w3")
def truncation_words_cer(s, d):
    """W3, W4 scored by edit distance on ASCII."""
    split = lambda c: F.filter(F.split(F.col(c), " "), lambda w: w != "")
    t = ascii_context(s, d).withColumns({"h": split("heard"), "e": split("expected")})
    return t.select("conv_id", "turn", Q.truncated_start(F.col("h"), F.col("e"), edit_score).alias("cut_start"), Q.truncated_end(F.col("h"), F.col("e"), edit_score).alias("cut_end"))


def checked_cer(s, d):
    split = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    t = ascii_context(s, d)
    t = t.withColumn("dist", edit_distance(F.col("heard"), F.col("expected")))
    similar = F.when((F.col("heard") == "") & (F.col("expected") == ""), 1.0).otherwise(1 - error_rate(F.col("dist"), F.greatest(F.length("heard"), F.length("expected"))))
    return Q.quality(t.withColumn("similarity", similar), edit_score, split).withColumn("filename", F.format_string("Script_%d_%04d.wav", "conv_id", "turn"))


@register("qc_rows_cer", "filename string, script_id string, line_number string, issues string, verdict string", f"WITH {WORDED} FINAL SELECT filename, conv_id::VARCHAR AS script_id, lpad(turn::VARCHAR, greatest(4, length(turn::VARCHAR))::INTEGER, '0') AS line_number, array_to_string(issues, '|') AS issues, CASE WHEN len(issues) = 0 THEN 'GOOD' ELSE 'PROBLEMATIC' END AS verdict FROM w4")
def qc_rows_cer(s, d):
    """C3, K6, P3 scored by edit distance on ASCII."""
    return qc_rows(checked_cer(s, d))


@register("qc_issue_histogram_cer", "issue string, n long", f"WITH {WORDED} FINAL SELECT issue, count(*) AS n FROM (SELECT unnest(issues) AS issue FROM w4) GROUP BY issue")
def qc_issue_histogram_cer(s, d):
    """G9, O6."""
    return Q.issue_histogram(checked_cer(s, d))


def checked(s, d):
    t = X0.dealt(with_context(s, d)).withColumn("similarity", guarded_ratio(F.col("heard"), F.col("expected")))
    return Q.quality(t).withColumn("filename", F.format_string("Script_%d_%04d.wav", "conv_id", "turn"))


@register("qc_rows", "filename string, script_id string, line_number string, issues string, verdict string")
def qc_report_rows(s, d):
    """C3, K6, P3."""
    return qc_rows(checked(s, d))


@register("qc_issue_histogram", "issue string, n long")
def qc_issue_histogram(s, d):
    """G9, O6."""
    return Q.issue_histogram(checked(s, d))


@register("qc_verdicts", "good long, problems long")
def qc_verdicts(s, d):
    """G9."""
    return Q.verdict_counts(checked(s, d))


ENDINGS = ["tion", "ing", "en", "er", "n"]


def endings(s, d):
    t = pairs(s, d).select(F.concat_ws("_", "doc_id", "line_no").alias("filename"), "truth", F.when(F.col("line_no") % 3 == 0, F.substring("truth", F.lit(1), F.greatest(F.length("truth") - F.col("line_no") % 5, F.lit(0)).cast("int"))).otherwise(F.col("truth")).alias("heard"), F.when(F.col("line_no") % 17 == 0, "FILE_NOT_FOUND").otherwise("OK").alias("status"))
    return Q.truncation(t, ENDINGS)


ENDED = PAIRS + """, u0 AS (SELECT doc_id || '_' || line_no AS filename, truth, CASE WHEN line_no % 3 = 0 THEN left(truth, greatest(length(truth) - line_no % 5, 0)::INT) ELSE truth END AS heard, CASE WHEN line_no % 17 = 0 THEN 'FILE_NOT_FOUND' ELSE 'OK' END AS s0,
    CASE WHEN truth LIKE '%tion' THEN 'tion' WHEN truth LIKE '%ing' THEN 'ing' WHEN truth LIKE '%en' THEN 'en' WHEN truth LIKE '%er' THEN 'er' WHEN truth LIKE '%n' THEN 'n' END AS ending_pattern FROM pairs),
    u1 AS (SELECT *, CASE WHEN s0 <> 'OK' THEN s0 WHEN ends_with(heard, ending_pattern) THEN 'OK' WHEN right(truth, 4) = right(heard, 4) THEN 'OK_TAIL_MATCH' ELSE 'TRUNCATED' END AS status FROM u0 WHERE length(truth) >= 6 AND ending_pattern IS NOT NULL),
    ended AS (SELECT *, CASE WHEN status = 'TRUNCATED' THEN coalesce(list_filter(range(1, least(length(ending_pattern) + 5, length(truth) - 1) + 1), lambda c: ends_with(heard, right(left(truth, length(truth) - c), 6)))[1], 0) ELSE 0 END AS missing_chars FROM u1)"""


@register("truncation_detect", "filename string, ending_pattern string, status string, missing_chars long", f"WITH {ENDED} FINAL SELECT filename, ending_pattern, status, missing_chars FROM ended")
def truncation_detect(s, d):
    """C7, F10, Y10, Y11, F4."""
    return endings(s, d)


@register("ending_histogram", "ending_pattern string, n long", f"WITH {ENDED} FINAL SELECT ending_pattern, count(*) AS n FROM ended GROUP BY 1")
def ending_histogram(s, d):
    """G13."""
    return Q.pattern_histogram(endings(s, d))


@register("truncation_rate", "checked long, truncated long, rate string", f"WITH {ENDED}, c AS (SELECT count_if(status <> 'FILE_NOT_FOUND') AS checked, count_if(status = 'TRUNCATED') AS truncated FROM ended) FINAL SELECT *, CASE WHEN checked > 0 THEN printf('%.1f', 100.0::DOUBLE * truncated / checked) || '%' ELSE 'N/A' END AS rate FROM c")
def truncation_rate(s, d):
    """G14."""
    return Q.truncation_rate(endings(s, d))


@register("truncation_recount", "ending_pattern string, n long, truncated long", f"WITH {ENDED} FINAL SELECT ending_pattern, count(*) AS n, count_if(NOT ends_with(heard, ending_pattern)) AS truncated FROM u0 WHERE s0 = 'OK' AND ending_pattern IS NOT NULL GROUP BY 1")
def truncation_recount(s, d):
    """C7b."""
    t = pairs(s, d).select("truth", F.when(F.col("line_no") % 17 != 0, F.when(F.col("line_no") % 3 == 0, F.substring("truth", F.lit(1), F.greatest(F.length("truth") - F.col("line_no") % 5, F.lit(0)).cast("int"))).otherwise(F.col("truth"))).alias("heard"))
    return Q.recount(t, ENDINGS)


SPOKEN_ENDINGS = [*FORMAL_ENDINGS_LONGEST_FIRST, "입니다", "했어요", ""]
LISTED = "[" + ", ".join(f"'{e}'" for e in SPOKEN_ENDINGS) + "]"
KOREAN = f"k0 AS (SELECT doc_id, coalesce(text, '') || ' 안녕 ' || substr('가각한글 ㄱㅏ', 1 + doc_id % 5, 3) || {LISTED}[1 + doc_id % {len(SPOKEN_ENDINGS)}] AS text FROM documents)"


def korean(s, d):
    """Every document with Korean at its end: syllables, single letters and each listed ending in turn, among them
    two that are no formal ending and none at all."""
    pick = F.get(F.array(*map(F.lit, SPOKEN_ENDINGS)), (F.col("doc_id") % len(SPOKEN_ENDINGS)).cast("int"))
    middle = F.substring(F.lit("가각한글 ㄱㅏ"), (1 + F.col("doc_id") % 5).cast("int"), F.lit(3))
    return table(s, d, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit(" 안녕 "), middle, pick).alias("text"))


def first_ending(endings):
    """SQL for the first of ``endings`` that ``text`` ends with."""
    return "list_filter([" + ", ".join(f"'{e}'" for e in endings) + "], lambda e: ends_with(text, e))[1]"


@register("korean_endings", "doc_id long, ending string", f"FINAL SELECT doc_id, {first_ending(FORMAL_ENDINGS_RECOUNT)} AS ending FROM documents")
def korean_endings(s, d):
    """F10 with the fixed endings: every document's own text."""
    return table(s, d, "documents").select("doc_id", X.first_suffix(F.col("text"), FORMAL_ENDINGS_RECOUNT).alias("ending"))


@register("korean_endings_planted", "doc_id long, longest string, detected string, counted string", f"WITH {KOREAN} FINAL SELECT doc_id, {first_ending(FORMAL_ENDINGS_LONGEST_FIRST)} AS longest, {first_ending(FORMAL_ENDINGS_DETECTOR)} AS detected, {first_ending(FORMAL_ENDINGS_RECOUNT)} AS counted FROM k0")
def korean_endings_planted(s, d):
    """F10 with the fixed endings in their three orders, on Korean texts."""
    t = F.col("text")
    return korean(s, d).select("doc_id", X.first_suffix(t).alias("longest"), X.first_suffix(t, FORMAL_ENDINGS_DETECTOR).alias("detected"), X.first_suffix(t, FORMAL_ENDINGS_RECOUNT).alias("counted"))


@register(
    "korean_normalize", "doc_id long, n1 string, n2 string, n3 string, n4 string, n1_apart string",
    rf"""WITH {KOREAN}, n AS (SELECT doc_id, text, replace(replace(text, '한', chr(4370) || chr(4449) || chr(4523)), '니', chr(4354) || chr(4469)) AS apart FROM k0)
    FINAL SELECT doc_id, regexp_replace(text, '[^가-힣a-zA-Z0-9]', '', 'g') AS n1, lower(regexp_replace(nfc_normalize(apart), '[^가-힣a-zA-Z0-9]', '', 'g')) AS n2, regexp_replace(nfc_normalize(apart), '[^가-힣a-zA-Z0-9]', '', 'g') AS n3,
    trim(regexp_replace(regexp_replace(text, '[^\p{{L}}\p{{N}}_\s가-힣ㄱ-ㅎㅏ-ㅣ]', '', 'g'), '\s+', ' ', 'g')) AS n4, regexp_replace(apart, '[^가-힣a-zA-Z0-9]', '', 'g') AS n1_apart FROM n""",
)
def korean_normalize(s, d):
    """N1-N4 on Korean, whole and taken apart into conjoining letters: N1 loses those, N2 and N3 compose them first."""
    apart = F.replace(F.replace(F.col("text"), F.lit("한"), F.lit("\u1112\u1161\u11ab")), F.lit("니"), F.lit("\u1102\u1175"))
    t = korean(s, d).withColumn("apart", apart)
    return X0.spread(t).select("doc_id", X.letters_only(F.col("text")).alias("n1"), X.eval_text(F.col("apart")).alias("n2"), X.detector_text(F.col("apart")).alias("n3"), X.spoken_text(F.col("text")).alias("n4"), X.letters_only(F.col("apart")).alias("n1_apart"))


# -- gaps, runs, signals ----------------------------------------------------------------


@register(
    "gap_padding", "conv_id long, turn long, left_pad long, right_pad long, start_ms long, end_ms long, flat_start long, flat_end long",
    f"""WITH {TURNS}, g AS (SELECT *, start_ms - lag(end_ms) OVER w AS lg, lead(start_ms) OVER w - end_ms AS rg, max(end_ms) OVER (PARTITION BY conv_id) AS len FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
    p AS (SELECT *, CASE WHEN lg IS NULL OR lg >= 30 THEN 50 ELSE 0 END AS left_pad, CASE WHEN rg IS NULL THEN 400 WHEN ends_with(text, 's.') THEN 650 WHEN rg < 30 THEN 0 ELSE least(400, greatest(0, rg - 20)) END AS right_pad FROM g)
    FINAL SELECT conv_id, turn, left_pad, right_pad, greatest(start_ms - left_pad, 0) AS start_ms, least(end_ms + right_pad, len) AS end_ms, greatest(start_ms - 50, 0) AS flat_start, least(end_ms + 50, len) AS flat_end FROM p""",
)
def gap_padding(s, d):
    """W6, W7, W7b."""
    t = W.gaps(turns(s, d), "conv_id", "turn").withColumn("len", F.max("end_ms").over(Window.partitionBy("conv_id")))
    t = t.withColumns({"left_pad": W.left_pad(F.col("left_gap")), "right_pad": W.right_pad(F.col("right_gap"), F.col("text").endswith("s."))})
    a, b = W.clamped(F.col("start_ms"), F.col("end_ms"), F.col("len"), F.col("left_pad"), F.col("right_pad"))
    fa, fb = W.clamped(F.col("start_ms"), F.col("end_ms"), F.col("len"))
    return t.select("conv_id", "turn", "left_pad", "right_pad", a.alias("start_ms"), b.alias("end_ms"), fa.alias("flat_start"), fb.alias("flat_end"))


@register("gap_padding_variants", "conv_id long, turn long, p500 long, p50 long", f"""WITH {TURNS}, g AS (SELECT *, lead(start_ms) OVER (PARTITION BY conv_id ORDER BY turn) - end_ms AS rg FROM turns)
    FINAL SELECT conv_id, turn, CASE WHEN rg IS NULL THEN 400 WHEN ends_with(text, 's.') THEN 500 WHEN rg < 30 THEN 0 ELSE least(400, greatest(0, rg - 20)) END AS p500, CASE WHEN rg IS NULL THEN 400 WHEN rg < 30 THEN 50 ELSE greatest(50, least(400, greatest(0, rg - 20))) END AS p50 FROM g""")
def gap_padding_variants(s, d):
    """W7c."""
    t = W.gaps(turns(s, d), "conv_id", "turn")
    return t.select("conv_id", "turn", W.right_pad(F.col("right_gap"), F.col("text").endswith("s."), 500).alias("p500"), W.right_pad(F.col("right_gap"), F.lit(False), least=50).alias("p50"))


MATCHED = LINES + ", matched AS (SELECT doc_id, line_no FROM lines WHERE (doc_id + line_no) % 3 = 0)"


@register("skipped_ranges", "doc_id long, line_no long, tail boolean", f"""WITH {MATCHED}, x AS (SELECT doc_id, line_no, coalesce(lag(line_no) OVER (PARTITION BY doc_id ORDER BY line_no), 0) AS p FROM matched), t AS (SELECT l.doc_id, max(l.line_no) AS n, max(m.line_no) AS z FROM lines l LEFT JOIN matched m USING (doc_id, line_no) GROUP BY 1)
    FINAL SELECT doc_id, unnest(range(p + 1, line_no)) AS line_no, false AS tail FROM x UNION ALL SELECT doc_id, unnest(range(coalesce(z, 0) + 1, n + 1)), true FROM t""")
def skipped_ranges(s, d):
    """W9, W10."""
    t = lines(s, d).select("doc_id", "line_no")
    m = t.where((F.col("doc_id") + F.col("line_no")) % 3 == 0)
    bounds = t.groupBy("doc_id").agg(F.min("line_no").alias("min_line"), F.max("line_no").alias("max_line"))
    return W.skipped_lines(m, "doc_id").withColumn("tail", F.lit(False)).unionByName(W.tail_lines(m, bounds, "doc_id").withColumn("tail", F.lit(True)))


@register("rms_windows", "vec_id long, win long, db double", f"WITH {CLIPS} FINAL SELECT vec_id, win, db FROM windows")
def rms_windows(s, d):
    """D1."""
    return clips(s, d).select("vec_id", F.posexplode(S.rms_windows(F.col("samples"), 8)).alias("win", "db"))


@register("onset_offset", "vec_id long, onset long, finish long", f"WITH {CLIPS} FINAL SELECT vec_id, coalesce(min(CASE WHEN db >= -17 THEN win END) * 8, 0) AS onset, coalesce((max(CASE WHEN db >= -17 THEN win END) + 1) * 8, 64) AS finish FROM windows GROUP BY vec_id")
def onset_offset(s, d):
    """D2, T1."""
    a, b = S.voice_span(S.rms_windows(F.col("samples"), 8), F.size("samples"), 8, -17.0)
    return clips(s, d).select("vec_id", a.alias("onset"), b.alias("finish"))


@register("boundary_r2", "vec_id long, first_db double, last_db double, passed boolean", f"""WITH {CLIPS}, e AS (SELECT vec_id, 20 * log10(greatest(sqrt(avg(CASE WHEN i < 4 THEN x * x END)), 1e-10)) AS first_db, 20 * log10(greatest(sqrt(avg(CASE WHEN i >= 60 THEN x * x END)), 1e-10)) AS last_db FROM samples GROUP BY vec_id)
    FINAL SELECT *, first_db < -40 AND last_db < -40 AS passed FROM e""")
def boundary_r2(s, d):
    """D3."""
    a, b, ok = S.edge_levels(F.col("samples"), 4)
    return clips(s, d).select("vec_id", a.alias("first_db"), b.alias("last_db"), ok.alias("passed"))


@register("envelope_r6", "vec_id long, before_ms double, after_ms double, passed boolean", f"""WITH {CLIPS}, e AS (SELECT vec_id, min(CASE WHEN db >= -17 THEN win END) AS a, max(CASE WHEN db >= -17 THEN win END) AS b FROM windows GROUP BY vec_id)
    FINAL SELECT vec_id, coalesce(a * 10.0, 80.0) AS before_ms, coalesce(80 - (b + 1) * 10.0, 80.0) AS after_ms, a IS NULL OR (a * 10.0 >= 10 AND 80 - (b + 1) * 10.0 >= 20) AS passed FROM e""")
def envelope_r6(s, d):
    """D4 at the clips' small scale: windows of 10 ms, tolerances of 10 and 20 ms."""
    a, b, ok = S.envelope(S.rms_windows(F.col("samples"), 8), F.lit(80.0), 10.0, -17.0, (10, 20))
    return clips(s, d).select("vec_id", a.alias("before_ms"), b.alias("after_ms"), ok.alias("passed"))


@register("zero_crossing", "vec_id long, place long", f"""WITH {CLIPS}, z AS (SELECT vec_id, i, x >= 0 AS p, lead(x >= 0) OVER (PARTITION BY vec_id ORDER BY i) AS q FROM samples), c AS (SELECT vec_id, i, abs(i - 32) AS dist FROM z WHERE i BETWEEN 22 AND 40 AND p <> q)
    FINAL SELECT v.vec_id, coalesce(arg_min(i, dist * 100 + i), 32) AS place FROM clips v LEFT JOIN c USING (vec_id) GROUP BY v.vec_id""")
def zero_crossing(s, d):
    """D5."""
    return clips(s, d).select("vec_id", S.zero_crossing(F.col("samples"), 32, 10).alias("place"))


@register("faded_samples", "vec_id long, i long, x double", f"WITH {CLIPS} FINAL SELECT vec_id, i, x * CASE WHEN i < 10 THEN 0.5 * (1 - cos(pi() * i / 10)) ELSE 1 END * CASE WHEN i >= 59 THEN 0.5 * (1 - cos(pi() * (63 - i) / 5)) ELSE 1 END + 0.0 AS x FROM samples")
def faded_samples(s, d):
    """D6."""
    return clips(s, d).select("vec_id", F.posexplode(S.fade(F.col("samples"), 10, 5)).alias("i", "x"))


@register("linear_faded_samples", "vec_id long, i long, x double", f"WITH {CLIPS} FINAL SELECT vec_id, i, x * CASE WHEN i < 10 THEN i / 10.0 ELSE 1 END * CASE WHEN i >= 59 THEN (63 - i) / 5.0 ELSE 1 END + 0.0 AS x FROM samples")
def linear_faded_samples(s, d):
    """D11."""
    return clips(s, d).select("vec_id", F.posexplode(S.fade(F.col("samples"), 10, 5, linear=True)).alias("i", "x"))


@register("peak_normalised", "vec_id long, i long, x double", f"WITH {CLIPS}, p AS (SELECT vec_id, max(abs(x)) AS m FROM samples GROUP BY vec_id) FINAL SELECT vec_id, i, CASE WHEN m > 0 THEN x * pow(10, -0.05) / m ELSE x END AS x FROM samples JOIN p USING (vec_id)")
def peak_normalised(s, d):
    """D7."""
    return clips(s, d).select("vec_id", F.posexplode(S.peak_normalised(F.col("samples"))).alias("i", "x"))


@register("trimmed_spans", "vec_id long, n long, total double", f"""WITH {CLIPS}, o AS (SELECT vec_id, coalesce(min(CASE WHEN db >= -17 THEN win END) * 8, 0) AS a, coalesce((max(CASE WHEN db >= -17 THEN win END) + 1) * 8, 64) AS b FROM windows GROUP BY vec_id)
    FINAL SELECT vec_id, count(*) AS n, sum(x) AS total FROM samples JOIN o USING (vec_id) WHERE i >= greatest(a - 2, 0) AND i < least(b + 6, 64) GROUP BY vec_id""")
def trimmed_spans(s, d):
    """D8."""
    t = clips(s, d)
    a, b = S.voice_span(S.rms_windows(F.col("samples"), 8), F.size("samples"), 8, -17.0)
    t = t.withColumn("t", S.trimmed(F.col("samples"), a, b, 2, 6))
    return t.select("vec_id", F.size("t").alias("n"), F.aggregate("t", F.lit(0.0), lambda x, y: x + y).alias("total"))


@register("padded_envelope", "vec_id long, n long, edge double, total double", f"WITH {CLIPS} FINAL SELECT vec_id, count(*) + 30 AS n, 0.0 AS edge, sum(greatest(-1.0, least(1.0, 4 * x))) AS total FROM samples GROUP BY vec_id")
def padded_envelope(s, d):
    """D9."""
    t = clips(s, d).withColumn("p", S.padded(F.transform("samples", lambda x: 4 * x), 10, 20))
    return t.select("vec_id", F.size("p").alias("n"), (F.abs(F.get("p", 9)) + F.abs(F.element_at("p", -20))).alias("edge"), F.aggregate("p", F.lit(0.0), lambda x, y: x + y).alias("total"))


@register("scalar_level", "vec_id long, db double", f"WITH {CLIPS} FINAL SELECT vec_id, CASE WHEN avg(x * x) = 0 THEN -100 ELSE 20 * log10(sqrt(avg(x * x)) / 32768) END AS db FROM samples GROUP BY vec_id")
def scalar_level(s, d):
    """D12."""
    return clips(s, d).select("vec_id", S.scalar_db(F.col("samples")).alias("db"))


@register("stripped_envelope", "vec_id long, n long, total double", f"WITH {CLIPS} FINAL SELECT vec_id, count(*) AS n, sum(x) AS total FROM samples WHERE i >= 8 AND i < 48 GROUP BY vec_id")
def stripped_envelope(s, d):
    """D16."""
    t = clips(s, d).withColumn("t", S.stripped(F.col("samples"), 8, 16, 20))
    return t.select("vec_id", F.size("t").alias("n"), F.aggregate("t", F.lit(0.0), lambda x, y: x + y).alias("total"))


@register("resampled", "vec_id long, i long, x double", f"WITH {CLIPS} FINAL SELECT c.vec_id, k AS i, c.samples[trunc(k * (63 / 15.0::DOUBLE))::INT + 1] AS x FROM clips c, (SELECT unnest(range(16)) AS k)")
def resampled(s, d):
    """S5c."""
    return clips(s, d).select("vec_id", F.posexplode(S.resampled(F.col("samples"), F.lit(16))).alias("i", "x"))


@register("post_processed", "vec_id long, n long, peak double")
def post_processed(s, d):
    """D10 at a rate of 800, so that a window is the clips' eight samples."""
    t = S.processed(clips(s, d), "samples", "p", 800, -17.0, (3, 8), (40, 73))
    return t.select("vec_id", F.size("p").alias("n"), F.array_max(F.transform("p", F.abs)).alias("peak"))


@register("series_windows", "user_id long, win_idx long, rms_db double", f"WITH {SERIES} FINAL SELECT * FROM swin")
def series_windows(s, d):
    """D1 on a long series, by rows."""
    return W.series_windows(series(s, d), "user_id", "i", "value", 4)


def split(s, d):
    return W.silence_split(W.series_windows(series(s, d), "user_id", "i", "value", 4), "user_id", -26.0, 2, 1, 3)


@register(
    "silence_split", "user_id long, start_win long, end_win long, name string",
    f"""WITH {SERIES}, f AS (SELECT *, rms_db < -26 AS q FROM swin), g AS (SELECT *, sum(CASE WHEN q IS DISTINCT FROM pq THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY win_idx) AS run FROM (SELECT *, lag(q) OVER (PARTITION BY user_id ORDER BY win_idx) AS pq FROM f)),
    r AS (SELECT user_id, run, min(win_idx) AS a, max(win_idx) AS b, count(*) AS n, bool_and(q) AS q FROM g GROUP BY ALL), c AS (SELECT *, q AND n >= 2 AS cut FROM r), p AS (SELECT *, sum(cut::INT) OVER (PARTITION BY user_id ORDER BY a) AS piece FROM c),
    k AS (SELECT user_id, piece, min(a) AS a, max(b) AS b FROM p WHERE NOT cut GROUP BY ALL), e AS (SELECT user_id, max(win_idx) AS z FROM swin GROUP BY 1),
    o AS (SELECT user_id, greatest(a - 1, 0) AS start_win, least(b + 1, z) AS end_win FROM k JOIN e USING (user_id))
    FINAL SELECT *, printf('%05d', row_number() OVER (ORDER BY user_id, start_win)) AS name FROM o WHERE end_win - start_win + 1 >= 3""",
)
def silence_split(s, d):
    """D13."""
    return W.clip_numbers(split(s, d), "user_id")


@register("coarse_profile", "user_id long, block long, mean_db double, silent boolean", f"WITH {SERIES} FINAL SELECT user_id, win_idx // 5 AS block, avg(rms_db) AS mean_db, avg(rms_db) < -26 AS silent FROM swin GROUP BY ALL")
def coarse_profile(s, d):
    """D17."""
    return W.coarse_profile(W.series_windows(series(s, d), "user_id", "i", "value", 4), "user_id", 5, -26.0)


@register("energy_valleys", "user_id long, first long, last long")
def energy_valleys(s, d):
    """The running maximum restarts, which a window function can't express."""
    return W.energy_valleys(W.series_windows(series(s, d), "user_id", "i", "value", 1), "user_id", 0.4, 15.0, 3)


@register("safety_sweep", "vec_id long, safety_ms long, n long", f"""WITH {CLIPS}, o AS (SELECT vec_id, coalesce((max(CASE WHEN db >= -17 THEN win END) + 1) * 8, 64) AS b FROM windows GROUP BY vec_id)
    FINAL SELECT vec_id, k AS safety_ms, least(b + k // 10, 64) AS n FROM o, (SELECT unnest([0, 20, 40, 60, 80]) AS k)""")
def safety_sweep(s, d):
    """D15."""
    _, b = S.voice_span(S.rms_windows(F.col("samples"), 8), F.size("samples"), 8, -17.0)
    t = W.safety_sweep(clips(s, d).select("vec_id", b.alias("b")), [0, 20, 40, 60, 80])
    return t.select("vec_id", "safety_ms", F.least(F.col("b") + F.floor(F.col("safety_ms") / 10), F.lit(64)).alias("n"))


@register("shift_classes", "shift string, n long", f"WITH {TURNS}, c AS (SELECT CASE WHEN ms % 200 - 100 > 50 THEN 'later' WHEN ms % 200 - 100 < -50 THEN 'earlier' ELSE 'similar' END AS shift FROM turns) FINAL SELECT shift, count(*) AS n FROM c GROUP BY 1")
def shift_classes(s, d):
    """D18."""
    c = W.shift_class(F.col("start_ms"), F.col("start_ms") + F.col("ms") % 200 - 100)
    return turns(s, d).groupBy(c.alias("shift")).agg(F.count(F.lit(1)).alias("n"))


@register("durations", "files long, total_s double, mean_s double, kept_files long, kept_s double, kept_pct double", f"WITH {TURNS}, k AS (SELECT ms / 1000.0::DOUBLE AS s, ms BETWEEN 300 AND 15000 AS kept FROM turns) FINAL SELECT count(*) AS files, sum(s) AS total_s, avg(s) AS mean_s, count_if(kept) AS kept_files, sum(s) FILTER (kept) AS kept_s, round(100.0::DOUBLE * sum(s) FILTER (kept) / sum(s), 2) AS kept_pct FROM k")
def durations(s, d):
    """G18, Z7, F11."""
    return R.durations(turns(s, d).withColumn("s", F.col("ms") / 1000), "s", F.col("ms").between(300, 15_000))


@register("duration_bounds", "conv_id long, turn long, ms long", f"WITH {TURNS} FINAL SELECT conv_id, turn, ms FROM turns WHERE ms BETWEEN 300 AND 15000")
def duration_bounds(s, d):
    """Z7."""
    return Z.duration_bounds(turns(s, d), "ms")


@register("cascade_runs", "doc_id long, first long, last long, n long", f"""WITH {LINES}, f AS (SELECT doc_id, line_no, line_no % 7 < 4 AS q FROM lines), g AS (SELECT *, sum(CASE WHEN q IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS run FROM (SELECT *, lag(q) OVER (PARTITION BY doc_id ORDER BY line_no) AS p FROM f))
    FINAL SELECT doc_id, min(line_no) AS first, max(line_no) AS last, count(*) AS n FROM g WHERE q GROUP BY doc_id, run HAVING count(*) >= 3""")
def cascade_runs(s, d):
    """Z2."""
    t = lines(s, d).withColumn("score", F.when(F.col("line_no") % 7 < 4, 0.0).otherwise(1.0))
    return Z.cascades(t, "doc_id", "line_no", "score")


SPLIT = LINES + r""", z0 AS (SELECT doc_id, line_no, regexp_replace(text, '[^가-힣a-zA-Z0-9]', '', 'g') AS whole FROM lines),
    z1 AS (SELECT doc_id, line_no * 2 AS k, whole AS expected, left(whole, length(whole) // 2) AS heard, 0.5 AS score FROM z0 UNION ALL SELECT doc_id, line_no * 2 + 1, '', substr(whole, length(whole) // 2 + 1), 0.0 FROM z0)"""


@register("split_lines", "doc_id long, k long, n_pieces long", f"""WITH {SPLIT}, n AS (SELECT *, coalesce(lead(heard) OVER w, '') AS h1, coalesce(lead(heard, 2) OVER w, '') AS h2, substr(expected, length(heard) + 1) AS rest FROM z1 WINDOW w AS (PARTITION BY doc_id ORDER BY k))
    FINAL SELECT doc_id, k, CASE WHEN h1 = rest THEN 2 ELSE 3 END AS n_pieces FROM n WHERE length(heard) > 0 AND length(heard) < length(expected) AND starts_with(expected, heard) AND (h1 = rest OR h1 || h2 = rest)""")
def split_lines(s, d):
    """Each line as heard in two halves."""
    whole = X.letters_only(F.col("text"))
    t = lines(s, d).select("doc_id", "line_no", whole.alias("w")).withColumn("half", F.floor(F.length("w") / 2).cast("int"))
    a = t.select("doc_id", (F.col("line_no") * 2).alias("k"), F.col("w").alias("expected"), F.left("w", F.col("half")).alias("heard"), F.lit(0.5).alias("score"))
    b = t.select("doc_id", (F.col("line_no") * 2 + 1).alias("k"), F.lit("").alias("expected"), F.substring("w", F.col("half") + 1, F.length("w")).alias("heard"), F.lit(0.0).alias("score"))
    return Z.split_lines(a.unionByName(b), "doc_id", "k")


# -- alignment --------------------------------------------------------------------------


def _align(s, d, config):
    segments = X0.heard_segments(s, d)
    t = lines(s, d).select(F.col("doc_id").cast("int").alias("script_id"), "line_no", F.lower("text").alias("text"))
    return A.align(segments, t, recordings(s, d), config)


ALIGNED = "script_id long, kind string, file_idx long, seg_idx long, merged long, line_no long, score double, reason string"


@register("align_greedy", ALIGNED)
def align_greedy(s, d):
    """J1."""
    return _align(s, d, A.AlignConfig())


@register("align_manager", ALIGNED)
def align_manager(s, d):
    """J2."""
    return _align(s, d, A.AlignConfig.manager())


@register("align_experiment", ALIGNED)
def align_experiment(s, d):
    """J1b."""
    return _align(s, d, A.AlignConfig.experiment())


@register("align_line_major", ALIGNED)
def align_line_major(s, d):
    """J3."""
    t = lines(s, d).select(F.col("doc_id").cast("int").alias("script_id"), "line_no", F.lower("text").alias("text"))
    return A.align_by_line(X0.heard_segments(s, d), t, recordings(s, d))


SPANS = "script_id long, kind string, file_idx long, seg_idx long, merged long, line_no long, score double, reason string, start_ms long, end_ms long"
MATCHED = """SELECT script_id, 'match' AS kind, file_idx, line_no AS seg_idx, 1 AS merged, line_no, ratio - 0.01 * {jumped} AS score, NULL AS reason, {start} AS start_ms, {end} AS end_ms FROM x5 {where}"""
SKIPPED = " UNION ALL SELECT script_id, 'skip', (SELECT min(file_idx) FROM x3 WHERE x3.script_id = m.script_id AND x3.line_no > m.line_no), NULL, NULL, line_no, NULL, 'SKIPPED', NULL, NULL FROM missed m WHERE line_no < top"


@register(
    "align_exact", SPANS, f"WITH {EXACT.replace('{pad}', '650')} FINAL " + MATCHED.format(jumped="jumped", start="greatest(0, a - left_pad)", end="least(2500 * n + 2000, b + right_pad)", where="") + SKIPPED
    + " UNION ALL SELECT script_id, 'skip', NULL, NULL, NULL, line_no, NULL, 'EOF_UNMATCHED', NULL, NULL FROM missed WHERE line_no > top AND line_no <= CASE WHEN n > half THEN last ELSE half END",
)
def align_exact(s, d):
    """J1 with spans (W8, W6, W7) where the alignment is certain: matches, skips and the tail."""
    return A.align(*X0.exact_scripts(s, d))


@register("align_exact_manager", SPANS, f"WITH {EXACT.replace('{pad}', '650')} FINAL " + MATCHED.format(jumped="jumped", start="greatest(0, seg_a - 50)", end="least(2500 * n + 2000, b + 50)", where="") + SKIPPED)
def align_exact_manager(s, d):
    """J2 with flat padding (W7b), no tail rows."""
    return A.align(*X0.exact_scripts(s, d), A.AlignConfig.manager())


@register(
    "align_exact_experiment", SPANS, f"""WITH {EXACT.replace('{pad}', '500')}, j AS (SELECT * REPLACE (line_no - coalesce(lag(line_no) OVER (PARTITION BY script_id, file_idx ORDER BY line_no) + 1, CASE WHEN file_idx = 0 THEN 1 ELSE half + 1 END) AS jumped) FROM x5), k AS (SELECT * FROM j WHERE line_no - jumped <= CASE WHEN file_idx = 0 THEN half ELSE last END) FINAL """
    + MATCHED.format(jumped="jumped", start="greatest(0, a - left_pad)", end="least(2500 * n + 2000, b + right_pad)", where="").replace("FROM x5", "FROM k"),
)
def align_exact_experiment(s, d):
    """Recordings for themselves, up to their last line; matches only."""
    return A.align(*X0.exact_scripts(s, d), A.AlignConfig.experiment())


@register("align_exact_rollup", "script_id long, matched long, skipped long, rate double", f"""WITH {EXACT.replace('{pad}', '650')}, r AS (SELECT script_id, 1 AS hit FROM x3 UNION ALL SELECT script_id, 0 FROM missed WHERE line_no < top OR line_no <= CASE WHEN n > half THEN last ELSE half END)
    FINAL SELECT script_id, sum(hit) AS matched, count(*) - sum(hit) AS skipped, round(100.0::DOUBLE * sum(hit) / count(*), 2) AS rate FROM r GROUP BY ROLLUP (script_id)""")
def align_exact_rollup(s, d):
    """G8 over J1."""
    return R.alignment_rollup(A.align(*X0.exact_scripts(s, d)), "script_id")


@register("align_exact_resumed", "script_id long, kind string, line_no long, reason string", f"""WITH {EXACT.replace('{pad}', '650')} FINAL SELECT script_id, 'match' AS kind, line_no, NULL AS reason FROM x3 WHERE file_idx = 1 UNION ALL
    SELECT script_id, 'skip', line_no, CASE WHEN line_no < top THEN 'SKIPPED' ELSE 'EOF_UNMATCHED' END FROM missed m WHERE line_no > coalesce((SELECT max(line_no) FROM x3 WHERE x3.script_id = m.script_id AND x3.file_idx = 0), 0) AND line_no <= CASE WHEN line_no < top THEN n WHEN n > half THEN last ELSE half END""")
def align_exact_resumed(s, d):
    """What a run does that goes on after the first recording of every script."""
    segments, t, files = X0.exact_scripts(s, d)
    first = A.align(segments, t, files.where("file_idx = 0"), A.AlignConfig(checkpoints=True)).where("kind = 'checkpoint'")
    return A.align(segments, t, files, resume=first)


MATCHES = LINES + ", m AS (SELECT doc_id AS script_id, line_no, CASE WHEN (doc_id + line_no) % 4 = 0 THEN 'skip' ELSE 'match' END AS kind, CASE WHEN line_no % 2 = 0 THEN 'SKIPPED' ELSE 'NO_MATCH' END AS reason, source AS audio_file FROM lines)"


def match_rows(s, d):
    t = lines(s, d)
    return t.select(F.col("doc_id").alias("script_id"), "line_no", "text", F.when((F.col("doc_id") + F.col("line_no")) % 4 == 0, "skip").otherwise("match").alias("kind"), F.when(F.col("line_no") % 2 == 0, "SKIPPED").otherwise("NO_MATCH").alias("reason"), F.col("source").alias("audio_file"))


@register("alignment_rollup", "audio_file string, matched long, skipped long, rate double", f"WITH {MATCHES} FINAL SELECT audio_file, count_if(kind = 'match') AS matched, count_if(kind <> 'match') AS skipped, round(100.0::DOUBLE * count_if(kind = 'match') / count(*), 2) AS rate FROM m GROUP BY ROLLUP (audio_file)")
def alignment_rollup(s, d):
    """G8."""
    return R.alignment_rollup(match_rows(s, d), "audio_file")


@register("skip_report", "audio_file string, reason string, n long", f"WITH {MATCHES} FINAL SELECT audio_file, reason, count(*) AS n FROM m WHERE kind = 'skip' GROUP BY ROLLUP (audio_file, reason)")
def skip_report(s, d):
    """G17b."""
    return R.skip_report(match_rows(s, d))


@register("missed_lines", "script_id long, line_no long, reason string", f"WITH {MATCHES} FINAL SELECT script_id, line_no, reason FROM m WHERE kind = 'skip'")
def missed_lines(s, d):
    """G17, K8."""
    return R.missed_lines(match_rows(s, d))


@register("refine_words", "conv_id long, turn long, start double, finish double")
def refine_words(s, d):
    """A turn's words with one foreign word at each end."""
    ws = F.split(F.concat(F.lit("xqz "), X.spoken_text(F.col("text")), F.lit(" zqx")), " ")
    t = table(s, d, "conversations").withColumn("words", F.transform(ws, lambda w, i: F.struct(w.alias("word"), (i * 0.5).cast("double").alias("start"), (i * 0.5 + 0.4).cast("double").alias("end"))))
    return X0.spread(t).select("conv_id", "turn", A.refined_span("words", "text").alias("r")).select("conv_id", "turn", "r.start", F.col("r.end").alias("finish"))


RECOVER = r"""WITH k AS (SELECT conv_id, turn, lower(regexp_replace(text, '[^a-zA-Z0-9]', '', 'g')) AS norm FROM conversations),
    q AS (SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 19 = 0 THEN left(norm, 1) WHEN (conv_id + turn) % 23 = 0 THEN repeat('#q', 60) WHEN (conv_id + turn) % 5 = 0 THEN regexp_replace(norm, '(.{6}).', '\1', 'g') ELSE norm END AS h0 FROM k),
    h AS (SELECT conv_id, turn, regexp_replace(h0, '[^a-zA-Z0-9]', '', 'g') AS heard FROM q),
    j AS (SELECT a.conv_id, a.turn, b.turn AS line_no, 1 - levenshtein(a.heard, b.norm)::DOUBLE / greatest(length(a.heard), length(b.norm), 1) + CASE WHEN b.turn = a.turn + 1 THEN 0.05 ELSE 0 END AS score
    FROM h a JOIN k b ON a.conv_id = b.conv_id AND abs(b.turn - (a.turn + 1)) <= 10 AND length(b.norm) >= 2 AND length(a.heard) >= 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY round(score, 9) DESC, line_no) AS k FROM j WHERE score >= 0.2)"""


def missed_clips(s, d):
    """Turns that look for their text one turn on: some heard in part, some not at all, some as noise."""
    t = table(s, d, "conversations").select("conv_id", "turn", F.lower(F.regexp_replace("text", "[^a-zA-Z0-9]", "")).alias("text"))
    n = F.col("conv_id") + F.col("turn")
    heard = F.when(n % 19 == 0, F.left("text", F.lit(1))).when(n % 23 == 0, F.repeat(F.lit("#q"), F.lit(60))).when(n % 5 == 0, F.regexp_replace("text", "(.{6}).", "$1")).otherwise(F.col("text"))
    asked = t.select(F.col("conv_id").alias("script_id"), F.col("turn").cast("string").alias("filename"), (F.col("turn") + 1).alias("expected"), heard.alias("heard"))
    return asked, t.select(F.col("conv_id").alias("script_id"), F.col("turn").alias("line_no"), "text")


@register(
    "recovery_match_cer", "conv_id long, turn long, line_no long, score double, outcome string",
    RECOVER + """ FINAL SELECT h.conv_id, h.turn, line_no, score, CASE WHEN NOT EXISTS (FROM k WHERE k.conv_id = h.conv_id) THEN 'NO_SCRIPT' WHEN length(heard) < 2 THEN 'TOO_SHORT' WHEN line_no IS NULL THEN 'NO_MATCH' ELSE 'MATCH' END AS outcome FROM h LEFT JOIN (SELECT * FROM r WHERE k = 1) x ON x.conv_id = h.conv_id AND x.turn = h.turn""",
)
def recovery_match_cer(s, d):
    """J4, Y6, scored by edit distance."""
    rated = lambda rows: with_edit_score(rows, "line_norm", "heard_norm", "least").withColumn("score", F.round("score", 9))
    found = A.recover(*missed_clips(s, d), rated, edit_ceiling)
    return found.select(F.col("script_id").alias("conv_id"), F.col("filename").alias("turn"), "line_no", "score", "outcome")


@register("recovery_match_ratio", "conv_id long, turn long, line_no long, score double, outcome string")
def recovery_match_ratio(s, d):
    """J4 with the block ratio."""
    found = A.recover(*missed_clips(s, d), lambda rows: rows.withColumn("score", ratio("heard_norm", "line_norm")), ratio_ceiling)
    return found.select(F.col("script_id").alias("conv_id"), F.col("filename").alias("turn"), "line_no", "score", "outcome")


@register("best_match_exhaustive", "item_id long, doc_id long, line_no long, score double", f"""WITH {LINES}, q AS (SELECT item_id, list_distinct(string_split(lower(text), ' ')) AS w FROM benchmark), t AS (SELECT doc_id, line_no, list_distinct(string_split(lower(text), ' ')) AS v FROM lines),
    r AS (SELECT item_id, doc_id, line_no, len(list_intersect(w, v))::DOUBLE / len(w) AS score FROM q, t), k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, line_no) AS n FROM r) FINAL SELECT item_id, doc_id, line_no, score FROM k WHERE n = 1""")
def best_match_exhaustive(s, d):
    """Benchmark items against all lines, by shared words."""
    return M.best_match_words(table(s, d, "benchmark"), X0.spread(lines(s, d)), "item_id", "text", ["doc_id", "line_no"])


# -- events -----------------------------------------------------------------------------


@register("event_sessions", "user_id long, start timestamp, n long, value double", """WITH e AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM e)
    FINAL SELECT user_id, min(ts) AS start, count(*) AS n, sum(value) AS value FROM g GROUP BY user_id, k""")
def event_sessions(s, d):
    """Session windows, the batch form of the stream."""
    return streams.sessions(table(s, d, "events"))


@register("event_windows", "start timestamp, event_type string, n long", "FINAL SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_windows(s, d):
    """Tumbling windows, the batch form of the stream."""
    return streams.tumbling(table(s, d, "events"))


# -- files and whole runs ---------------------------------------------------------------


def place(s, name):
    """A new folder that all executors see, for tables that a query writes and reads back."""
    base = s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getConf().get("spark.checkpoint.dir") or "/tmp/checkpoints"
    path = f"{base.rstrip('/')}/corvox-{name}-{uuid.uuid4().hex}"
    there = s.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(s.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(there)
    return path


CLIP_NAMES = "n0 AS (SELECT 'Script_' || conv_id || '_' || lpad(turn::VARCHAR, greatest(4, length(turn::VARCHAR))::INTEGER, '0') || '.wav' AS filename, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text, conv_id, turn FROM conversations)"


def named_turns(s, d):
    return table(s, d, "conversations").select(X.clip_name(F.col("conv_id"), F.col("turn")).alias("filename"), F.trim(F.regexp_replace("text", r"\s+", " ")).alias("text"), "conv_id", "turn")


@register("manifest_round_trip", "filename string, text string, pos long", f"WITH {CLIP_NAMES} FINAL SELECT filename, text, row_number() OVER (ORDER BY filename || '|' || text) AS pos FROM n0")
def manifest_round_trip(s, d):
    """Written in order of lines, read back with positions."""
    path = place(s, "manifest")
    write_manifest(named_turns(s, d), path)
    return read_manifest(s, path).withColumn("pos", F.col("pos") + 1)


@register("appended_manifest", "filename string, text string", f"WITH {CLIP_NAMES} FINAL SELECT filename, text FROM n0")
def appended_manifest(s, d):
    """Half the rows are there, all are offered, none comes twice."""
    path, rows = place(s, "appended"), named_turns(s, d)
    write_manifest(rows.where("turn % 2 = 0").select("filename", "text"), path)
    append_manifest(M.only_in(rows.select("filename", "text"), read_manifest(s, path), ["filename"]), path)
    return read_manifest(s, path)


@register("checkpoint_resume", "filename string, again boolean", f"WITH {CLIP_NAMES} FINAL SELECT filename, false AS again FROM n0 WHERE turn % 3 <> 0")
def checkpoint_resume(s, d):
    """What is left after a checkpoint of every third turn, and whether any of it is in it."""
    path, rows = place(s, "checkpoint"), named_turns(s, d).select("filename", "turn")
    schema = T.StructType([T.StructField("filename", T.StringType())])
    left = not_done(rows, read_checkpoint(s, path, schema), ["filename"])  # nothing there yet
    append_checkpoint(left.where("turn % 3 = 0").select("filename"), path)
    done = read_checkpoint(s, path, schema)
    return not_done(left, done, ["filename"]).join(done.withColumn("again", F.lit(True)), "filename", "left").na.fill(False, ["again"])


@register("stored_tables", "filename string, tier long, text string, seg_idx long, end_s double", f"WITH {CLIP_NAMES} FINAL SELECT filename, turn % 2 + 1 AS tier, CASE WHEN turn % 4 <> 0 THEN text END AS text, turn AS seg_idx, turn * 2.5 AS end_s FROM n0")
def stored_tables(s, d):
    """Segments and transcriptions as input tables, null where recognition gave none."""
    a, b, t = place(s, "segments"), place(s, "transcriptions"), named_turns(s, d)
    empty = "CAST(NULL AS array<struct<word:string,start:double,end:double>>) AS words"
    t.selectExpr("filename AS audio_path", "CAST(conv_id AS int) AS script_id", "0 AS file_idx", "CAST(turn AS int) AS seg_idx", "turn * 2.0D AS start_s", "turn * 2.5D AS end_s", "text", empty).write.parquet(a)
    t.selectExpr("filename", "CAST(turn % 2 + 1 AS int) AS tier", "IF(turn % 4 <> 0, text, NULL) AS prompted_text", "CAST(NULL AS string) AS plain_text").write.parquet(b)
    segments = read_segments(s, a).select(F.col("audio_path").alias("filename"), "seg_idx", "end_s")
    return read_transcriptions(s, b).join(segments, "filename").withColumn("text", F.coalesce("prompted_text", "plain_text"))


@register("labels_with_errors", "filename string, text string", f"WITH {CLIP_NAMES} FINAL SELECT filename, CASE WHEN turn % 4 <> 0 THEN text ELSE '[ERROR: no transcription]' END AS text FROM n0")
def labels_with_errors(s, d):
    """C12."""
    t = named_turns(s, d).withColumns({"prompted_text": F.when(F.col("turn") % 4 != 0, F.col("text")), "plain_text": F.lit(None).cast("string")})
    return labels_from(t, True)


@register("wav_round_trip", "vec_id long, n long, far boolean", "FINAL SELECT vec_id, len(embedding) AS n, false AS far FROM embeddings")
def wav_round_trip(s, d):
    """Clips as 24-bit WAV bytes, decoded again: no sample is off by more than a step."""
    t = table(s, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(0.9999998), x.cast("double")))).alias("samples"))
    read = t.withColumn("wav", wav_files("samples", F.lit(48_000))).withColumn("again", wav_column("wav")["samples"])
    gap = F.array_max(F.zip_with("samples", "again", lambda a, b: F.abs(a - b)))
    return read.select("vec_id", F.size("again").alias("n"), (gap > 2.0**-23).alias("far"))


@register("dry_run_plan", "script_id long, recordings long, first_line long, last_line long, lines long", f"WITH {EXACT.replace('{pad}', '650')} FINAL SELECT script_id, max(CASE WHEN n > half THEN 2 ELSE 1 END) AS recordings, 1 AS first_line, max(CASE WHEN n > half THEN last ELSE half END) AS last_line, count_if(line_no <= CASE WHEN n > half THEN last ELSE half END) AS lines FROM x2 WHERE script_id % 2 = 0 GROUP BY script_id")
def dry_run_plan(s, d):
    """What a run over every second script would work on."""
    _, t, files = X0.exact_scripts(s, d)
    return dry_run(files.where("script_id % 2 = 0"), t)


@register("manager_rollup", "script_id long, matched long, skipped long, total_lines long, audio_files long, rate double", f"""WITH {EXACT.replace('{pad}', '650')}, r AS (SELECT script_id, count(*) AS total_lines, max(CASE WHEN n > half THEN 2 ELSE 1 END) AS audio_files, count_if(spoken) AS matched FROM x2 GROUP BY script_id),
    k AS (SELECT script_id, count_if(line_no < top) AS skipped FROM missed GROUP BY script_id) FINAL SELECT script_id, matched, coalesce(skipped, 0) AS skipped, total_lines, audio_files, round(100.0::DOUBLE * matched / total_lines, 1) AS rate FROM r LEFT JOIN k USING (script_id)""")
def manager_rollup(s, d):
    """The manager's result by script."""
    segments, t, files = X0.exact_scripts(s, d)
    return R.manager_rollup(A.align(segments, t, files, A.AlignConfig.manager()), t, files)


@register("report_over_results", "total long, passed long, failed long, r1_pct double, r2_pct double, r3_pct double, r6_pct double, preattack_mean double, tail_short long", """WITH e AS (SELECT (event_id % 101) / 100.0::DOUBLE AS similarity, event_id % 23 <> 0 AS b, event_id % 29 <> 0 AS v, (380 + event_id % 40)::DOUBLE AS pre, (710 + event_id % 50)::DOUBLE AS tail FROM events)
    FINAL SELECT count(*) AS total, count_if(similarity >= 0.95 AND b AND v) AS passed, count_if(NOT (similarity >= 0.95 AND b AND v)) AS failed, round(100.0::DOUBLE * count_if(similarity >= 0.95) / count(*), 2) AS r1_pct, round(100.0::DOUBLE * count_if(b) / count(*), 2) AS r2_pct,
    round(100.0::DOUBLE * count_if(similarity >= 0.95 AND b AND v) / count(*), 2) AS r3_pct, round(100.0::DOUBLE * count_if(v) / count(*), 2) AS r6_pct, avg(pre) AS preattack_mean, count_if(tail < 725) AS tail_short FROM e""")
def report_over_results(s, d):
    """G1, G2 alone, over rows that are judged already (events stand in for them)."""
    n = F.col("event_id")
    t = table(s, d, "events").select((n % 101 / 100).alias("similarity"), (n % 23 != 0).alias("boundary_pass"), (n % 29 != 0).alias("envelope_pass"), (380 + n % 40).cast("double").alias("preattack_ms"), (710 + n % 50).cast("double").alias("tail_silence_ms"))
    return R.evaluation_report(t.withColumn("verdict", F.when((F.col("similarity") >= 0.95) & F.col("boundary_pass") & F.col("envelope_pass"), "PASS").otherwise("FAIL")))
