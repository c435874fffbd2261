"""Whole runs: alignment, evaluation and integrity from input tables to outputs."""

from __future__ import annotations

from dataclasses import asdict, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvox.functions.text import clip_name
from corvox.operators import report as R
from corvox.operators.align import AlignConfig, align
from corvox.operators.integrity import integrity_stats, presence, quarantine
from corvox.operators.matching import all_keys, append_new, dedupe, script_audio
from corvox.operators.timing import covered_lines
from corvox.operators.verdict import evaluate, merge_tier2
from corvox.sources import writers as K
from corvox.sources.readers import not_done


def select_recordings(files: DataFrame, scripts: list[int] | None = None, span: tuple[int, int] | None = None) -> DataFrame:
    """recordings of some scripts, and of one exact line range."""
    chosen = files if scripts is None else files.where(F.col("script_id").isin(scripts))
    return chosen if span is None else chosen.where((F.col("start_line") == span[0]) & (F.col("end_line") == span[1]))


def select_clips(rows: DataFrame, script: int | None = None) -> DataFrame:
    """F1 on clip names: a prefix."""
    return rows if script is None else rows.where(F.col("filename").startswith(f"Script_{script}_"))


def dry_run(files: DataFrame, lines: DataFrame) -> DataFrame:
    """By script, what a run would work on: recordings, first and last line, lines there are."""
    plan = files.groupBy("script_id").agg(F.count(F.lit(1)).alias("recordings"), F.min("start_line").alias("first_line"), F.max("end_line").alias("last_line"))
    counts = covered_lines(lines, files).groupBy("script_id").agg(F.count(F.lit(1)).alias("lines"))
    return plan.join(counts, "script_id", "left").withColumn("lines", F.coalesce("lines", F.lit(0)))


def labels_from(transcriptions: DataFrame, keep_errors: bool = False) -> DataFrame:
    """Filename and text; failed ones are left out, or stand as ``[ERROR: ...]``."""
    text = F.coalesce("plain_text", "prompted_text")
    if keep_errors:
        return transcriptions.select("filename", F.coalesce(text, F.lit("[ERROR: no transcription]")).alias("text"))
    return transcriptions.select("filename", text.alias("text")).where(F.col("text").isNotNull())


def aligned_manifest(aligned: DataFrame, lines: DataFrame) -> DataFrame:
    """One row a matched line: filename and the script's text, the least text of a name."""
    matched = aligned.where("kind = 'match'").join(lines.select("script_id", "line_no", "text").withColumnRenamed("text", "line_text"), ["script_id", "line_no"])
    return dedupe(matched.select(clip_name(F.col("script_id"), F.col("line_no")).alias("filename"), F.col("line_text").alias("text")))


def run_alignment(segments: DataFrame, lines: DataFrame, files: DataFrame, base: str, config: AlignConfig = AlignConfig(), done: DataFrame | None = None, resume: DataFrame | None = None) -> str:
    """Align the scripts that aren't ``done`` and write aligned rows,
    manifest, skip log, rollup, parameters and a checkpoint to a new versioned folder, which is
    returned. ``resume``: the checkpoint (script_id, file_idx, line_no) of a run that ended
    within scripts; recordings up to it aren't aligned again."""
    spark = segments.sparkSession
    path = K.versioned_dir(spark, base)
    todo = files if done is None else not_done(files, done, ["script_id"])
    align(segments.join(todo.select("script_id").distinct(), "script_id", "left_semi"), lines, todo, replace(config, checkpoints=True), resume).write.parquet(f"{path}/aligned")
    aligned = spark.read.parquet(f"{path}/aligned")
    K.write_manifest(aligned_manifest(aligned, lines), f"{path}/manifest")
    K.append_skips(aligned.where("kind = 'skip'").select("script_id", "line_no", "reason", "text"), f"{path}/skipped")
    K.write_report(R.alignment_rollup(aligned.where("kind <> 'checkpoint'"), "script_id"), f"{path}/rollup")
    K.append_checkpoint(aligned.where("kind = 'checkpoint'").select("script_id", "file_idx", "line_no"), f"{path}/checkpoint")
    K.write_report(spark.createDataFrame([{k: str(v) for k, v in asdict(config).items()}]), f"{path}/parameters")
    return path


def run_evaluation(clips: DataFrame, path: str, done: DataFrame | None = None, again: DataFrame | None = None, script: int | None = None, resume_semantics: str = "filtered") -> DataFrame:
    """Stages 3 and 4: judge the clips that aren't ``done``, merge second scores, write rows, report
    and CSV. The script filter holds for what is reported too; with ``reference`` only for what
    is judged, and earlier results are reported in full."""
    new = select_clips(clips, script) if done is None else not_done(select_clips(clips, script), done, ["filename"])
    judged = evaluate(new)
    judged = judged.withColumn("recovered", F.lit(False)) if again is None else merge_tier2(judged, again)
    judged.write.mode("overwrite").parquet(f"{path}/new")
    rows = clips.sparkSession.read.parquet(f"{path}/new")
    if done is not None:
        rows = rows.unionByName(done if resume_semantics == "reference" else select_clips(done, script), allowMissingColumns=True)
    report = R.evaluation_report(rows)
    K.write_report(report, f"{path}/report")
    shown = rows.select(*(c for c in rows.columns if c in ("filename", "similarity", "cer", "verdict", "preattack_ms", "tail_silence_ms", "failure_reasons", "failure_types")))
    K.write_validation(shown, f"{path}/validation")
    return report


def validate(manifest: DataFrame, files: DataFrame, path: str | None = None) -> DataFrame:
    """C8, the short path: integrity by script; with ``path`` orphans are marked for quarantine too."""
    found = presence(manifest, files, ["filename"]).withColumn("script", F.regexp_extract("filename", r"Script_(\d+)_", 1))
    if path:
        K.write_quarantine(quarantine(found), f"{path}/places")
    return integrity_stats(found, "script")


def run_manager(segments: DataFrame, lines: DataFrame, files: DataFrame, manifest: DataFrame, wavs: DataFrame, base: str, scripts: list[int] | None = None, start_line: int = 1, validate_only: bool = False, collect_orphans: bool = False) -> str:
    """The six steps of the older manager: discover, take recognised segments, align (J2) and add
    to the manifest, validate, collect orphans, report. Returns the new versioned folder.

    ``manifest`` (filename, text) and ``wavs`` (filename) are what there is; clips of this run count
    as written. With ``validate_only`` or ``collect_orphans`` nothing is aligned, and with the first
    alone orphans stay where they are. Missed lines are written only where orphans were found.
    """
    spark = segments.sparkSession
    path, aligned = K.versioned_dir(spark, base, "manager"), None
    if not (validate_only or collect_orphans):
        chosen = script_audio(select_recordings(files, scripts), lines)
        K.write_report(chosen.groupBy("script_id", "status").agg(F.count(F.lit(1)).alias("recordings")), f"{path}/discovered")
        todo = chosen.where("status = 'OK'").drop("status")
        align(segments, lines, todo, replace(AlignConfig.manager(), start_line=start_line)).write.parquet(f"{path}/aligned")
        aligned = spark.read.parquet(f"{path}/aligned")
        R.manager_rollup(aligned, lines, todo).write.parquet(f"{path}/rollup")
        new = aligned_manifest(aligned, lines)
        manifest, wavs = append_new(manifest.select("filename", "text"), new), all_keys(wavs, new, "filename")
    K.write_manifest(manifest.select("filename", "text"), f"{path}/manifest")
    found = presence(manifest, wavs, ["filename"]).withColumn("script", F.regexp_extract("filename", r"Script_(\d+)_", 1))
    found.write.parquet(f"{path}/validation")
    found = spark.read.parquet(f"{path}/validation")
    if not validate_only and found.where("status = 'ORPHAN'").limit(1).count():
        K.write_quarantine(quarantine(found), f"{path}/places")
        if aligned is not None:
            K.write_missed(R.missed_lines(aligned), f"{path}/missed")
    K.write_report(integrity_stats(found, "script"), f"{path}/report")
    return path
