from pyspark.sql import functions as F

from corvox.operators import lifecycle as L
from corvox.sources.readers import read_manifest


def tables(spark):
    lines = spark.createDataFrame([(s, k, f"script {s} says number {k} of many " + "abcdefgh"[k] * 6) for s in (1, 2) for k in range(1, 7)], "script_id int, line_no int, text string")
    files = spark.createDataFrame([(s, 0, 1, 6) for s in (1, 2)], "script_id int, file_idx int, start_line int, end_line int")
    segments = lines.where("line_no <> 3").select("script_id", F.lit(0).alias("file_idx"), F.col("line_no").alias("seg_idx"), "text")
    return segments, lines, files


def test_alignment_run(spark, tmp_path):
    segments, lines, files = tables(spark)
    assert {r["script_id"]: r["lines"] for r in L.dry_run(files, lines).collect()} == {1: 6, 2: 6}
    path = L.run_alignment(segments, lines, files, str(tmp_path), done=spark.createDataFrame([(2,)], "script_id int"))
    aligned = spark.read.parquet(path + "/aligned")
    assert {(r["script_id"], r["kind"], r["line_no"]) for r in aligned.where("kind <> 'checkpoint'").collect()} == {(1, "skip" if k == 3 else "match", k) for k in range(1, 7)}
    assert [(r["script_id"], r["line_no"]) for r in spark.read.json(path + "/checkpoint").collect()] == [(1, 7)]
    assert read_manifest(spark, path + "/manifest").count() == 5 and path.endswith("run_v1")
    assert L.select_recordings(files, [1], (1, 6)).count() == 1 and L.select_recordings(files, span=(1, 5)).count() == 0


def test_manager_run(spark, tmp_path):
    segments, lines, files = tables(spark)
    files = files.union(spark.createDataFrame([(3, 0, 1, 6)], files.schema))  # no script
    manifest = spark.createDataFrame([("Script_1_0001.wav", "kept")], "filename string, text string")
    wavs = spark.createDataFrame([("Script_1_0001.wav",), ("Script_9_0001.wav",)], "filename string")
    path = L.run_manager(segments, lines, files, manifest, wavs, str(tmp_path))
    assert {(r["script_id"], r["status"]) for r in spark.read.json(path + "/discovered").collect()} == {(1, "OK"), (2, "OK"), (3, "NO_SCRIPT")}
    assert {(r["script_id"], r["matched"], r["skipped"], r["total_lines"], r["rate"]) for r in spark.read.parquet(path + "/rollup").collect()} == {(s, 5, 1, 6, 83.3) for s in (1, 2)}
    rows = {r["filename"]: r["text"] for r in read_manifest(spark, path + "/manifest").collect()}
    assert len(rows) == 10 and rows["Script_1_0001.wav"] == "kept"
    assert [r["filename"] for r in spark.read.parquet(path + "/places").where("place = 'quarantine'").collect()] == ["Script_9_0001.wav"]
    assert spark.read.option("header", True).option("sep", "|").csv(path + "/missed").count() == 2
    again = L.run_manager(segments, lines, files, manifest, wavs, str(tmp_path), validate_only=True)
    assert {r["script"]: r["verdict"] for r in spark.read.json(again + "/report").collect()} == {"1": "PASS", "9": "FAIL"}
    assert not (tmp_path / "manager_v2" / "places").exists()


def test_evaluation_resume(spark, tmp_path):
    clips = spark.createDataFrame([(f"Script_{s}_{k:04d}.wav", 0.99 if k else 0.6, "x", True, True, True, 400.0, 730.0) for s in (1, 2) for k in range(3)], "filename string, similarity double, heard string, boundary_pass boolean, envelope_pass boolean, readable boolean, preattack_ms double, tail_silence_ms double")
    assert L.run_evaluation(clips, str(tmp_path / "a"), script=1).first()["total"] == 3
    done = spark.read.parquet(str(tmp_path / "a" / "new"))
    assert L.run_evaluation(clips, str(tmp_path / "b"), done, script=2).first()["total"] == 3
    assert L.run_evaluation(clips, str(tmp_path / "c"), done, script=2, resume_semantics="reference").first()["total"] == 6
    again = spark.createDataFrame([("Script_1_0000.wav", 0.96, "y")], "filename string, similarity2 double, heard2 string")
    assert L.run_evaluation(clips, str(tmp_path / "d"), again=again).first()["passed"] == 5


def test_validate_and_labels(spark, tmp_path):
    m, f = (spark.createDataFrame([(n,) for n in names], "filename string") for names in (["Script_1_0001.wav", "Script_2_0001.wav"], ["Script_1_0001.wav"]))
    assert {r["script"]: r["verdict"] for r in L.validate(m, f, str(tmp_path)).collect()} == {"1": "PASS", "2": "FAIL"}
    t = spark.createDataFrame([("a", 1, None, None), ("b", 1, "p", None)], "filename string, tier int, prompted_text string, plain_text string")
    assert L.labels_from(t).count() == 1 and L.labels_from(t, True).count() == 2
