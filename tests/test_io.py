import io
import wave

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvox.operators.align import align

from corvox.sources import readers as R
from corvox.sources import writers as K
from corvox.streaming.streams import align_stream, incremental


def test_scripts_and_encodings(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("﻿첫 줄\r\n\r\n 둘째 \n".encode())
    (tmp_path / "b.txt").write_bytes("가나다\n라마\n".encode("cp949"))
    rows = R.read_scripts(spark, str(tmp_path)).orderBy("path", "line_no").collect()
    assert [(r["line_no"], r["text"]) for r in rows] == [(1, "첫 줄"), (2, "둘째"), (1, "가나다"), (2, "라마")]
    assert {r["encoding"] for r in rows} == {"utf-8-sig", "cp949"}
    assert R.read_scripts(spark, str(tmp_path / "a.txt"), R.BOM_KEPT, 2).first()["text"] == "둘째"
    assert R.sniff_encoding(spark, str(tmp_path / "b.txt")).first()["fits"] == ["cp949", "euc-kr"]
    assert K.reencode((tmp_path / "b.txt").read_bytes()).decode() == "가나다\n라마"


def test_manifest_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b.wav", "x|y"), ("a.wav", "z")], "filename string, text string")
    path = str(tmp_path / "m")
    K.write_manifest(df, path)
    K.append_manifest(spark.createDataFrame([("c.wav", "w")], df.schema), path)
    rows = {(r["filename"], r["text"]) for r in R.read_manifest(spark, path).collect()}
    assert rows == {("a.wav", "z"), ("b.wav", "x|y"), ("c.wav", "w")}
    assert K.versioned_dir(spark, str(tmp_path), "run").endswith("run_v1")
    (tmp_path / "run_v4").mkdir()
    assert K.versioned_dir(spark, str(tmp_path), "run").endswith("run_v5")


def test_wavs_and_names(spark, tmp_path):
    for name, wide, channels, data in (("Script_3_1-20.wav", 2, 2, b"\x00\x40\x00\x00" * 4), ("note.wav", 3, 1, K.pcm24([0.5, -1.0]))):
        out = io.BytesIO()
        with wave.open(out, "wb") as f:
            f.setnchannels(channels)
            f.setsampwidth(wide)
            f.setframerate(8000)
            f.writeframes(data)
        (tmp_path / name).write_bytes(out.getvalue())
    (tmp_path / "bad.wav").write_bytes(b"RIFF")
    rows = {r["path"].rsplit("/", 1)[1]: r for r in R.read_wavs(spark, str(tmp_path)).collect()}
    assert rows["Script_3_1-20.wav"]["samples"] == [0.5] * 4 and rows["note.wav"]["samples"] == [0.5, -1.0] and rows["bad.wav"]["sr"] is None
    assert {r["path"].rsplit("/", 1)[1]: r for r in R.read_wavs(spark, str(tmp_path), mean=True).collect()}["Script_3_1-20.wav"]["samples"] == [0.25] * 4
    found = R.list_audio(spark, str(tmp_path), "wav").collect()
    assert [(r["script_id"], r["start_line"], r["end_line"]) for r in found] == [(3, 1, 20)]


def test_checkpoint_missing_and_broken(spark, tmp_path):
    schema = T.StructType.fromDDL("filename string")
    assert R.read_checkpoint(spark, str(tmp_path / "none"), schema).count() == 0
    (tmp_path / "c.json").write_text('{"filename": "a"}\n{"filename": \n')
    assert [r[0] for r in R.read_checkpoint(spark, str(tmp_path / "c.json"), schema).collect()] == ["a"]


def test_streams(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, 1, "hello there"), (1, 2, "general")], "script_id long, seg_idx long, text string").write.parquet(source)
    schema = "script_id long, seg_idx long, text string"
    for expected in (2, 3):
        incremental(spark.readStream.schema(schema).parquet(source), lambda b: b, out, str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(out).count() == expected
        spark.createDataFrame([(1, 3, "again")], schema).write.mode("append").parquet(source)


def test_aligned_stream_equals_one_run(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    lines = spark.createDataFrame([(s, k, f"{chr(96 + k) * 6} number {k}") for s in (1, 2) for k in range(1, 9)], "script_id int, line_no int, text string")
    files = spark.createDataFrame([(s, f, 4 * f + 1, 4 * f + 4) for s in (1, 2) for f in (0, 1)], "script_id int, file_idx int, start_line int, end_line int")
    segments = lines.where("line_no <> 3").select("script_id", F.floor((F.col("line_no") - 1) / 4).cast("int").alias("file_idx"), F.col("line_no").alias("seg_idx"), "text")
    for part in (0, 1):
        segments.where(F.col("file_idx") == part).write.mode("append").parquet(source)
        align_stream(spark.readStream.schema(segments.schema).parquet(source), lines, files, out, str(tmp_path / "cp")).awaitTermination()
    row = lambda r: (r["script_id"], r["file_idx"], r["kind"], r["line_no"], r["reason"])
    streamed = {row(r) for r in spark.read.parquet(out).where("kind <> 'checkpoint'").collect()}
    assert streamed == {row(r) for r in align(segments, lines, files).collect()} and len(streamed) == 16


def test_wav_files_and_rates(spark, tmp_path):
    tone = np.sin(2 * np.pi * 440 * np.arange(4800) / 48000) * 0.5
    clips = spark.createDataFrame([("a.wav", 48000, tone.tolist()), ("b.wav", 8000, [0.25, -0.25]), ("c.wav", 8000, None)], "filename string, sr int, samples array<double>")
    for _ in range(2):  # written again: replaced
        K.write_wav_files(clips, str(tmp_path / "w"))
    rows = {r["path"].rsplit("/", 1)[1]: r for r in R.read_wavs(spark, str(tmp_path / "w")).collect()}
    assert set(rows) == {"a.wav", "b.wav"} and np.abs(np.array(rows["a.wav"]["samples"]) - tone).max() < 1e-6
    assert clips.select(K.wav_files("samples", "sr").alias("w")).collect()[1]["w"] == (tmp_path / "w" / "b.wav").read_bytes()
    low = next(r for r in R.read_wavs(spark, str(tmp_path / "w"), mean=True, target=16000).collect() if r["path"].endswith("a.wav"))
    assert low["sr"] == 16000 and len(low["samples"]) == 1600 and np.abs(np.array(low["samples"]) - tone[::3]).max() < 1e-3
    assert K.pcm24([1.0, -1.0, 0.5]) == b"\xff\xff\x7f\x00\x00\x80\x00\x00\x40"


def test_scripts_are_reencoded_once(spark, tmp_path):
    raw = "가나\r\n\r\n 다라 ".encode("cp949")
    (tmp_path / "s.txt").write_bytes(raw)
    for _ in range(2):
        K.reencode_scripts(spark, str(tmp_path))
        assert (tmp_path / "s.txt").read_text() == "가나\n다라" and (tmp_path / "s.txt.bak").read_bytes() == raw
    assert R.sniff_encoding(spark, str(tmp_path / "*.bak")).first()["guess"] == "cp949"


def test_versions_are_claimed(spark, tmp_path):
    assert [K.versioned_dir(spark, str(tmp_path), "run")[-2:] for _ in range(3)] == ["v1", "v2", "v3"]


def test_manifest_order_over_files(spark, tmp_path):
    """Files of rising size: read by size, the last would come first."""
    folder, k = tmp_path / "m", 0
    folder.mkdir()
    for part, n in enumerate((1, 50, 3000)):
        (folder / f"part-{part:05d}.txt").write_text("".join(f"{k + j:06d}.wav|t\n" for j in range(n)))
        k += n
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")  # the last file in several splits
    try:
        got = {r["filename"]: r["pos"] for r in R.read_manifest(spark, str(folder)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {f"{j:06d}.wav": j for j in range(k)}
