"""Writers (inventory K1-K15). Task commits are atomic, which K11 asks of checkpoints."""

from __future__ import annotations

import io
import os
import re
import time
import uuid
import wave

import numpy as np
import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvox.functions.text import four_places
from corvox.sources.readers import ENCODINGS, decode_bytes


def versioned_dir(spark: SparkSession, base: str, tag: str = "run") -> str:
    """K1: ``base/tag_vN`` with the first N after those there are. A marker file, which one
    writer alone can create, claims it."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    taken = [int(m[1]) for s in (fs.listStatus(root) if fs.exists(root) else []) if (m := re.fullmatch(rf"{re.escape(tag)}_v(\d+)", s.getPath().getName()))]
    n = max(taken, default=0) + 1
    while True:
        try:
            fs.create(jvm.org.apache.hadoop.fs.Path(f"{base}/{tag}_v{n}/_CLAIMED"), False).close()
            return f"{base}/{tag}_v{n}"
        except Py4JJavaError:
            if not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{base}/{tag}_v{n}/_CLAIMED")):
                raise
            n += 1


def write_manifest(manifest: DataFrame, path: str) -> None:
    """K2: ``filename|text`` lines in code-point order. Files are range-sorted, so reading them
    in name order gives the whole order."""
    lines = manifest.select(F.concat_ws("|", "filename", "text").alias("value"))
    lines.orderBy("value").write.mode("errorifexists").text(path)


def append_manifest(manifest: DataFrame, path: str) -> None:
    """K3: after ``append_new`` or ``not_done``."""
    manifest.select(F.concat_ws("|", "filename", "text").alias("value")).write.mode("append").text(path)


def write_report(report: DataFrame, path: str) -> None:
    """JSON rows; a report is one row."""
    report.coalesce(1).write.mode("overwrite").json(path)


def validation_rows(rows: DataFrame) -> DataFrame:
    """K5: columns as text: similarity and rates at four places, levels and times at two."""
    four, two = ("similarity", "cer"), ("boundary_first_db", "boundary_last_db", "preattack_ms", "tail_silence_ms")
    shown = {c: four_places(F.col(c).cast("double")) for c in four if c in rows.columns}
    shown |= {c: F.format_string("%.2f", F.col(c).cast("double")) for c in two if c in rows.columns}
    shown |= {c: F.array_join(c, sep) for c, sep in (("failure_reasons", "; "), ("failure_types", ",")) if c in rows.columns}
    return rows.withColumns(shown)


def write_validation(rows: DataFrame, path: str) -> None:
    validation_rows(rows).orderBy("filename").write.mode("overwrite").option("header", True).csv(path, sep="|")


def qc_rows(rows: DataFrame) -> DataFrame:
    """K6: script and line from the name, issues joined by ``|``."""
    parts = F.split(F.regexp_replace("filename", r"\.wav$", ""), "_")
    return rows.withColumns({"script_id": F.coalesce(F.get(parts, 1), F.lit("")), "line_number": F.coalesce(F.get(parts, 2), F.lit("")), "issues": F.array_join("issues", "|")})


def write_qc(rows: DataFrame, path: str) -> None:
    """K6: CSV whose header starts with a byte order mark."""
    shown = qc_rows(rows)
    marked = shown.withColumnRenamed(shown.columns[0], "﻿" + shown.columns[0])
    marked.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_skips(skips: DataFrame, path: str) -> None:
    """K7."""
    skips.write.mode("append").option("header", True).csv(path, sep="|")


def write_missed(missed: DataFrame, path: str) -> None:
    """K8: a folder a script, lines in order."""
    missed.repartition("script_id").sortWithinPartitions("script_id", "line_no").write.mode("overwrite").partitionBy("script_id").option("header", True).csv(path, sep="|")


def replace_file(place: str, data: bytes, tries: int = 3) -> None:
    """Write ``data`` beside ``place`` and move it there, so that a repeated or lost task never
    leaves half a file."""
    for left in range(tries - 1, -1, -1):
        try:
            beside = f"{place}.{uuid.uuid4().hex}.tmp"
            with open(beside, "wb") as f:
                f.write(data)
            os.replace(beside, place)
            return
        except OSError:
            if not left:
                raise
            time.sleep(0.1)


def pcm24(samples) -> bytes:
    """24-bit little-endian PCM of samples in -1..1."""
    whole = np.clip(np.rint(np.asarray(samples, np.float64) * (1 << 23)), -(1 << 23), (1 << 23) - 1).astype("<i4")
    return whole.view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def wav_bytes(samples, rate: int) -> bytes:
    """A mono 24-bit WAV file."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(3)
        f.setframerate(int(rate))
        f.writeframes(pcm24(samples))
    return out.getvalue()


@F.pandas_udf(T.BinaryType())
def wav_files(samples: pd.Series, rate: pd.Series) -> pd.Series:
    """WAV bytes as a column, for stores that executors don't mount."""
    return pd.Series([None if x is None else wav_bytes(x, r) for x, r in zip(samples, rate, strict=True)])


def write_wav_files(clips: DataFrame, folder: str) -> None:
    """Each (filename, sr, samples) as a WAV file in ``folder``, which every executor must
    see at that path; an existing file is replaced, with three tries."""

    def run(rows) -> None:
        os.makedirs(folder, exist_ok=True)
        for row in rows:
            replace_file(os.path.join(folder, row["filename"]), wav_bytes(row["samples"], row["sr"]))

    clips.select("filename", "sr", "samples").where("samples is not null").foreachPartition(run)


def append_checkpoint(done: DataFrame, path: str) -> None:
    """Rows done by this run, beside those before; task commits are atomic."""
    done.write.mode("append").json(path)


def reencode_scripts(spark: SparkSession, folder: str) -> None:
    """Every script of a folder that executors mount becomes UTF-8; the first time, the
    file as it was stays beside it as ``.bak``."""

    def run(rows) -> None:
        for row in rows:
            place, data = row["path"].removeprefix("file:"), bytes(row["content"])
            if not os.path.exists(place + ".bak"):
                replace_file(place + ".bak", data)
            replace_file(place, reencode(data))

    spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select("path", "content").foreachPartition(run)


def write_quarantine(found: DataFrame, path: str) -> None:
    """The logical move: a folder a place."""
    found.write.mode("overwrite").partitionBy("place").parquet(path)


def reencode(data: bytes) -> bytes:
    """UTF-8 without blank lines; the source file stays as its own backup."""
    text, _ = decode_bytes(data, ENCODINGS)
    return "\n".join(line.strip() for line in (text or "").splitlines() if line.strip()).encode()
