"""Readers (inventory S1-S11). Everything is read by Spark, so paths may be in any store it knows."""

from __future__ import annotations

import io
import wave

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvox.functions.text import audio_name_fields, strip

#: Encodings tried in order; BOM_KEPT keeps a byte order mark in line 1.
ENCODINGS = ["utf-8-sig", "utf-8", "cp949", "euc-kr"]
BOM_KEPT = ["utf-8", "utf-8-sig", "cp949", "euc-kr"]


def decode_bytes(data: bytes, encodings: list[str]) -> tuple[str | None, str | None]:
    """(text, encoding) of the first encoding that decodes to something."""
    for name in encodings:
        try:
            text = data.decode(name)
        except (UnicodeDecodeError, LookupError):
            continue
        if text.strip():
            return text, name
    return None, None


def decoded(content: Column, encodings: list[str]) -> Column:
    @F.pandas_udf("struct<text: string, encoding: string>")
    def run(data: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([decode_bytes(d, encodings) if d is not None else (None, None) for d in data], columns=["text", "encoding"])

    return run(content)


def script_lines(scripts: DataFrame, key: str, text: str, start_line: int = 1) -> DataFrame:
    """S1 on texts: (key, line_no, text): stripped lines, blanks dropped before they are numbered from 1.

    Lines are numbered inside their row's array, without a shuffle: the array of non-blank
    lines is exploded with its positions. They end at CR LF, CR or LF; as blanks are dropped,
    each CR may count as an LF, and a split at one character needs no pattern.
    """
    lines = F.filter(F.transform(F.split(F.replace(F.col(text), F.lit("\r"), F.lit("\n")), "\n"), strip), lambda line: line != "")
    rows = scripts.select(key, F.posexplode(lines).alias("p", "text"))
    return rows.select(key, (F.col("p") + 1).alias("line_no"), "text").where(F.col("line_no") >= start_line)


def read_scripts(spark: SparkSession, path: str, encodings: list[str] = ENCODINGS, start_line: int = 1) -> DataFrame:
    """S1, S1b-S1d: lines of script files: path, encoding, line_no, text."""
    files = spark.read.format("binaryFile").load(path).select("path", decoded(F.col("content"), encodings).alias("d"))
    files = files.select(F.struct("path", "d.encoding").alias("file"), F.col("d.text").alias("text"))
    return script_lines(files, "file", "text", start_line).select("file.path", "line_no", "text", "file.encoding")


def read_answer_key(spark: SparkSession, path: str) -> DataFrame:
    """1-based raw lines, blanks kept."""
    files = spark.read.format("binaryFile").load(path).select(decoded(F.col("content"), ENCODINGS)["text"].alias("text"))
    return answer_lines(files, "text")


def answer_lines(texts: DataFrame, text: str, *keys: str) -> DataFrame:
    """S8 on texts; a last line's end doesn't begin another."""
    whole = F.regexp_replace(text, r"\n\z", "")
    return texts.select(*keys, F.posexplode(F.split(whole, "\n")).alias("p", "text")).select(*keys, (F.col("p") + 1).alias("line_no"), "text")


def manifest_rows(lines: DataFrame, value: str = "value") -> DataFrame:
    """Split once at the first ``|``; rows without one are dropped."""
    parts = F.split(F.col(value), r"[|]", 2)
    return lines.where(F.contains(F.col(value), F.lit("|"))).withColumns({"filename": strip(parts[0]), "text": strip(parts[1])})


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Pos, filename, text, duplicates kept (``dedupe`` has the policies); pos counts all
    lines from 0, files in order of their names.

    Spark reads large files first, so an id that rises over tasks doesn't follow the names. Lines
    are counted a split (a row each, ordered together), and a line's place in its split is added.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    splits = lines.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = lines.join(splits.toDF("_f", "_b", "_first", "_start"), (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    return manifest_rows(placed.withColumn("pos", F.col("_start") + F.col("_id") - F.col("_first"))).select("pos", "filename", "text")


def list_audio(spark: SparkSession, path: str, anchored: str = "") -> DataFrame:
    """Recordings by name: path, script_id, start_line, end_line; other names are left out.
    Contents are not read."""
    files = spark.read.format("binaryFile").load(path).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    script, start, end = audio_name_fields(name, anchored)
    return files.select("path", script.alias("script_id"), start.alias("start_line"), end.alias("end_line")).where("script_id is not null")


def discover(spark: SparkSession, audio_path: str, scripts: DataFrame) -> DataFrame:
    """Recordings with the path of their script, null if missing, by script and first line."""
    return list_audio(spark, audio_path, "wav").join(scripts.select("script_id", F.col("path").alias("script_path")), "script_id", "left").orderBy("script_id", "start_line")


def wav_samples(data: bytes, mean: bool) -> tuple[np.ndarray, int]:
    """(samples in -1..1, rate) of PCM bytes: channel 0, or the channels' mean."""
    with wave.open(io.BytesIO(data)) as f:
        channels, wide, rate, n = f.getnchannels(), f.getsampwidth(), f.getframerate(), f.getnframes()
        raw = np.frombuffer(f.readframes(n), np.uint8)
    if wide == 1:
        x = (raw.astype(np.float64) - 128) / 128
    else:
        padded = np.zeros((len(raw) // wide, 4), np.uint8)
        padded[:, 4 - wide :] = raw[: len(raw) // wide * wide].reshape(-1, wide)
        x = padded.view("<i4")[:, 0] / 2.0**31
    x = x[: len(x) // channels * channels].reshape(-1, channels)
    return (x.mean(axis=1) if mean else x[:, 0]), rate


def band_limited(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    """32-bit samples at another rate, by the signal's spectrum (all of a clip at once)."""
    if rate == target or not len(x):
        return x.astype(np.float32)
    n = max(1, round(len(x) * target / rate))
    spectrum = np.fft.rfft(x)[: n // 2 + 1]
    return (np.fft.irfft(spectrum, n) * (n / len(x))).astype(np.float32)


def read_wavs(spark: SparkSession, path: str, mean: bool = False, target: int | None = None) -> DataFrame:
    """Path, sr, samples of WAV files; unreadable files have nulls (failure type E).
    ``target``: the rate to resample to, such as a recogniser's 16,000."""

    return spark.read.format("binaryFile").load(path).select("path", wav_column("content", mean, target).alias("w")).select("path", "w.sr", "w.samples")


def wav_column(data: Column | str, mean: bool = False, target: int | None = None) -> Column:
    """S5, S5b on a column of WAV bytes: struct(sr, samples), nulls where they can't be read."""

    @F.pandas_udf("struct<sr: int, samples: array<double>>")
    def run(data: pd.Series) -> pd.DataFrame:
        rows = []
        for d in data:
            try:
                x, rate = wav_samples(d, mean)
                rows.append((rate, x) if target is None else (target, band_limited(x, rate, target).astype(np.float64)))
            except (wave.Error, EOFError, ValueError, TypeError):
                rows.append((None, None))
        return pd.DataFrame({"sr": pd.array([r for r, _ in rows], "Int32"), "samples": [x for _, x in rows]})

    return run(data)


SEGMENTS = ("audio_path string, script_id int, file_idx int, seg_idx int, start_s double, end_s double, text string, words array<struct<word:string,start:double,end:double>>")
TRANSCRIPTIONS = "filename string, tier int, prompted_text string, plain_text string"


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Recognised segments, an input table."""
    return spark.read.schema(SEGMENTS).parquet(path)


def read_transcriptions(spark: SparkSession, path: str) -> DataFrame:
    """Transcriptions of clips, null where recognition timed out (C11)."""
    return spark.read.schema(TRANSCRIPTIONS).parquet(path)


def read_checkpoint(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows done so far; a missing folder or broken lines give none."""
    try:
        rows = spark.read.schema(T.StructType([*schema, T.StructField("_broken", T.StringType())])).option("columnNameOfCorruptRecord", "_broken").json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    return rows.where(F.col("_broken").isNull() if "_broken" in rows.columns else F.lit(True)).select(*schema.names)


def sniff_encoding(spark: SparkSession, path: str) -> DataFrame:
    """Path, first 100 bytes in hex, the encodings that decode the file, and ``guess``: the one
    that a byte order mark tells, else the first that fits, else binary."""

    @F.pandas_udf("array<string>")
    def fits(data: pd.Series) -> pd.Series:
        return data.map(lambda d: [e for e in ENCODINGS if decode_bytes(d, [e])[1]])

    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.hex(F.substring("content", 1, 100)).alias("head"), fits("content").alias("fits"), F.is_valid_utf8(F.col("content").cast("string")).alias("utf8")).withColumn("guess", guessed(F.col("head"), F.col("fits")))


def guessed(head: Column, fits: Column) -> Column:
    """Encoding by byte order mark, else by trial."""
    return (
        F.when(F.startswith(head, F.lit("EFBBBF")), "utf-8-sig").when(F.startswith(head, F.lit("FFFE")), "utf-16-le").when(F.startswith(head, F.lit("FEFF")), "utf-16-be")
        .otherwise(F.coalesce(F.get(F.array_remove(fits, "utf-8-sig"), 0), F.lit("binary")))
    )


def not_done(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't in the output yet."""
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")
