"""Media columns: audio features of 8-bit sound held in binary columns.

Sound is stored as 8-bit mono WAV bytes. Features: polyphase resampling, log-mel
filterbanks over overlapped frames, and segments by energy with hysteresis. Frames are
grouped into windows of a fixed shape (``WINDOW`` frames x ``BANDS`` bands), one row of an
Arrow fixed-shape tensor column each, with the window's time span.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvox.llm._shared import materialize, small_batches

RATE, UP, DOWN, TAPS = 16_000, 1, 2, 32
FRAME, HOP, BANDS, WINDOW = 256, 128, 16, 32
BLOCK = 1 << 18  # samples worked on at a time; a multiple of DOWN * HOP / UP
RISE_DB, FALL_DB = 1.5, 0.5
UNIT = 64  # payloads are padded to a multiple of this


def encode_wav(payload: bytes, rate: int = RATE) -> bytes:
    """8-bit unsigned mono PCM in a RIFF container (chunks are padded to even sizes)."""
    pad = len(payload) % 2
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload) + pad, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload))
    return head + payload + b"\0" * pad


def decode_wav(media: bytes) -> tuple[bytes, int]:
    """(samples, rate) of a mono 8-bit PCM file; unknown chunks are skipped."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, rate = 12, None
    while at + 8 <= len(media):
        kind, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if kind == b"fmt ":
            code, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (code, channels, bits) != (1, 1, 8):
                raise ValueError("only 8-bit mono PCM is read")
        elif kind == b"data":
            return media[at + 8 : at + 8 + size], rate or RATE
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def payload_of(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8")
    return raw + b"\0" * ((-len(raw)) % UNIT or (0 if raw else UNIT))


@lru_cache(maxsize=8)
def fir(up: int, down: int) -> np.ndarray:
    """Windowed-sinc low-pass of TAPS taps a phase; row p holds phase p."""
    n = np.arange(TAPS * up) - (TAPS * up - 1) / 2
    h = np.sinc(n / max(up, down)) * np.hamming(TAPS * up)
    return (h * up / h.sum()).reshape(TAPS, up).T.astype(np.float32)


def resample(x: np.ndarray, up: int = UP, down: int = DOWN) -> np.ndarray:
    """Polyphase resampling by up/down: only the outputs that are kept are computed, each
    with the taps of its own phase."""
    out = -(-len(x) * up // down)
    y, bank, padded = np.zeros(out, np.float32), fir(up, down), np.concatenate([np.zeros(TAPS, np.float32), x, np.zeros(down + TAPS, np.float32)])
    for r in range(min(up, out)):
        phase, first, n = (r * down) % up, (r * down) // up, len(range(r, out, up))
        part = np.zeros(n, np.float32)
        for k in range(TAPS):
            at = TAPS + first - k + TAPS // 2
            part += bank[phase, k] * padded[at : at + (n - 1) * down + 1 : down]
        y[r::up] = part
    return y


@lru_cache(maxsize=4)
def mel_bank(rate: int) -> np.ndarray:
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(20), mel(rate / 2), BANDS + 2) / 2595) - 1)
    bins = np.fft.rfftfreq(FRAME, 1 / rate)
    rise = (bins[None] - edges[:-2, None]) / np.diff(edges)[:-1, None]
    fall = (edges[2:, None] - bins[None]) / np.diff(edges)[1:, None]
    return np.maximum(0, np.minimum(rise, fall)).T.astype(np.float32)


HANN = np.hanning(FRAME + 1)[:-1].astype(np.float32)


def log_mel(payload: bytes, rate: int = RATE) -> np.ndarray:
    """Frames x BANDS, in dB. Whole payload, in blocks: memory doesn't grow with its length
    but for the result; a block brings the samples that its last frames overlap."""
    n_out = -(-len(payload) * UP // DOWN)
    frames = max(1, 1 + -(-(n_out - FRAME) // HOP))
    out = np.empty((frames, BANDS), np.float32)
    step, margin = BLOCK, 4 * TAPS * DOWN
    raw, bank, done = np.frombuffer(payload, np.uint8), mel_bank(rate * UP // DOWN), 0
    for at in range(0, max(1, len(raw)), step):
        first = max(0, at - margin)
        x = (raw[first : at + step + margin + FRAME * DOWN // UP].astype(np.float32) - 128) / 128
        y = resample(x)[(at - first) * UP // DOWN :]
        n = min(frames - done, step * UP // DOWN // HOP)
        if n <= 0:
            break
        y = np.concatenate([y, np.zeros(max(0, (n - 1) * HOP + FRAME - len(y)), np.float32)])
        view = np.lib.stride_tricks.sliding_window_view(y, FRAME)[: (n - 1) * HOP + 1 : HOP]
        power = np.abs(np.fft.rfft(view * HANN, axis=1)).astype(np.float32) ** 2
        out[done : done + n] = 10 * np.log10(power @ bank + 1e-6)
        done += n
    return out


def segments(mel: np.ndarray, rate: int = RATE) -> list[tuple[float, float]]:
    """Time spans of sound: a span opens where a frame's level is RISE_DB over the median
    and closes where it falls below FALL_DB over it."""
    level = mel.mean(axis=1, dtype=np.float64)
    rest = np.median(level)
    mark = np.where(level >= rest + RISE_DB, 1, np.where(level < rest + FALL_DB, -1, 0))
    known = np.maximum.accumulate(np.where(mark != 0, np.arange(len(mark)), -1))
    on = (known >= 0) & (mark[known] == 1)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]])))
    second = HOP * DOWN / (UP * rate)
    return [(float(a * second), float(b * second)) for a, b in edge.reshape(-1, 2)]


def tensors(mel: np.ndarray, rate: int = RATE) -> tuple[pa.ExtensionArray, list[tuple[float, float]]]:
    """Windows of WINDOW frames as an Arrow fixed-shape tensor array (the last is padded
    with its lowest value), and their time spans."""
    n = -(-len(mel) // WINDOW)
    full = np.full((n * WINDOW, BANDS), mel.min(), np.float32)
    full[: len(mel)] = mel
    second = HOP * DOWN / (UP * rate)
    spans = [(k * WINDOW * second, min((k + 1) * WINDOW, len(mel)) * second) for k in range(n)]
    return pa.FixedShapeTensorArray.from_numpy_ndarray(full.reshape(n, WINDOW, BANDS)), spans


def audio_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its text's bytes written as a media column, and digests of
    the sound and the feature tensors that are read back (both are written tables).

    ``feature`` has the file's frames, segments, sounding time and mean level a band, and its
    windows with a hash of their tensors and time spans. Null and empty texts are one block
    of zero bytes. Equal texts get equal values; ties, repeated rows and null ids pass
    through. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    of_id = source.schema["_id"].dataType.simpleString()

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            columns = [pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array([encode_wav(payload_of(t)) for t in texts], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["_row", "_id", "n_bytes", "media"])

    media = materialize(source.mapInArrow(store, f"_row long, _id {of_id}, n_bytes long, media binary"), "audio-media")

    def sound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string()}
        for batch in batches:
            rows = []
            for data in batch.column(3).to_pylist():
                payload, _ = decode_wav(data)
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(data), hashlib.sha256(data).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(c, t) for c, t in zip(columns, fields.values(), strict=True))], names=["_row", "_id", "n_bytes", *fields])

    sounds = media.mapInArrow(sound, f"_row long, _id {of_id}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string")
    features = materialize(audio_features(media, "_row", "media"), "audio-features")
    described = sounds.join(feature_digests(features, "_row"), "_row")
    return described.select(F.col("_id").alias(id_col), "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def feature_digests(features: DataFrame, id_col: str) -> DataFrame:
    """id and feature of each file in ``features``, the rows of ``audio_features``; ids must
    be unique by file. Band sums are whole thousandths of a dB, so that the order of windows
    doesn't change them."""
    small_batches(features.sparkSession)
    source = features.select(F.col(id_col).alias("_id"), "window", "start_s", "end_s", "tensor", F.when(F.col("window") == 0, F.col("segments")).alias("segments"))
    second = HOP * DOWN / (UP * RATE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frames = [round((b - a) / second) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            shaped = as_tensor(batch.column(4)).to_numpy_ndarray() if batch.num_rows else []
            sums = [np.rint(1000 * t[:n].sum(axis=0, dtype=np.float64)).astype(np.int64) for t, n in zip(shaped, frames, strict=True)]
            crc = [zlib.crc32(struct.pack("<2d", a, b) + t.tobytes()) for a, b, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), shaped, strict=True)]
            found = [(len(s or ()), sum(x["end_s"] - x["start_s"] for x in s or ())) for s in batch.column(5).to_pylist()]
            columns = [pa.array(frames, pa.int64()), pa.array(crc, pa.int64()), pa.array([n for n, _ in found], pa.int64()), pa.array([float(x) for _, x in found], pa.float64()), *(pa.array([s[k] for s in sums], pa.int64()) for k in range(BANDS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["_id", "window", "frames", "crc", "segments", "sound", *(f"b{k}" for k in range(BANDS))])

    bands = ", ".join(f"b{k} long" for k in range(BANDS))
    windows = source.mapInArrow(run, f"_id {source.schema['_id'].dataType.simpleString()}, window int, frames long, crc long, segments long, sound double, {bands}")
    marks = F.transform(F.array_sort(F.collect_list(F.struct("window", "crc"))), lambda w: w["crc"].cast("string"))
    files = windows.groupBy("_id").agg(
        F.sum("frames").alias("frames"), F.sum("segments").alias("segments"), F.max("sound").alias("sound"), F.count(F.lit(1)).alias("windows"),
        F.crc32(F.array_join(marks, ",").cast("binary")).alias("hash"), *(F.sum(f"b{k}").alias(f"b{k}") for k in range(BANDS)),
    )
    means = F.concat_ws(",", *(F.format_string("%.1f", F.col(f"b{k}") / 1000 / F.col("frames")) for k in range(BANDS)))
    return files.select(F.col("_id").alias(id_col), F.format_string("frames=%d;segments=%d;sound=%.3f;mel=%s;windows=%d;tensors=%08x", "frames", "segments", "sound", means, "windows", "hash").alias("feature"))


def audio_features(media: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """One row per window of each WAV in ``media_col``: id, window, start_s, end_s, tensor
    (WINDOW * BANDS floats; ``as_tensor`` gives it its shape) and the file's segments.
    Null media gives no rows."""
    small_batches(media.sparkSession)
    source = media.select(F.col(id_col).alias("_id"), F.col(media_col).alias("_media")).where(F.col("_media").isNotNull())
    span = T.ArrayType(T.StructType([T.StructField("start_s", T.DoubleType()), T.StructField("end_s", T.DoubleType())]))
    schema = T.StructType([T.StructField("_id", source.schema["_id"].dataType), T.StructField("window", T.IntegerType()), T.StructField("start_s", T.DoubleType()), T.StructField("end_s", T.DoubleType()), T.StructField("tensor", T.ArrayType(T.FloatType())), T.StructField("segments", span)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow_span = pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))
        for batch in batches:
            parts = []
            for row, data in enumerate(batch.column(1)):
                payload, rate = decode_wav(data.as_py())
                mel = log_mel(payload, rate)
                found = [{"start_s": a, "end_s": b} for a, b in segments(mel, rate)]
                tensor, spans = tensors(mel, rate)
                n = len(spans)
                parts.append([batch.column(0).take(pa.array([row] * n, pa.int64())), pa.array(range(n), pa.int32()), pa.array([a for a, _ in spans], pa.float64()), pa.array([b for _, b in spans], pa.float64()), tensor.storage.cast(pa.list_(pa.float32())), pa.array([found] * n, arrow_span)])
            if parts:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(column) for column in zip(*parts, strict=True)], names=["_id", "window", "start_s", "end_s", "tensor", "segments"])

    return source.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def as_tensor(column: pa.Array | pa.ChunkedArray) -> pa.ExtensionArray:
    """The ``tensor`` column of an Arrow table of ``audio_features`` as fixed-shape tensors."""
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return pa.ExtensionArray.from_storage(pa.fixed_shape_tensor(pa.float32(), (WINDOW, BANDS)), pa.FixedSizeListArray.from_arrays(flat, WINDOW * BANDS))
