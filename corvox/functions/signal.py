"""Signal metrics on arrays of samples (inventory D1-D9, D11, D12, D16, S5c).

A clip is a row with ``samples`` array<double> and a rate. Expressions here stay in the
JVM: higher-order functions over the array, no explode, no shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvox.functions.constants import FADE_IN_MS, FADE_OUT_MS, FLOOR, JUDGE_DB, MIN_GAP_MS, ONSET_SAFETY_MS, PAD_MS, PEAK_DB, PREATTACK_LEAST_MS, PREATTACK_MS, TAIL_LEAST_MS, TAIL_MS


def _mean_square(samples: Column) -> Column:
    total = F.aggregate(samples, F.lit(0.0), lambda a, x: a + x * x)
    return total / F.size(samples)


def level_db(samples: Column) -> Column:
    """RMS of samples in dB, floored."""
    return 20 * F.log10(F.greatest(F.sqrt(_mean_square(samples)), F.lit(FLOOR)))


def rms_windows(samples: Column, window: Column | int) -> Column:
    """dB of each full window in order; a last partial one is dropped; a clip without a
    full window is one value."""
    w = F.lit(window) if isinstance(window, int) else window
    n = F.floor(F.size(samples) / w).cast("int")
    each = F.transform(F.sequence(F.lit(0), n - 1), lambda k: level_db(F.slice(samples, (k * w + 1).cast("int"), w)))
    return F.when(n >= 1, each).otherwise(F.array(level_db(samples)))


def voice_span(windows: Column, length: Column, window: Column | int, threshold: float, sustained: int | None = None) -> tuple[Column, Column]:
    """(onset, offset) in samples: the first window at the threshold or over it, and the
    end of the last. None: the full range. With ``sustained`` (windows), the offset is where
    the first silence of at least that many windows begins."""
    w = F.lit(window) if isinstance(window, int) else window
    at = F.filter(F.transform(windows, lambda x, k: F.when(x >= threshold, k)), lambda k: k.isNotNull())
    last = F.array_max(at)
    if sustained:
        gap = F.filter(F.transform(at, lambda k, i: F.when(F.coalesce(F.get(at, i + 1), F.size(windows)) - k > sustained, k)), lambda k: k.isNotNull())
        last = F.coalesce(F.get(gap, 0), last)
    return F.coalesce(F.array_min(at) * w, F.lit(0)), F.when(last.isNull(), length).otherwise(F.least((last + 1) * w, length))


def edge_levels(samples: Column, edge: int) -> tuple[Column, Column, Column]:
    """D3: (first dB, last dB, passed): both edges below the judging level; a clip shorter
    than two edges passes at -100."""
    short = F.size(samples) < 2 * edge
    first = F.when(short, F.lit(-100.0)).otherwise(level_db(F.slice(samples, 1, edge)))
    last = F.when(short, F.lit(-100.0)).otherwise(level_db(F.slice(samples, F.greatest(F.size(samples) - edge + 1, F.lit(1)), edge)))
    return first, last, (first < JUDGE_DB) & (last < JUDGE_DB)


def envelope(windows: Column, length_ms: Column, window_ms: float, threshold: float = JUDGE_DB, least: tuple[float, float] = (PREATTACK_LEAST_MS, TAIL_LEAST_MS)) -> tuple[Column, Column, Column]:
    """(silence before, silence after, passed) in ms; an all-silent clip passes with its
    whole length for both."""
    at = F.filter(F.transform(windows, lambda x, k: F.when(x >= threshold, k)), lambda k: k.isNotNull())
    first, last = F.array_min(at), F.array_max(at)
    before = F.when(first.isNull(), length_ms).otherwise(first * F.lit(window_ms))
    after = F.when(last.isNull(), length_ms).otherwise(length_ms - (last + 1) * F.lit(window_ms))
    return before, after, first.isNull() | ((before >= least[0]) & (after >= least[1]))


def zero_crossing(samples: Column, centre: Column | int, reach: int) -> Column:
    """Index of the nearest sign change within ``reach`` of ``centre`` (the first of equals,
    0 counts as positive); the centre without one, or with fewer than two samples."""
    c = F.lit(centre) if isinstance(centre, int) else centre
    low, high = F.greatest(c - reach, F.lit(0)), F.least(c + reach, F.size(samples))
    positive = lambda k: F.get(samples, k) >= 0
    inside = F.when(high - low >= 2, F.sequence(low, high - 2)).otherwise(F.array().cast("array<int>"))
    changes = F.filter(inside, lambda k: positive(k) != positive(k + 1))
    nearest = F.array_min(F.transform(changes, lambda k: F.struct(F.abs(k - c).alias("d"), k.alias("k"))))
    return F.coalesce(nearest["k"], c)


def fade(samples: Column, into: Column | int, out: Column | int, linear: bool = False) -> Column:
    """Raised-cosine fades of at most a quarter of the clip at each end. D11 (``linear``):
    linear fades, left out where the clip is shorter than both."""
    n = F.size(samples)
    a, b = (F.lit(x) if isinstance(x, int) else x for x in (into, out))
    if not linear:
        a, b = F.least(a, F.floor(n / 4).cast("int")), F.least(b, F.floor(n / 4).cast("int"))
    rise = lambda k, m: k / m if linear else 0.5 * (1 - F.cos(F.lit(math.pi) * k / m))
    shaped = F.transform(samples, lambda x, i: x * F.when(i < a, rise(i, a)).otherwise(F.lit(1.0)) * F.when(i >= n - b, rise(n - 1 - i, b)).otherwise(F.lit(1.0)))
    return F.when(n <= a + b, samples).otherwise(shaped) if linear else shaped


def peak_normalised(samples: Column, peak_db: float = PEAK_DB) -> Column:
    """Scaled so that the peak stands at ``peak_db``; silence stays."""
    peak = F.array_max(F.transform(samples, F.abs))
    return F.when(peak > 0, F.transform(samples, lambda x: x * (10 ** (peak_db / 20)) / peak)).otherwise(samples)


def trimmed(samples: Column, onset: Column, offset: Column, before: int, after: int) -> Column:
    """From ``before`` samples ahead of the onset to ``after`` behind the offset; unchanged
    where that leaves nothing."""
    start, end = F.greatest(onset - before, F.lit(0)), F.least(offset + after, F.size(samples))
    return F.when(end > start, F.slice(samples, (start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int"))).otherwise(samples)


def padded(samples: Column, before: int, after: int) -> Column:
    """Silence at both ends, and samples clipped to -1..1."""
    clipped = F.transform(samples, lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)))
    return F.concat(F.array_repeat(F.lit(0.0), before), clipped, F.array_repeat(F.lit(0.0), after))


def scalar_db(samples: Column, full_scale: float = 32768.0) -> Column:
    """dB of whole-number samples against full scale; -100 for silence or no samples."""
    mean = F.sqrt(_mean_square(samples))
    return F.when((F.size(samples) == 0) | (mean == 0), F.lit(-100.0)).otherwise(20 * F.log10(mean / full_scale))


def stripped(samples: Column, before: int, after: int, least: int) -> Column:
    """The envelope off both ends, if at least ``least`` samples remain."""
    left = F.size(samples) - before - after
    return F.when(left >= least, F.slice(samples, before + 1, F.greatest(left, F.lit(0)))).otherwise(samples)


def resampled(samples: Column, n: Column) -> Column:
    """N samples at indices cut off from evenly spaced positions, first to last."""
    step = (F.size(samples) - 1) / F.greatest(n - 1, F.lit(1))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.get(samples, (k * step).cast("int")))).otherwise(F.array().cast("array<double>"))


def processed(clips: DataFrame, samples: str, out: str, rate: int, level_at: float, safety_ms: tuple[int, int], envelope_ms: tuple[int, int], fades_ms: tuple[int, int] = (FADE_IN_MS, FADE_OUT_MS), snap_ms: int | None = 10, end_level: str | None = None) -> DataFrame:
    """The post-processing chain as staged columns: snap the start to a zero crossing, trim
    to the voice with safety, fade, normalise the peak, pad. D10b: ``sliced_variant``. ``end_level``:
    a column for the level (dB) of the slice's last window before it is trimmed. Each stage is its own projection, so that none is computed twice."""
    ms = lambda x: int(rate * x / 1000)
    a = F.col("_a")
    staged = clips.withColumn("_a", F.col(samples))
    if snap_ms:
        staged = staged.withColumn("_at", zero_crossing(a, 0, ms(snap_ms))).withColumn("_a", F.slice("_a", F.col("_at") + 1, F.size("_a"))).drop("_at")
    staged = staged.withColumn("_w", rms_windows(a, ms(10)))
    if end_level:
        staged = staged.withColumn(end_level, F.coalesce(F.element_at("_w", -1), F.lit(-100.0)))
    onset, offset = voice_span(F.col("_w"), F.size("_a"), ms(10), level_at)
    staged = staged.withColumn("_on", onset).withColumn("_off", offset)
    staged = staged.withColumn("_a", trimmed(a, F.col("_on"), F.col("_off"), ms(safety_ms[0]), ms(safety_ms[1])))
    staged = staged.withColumn("_a", fade(a, ms(fades_ms[0]), ms(fades_ms[1]))).withColumn("_a", peak_normalised(a))
    return staged.withColumn(out, padded(a, ms(envelope_ms[0]), ms(envelope_ms[1]))).drop("_a", "_w", "_on", "_off")


def sliced_variant(clips: DataFrame, samples: str, start_ms: Column, end_ms: Column, next_ms: Column, out: str, rate: int, level_at: float, offset_safety_ms: int = 0, envelope_ms: tuple[int, int] = (PREATTACK_MS, TAIL_MS), right_pad: Column | None = None) -> DataFrame:
    """Slice a recording at a segment, padded by 50 ms (at the end only where the next segment
    is 30 ms or more away, or by ``right_pad``), then D10 with like fades at both ends and no
    snap. ``end_db`` is the level where the slice ends, and ``mid_speech`` whether it is over the
    level of silence, so that nothing can be trimmed there."""
    gap = F.coalesce(next_ms - end_ms, F.lit(9999))
    after = F.when(gap >= MIN_GAP_MS, F.lit(PAD_MS)).otherwise(F.lit(0)) if right_pad is None else right_pad
    first = F.greatest(F.lit(0), (rate * (start_ms - PAD_MS) / 1000).cast("int"))
    last = F.least(F.size(samples), (rate * (end_ms + after) / 1000).cast("int"))
    cut = clips.withColumn("_cut", F.slice(samples, first + 1, F.greatest(F.lit(0), last - first)))
    chain = processed(cut, "_cut", out, rate, level_at, (ONSET_SAFETY_MS, offset_safety_ms), envelope_ms, (FADE_IN_MS, FADE_IN_MS), None, "end_db")
    return chain.withColumn("mid_speech", F.col("end_db") > level_at).drop("_cut")
