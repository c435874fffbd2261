"""Similarity and scoring (inventory Y1-Y11)."""

from __future__ import annotations

from collections import Counter
from difflib import SequenceMatcher
from itertools import repeat
from operator import contains

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvox.functions.constants import PASS_AT


def with_edit_similarity(df: DataFrame, truth: str, heard: str, prefix: str = "") -> DataFrame:
    """Add ``dist``, ``max_len``, ``cer``, ``similarity`` of two normalised columns.

    Both empty: (0, 1); one empty: (1, 0). The distance is computed once, in its own
    projection, and the rates follow from it.
    """
    measured = df.withColumn(prefix + "dist", edit_distance(F.col(truth), F.col(heard))).withColumn(prefix + "max_len", F.greatest(F.length(truth), F.length(heard)))
    return measured.withColumn(prefix + "cer", error_rate(F.col(prefix + "dist"), F.col(prefix + "max_len"))).withColumn(prefix + "similarity", 1 - F.col(prefix + "cer"))


def with_edit_score(df: DataFrame, truth: str, heard: str, least: str) -> DataFrame:
    """Y2 as ``score``, null where it is below the column ``least``: a distance beyond what that
    allows isn't computed to its end."""
    longest = F.greatest(F.length(truth), F.length(heard))
    most = F.greatest(F.lit(0), F.ceil((1 - F.col(least)) * longest + 1e-6)).cast("int")
    measured = df.withColumns({"_longest": longest, "_dist": edit_distance_within(F.col(truth), F.col(heard), most)})
    return measured.withColumn("score", F.when(F.col("_dist") >= 0, 1 - error_rate(F.col("_dist"), F.col("_longest")))).drop("_longest", "_dist")


def _follows(short: str, long: str) -> bool:
    """Whether ``short`` is ``long`` with characters left out: each is looked for where the one before was found."""
    return all(map(contains, repeat(iter(long)), short))


def distance(a: str, b: str, most: int | None = None) -> int:
    """The Levenshtein distance, or -1 if it is more than ``most``.

    Equal ends don't count; a text that only lacks characters of the other is as far from it as
    they differ in length, which is never less than that. What is left goes through Myers' and
    Hyyro's bit vectors: a column of the table is two whole numbers, so a character costs a few
    operations on as many bits as the shorter text is long.
    """
    if a == b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    most = len(b) if most is None else most
    if len(b) - len(a) > most:
        return -1
    if a and (a[0] == b[0] or a[-1] == b[-1]):
        start, n = 0, len(a)
        while start < n and a[start] == b[start]:
            start += 1
        end = 0
        while end < n - start and a[-1 - end] == b[-1 - end]:
            end += 1
        a, b = a[start : n - end], b[start : len(b) - end]
    if not a or _follows(a, b):
        return len(b) - len(a)
    n, places = len(a), {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    full, top, up, down, found, left = (1 << n) - 1, 1 << (n - 1), (1 << n) - 1, 0, n, len(b)
    for c in b:
        eq = places.get(c, 0)
        same = (((eq & up) + up) ^ up) | eq | down
        rise, fall = down | (full & ~(same | up)), up & same
        left -= 1
        if rise & top:
            found += 1
            if found - left > most:
                return -1
        elif fall & top:
            found -= 1
        rise = rise << 1 | 1
        up, down = full & (fall << 1 | ~(same | rise)), rise & same
    return found if found <= most else -1


@F.pandas_udf(T.IntegerType())
def edit_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Y1 over batches; null if either text is."""
    return pd.Series([None if x is None or y is None else distance(x, y) for x, y in zip(a, b, strict=True)], dtype="Int32")


edit_distance = edit_distance.asNondeterministic()  # it isn't; but a filter on it would be moved before it, and compute it twice


@F.pandas_udf(T.IntegerType())
def edit_distance_within(a: pd.Series, b: pd.Series, most: pd.Series) -> pd.Series:
    """Y1, -1 where it is more than ``most``."""
    return pd.Series([None if x is None or y is None or m != m else distance(x, y, int(m)) for x, y, m in zip(a, b, most, strict=True)], dtype="Int32")


def edit_ceiling(a: Column, b: Column) -> Column:
    """The highest Y2 of two texts of these lengths."""
    return F.when((a == 0) & (b == 0), F.lit(1.0)).otherwise(F.least(a, b) / F.greatest(a, b))


def ratio_ceiling(a: Column, b: Column) -> Column:
    """The highest Y3 of two texts of these lengths."""
    return F.when((a == 0) & (b == 0), F.lit(1.0)).otherwise(2 * F.least(a, b) / (a + b))


def error_rate(dist: Column, max_len: Column) -> Column:
    return F.when(max_len == 0, F.lit(0.0)).otherwise(dist / max_len)


def block_ratio(a: str | None, b: str | None) -> float | None:
    """Ratcliff-Obershelp ratio of the standard library, junk heuristic and all; its
    argument order matters."""
    return None if a is None or b is None else SequenceMatcher(None, a, b).ratio()


POPULAR_FROM = 200  # Fixed value: the standard library's length from which frequent characters begin no block
LARGEST = 1 << 22  # bits of a table of equal characters


class Second:
    """A second text of block ratios, with what is known of it: counts, and where its characters are."""

    def __init__(self, text: str):
        self.text, self.length, self.counts = text, len(text), Counter(text)
        self.matcher, self.rows, self.width = None, {}, 0

    def table(self, a: str) -> int:
        """Where the characters of ``a`` and of this text are equal (frequent ones apart), as bits: a row for each of ``a``, wide enough for
        a zero at its end, so that runs along a diagonal end there."""
        if not self.width:
            self.width = self.length // 8 * 8 + 8
            places: dict[str, int] = {}
            most = self.length // 100 + 1 if self.length >= POPULAR_FROM else self.length
            for k, c in enumerate(self.text):
                if self.counts[c] <= most:
                    places[c] = places.get(c, 0) | 1 << k
            self.rows = {c: bits.to_bytes(self.width // 8, "little") for c, bits in places.items()}
        for c in set(a) - self.rows.keys():
            self.rows[c] = bytes(self.width // 8)
        return int.from_bytes(b"".join(map(self.rows.__getitem__, a)), "little")


def repeated(bits: int, width: int, times: int) -> int:
    """``bits`` in each of ``times`` rows of ``width``."""
    return int.from_bytes(bits.to_bytes(width // 8, "little") * times, "little")


def longest_run(table: int, step: int) -> tuple[int, int]:
    """(length, place) of the longest diagonal run of a table of bits, of equals the first one's; (0, 0) without any."""
    if not table:
        return 0, 0
    size = 1
    kept, by = [(table, 1)], table
    while (longer := by & by >> size * step):  # runs of twice the length
        size *= 2
        by = longer
        kept.append((by, size))
    found, at = size, by
    for known, length in reversed(kept[:-1]):  # and what is between
        if (longer := at & known >> found * step):
            at, found = longer, found + length
    return found, (at & -at).bit_length() - 1


def block_ratio_from(a: str, second: Second, least: float = 0.0) -> float:
    """Y3, the standard library's ratio to the bit, or -1 if it is certainly below ``least``.

    A longest block is a longest run in a table of bits, found in a few operations on whole
    numbers; from 200 characters on frequent ones begin no block, but lengthen those found.
    Tables beyond LARGEST bits are left to the standard library's search. What blocks can still
    come is bounded by the ranges left, so a ratio out of reach isn't computed to its end.
    """
    n, m, b = len(a), second.length, second.text
    if not n + m:
        return 1.0
    if 2.0 * min(n, m) / (n + m) < least:
        return -1.0
    popular = m >= POPULAR_FROM
    if a == b and not popular:
        return 1.0
    whole, total, left = n + m, 0, min(n, m)
    tabled = n * m <= LARGEST
    if tabled:
        table, width = second.table(a), second.width
    else:
        if second.matcher is None:
            second.matcher = SequenceMatcher(None, "", b)
        second.matcher.set_seq1(a)
    todo = [(0, n, 0, m)]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        left -= min(ahi - alo, bhi - blo)
        if tabled:
            part = (table >> alo * width) & ((1 << (ahi - alo) * width) - 1) if alo or ahi < n else table
            if part and (blo or bhi < m):
                part &= repeated((1 << bhi) - (1 << blo), width, ahi - alo)
            size, at = longest_run(part, width + 1)
            i, j = (alo + at // width, at % width) if size else (alo, blo)
            if popular:
                while i > alo and j > blo and a[i - 1] == b[j - 1]:
                    i, j, size = i - 1, j - 1, size + 1
                while i + size < ahi and j + size < bhi and a[i + size] == b[j + size]:
                    size += 1
        else:
            i, j, size = second.matcher.find_longest_match(alo, ahi, blo, bhi)
        if size:
            total += size
            if alo < i and blo < j:
                todo.append((alo, i, blo, j))
                left += min(i - alo, j - blo)
            if i + size < ahi and j + size < bhi:
                todo.append((i + size, ahi, j + size, bhi))
                left += min(ahi - i - size, bhi - j - size)
        if 2.0 * (total + left) / whole < least:
            return -1.0
    return 2.0 * total / whole


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Y3 over batches; pairs that repeat in a batch are scored once."""
    known: dict = {}
    return pd.Series([known[p] if p in known else known.setdefault(p, block_ratio(*p)) for p in zip(a, b, strict=True)], dtype="float64")


def guarded_ratio(a: Column, b: Column) -> Column:
    """Both empty 1, one empty 0, else Y3."""
    return F.when((a == "") & (b == ""), F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(ratio(a, b))


def adjusted(score: Column, skipped: Column, penalty: float = 0.01) -> Column:
    """A score less a penalty for each script line skipped."""
    return score - penalty * skipped


def with_bonus(score: Column, line: Column, expected: Column, bonus: float = 0.05) -> Column:
    """The expected line's bonus, which counts toward thresholds."""
    return score + F.when(line == expected, F.lit(bonus)).otherwise(F.lit(0.0))


def words_in_blocks(heard: list[str], answer: list[str]) -> float:
    """Words in matching blocks over the answer's words; both empty 1, one empty 0."""
    if not heard and not answer:
        return 1.0
    if not heard or not answer:
        return 0.0
    return sum(b.size for b in SequenceMatcher(None, heard, answer).get_matching_blocks()) / len(answer)


@F.pandas_udf(T.DoubleType())
def word_block_score(heard: pd.Series, answer: pd.Series) -> pd.Series:
    return pd.Series([None if h is None or a is None else words_in_blocks(list(h), list(a)) for h, a in zip(heard, answer, strict=True)], dtype="float64")


def word_membership_score(heard: Column, answer: Column) -> Column:
    """Share of the heard words that the answer contains; null without heard words."""
    return F.when(F.size(heard) > 0, F.size(F.filter(heard, lambda w: F.array_contains(answer, w))) / F.size(heard))


def best_of_two(prompted: Column, plain: Column, prompted_text: Column, plain_text: Column) -> tuple[Column, Column]:
    """(score, text) of the better transcription. The plain one is looked at only where
    the prompted one is below the pass mark, and wins only if strictly better; without a
    positive score the text is empty."""
    a = F.coalesce(prompted, F.lit(0.0))
    b = F.when(a < PASS_AT, F.coalesce(plain, F.lit(0.0))).otherwise(F.lit(0.0))
    score = F.greatest(a, b)
    return score, F.when(score <= 0, F.lit("")).when(b > a, plain_text).otherwise(prompted_text)


def missing_suffix(truth: Column, heard: Column, pattern: Column) -> Column:
    """The smallest cut of the truth's end (1 to pattern length + 5, less than the truth)
    whose last six characters before it end the heard text; 0 if none."""
    last = F.least(F.length(pattern) + 5, F.length(truth) - 1)
    cuts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    fits = F.filter(cuts, lambda c: F.endswith(heard, F.right(F.left(truth, F.length(truth) - c), F.lit(6))))
    return F.coalesce(F.get(fits, 0), F.lit(0))


def tails_equal(truth: Column, heard: Column, n: int = 4) -> Column:
    """The last n characters (all if fewer) agree."""
    return F.right(truth, F.lit(n)) == F.right(heard, F.lit(n))
