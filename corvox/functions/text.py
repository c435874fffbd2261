"""Text normalisation and parsing (inventory N1-N5, P1-P11) as column expressions."""

from __future__ import annotations

import re
import string
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvox.functions.constants import FORMAL_ENDINGS_LONGEST_FIRST

#: Letters and digits one by one: Java looks these up in a table, but compares a character with each range.
ASCII = string.ascii_letters + string.digits
#: What Java's ``\\s`` with ``(?U)`` is: Unicode's white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Bytes of UTF-8: lower case of ASCII letters, those that aren't ASCII letters or digits, and those that begin no Hangul syllable.
_LOWER = bytes(range(256)).lower()
_OTHER = bytes(b for b in range(256) if chr(b) not in ASCII)
_NO_LEAD = bytes(b for b in range(256) if not 0xEA <= b <= 0xED)
_NO_LETTERS = re.compile("[^a-zA-Z0-9가-힣]+")


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Canonical composition; Spark has no built-in for it."""
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


@F.pandas_udf(T.StringType())
def four_places(x: pd.Series) -> pd.Series:
    """``%.4f`` of the exact binary value (Spark's own formatter rounds the shortest decimal)."""
    return x.map(lambda v: None if pd.isna(v) else f"{v:.4f}")


def letters_only(text: Column) -> Column:
    """Delete all but Hangul syllables and ASCII letters and digits; case stays."""
    return F.regexp_replace(text, f"[^{ASCII}가-힣]+", "")


def eval_text(text: Column, composed: bool = False) -> Column:
    """NFC, N1, lower case. ``composed``: the text is known to be in NFC already, so the
    plan needs no Python."""
    return F.lower(letters_only(text if composed else nfc(text)))


def composed_eval_text(text: str) -> str:
    """N2 of one text in NFC. A text without Hangul keeps ASCII alone, so its bytes go through a table."""
    coded = text.encode("utf-8", "replace")
    if not text.isascii() and coded.translate(None, _NO_LEAD):
        return _NO_LETTERS.sub("", text).lower()
    return coded.translate(_LOWER, _OTHER).decode("ascii")


def detector_text(text: Column, composed: bool = False) -> Column:
    """NFC, N1, case kept."""
    return letters_only(text if composed else nfc(text))


def spoken_text(text: Column) -> Column:
    """Word characters, white space and Hangul (with jamo) stay; blanks collapse; case kept."""
    kept = F.regexp_replace(text, r"(?U)[^\p{L}\p{N}_\s가-힣ㄱ-ㅎㅏ-ㅣ]", "")
    return F.trim(F.regexp_replace(kept, r"(?U)\s+", " "))


def word_list(text: Column) -> Column:
    """Words of N4; none for an empty text."""
    return F.filter(F.split(spoken_text(text), " "), lambda w: w != "")


def strip(text: Column) -> Column:
    """White space of any kind off both ends (``trim`` takes blanks only unless told)."""
    return F.trim(text, F.lit(WHITE))


def script_key(filename: Column) -> Column:
    """``Script_<n>`` of a clip name, else ``Unknown``."""
    found = F.regexp_extract(filename, r"^(Script_\d+)_", 1)
    return F.when(found == "", "Unknown").otherwise(found)


def name_parts(filename: Column) -> tuple[Column, Column]:
    """(second, third) part of a clip name at underscores, without its suffix; '' if missing."""
    parts = F.split(F.regexp_replace(filename, r"\.wav$", ""), "_")
    return F.coalesce(F.get(parts, 1), F.lit("")), F.coalesce(F.get(parts, 2), F.lit(""))


def script_number(filename: Column) -> Column:
    """The script's number anywhere in a name, else null."""
    found = F.regexp_extract(filename, r"Script_(\d+)_", 1)
    return F.when(found != "", found.cast("int"))


def trailing_line(filename: Column, suffix: str = r"\.wav") -> Column:
    """P5: the number right before the suffix, else null."""
    found = F.regexp_extract(filename, rf"(\d+){suffix}$", 1)
    return F.when(found != "", found.cast("int"))


def clip_name(script: Column, line: Column) -> Column:
    """``Script_<n>_<line, at least four digits>.wav``."""
    return F.format_string("Script_%d_%04d.wav", script.cast("long"), line.cast("long"))


def milliseconds(seconds: Column) -> Column:
    """Whole milliseconds, cut off and not rounded."""
    return (seconds * 1000).cast("int")


def parse_range(text: str, script: int | None) -> tuple[int, int]:
    """``a-b`` of a command line; needs a script to apply to."""
    first, dash, last = text.partition("-")
    if not (dash and first.isdigit() and last.isdigit()):
        raise ValueError(f"not a range: {text!r}")
    if script is None:
        raise ValueError("a range needs a script")
    return int(first), int(last)


def bucket_label(line: Column, size: int = 50) -> Column:
    """Label of the block of ``size`` lines, such as ``50-99``."""
    start = (F.floor(line / size) * size).cast("long")
    return F.concat(start.cast("string"), F.lit("-"), (start + (size - 1)).cast("string"))


def head_chars(text: Column, n: int) -> Column:
    """P10."""
    return F.substring(text, 1, n)


def tail_chars(text: Column, n: int) -> Column:
    """P10; the whole text if shorter."""
    return F.right(text, F.lit(n))


def head_words(words: Column, n: int) -> Column:
    """P11."""
    return F.array_join(F.slice(words, 1, n), " ")


def tail_words(words: Column, n: int) -> Column:
    """P11; all words if there are fewer."""
    return F.array_join(F.slice(words, F.greatest(F.size(words) - n + 1, F.lit(1)), n), " ")


def audio_name_fields(name: Column, anchored: str = "") -> tuple[Column, Column, Column]:
    """(script, start, end) of ``Script_<n>_<start>-<end>``, else nulls. ``anchored``: ``start``
    asks for it at the start of the name (S4c), ``wav`` for the whole of ``....wav`` (S4b)."""
    pattern = r"Script_(\d+)_(\d+)-(\d+)"
    pattern = {"": pattern, "start": "^" + pattern, "wav": "^" + pattern + r"\.wav$"}[anchored]
    parts = [F.regexp_extract(name, pattern, k) for k in (1, 2, 3)]
    return tuple(F.when(p != "", p.cast("int")) for p in parts)


def first_suffix(text: Column, patterns: list[str] | None = None) -> Column:
    """the first of ``patterns`` that the text ends with, else null. The order is the
    priority: longest first finds the most specific one, shortest first the least."""
    listed = F.array(*map(F.lit, FORMAL_ENDINGS_LONGEST_FIRST if patterns is None else patterns))
    return F.get(F.filter(listed, lambda p: F.endswith(text, p)), 0)
