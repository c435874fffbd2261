"""Language identification by words first, backing off to shorter character n-grams.

A known word is scored by its log frequency in each language. A word that no language has
is scored by its longest known character n-grams: those of ``MAX_N`` characters if any is
known, else one character fewer, and so on. A text's language is the one with the highest
sum over its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvox.llm._shared import small_batches

WORD = re.compile(r"[^\W\d_]+")
MAX_N, CACHE_WORDS, SMOOTH = 5, 200_000, 0.5
EVIDENCE = 25  # words' worth of evidence that a long text's score rests on, at most
UNDETERMINED = "und"


def words(text: str | None) -> list[str]:
    """Runs of letters (and of what the pattern can't tell from them, such as superscript
    digits); none where no character is a letter."""
    found = WORD.findall((text or "").lower())
    return found if any(map(str.isalpha, found)) or any(c.isalpha() for w in found for c in w) else []


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies: ``words`` and, by n, ``grams`` hold one row of numbers a key, one
    number a language."""

    def __init__(self, samples: list[tuple[str, str]]):
        self.langs = sorted({lang for lang, text in samples if words(text)})
        counts = {lang: Counter() for lang in self.langs}
        for lang, text in samples:
            if lang in counts:
                counts[lang].update(words(text))
        self.words = self.table({lang: c for lang, c in counts.items()})
        self.grams = {}
        for n in range(1, MAX_N + 1):
            by_lang = {lang: Counter() for lang in self.langs}
            for lang, c in counts.items():
                for word, k in c.items():
                    for gram in grams(word, n):
                        by_lang[lang][gram] += k
            self.grams[n] = self.table(by_lang)

    def table(self, counts: dict[str, Counter]) -> dict[str, np.ndarray]:
        keys = sorted(set().union(*counts.values()))
        total = np.array([sum(counts[lang].values()) for lang in self.langs], np.float64)
        values = np.array([[counts[lang][k] for lang in self.langs] for k in keys], np.float64).reshape(len(keys), len(self.langs))
        logs = np.log((values + SMOOTH) / (total + SMOOTH * max(1, len(keys)))).astype(np.float32)
        return dict(zip(keys, logs, strict=True))

    def backoff(self, word: str) -> np.ndarray:
        for n in range(min(MAX_N, len(word) + 2), 0, -1):
            table = self.grams[n]
            found = [table[g] for g in grams(word, n) if g in table]
            if found:
                return np.mean(found, axis=0)
        return np.zeros(len(self.langs), np.float32)


class Predictor:
    def __init__(self, model: Model):
        self.model, self.at, self.rows = model, {}, np.empty((0, len(model.langs)), np.float32)

    def learn(self, new: list[str]) -> None:
        known = self.model.words
        rows = [known[w] if w in known else self.model.backoff(w) for w in new]
        self.at.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
        self.rows = np.concatenate([self.rows, np.array(rows, np.float32).reshape(len(new), self.rows.shape[1])])

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        langs = self.model.langs
        for k in range(0, len(texts), 256):
            if len(self.at) > CACHE_WORDS:
                self.at, self.rows = {}, self.rows[:0]
            some = [words(t) for t in texts[k : k + 256]]
            new: set[str] = set()
            for found in some:
                new.update(filterfalse(self.at.__contains__, found))
            self.learn(sorted(new))
            for found in some:
                if not found or not langs:
                    yield UNDETERMINED, 0.0
                    continue
                mean = self.rows[np.fromiter(map(self.at.__getitem__, found), np.int64, len(found))].mean(axis=0, dtype=np.float64)
                best = int(np.argmax(mean))
                yield langs[best], float(1 / np.exp((mean - mean[best]) * min(len(found), EVIDENCE)).sum())


def labelled_sample(docs: DataFrame, text_col: str, lang_col: str, id_col: str, usable: Column, rows_per_lang: int) -> list[tuple[str, str]]:
    """About ``rows_per_lang`` labelled rows of each language, chosen by a hash of the id."""
    rows = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    counts = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().collect()}
    if not counts:
        return []
    unit = F.pmod(F.xxhash64(F.lit("langid"), F.col("_id")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("_lang") == lang, F.lit(min(1.0, rows_per_lang / n))).otherwise(share)
    return sorted((r["_lang"], r["_text"]) for r in rows.where(unit < share).select("_lang", "_text").distinct().collect())


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: Column | None = None, rows_per_lang: int = 400) -> DataFrame:
    """One row per row of ``docs``: id, lang_pred, score (0 to 1, a softmax over languages).

    Learns from the text and non-null language of rows for which ``held_out`` doesn't hold,
    at most about ``rows_per_lang`` rows a language (a documented bound of the fit; whole
    texts). Predictions see the text alone, all of it. Null and empty texts and texts
    without letters are ``und`` with score 0, as is everything if nothing could be learned.
    Of equally likely languages the first in order of names is given. Repeated rows are
    predicted alike, null ids pass through, other columns are not read.
    """
    small_batches(docs.sparkSession)
    usable = F.lit(True) if held_out is None else ~held_out
    model = docs.sparkSession.sparkContext.broadcast(Model(labelled_sample(docs, text_col, lang_col, id_col, usable, rows_per_lang)))
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(model.value)
        for batch in batches:
            found = list(predictor.predict(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())], names=["_id", "lang_pred", "score"])

    kind = source.schema["_id"].dataType.simpleString()
    return source.mapInArrow(run, f"_id {kind}, lang_pred string, score double").withColumnRenamed("_id", id_col)
