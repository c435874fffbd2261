"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

Each word is the mean of the vectors of its hashed character n-grams (and of itself), a
document is the mean of its distinct words, and a linear softmax with two outputs sits on
top. Vectors and softmax are learned together by full-batch Adam on a bounded sample of
labelled rows. Because everything above the vectors is linear, the trained model is one
number per n-gram bucket; a misspelt word shares most buckets with the word it hides.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvox.llm._shared import free_name, small_batches

STRIP = ".,;:!?\"'()[]{}|*#$%&-_/\\<>+=~^`"
BITS, DIM, SCALE, THREADS = 17, 8, 60.0, 4
BUCKETS = 1 << BITS
BASE, MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
MIN_N, MAX_N = 3, 5
CACHE_WORDS = 200_000


def subwords(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, word numbers) of all words: each word itself and its character n-grams,
    with marks at both ends."""
    marked = [f"<{w.strip(STRIP)}>" for w in found]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(marked), dtype=np.int32), sizes)
    place = np.arange(len(codes)) - starts[owner]
    left = sizes[owner] - place
    powers = np.cumprod(np.full(int(sizes.max()), BASE, np.uint64))
    hashes, owners = [np.add.reduceat(codes * powers[place], starts)], [np.arange(len(marked), dtype=np.int32)]
    for n in range(MIN_N, MAX_N + 1):
        h = np.full(max(0, len(codes) - n + 1), n, np.uint64)
        for k in range(n):
            h = h * BASE + codes[k : k + len(h)]
        inside = left[: len(h)] >= n
        hashes.append(h[inside])
        owners.append(owner[: len(h)][inside])
    mixed = np.concatenate(hashes) * MIX
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * MIX) >> np.uint64(64 - BITS)).astype(np.int32), np.concatenate(owners)


def words(text: str | None) -> set[str]:
    """Distinct lower-cased words of the whole text; marks around them are cut off later."""
    return set((text or "").lower().split())


def train(texts: list[str], labels: list[int], epochs: int = 60, rate: float = 0.12, decay: float = 1e-5, seed: int = 7) -> tuple[np.ndarray, float]:
    """Return (score of each bucket, bias): the softmax's margin for toxic.

    One class alone, or no row, gives a model with that class's constant score.
    """
    y = np.asarray(labels, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return np.zeros(BUCKETS), (8.0 if len(y) and y[0] else -8.0)
    index: dict[str, int] = {}
    doc_words, lengths = array("i"), []
    for text in texts:
        ids = [index.setdefault(w, len(index)) for w in sorted(words(text))]
        doc_words.extend(ids)
        lengths.append(len(ids))
    if not index:
        return np.zeros(BUCKETS), float(np.log(y.mean() / (1 - y.mean())))
    blocks, known = [], list(index)
    for k in range(0, len(known), 20_000):  # in blocks, so that work arrays stay small
        flat, owner = subwords(known[k : k + 20_000])
        blocks.append((flat, owner, k, min(k + 20_000, len(known))))
    per_word = np.concatenate([np.bincount(owner, minlength=b - a) for _, owner, a, b in blocks])
    doc_words, lengths = np.frombuffer(doc_words, np.int32), np.array(lengths)
    doc_of = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    share = SCALE / np.maximum(lengths, 1)
    weight = np.where(y > 0, 0.35 / y.sum(), 0.65 / (len(y) - y.sum()))  # rejecting a clean text costs more

    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.05, (DIM, BUCKETS))
    softmax = rng.normal(0, 0.5, (DIM, 2))
    bias = np.zeros(2)
    params = [vectors, softmax, bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    target = np.stack([1 - y, y], axis=1)
    doc_vec, by_gram = np.empty((len(y), DIM)), np.empty_like(vectors)

    def forward(d: int) -> None:
        word_value = np.concatenate([np.bincount(owner, vectors[d][flat], b - a) for flat, owner, a, b in blocks]) / per_word
        doc_vec[:, d] = np.bincount(doc_of, word_value[doc_words], len(y)) * share

    def backward(d: int) -> None:
        g_word = np.bincount(doc_words, g_doc[:, d][doc_of], len(per_word)) / per_word
        by_gram[d] = decay * vectors[d]
        for flat, owner, a, b in blocks:
            by_gram[d] += np.bincount(flat, g_word[a:b][owner], BUCKETS)

    pool = ThreadPoolExecutor(THREADS)  # dimensions are worked on side by side; each one's sums keep their order
    for step in range(1, epochs + 1):
        list(pool.map(forward, range(DIM)))
        logits = doc_vec @ softmax + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = (p - target) * weight[:, None]
        g_doc = g @ softmax.T * share[:, None]
        list(pool.map(backward, range(DIM)))
        for param, grad, (m, v) in zip(params, [by_gram, doc_vec.T @ g, g.sum(axis=0)], moments, strict=True):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            param -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    pool.shutdown()
    scores = (softmax[:, 1] - softmax[:, 0]) @ vectors * SCALE
    return scores, float(bias[1] - bias[0])


class Scorer(dict):
    """Scores texts; remembers the words that it has seen, up to ``CACHE_WORDS``.

    Word scores are held as whole numbers, so that sums don't depend on the order of words.
    """

    UNIT = 1 << 24

    def __init__(self, scores: np.ndarray, bias: float):
        super().__init__()
        self.scores, self.bias = scores, bias

    def learn(self, found: list[str]) -> None:
        for k in range(0, len(found), 20_000):
            part = found[k : k + 20_000]
            buckets, owner = subwords(part)
            mean = np.bincount(owner, self.scores[buckets], len(part)) / np.bincount(owner, minlength=len(part))
            self.update(zip(part, np.rint(mean * self.UNIT).astype(np.int64).tolist(), strict=True))

    def score(self, texts: list[str | None]) -> Iterator[float]:
        for k in range(0, len(texts), 64):
            if len(self) > CACHE_WORDS:
                self.clear()
            some = [words(t) for t in texts[k : k + 64]]
            new: set[str] = set()
            for found in some:
                new.update(filterfalse(self.__contains__, found))
            self.learn(list(new))
            for found in some:
                margin = self.bias + sum(map(self.__getitem__, found)) / (self.UNIT * max(1, len(found)))
                yield 1 / (1 + math.exp(-min(30.0, max(-30.0, margin))))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, usable: Column, bounds: dict[int, int]) -> DataFrame | None:
    """At most about ``bounds[y]`` rows (_id, _text, _y) of class y, chosen by a hash of the id."""
    usable_labels = labels.where(F.col(label_col).isin(0, 1) & usable).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y")).distinct()
    counts = {r["_y"]: r["count"] for r in usable_labels.groupBy("_y").count().collect()}
    if not counts:
        return None
    unit = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("_id")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("_y") == label, F.lit(min(1.0, bounds[label] / n))).otherwise(share)
    chosen = F.broadcast(usable_labels.where(unit < share))  # about as many ids as the bounds say
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(chosen, "_id").select("_id", "_text", "_y").distinct()


def trained(sample: DataFrame, training: dict) -> tuple[np.ndarray, float]:
    """``train`` in one task, which holds the sample; the driver gets the model alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)]
        rows.sort(key=lambda r: (r[0], r[2], r[1] or ""))
        scores, bias = train([text for _, text, _ in rows], [y for _, _, y in rows], **training)
        yield pa.RecordBatch.from_arrays([pa.array([scores.astype(np.float32).tobytes()], pa.binary()), pa.array([bias], pa.float64())], names=["scores", "bias"])

    row = sample.repartition(1).mapInArrow(run, "scores binary, bias double").first()
    return train([], []) if row is None else (np.frombuffer(bytes(row["scores"]), np.float32), row["bias"])


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: Column | None = None, rows_toxic: int = 1000, rows_clean: int = 2000, **training) -> DataFrame:
    """Add ``score`` (0 to 1, higher: toxic likelier) and ``predicted`` to every row of ``docs``.

    ``labels`` (id, 0/1) may cover any part of the rows; those for which ``held_out`` holds
    (an expression on the id) are not learned from. The fit uses at most about
    ``rows_toxic`` and ``rows_clean`` labelled rows, whole texts; scoring reads every row and
    whole text. Null and empty texts, and texts without words, get the bias's score. Null
    labels and ids are not learned from; repeated rows are scored alike. All columns of
    ``docs`` stay; one named like an output is replaced.
    """
    small_batches(docs.sparkSession)
    usable = F.col(id_col).isNotNull() & (F.lit(True) if held_out is None else ~held_out)
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, usable, {1: rows_toxic, 0: rows_clean})
    scores, bias = train([], []) if sample is None else trained(sample, training)
    model = docs.sparkSession.sparkContext.broadcast((scores.astype(np.float32), bias))  # 2**17 numbers

    names = [c for c in docs.columns if c not in ("score", "predicted")]
    at = names.index(text_col) if text_col in names else len(names)
    source = docs.select(*names, *([] if text_col in names else [F.col(text_col).alias(free_name("text", docs))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value)
        for batch in batches:
            scores = list(scorer.score(batch.column(at).to_pylist()))
            score, predicted = pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], score, predicted], names=[*names, "score", "predicted"])

    schema = docs.select(*names).withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0)).schema
    return source.mapInArrow(run, schema)
