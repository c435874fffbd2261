"""Bulk-synchronous best-fit packing of tokenised documents into sequences.

Documents are tokenised where they lie and cut only when longer than a sequence. Pieces of
one length are alike, and so are sequences with equal gaps: before anything is compared,
pieces are grouped to classes and sequences to runs. A row is then its class and its rank
in it (counted in parallel, a third of all rows in one class included), and what the rounds
work on has at most one row a length and some a class, whatever the number of documents.

A round takes the band of the longest pieces left and all gaps of at least the band's
length, both sorted by size, in one DataFrame job:

1. *Successor sweep.* A gap shorter than the band's longest piece takes the largest class that
   fits it, its neighbour in the common order of sizes. Of gaps that take the same class the
   smallest come first: their ranks are running sums, and those beyond the class's end go
   without.
2. *Rank match.* What is left of the band meets the gaps that fit any of it: pieces from the
   longest, gaps from the smallest, on one axis of ranks; a gap takes as many as fit it.
3. *Update.* Gaps shrink, and what found no gap waits for the next round.

Rounds repeat until all pieces have a place; where no gap fits the longest piece, sequences are
opened for the classes that fit none.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvox.llm._shared import distributed_rank, materialize, salted, small_batches

CACHE_CHUNKS, TOGETHER = 800_000, 2000
BAND = 80  # a round takes pieces of at least this share (percent) of the longest one's length


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def stays_letters(chunk: str) -> bool:
    """Whether ``chunk`` is letters alone and still is once the tokenizer has normalised it:
    NFC and lower case turn some letters into a letter and a combining mark, which the
    tokenizer joins with punctuation that follows."""
    return chunk.isalpha() and (chunk.isascii() or unicodedata.normalize("NFC", chunk).lower().isalpha())


class Encoder(dict):
    """Ids of texts, as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and joins nothing across it, so each chunk between
    blanks or line ends has the same ids alone as in its text; known chunks are looked up.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = load_tokenizer(path)
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text alone; the tokenizer needn't say where in the text they are."""
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks that aren't known yet.

        Chunks that stay letters alone are one word for the tokenizer, so they are encoded in
        one call; the ids of each end with an id of the vocabulary's word ends. A comma or
        full stop after such a word is a word of its own. All other chunks are encoded whole.
        """
        new: dict[str, None] = {}
        marked: dict[str, tuple[str, str]] = {}
        for chunk in chunks:
            word, mark = chunk[:-1], chunk[-1:]
            if mark and mark in ",." and stays_letters(word):
                marked[chunk] = word, mark
                new[word] = new[mark] = None
            else:
                new[chunk] = None
        letters, rest = [], []
        for chunk in new:
            if chunk not in self:
                (letters if stays_letters(chunk) else rest).append(chunk)
        found = np.concatenate([np.zeros(0, "<u4"), *self.ids([" ".join(letters[k : k + TOGETHER]) for k in range(0, len(letters), TOGETHER)])])
        ends = np.flatnonzero(self.ends[found]) + 1
        if len(ends) == len(letters):
            data, at = found.tobytes(), 0
            for chunk, end in zip(letters, (4 * ends).tolist(), strict=True):
                self[chunk] = data[at:end]
                at = end
        else:  # a vocabulary without word ends
            rest += letters
        for chunk, ids in zip(rest, self.ids(rest), strict=True):
            self[chunk] = ids.tobytes()
        for chunk, (word, mark) in marked.items():
            self[chunk] = self[word] + self[mark]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text. Texts are taken a few at a time, so that what is remembered
        besides CACHE_CHUNKS chunks is at most what these hold."""
        for k in range(0, len(texts), 64):
            if len(self) > CACHE_CHUNKS:
                self.clear()
            split = [(t or "").replace("\n", " ").split(" ") for t in texts[k : k + 64]]
            new: set[str] = set()
            for chunks in split:
                new.update(filterfalse(self.__contains__, chunks))
            self.learn(new)
            for chunks in split:
                yield b"".join(map(self.__getitem__, chunks))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each Python worker, which many tasks use."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def cut(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str, with_ids: bool) -> DataFrame:
    """Pieces: _id, piece, start, length, ids_crc32 and, if asked for, ids."""
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    fields = [T.StructField("_id", source.schema["_id"].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer)
        for batch in batches:
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, data in enumerate(known.encode(batch.column(1).to_pylist())):
                data += end
                for k in range(0, len(data), 4 * capacity):
                    part = data[k : k + 4 * capacity]
                    rows.append(row)
                    piece.append(k // (4 * capacity))
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            columns += [pa.array(ids, pa.list_(pa.int32()))] * with_ids
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return source.mapInArrow(run, T.StructType(fields))


def _running(column: str, window) -> Column:
    """Sum of the rows before."""
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def successors(classes: DataFrame, gaps: DataFrame) -> DataFrame:
    """The sweep of sizes: each of ``gaps`` (gap, first, count) with the largest of ``classes``
    (length, left) that fits it, and ``ahead``: how many smaller gaps take the same class."""
    sizes = classes.select(F.col("length").alias("size"), F.lit(0).alias("side"), "length", F.col("left").alias("class_left"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("count"))
    sizes = sizes.union(gaps.select("gap", F.lit(1), F.lit(None), F.lit(None), "first", "count")).coalesce(1)
    up = Window.orderBy("size", "side", "first").rowsBetween(Window.unboundedPreceding, 0)
    near = lambda c: F.last(c, ignorenulls=True).over(up)
    taken = sizes.select("size", "side", "first", "count", near("length").alias("takes"), near("class_left").alias("left")).where("side = 1 and takes is not null")
    return taken.select(F.col("size").alias("gap"), "first", "count", F.col("takes").alias("length"), "left", _running("count", Window.partitionBy("takes").orderBy("size", "first")).alias("ahead"))


def rank_matches(classes: DataFrame, room: DataFrame) -> DataFrame:
    """The match by rank: pieces of ``classes`` (length, left) from the longest and places of
    ``room`` (gap, first, count, per: pieces that fit a gap) from the smallest gap lie on one axis.
    Rows (length, skip, gap, first, per, a, z): after ``skip`` pieces of the class, the next z - a fill
    the places a to z - 1 of the run of gaps."""
    pieces = classes.select(_running("left", Window.orderBy(F.desc("length"))).alias("at"), F.lit(0).alias("side"), F.struct("length", "left").alias("p"))
    none = F.lit(None).cast("struct<gap:bigint,first:bigint,count:bigint,per:bigint>")
    places = room.withColumn("units", F.col("count") * F.col("per")).select(
        _running("units", Window.orderBy("gap", "first")).alias("at"), F.lit(1), F.lit(None).cast("struct<length:bigint,left:bigint>"), F.struct("gap", "first", "count", "per"))
    axis = pieces.withColumn("r", none).union(places).coalesce(1)
    order = Window.orderBy("at", "side")
    near = lambda c: F.last(c, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    met = axis.select("at", F.lead("at").over(order).alias("upto"), near("p").alias("p"), near("r").alias("r"), near(F.when(F.col("side") == 0, F.col("at"))).alias("p0"), near(F.when(F.col("side") == 1, F.col("at"))).alias("u0"))
    upto = F.least(F.coalesce("upto", F.lit(1 << 62)), F.col("p0") + F.col("p.left"), F.col("u0") + F.col("r.count") * F.col("r.per"))
    return met.where("p is not null and r is not null").select("p.length", (F.col("at") - F.col("p0")).alias("skip"), "r.gap", "r.first", "r.per", (F.col("at") - F.col("u0")).alias("a"), (upto - F.col("u0")).alias("z")).where("a < z")


def sweeps(spark: SparkSession, counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places for all pieces: rows (length, first rank, end rank, pieces a sequence, first sequence,
    offset): of the pieces with these ranks, ``per`` after one another go to each sequence."""
    small = spark.newSession()  # its tables have some rows a length: no need to plan for large ones
    small.conf.set("spark.sql.adaptive.enabled", "false")
    small.conf.set("spark.sql.codegen.wholeStage", "false")
    small.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    left, done, gaps = dict(counts), dict.fromkeys(counts, 0), []
    places: list[tuple[int, int, int, int, int, int]] = []
    opened = -(-sum(n * k for n, k in left.items()) // capacity)
    if opened:
        gaps.append((capacity, 0, opened))

    def rows_of(rows: list, *names: str) -> DataFrame:
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        return small.createDataFrame(pa.table({c: pa.array(v, pa.int64()) for c, v in zip(names, columns, strict=True)})).coalesce(1)

    def put(length: int, n: int, per: int, sequence: int, offset: int, rank: int | None = None) -> None:
        rank = done[length] if rank is None else rank
        places.append((length, rank, rank + n, per, sequence, offset))

    def took(length: int, n: int) -> None:
        done[length] += n
        left[length] -= n

    def keep(gap: int, first: int, count: int) -> None:
        if gap and count:
            gaps.append((gap, first, count))

    while left:
        top, most = max(left), max((g for g, _, _ in gaps), default=0)
        low = -(-BAND * top // 100)
        if top > most:
            more = -(-sum(n * k for n, k in left.items() if n > max(most, low - 1)) // capacity)
            gaps.append((capacity, opened, more))
            opened += more
        near, room = [g for g in gaps if low <= g[0] < top], [(*g, g[0] // top) for g in gaps if g[0] >= top]
        gaps = [g for g in gaps if g[0] < low]
        band = [n for n in left if n >= low]
        if near:
            found = successors(rows_of([(n, left[n]) for n in band], "length", "left"), rows_of(near, "gap", "first", "count")).collect()
            swept = {r["first"] for r in found}
            gaps += [g for g in near if g[1] not in swept]  # no class of the band fits
            for r in sorted(found, key=lambda r: r["ahead"]):
                n = max(0, min(r["count"], r["left"] - r["ahead"]))
                if n:
                    put(r["length"], n, 1, r["first"], capacity - r["gap"])
                    took(r["length"], n)
                    keep(r["gap"] - r["length"], r["first"], n)
                keep(r["gap"], r["first"] + n, r["count"] - n)
        rest = [(n, left[n]) for n in band if left[n]]
        if rest:
            filled: dict[int, tuple[int, int]] = {}  # sequences that several classes share: gap and what is left of it
            used: dict[int, int] = {}
            for r in sorted(rank_matches(rows_of(rest, "length", "left"), rows_of(room, "gap", "first", "count", "per")).collect(), key=lambda r: (r["gap"], r["first"], r["a"])):
                length, per, at, end = r["length"], r["per"], r["a"], r["z"]
                rank = done[length]
                while at < end:
                    sequence, inside = divmod(at, per)
                    whole = 0 if inside else (end - at) // per
                    n = whole * per or min(end - at, per - inside)
                    if whole:
                        put(length, n, per, r["first"] + sequence, capacity - r["gap"], rank)
                        keep(r["gap"] - per * length, r["first"] + sequence, whole)
                    else:
                        gap = filled.get(r["first"] + sequence, r["gap"])
                        put(length, n, n, r["first"] + sequence, capacity - gap, rank)
                        filled[r["first"] + sequence] = gap - n * length
                    at, rank = at + n, rank + n
                took(length, rank - done[length])
                used[r["first"]] = -(-end // per)
            for sequence, gap in filled.items():
                keep(gap, sequence, 1)
            room = [(gap, first + used.get(first, 0), count - used.get(first, 0), per) for gap, first, count, per in room]
        for gap, first, count, _ in room:
            keep(gap, first, count)
        left = {n: k for n, k in left.items() if k}
    return places


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Pieces fill as few sequences as bulk-synchronous best fit finds: about the tokens there
    are over the capacity.

    ``tokenizer`` is the path of a tokenizers file whose pre-tokenizer drops white space;
    the file must be at that path on every executor. Null and empty texts are the end id
    alone. Repeated rows are packed each for itself, in any order among them; null ids
    stay null. Only documents longer than ``capacity`` are cut, into full pieces and a
    last one. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    found = cut(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids)
    pieces = materialize(salted(found), "pack-pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    places = spark.createDataFrame(sweeps(spark, counts, capacity) or [(0, 0, 0, 1, 0, 0)], "_length long, _from long, _to long, _per long, _sequence long, _offset long")
    ranked = distributed_rank(pieces, ["length"], ["_id", "piece", "ids_crc32"], "_rank")
    here = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    placed = ranked.join(F.broadcast(places), here).withColumn("_nth", F.col("_rank") - F.col("_from"))  # some rows a length
    return placed.select(
        F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32", (F.col("_sequence") + F.floor(F.col("_nth") / F.col("_per"))).alias("sequence_id"),
        (F.col("_offset") + F.col("_nth") % F.col("_per") * F.col("length")).alias("offset"), *["ids"] * with_ids,
    )
