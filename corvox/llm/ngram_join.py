"""Similarity self-join on word n-grams: a grouped prefix join, down to connected components.

* *Order.* Shingles are counted over all documents in a table of ``1 << COUNT_BITS``
  counters (a shingle's counter is an upper bound of its documents, by hash); rarer ones
  come first, ties by hash. Any order is correct; this one keeps common passages out of
  prefixes.
* *Prefixes.* A set of n shingles has a prefix of n - ceil(t n) + 1. Two sets that reach
  Jaccard t share a shingle of their prefixes, one of them among the first
  n - ceil(2t/(1+t) n) + 1 of the smaller set (its index prefix).
* *Groups.* Documents with equal sets are one class; classes with the same prefix and size
  are one group. A task sends each group's prefix once, packed with those of its other
  groups by hash range. Where a shingle is met, the groups that share it form a list;
  a list that another shingle has given already is not given again.
* *Group pairs.* In each list, sorted by size, groups are paired with a pivot (sizes
  permitting), one pair a group and not all pairs; pivots form a tree, so that none has
  all of a list. Pairs are expanded to their classes,
  filtered by a parity bitmap (its Hamming distance is at most the size of the symmetric
  difference, so no link is lost), verified on whole sets, and joined to components.
* *The rest.* Then the classes of a list that still lie in different components are compared,
  in blocks by size and in arrays, by size, by the place of the shared shingle (what comes
  after it must suffice for a link) and by bitmap; only pairs that pass are given out and
  verified.

Shingles have two independent 64-bit hashes. Candidates come from the first, a class is
known by both, and links are verified by the second. A wrong link needs many collisions of
the second; a lost one a collision of two shingles, prefixes or lists in the first, with
odds of 2**-64 a pair.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvox.llm._shared import materialize, own, small_batches, width
from corvox.llm.components import components
from corvox.llm.shingles import mix, shingle_sets

U = np.uint64
COUNT_BITS, CHUNK_BITS, MAP_BITS = 23, 17, 10
BLOCK = 128
FLUSH = 1 << 20  # prefix shingles held by a task before they are sent
BROADCAST_IDS = 2_000_000  # document ids (8 bytes each) broadcast at most


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))


def shingle_counts(texts: DataFrame, size: int) -> np.ndarray:
    """Counters of all documents' shingles, on a log scale, one byte each: a table of fixed
    size. Tasks count for themselves; counters are summed by range in two steps."""
    chunks = 1 << (COUNT_BITS - CHUNK_BITS)
    per = 1 << CHUNK_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, n = np.zeros(1 << COUNT_BITS, np.uint32), [], 0

        def settle() -> None:
            at, k = np.unique(np.concatenate(held), return_counts=True)
            total[at] += k.astype(np.uint32)
            held.clear()

        for batch in batches:
            for found in shingle_sets(batch.column(1).to_pylist(), size):
                held.append((found >> U(64 - COUNT_BITS)).astype(np.uint32))
                n += len(found)
                if n > FLUSH:
                    settle()
                    n = 0
        if held:
            settle()
        salt = TaskContext.get().partitionId() % 16
        yield from pack(((c, salt), part) for c in range(chunks) if (part := total[c * per : (c + 1) * per]).any())

    def pack(parts) -> Iterator[pa.RecordBatch]:
        rows = [(c, s, zlib.compress(p.astype(np.uint32).tobytes(), 1)) for (c, s), p in parts]
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], names=["chunk", "salt", "counts"])

    def add(keep_salt: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for c, s, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    key = (c, s if keep_salt else 0)
                    part = np.frombuffer(zlib.decompress(data), np.uint32)
                    sums[key] = np.minimum(sums[key].astype(np.uint64) + part, 2**32 - 1).astype(np.uint32) if key in sums else part
            yield from pack(sums.items())

        return run

    schema = "chunk int, salt int, counts binary"
    tasks = width(texts.sparkSession)
    counted = texts.mapInArrow(count, schema).repartition(tasks, "chunk", "salt").mapInArrow(add(True), schema)
    summed = counted.repartition(min(tasks, chunks), "chunk").mapInArrow(add(False), schema)
    table = np.zeros(1 << COUNT_BITS, np.uint8)
    for row in summed.collect():  # at most 2**COUNT_BITS counters
        part = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
        table[row["chunk"] * per : (row["chunk"] + 1) * per] = np.rint(8 * np.log2(1 + part.astype(np.float64))).astype(np.uint8)
    return table


def parity(found: np.ndarray) -> bytes:
    """Bitmap with the parity of how many shingles fall on each bit."""
    return np.packbits((np.bincount(mix(found) >> U(64 - MAP_BITS), minlength=1 << MAP_BITS) & 1).astype(np.uint8)).tobytes()


def set_key(found: np.ndarray, second: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set: 64 of each of its shingles' two hashes."""
    return int(np.sum(mix(found), dtype=np.uint64).view(np.int64)), int(np.sum(mix(second), dtype=np.uint64).view(np.int64))


def prefixes(texts: DataFrame, table: np.ndarray, size: int, pct: int, parts: int) -> DataFrame:
    """Rows of two kinds: a document's (part null) with its id, set size, class, group and
    bitmap; and packed prefix entries of a hash range (part, shingles, groups, sizes)."""
    order = texts.sparkSession.sparkContext.broadcast(table)  # 2**COUNT_BITS bytes
    names = ["part", "shingles", "groups", "sizes", "_id", "n", "h1", "h2", "g", "bits"]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def packed(held: list) -> pa.RecordBatch:
        shingles, groups, sizes = (np.concatenate([h[k] for h in held]) for k in range(3))
        part = (mix(shingles >> U(8)) >> U(40)) % U(parts)
        by = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[by], np.arange(parts + 1, dtype=np.uint64))
        full = [p for p in range(parts) if edges[p] < edges[p + 1]]
        cut = lambda a: pa.array([a[by[edges[p] : edges[p + 1]]].tobytes() for p in full], pa.binary())
        empty = [pa.nulls(len(full), k) for k in kinds[4:]]
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), cut(shingles), cut(groups), cut(sizes), *empty], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, sent, held, n_held = order.value, set(), [], 0
        for batch in batches:
            rows = []
            for found, second in shingle_sets(batch.column(1).to_pylist(), size, (0, 1)):
                n = len(found)
                if not n:
                    rows.append((0, None, None, None, None))
                    continue
                h1, h2 = set_key(found, second)
                by = np.argsort(rank[found >> U(64 - COUNT_BITS)], kind="stable")
                probe = n - -(-pct * n // 100) + 1
                prefix = found[by[:probe]]
                g = int(np.sum(mix(prefix ^ U(2 * n)), dtype=np.uint64).view(np.int64))
                rows.append((n, h1, h2, g, parity(found)))
                if g not in sent:
                    sent.add(g)
                    place = (256 * np.arange(probe, dtype=np.uint64)) // U(probe)  # of 256 parts of the prefix
                    held.append(((prefix & ~U(255)) | place, np.full(probe, g, np.int64), np.full(probe, n, np.int32)))
                    n_held += probe
                    if n_held > FLUSH:
                        yield packed(held)
                        held, n_held = [], 0
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(len(rows), k) for k in kinds[:4]), batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds[5:], strict=True))], names=names
            )
        if held:
            yield packed(held)

    return texts.mapInArrow(run, "part int, shingles binary, groups binary, sizes binary, _id long, n int, h1 long, h2 long, g long, bits binary")


def parent(k: int, width: int = 64) -> int:
    """The place that place k > 0 of a list is tried with: k without its last digit that isn't
    zero, to the base ``width``, so that no place has many more than ``width`` after it.

    >>> [parent(k) for k in (1, 63, 64, 70, 4096, 4160)]
    [0, 0, 0, 64, 0, 4096]
    """
    step = 1
    while k // step % width == 0:
        step *= width
    return k - k // step % width * step


def group_lists(packed: DataFrame, pct: int) -> DataFrame:
    """(list, g, n, place, pivot): groups that share a prefix shingle. place: a lower bound of its
    place in the group's prefix. pivot: the group of the list to try this one with first, or
    null. Shingles with the same groups give one list, with the first place of each group; as
    all prefixes have one order, that is where each two of these groups first meet."""
    names = ["list", "g", "n", "place", "pivot"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[], [], []]
        for batch in batches:
            for k in range(3):
                kind = (np.uint64, np.int64, np.int32)[k]
                held[k] += [np.frombuffer(b, kind) for b in batch.column(k).to_pylist()]
        if not held[0]:
            return
        shingle, g, n = (np.concatenate(h) for h in held)
        key = shingle >> U(8)
        by = np.argsort(key)
        k = key[by]
        same = k[1:] == k[:-1]
        met = by[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
        if not len(met):
            return
        met = met[np.lexsort((g[met], n[met], key[met]))]
        key, g, n = key[met], g[met], n[met].astype(np.int64)
        probe = n - -(-pct * n // 100) + 1
        place = -(-((shingle[met] & U(255)).astype(np.int64) * probe) // 256)
        early = place < n - -(-2 * pct * n // (100 + pct)) + 1  # in the index prefix
        once = np.concatenate([[True], (key[1:] != key[:-1]) | (g[1:] != g[:-1])])
        key, g, n, place, early = key[once], g[once], n[once], place[once], early[once]
        code = mix(g.view(np.uint64))
        edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        lists: dict[int, list] = {}
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b - a < 2:
                continue
            m = n[a:b]
            # a group stays if some other fits it: the smaller of two has the shingle in its index prefix
            low = np.searchsorted(m, -(-pct * m // 100))
            before = np.concatenate([[0], np.cumsum(early[a:b])])
            here = np.arange(b - a)
            keep = (before[here] - before[low] > 0) | (early[a:b] & (np.searchsorted(m, 100 * m // pct, side="right") > here + 1))
            if keep.sum() < 2:
                continue
            digest = int(np.sum(code[a:b][keep], dtype=np.uint64).view(np.int64))
            if digest in lists:
                np.minimum(lists[digest][2], place[a:b][keep], out=lists[digest][2])
            else:
                lists[digest] = [g[a:b][keep], m[keep], place[a:b][keep]]
        out, size = [[], [], [], [], []], 0
        for digest, (gs, ms, ps) in lists.items():
            pivots, p = [], None
            for at in range(len(gs)):
                if p is not None and 100 * ms[p] >= pct * ms[at]:
                    pivots.append(int(gs[parent(at - p) + p]))
                else:
                    pivots.append(None)
                    p = at
            for col, values in zip(out, ([digest] * len(gs), gs, ms, ps, pivots), strict=True):
                col.extend(values)
            size += len(gs)
            if size > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)
                out, size = [[], [], [], [], []], 0
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    return packed.mapInArrow(run, "list long, g long, n int, place int, pivot long")


def block_pairs(entries: DataFrame, pct: int) -> DataFrame:
    """``entries`` (list, u, n, place, root, bits) dealt to pairs of blocks: list, x, y, mine and the rest.

    A list is cut by size into bands, of which only neighbours can hold a link, and a band by
    hash into blocks of about BLOCK entries. ``cap`` is the largest partner that the place of
    the shared shingle leaves to an entry; an entry goes only to blocks that hold some entry
    of another component within both caps. No link is lost.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(1.001 * 100 / pct)).cast("int")  # sizes of a link: at most one band apart
    sized = entries.withColumns({"band": band, "cap": F.floor((100 * F.col("n") - (100 + pct) * F.col("place")) / pct)})
    counts = sized.groupBy("list", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
    cut = sized.join(counts, ["list", "band"]).withColumn("mine", F.col("band").cast("long") * (1 << 32) + F.pmod(F.xxhash64("u"), F.col("blocks")))
    of = cut.groupBy("list", "band", F.col("mine").alias("other")).agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("cap").alias("reach"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    turned = cut.select("*", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("to")).drop("band")
    met = turned.join(of.withColumnRenamed("band", "to"), ["list", "to"])
    some = (F.col("reach") >= F.col("n")) & (F.col("least") <= F.col("cap")) & (100 * F.col("most") >= pct * F.col("n")) & ((F.col("r0") != F.col("root")) | (F.col("r1") != F.col("root")))
    return met.where(some).select("list", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "u", "n", "place", "root", "bits")


def unlike_pairs(entries: DataFrame, pct: int) -> DataFrame:
    """Pairs (a, b) of one list and different components that sizes, places and bitmaps allow.

    Each pair of blocks is a group of its own; pairs are made and filtered in arrays, and only
    those that may be links leave the task.
    """
    keyed = block_pairs(entries, pct)
    least = needed(pct)

    def compare(rows: dict) -> tuple[np.ndarray, np.ndarray]:
        left = np.flatnonzero(rows["mine"] == rows["x"][0])
        right = np.flatnonzero(rows["mine"] == rows["y"][0])
        bits = np.frombuffer(b"".join(rows["bits"]), np.uint64).reshape(len(rows["u"]), -1)
        u, n, place, root = (np.array(rows[c], np.int64) for c in ("u", "n", "place", "root"))
        pairs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in left:
            j = right[(root[right] != root[i]) & (u[right] != u[i])]
            want = least(n[i], n[j])
            j = j[(n[j] - place[j] >= want) & (n[i] - place[i] >= want) & (100 * np.minimum(n[i], n[j]) >= pct * np.maximum(n[i], n[j]))]
            if len(j):
                apart = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
                j = j[apart <= n[i] + n[j] - 2 * least(n[i], n[j])]
                pairs[0].append(np.minimum(u[i], u[j]))
                pairs[1].append(np.maximum(u[i], u[j]))
        return np.concatenate(pairs[0]), np.concatenate(pairs[1])

    names = ["list", "x", "y", "mine", "u", "n", "place", "root", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, open_rows = None, []

        def closed() -> pa.RecordBatch:
            columns = {c: np.concatenate([r[c] for r in open_rows]) if c != "bits" else [b for r in open_rows for b in r[c]] for c in names}
            a, b = compare(columns)
            one = np.unique(np.stack([a, b], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(one[:, 0], pa.int64()), pa.array(one[:, 1], pa.int64())], names=["a", "b"])

        for batch in batches:
            columns = {c: batch.column(k).to_pylist() if c == "bits" else batch.column(k).to_numpy(zero_copy_only=False) for k, c in enumerate(names)}
            keys = list(zip(columns["list"].tolist(), columns["x"].tolist(), columns["y"].tolist(), strict=True))
            start = 0
            for at in range(1, len(keys) + 1):
                if at == len(keys) or keys[at] != keys[start]:
                    if keys[start] != open_key:
                        if open_rows:
                            yield closed()
                        open_key, open_rows = keys[start], []
                    open_rows.append({c: v[start:at] for c, v in columns.items()})
                    start = at
        if open_rows:
            yield closed()

    sorted_rows = keyed.repartition(width(entries.sparkSession), "list", "x", "y").sortWithinPartitions("list", "x", "y")
    return sorted_rows.mapInArrow(run, "a long, b long").distinct()


def needed(pct: int):
    """Smallest intersection that links sets of na and nb: 100 i >= pct (na + nb - i)."""
    return lambda na, nb: -(-pct * (na + nb) // (100 + pct))


def filtered(pairs: DataFrame, classes: DataFrame, pct: int) -> DataFrame:
    """Pairs (a, b) of classes whose bitmaps allow a link."""
    side = lambda s: classes.select(F.col("u").alias(s), F.col("n").alias(f"n{s}"), F.col("bits").alias(f"bits{s}"))
    wide = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "bitsa", "bitsb")
    least = needed(pct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3))
            bits = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for k in (4, 5)]
            apart = np.bitwise_count(bits[0] ^ bits[1]).sum(axis=1, dtype=np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(na + nb - 2 * least(na, nb) >= apart))

    return wide.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, pct: int) -> DataFrame:
    """Pairs (a, b) whose whole sets reach the threshold, by the second hash of their shingles:
    what the first took for equal by chance doesn't link."""
    wanted = pairs.select(F.col("a").alias("u")).union(pairs.select(F.col("b").alias("u"))).distinct()
    wanted = materialize(wanted.join(classes.select("u", "h1", "h2", "first_id"), "u"), "join-wanted")
    ids = wanted.select(F.col("first_id").alias("_want")).distinct()
    small = wanted.count() <= BROADCAST_IDS
    rows = texts.join(F.broadcast(ids) if small else ids, F.col("_id").eqNullSafe(F.col("_want")), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, data = [], []
            for found, second in shingle_sets(batch.column(0).to_pylist(), size, (0, 1)):
                if len(found):
                    keys.append(set_key(found, second))
                    data.append(np.sort(second).tobytes())
            h1, h2 = zip(*keys, strict=True) if keys else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(data, pa.binary())], names=["h1", "h2", "items"])

    made = rows.select("_text").mapInArrow(sets, "h1 long, h2 long, items binary")
    keys = wanted.select("u", "h1", "h2")
    found = materialize(made.join(F.broadcast(keys) if small else keys, ["h1", "h2"]).select("u", "items").dropDuplicates(["u"]), "join-sets")
    a = found.select(F.col("u").alias("a"), F.col("items").alias("ia"))
    b = found.select(F.col("u").alias("b"), F.col("items").alias("ib"))
    least = needed(pct)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint64) for c in (2, 3))
                both = np.sort(np.concatenate([x, y]))
                good.append(int((both[1:] == both[:-1]).sum()) >= least(len(x), len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "ia", "ib").mapInArrow(check, "a long, b long")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, pct: int = 80) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles (set size) and component_id, the smallest
    id among the documents reachable by links of Jaccard similarity pct/100 or more.

    Null and empty texts, and texts without words, have size 0, are linked with nothing
    and are their own component. Texts of fewer than ``size`` words are one shingle.
    Repeated rows are linked with each other. Null ids stay null and never name a
    component; ids are whole numbers. Other columns are not read. An empty table gives no
    rows.
    """
    small_batches(docs.sparkSession)
    tasks = width(docs.sparkSession)
    texts = _texts(docs, id_col, text_col)
    scanned = materialize(prefixes(texts, shingle_counts(texts, size), size, pct, 4 * tasks), "join-scan")
    rows = scanned.where("part is null").select("_id", "n", "h1", "h2", "g", "bits")
    alike = rows.where("n > 0").groupBy("h1", "h2").agg(F.min("_id").alias("first_id"), F.first("n").alias("n"), F.first("g").alias("g"), F.first("bits").alias("bits"))
    classes = materialize(alike.withColumn("u", F.monotonically_increasing_id()), "join-classes")  # written, so numbers stay
    met = group_lists(scanned.where("part is not null").select("part", "shingles", "groups", "sizes").repartition(tasks, "part").select("shingles", "groups", "sizes"), pct)
    lists = materialize(met.groupBy("list", "g").agg(F.first("n").alias("n"), F.min("place").alias("place"), F.first("pivot", ignorenulls=True).alias("pivot")), "join-lists")
    members = classes.select("g", "u", "n")
    heads = members.groupBy("g").agg(F.min("u").alias("head"), F.max("u").alias("tail"))
    several = members.join(heads.where("head <> tail"), "g").select("g", "u", "n", "head")

    between = (
        lists.where("pivot is not null").select("g", "pivot").distinct()
        .join(heads.select("g", F.col("head").alias("b")), "g")
        .join(heads.select(F.col("g").alias("pivot"), F.col("head").alias("a")), "pivot").select("a", "b")
    )
    within = several.where("u <> head").select(F.col("head").alias("a"), F.col("u").alias("b"))
    first = materialize(filtered(between.union(within).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), classes, pct), "join-pairs")
    links = materialize(verified(first, classes, texts, size, pct), "join-links")
    roots = components(links)

    entries = (
        lists.select("list", "g", "place").join(members, "g").select("list", "u", "n", "place")
        .union(several.select(F.col("g").alias("list"), "u", "n", F.lit(0)))
        .join(roots, F.col("u") == F.col("node"), "left").select("list", "u", "n", "place", F.coalesce("root", "u").alias("root"))
    )
    open_lists = entries.groupBy("list").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("list")
    left = materialize(entries.join(open_lists, "list", "left_semi").join(classes.select("u", "bits"), "u"), "join-open")
    second = materialize(unlike_pairs(left, pct).join(first, ["a", "b"], "left_anti"), "join-pairs")
    more = verified(second, classes, texts, size, pct)
    settled = materialize(links.union(more), "join-links")
    roots = components(settled)

    named = classes.select("u", "h1", "h2", "first_id").join(roots, F.col("u") == F.col("node"), "left").withColumn("root", F.coalesce("root", "u"))
    names = materialize(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "join-names")  # written, so that a hot root's join can be split
    by_class = named.join(names, "root").select("h1", "h2", "component_id")
    return rows.join(by_class, ["h1", "h2"], "left").select(
        F.col("_id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", F.col("_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **join) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the row with its
    smallest id. Rows that repeat that id stay too."""
    found = ngram_components(docs, id_col, text_col, **join)
    stay = found.where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col)).distinct()
    kept = own(stay.select(F.col(id_col).alias("stay")))
    return docs.join(kept, F.col(id_col).eqNullSafe(kept["stay"]), "left_semi")
