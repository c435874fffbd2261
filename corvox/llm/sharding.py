"""Resharding by minimum-cost flow: fewest bytes moved from old shards to new capacities.

Rows of an old shard that are about equally large form a block. Rows that stay in the shard
of their number cost nothing, a row that moves costs its bytes. The flow network has a node
for each old and each new shard and an arc for each block, so it is bounded by shards times
size classes; it is solved on the driver by successive cheapest paths. It says how many rows
each shard sends where; the rows that go are the shard's smallest, found by narrowing the
size at which they end, so the bytes moved are the least there can be.

Rows find their shard and slot without meeting one another: a shard's rows are dealt to
salts by hash, and from the row counts of (shard, salt) follows where each salt's rows go.
The texts are shuffled once, to the task that writes them.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvox.llm._shared import free_name, materialize, remove_at_end, shared_path, width

CLASSES_PER_OCTAVE, PARTS = 8, 256


def cheapest_transfers(blocks: dict[int, list[tuple[int, float]]], capacity: list[int]) -> dict[int, dict[int, int]]:
    """Rows to move, as {old shard: {new shard: rows}}, at the lowest total cost.

    ``blocks[i]`` holds (rows, cost a row) of old shard i, cheapest first; shard i keeps its
    number if it is below len(capacity). Capacities must add up to the rows. Which of a shard's
    blocks move follows from the number that move: the cheapest.
    """
    nodes: dict = {}
    to, cap, cost, out = [], [], [], defaultdict(list)

    def node(name) -> int:
        return nodes.setdefault(name, len(nodes))

    def arc(a, b, c, w) -> int:
        for u, v, k, x in ((a, b, c, w), (b, a, 0, -w)):
            out[node(u)].append(len(to))
            to.append(node(v))
            cap.append(k)
            cost.append(x)
        return len(to) - 2

    moves = {}
    for i, parts in blocks.items():
        total = sum(n for n, _ in parts)
        arc("source", ("old", i), total, 0.0)
        if 0 <= i < len(capacity):
            arc(("old", i), ("new", i), total, 0.0)
        for n, w in parts:
            arc(("old", i), ("out", i), n, w)
        moves[i] = arc(("out", i), "hub", total, 0.0)
    takes = [arc("hub", ("new", j), n, 0.0) for j, n in enumerate(capacity)]
    for j, n in enumerate(capacity):
        arc(("new", j), "sink", n, 0.0)

    source, sink = node("source"), node("sink")
    height = [0.0] * len(nodes)
    while True:
        far, via, queue = [math.inf] * len(nodes), [-1] * len(nodes), [(0.0, source)]
        far[source] = 0.0
        while queue:
            d, u = heapq.heappop(queue)
            if d > far[u]:
                continue
            for e in out[u]:
                if cap[e]:
                    v, reach = to[e], d + max(0.0, cost[e] + height[u] - height[to[e]])
                    if reach < far[v] - 1e-9:
                        far[v], via[v] = reach, e
                        heapq.heappush(queue, (reach, v))
        if via[sink] < 0:
            break
        height = [h + (f if f < math.inf else far[sink]) for h, f in zip(height, far, strict=True)]
        path, v = [], sink
        while v != source:
            path.append(via[v])
            v = to[via[v] ^ 1]
        flow = min(cap[e] for e in path)
        for e in path:
            cap[e] -= flow
            cap[e ^ 1] += flow

    wanted = [[j, cap[e ^ 1]] for j, e in enumerate(takes) if cap[e ^ 1]]
    plan: dict[int, dict[int, int]] = {}
    for i, e in moves.items():  # the hub joins movers and takers in any way: a row's cost is the same to each
        left = cap[e ^ 1]
        while left:
            n = min(left, wanted[-1][1])
            plan.setdefault(i, {})[wanted[-1][0]] = n
            left -= n
            wanted[-1][1] -= n
            if not wanted[-1][1]:
                wanted.pop()
    return plan


def row_capacities(rows: dict[int, int], shards: int) -> list[int]:
    """Capacities at most one row apart; the shards with most rows so far get the larger ones."""
    n = sum(rows.values())
    larger = sorted(range(shards), key=lambda j: (-rows.get(j, 0), j))[: n % shards]
    return [n // shards + (j in set(larger)) for j in range(shards)]


@dataclass(frozen=True)
class Plan:
    """``rows``: id, size, text_crc32 and old shard of every row (a written table). ``shards``: by old
    shard its salts and the size at which its moving rows end. ``routes``: by old shard and salt
    the parts (cat, from, to, shard, slot) of its rows. ``affected``: shards that lose or gain rows."""

    rows: DataFrame
    shards: DataFrame
    routes: DataFrame
    affected: list[int]


def described(docs: DataFrame, old: Column, id_col: str, text_col: str, *more: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    size, crc = (F.octet_length(text) + 16).cast("long"), F.crc32(text.cast("binary"))
    known = F.coalesce(old.cast("int"), F.lit(-1))
    return docs.select(F.col(id_col).alias("id"), size.alias("size"), crc.alias("text_crc32"), F.when(known < 0, -1).otherwise(known).alias("old_shard"), *more)


def cut_sizes(rows: DataFrame, sent: dict[int, tuple[float, float, int]]) -> dict[int, tuple[int, int]]:
    """For each old shard (size, rows): its moving rows are all below that size and so many of it.
    ``sent``: bounds of the size class (from, below) in which its moving rows end, and how many of
    that class's rows go. Each step counts by PARTS parts of what is left of the bounds."""
    found: dict[int, tuple[int, int]] = {}
    spans = {i: (math.floor(a), math.ceil(b), k) for i, (a, b, k) in sent.items()}
    while spans:
        step = rows.sparkSession.createDataFrame([(i, a, -(-(b - a) // PARTS)) for i, (a, b, _) in spans.items()], "old_shard int, _from long, _wide long")
        part = F.floor((F.col("size") - F.col("_from")) / F.col("_wide"))
        inside = rows.join(F.broadcast(step), "old_shard").where((F.col("size") >= F.col("_from")) & (part < PARTS))
        counts = defaultdict(dict)
        for r in inside.groupBy("old_shard", part.alias("part")).count().collect():  # shards x PARTS
            counts[r["old_shard"]][r["part"]] = r["count"]
        left = {}
        for i, (a, b, k) in spans.items():
            wide = -(-(b - a) // PARTS)
            for p in sorted(counts[i]):
                if k <= counts[i][p]:
                    break
                k -= counts[i][p]
            if wide == 1:
                found[i] = a + p, k
            else:
                left[i] = a + p * wide, a + (p + 1) * wide, k
        spans = left
    return found


def plan_shards(docs: DataFrame, old: Column, shards: int, id_col: str = "doc_id", text_col: str = "text", rows_per_file: int = 250_000) -> Plan:
    """Where the rows of ``docs`` go (see ``reshard``). The driver holds numbers by old shard and
    size class; salts, a few for each task or one for each ``rows_per_file`` rows, stay in tables."""
    spark = docs.sparkSession
    rows = materialize(described(docs, old, id_col, text_col), "shard-rows")
    octave = F.floor(F.log2(F.col("size").cast("double")) * CLASSES_PER_OCTAVE).cast("int")
    blocks: dict[int, dict[int, tuple[int, int]]] = defaultdict(dict)
    for r in rows.groupBy("old_shard", octave.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.min("size").alias("a"), F.max("size").alias("b")).collect():  # shards x classes
        blocks[r["old_shard"]][r["c"]] = r["n"], r["bytes"], r["a"], r["b"]
    counts = {i: sum(b[0] for b in parts.values()) for i, parts in blocks.items()}
    plan = cheapest_transfers({i: [(b[c][0], b[c][1] / b[c][0]) for c in sorted(b)] for i, b in blocks.items()}, row_capacities(counts, shards))

    sent, below = {}, {}
    for i, to in plan.items():
        k = sum(to.values())
        for c in sorted(blocks[i]):
            n, _, a, b = blocks[i][c]
            if k <= n:
                sent[i], below[i] = (a, b + 1, k), sum(to.values()) - k
                break
            k -= n
    cuts = cut_sizes(rows, sent)

    total, runs = sum(counts.values()), [(-2, 0, 0, 0, 0)]
    for i, n in counts.items():
        to = [[j, k] for j, k in sorted(plan.get(i, {}).items())]
        moving = sum(k for _, k in to)
        at_cut = cuts[i][1] if i in cuts else 0
        for cat, size in ((0, moving - at_cut), (1, at_cut)):
            at = 0
            while at < size:
                k = min(size - at, to[0][1])
                runs.append((i, cat, at, at + k, to[0][0]))
                at, to[0][1] = at + k, to[0][1] - k
                if not to[0][1]:
                    to.pop(0)
        runs += [(i, 1, at_cut, n, i), (i, 2, 0, n, i)] if n > moving else []
    salts = {i: max(-(-n // rows_per_file), -(-4 * width(spark) * n // total)) for i, n in counts.items()}
    known = spark.createDataFrame([(i, salts[i], cuts[i][0] if i in cuts else -1) for i in counts] or [(-2, 1, -1)], "old_shard int, salts long, cut long")

    groups = materialize(dealt(rows, known).groupBy("old_shard", "salt", "cat").agg(F.count(F.lit(1)).alias("n")), "shard-groups")
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(before("old_shard", "cat").orderBy("salt")), F.lit(0))
    each = spark.createDataFrame(runs, "_o int, _c int, _from long, _to long, shard int")  # some a shard, and one for each transfer of the flow
    met = groups.withColumn("start", start).join(F.broadcast(each), (F.col("old_shard") == F.col("_o")) & (F.col("cat") == F.col("_c")) & (F.col("_from") < F.col("start") + F.col("n")) & (F.col("_to") > F.col("start")))
    parts = met.select("old_shard", "salt", "cat", (F.greatest("_from", "start") - F.col("start")).alias("from"), (F.least("_to", F.col("start") + F.col("n")) - F.col("start")).alias("to"), "shard")
    slot = F.coalesce(F.sum(F.col("to") - F.col("from")).over(before("shard").orderBy("old_shard", "salt", "cat", "from")), F.lit(0))
    routes = parts.withColumn("slot", slot).groupBy("old_shard", "salt").agg(F.collect_list(F.struct("cat", "from", "to", "shard", "slot")).alias("parts"))  # few: three kinds and the shard's transfers
    moved = [i for i in plan if i >= 0] + [j for to in plan.values() for j in to]
    return Plan(rows, known, materialize(routes, "shard-routes"), sorted(set(moved)))


def dealt(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows with their salt and ``cat``: below the size at which their shard's moving rows end (0),
    of it (1), or above it (2)."""
    cat = F.when(F.col("size") < F.col("cut"), 0).when(F.col("size") == F.col("cut"), 1).otherwise(2)
    return rows.join(F.broadcast(known), "old_shard").withColumns({"salt": F.pmod(F.xxhash64("id", "text_crc32"), F.col("salts")), "cat": cat}).drop("salts", "cut")


def placed(rows: DataFrame, plan: Plan) -> DataFrame:
    """``rows`` (id, size, text_crc32, old_shard and any more) with shard and slot, by one shuffle."""
    mine = dealt(rows, plan.shards).repartition("old_shard", "salt")
    nth = F.row_number().over(Window.partitionBy("old_shard", "salt", "cat").orderBy("id", "text_crc32", "size")) - 1
    joined = mine.withColumn("nth", nth).join(plan.routes, ["old_shard", "salt"])
    part = F.get(F.filter("parts", lambda p: (p["cat"] == F.col("cat")) & (p["from"] <= F.col("nth")) & (F.col("nth") < p["to"])), 0)
    return joined.withColumn("part", part).select(*rows.columns, F.col("part.shard").alias("shard"), (F.col("part.slot") + F.col("nth") - F.col("part.from")).alias("slot"))


def reshard(docs: DataFrame, old: Column, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, old_shard, shard, slot.

    ``old`` is the present shard of a row (an int; null, negative or over the new number:
    a row that has to move; null and negative ones are given as -1). New shards hold row counts
    at most one apart, and of all ways to reach them one that moves the fewest bytes is taken.
    ``size`` is the text's UTF-8 bytes (null: none) plus 16; slots number a shard's rows from 0.
    Repeated rows are placed each for itself (those of one id and text by one task), null ids
    pass through, other columns are not read. An empty table gives no rows. The driver holds
    a few numbers by old shard, so ``old`` must name shards and not rows.
    """
    plan = plan_shards(docs, old, shards, id_col, text_col)
    return placed(plan.rows, plan).withColumnRenamed("id", id_col)


def rewrite_affected(docs: DataFrame, old: Column, plan: Plan, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the rows of all shards that lose or gain rows under ``path``, a folder a shard, with
    their slot, and return what is read back; the files of all other shards stay as they are.
    ``plan`` comes from ``plan_shards``. Columns named like ``shard`` and ``slot`` keep their
    names, and these two get underscores."""
    spark = docs.sparkSession
    shard, slot = free_name("shard", docs), free_name("slot", docs)
    rows = described(docs, old, id_col, text_col, F.struct(*docs.columns).alias("row"))
    written = placed(rows.where(F.col("old_shard").isin([-1, *plan.affected])), plan)
    out = written.select("row.*", F.col("shard").alias(shard), F.col("slot").alias(slot))
    out.sortWithinPartitions(shard, slot).write.option("compression", "zstd").partitionBy(shard).parquet(path)
    fields = docs.withColumns({slot: F.lit(0).cast("long"), shard: F.lit(0)}).schema
    return spark.read.schema(fields).parquet(path)


def rewritten(docs: DataFrame, old: Column, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``reshard``, with the affected shards written to the shared folder: their rows' id,
    size, text_crc32, old_shard, shard and slot are read back from the files. ``old`` is an
    expression on the columns of ``docs``. Rows of other shards, whose files stay as they
    are, come from the plan."""
    spark = docs.sparkSession
    plan = plan_shards(docs, old, shards, id_col, text_col)
    path = shared_path(spark, "shard-files")
    files = rewrite_affected(docs, old, plan, path, id_col, text_col)
    remove_at_end(spark, path)
    read = described(files, old, id_col, text_col, F.col(free_name("shard", docs)).alias("shard"), F.col(free_name("slot", docs)).alias("slot"))
    if set(plan.affected) >= set(range(shards)):
        return read.withColumnRenamed("id", id_col)
    rest = placed(plan.rows.where(~F.col("old_shard").isin([-1, *plan.affected])), plan)
    return read.unionByName(rest).withColumnRenamed("id", id_col)
