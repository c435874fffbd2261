import random
import unicodedata
import zlib
from bisect import bisect_left, insort

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corvox.llm import registry, sharding
from corvox.llm.packing import Encoder, load_tokenizer, pack, rank_matches, successors, sweeps
from corvox.llm.sharding import cheapest_transfers, plan_shards, reshard, rewrite_affected, rewritten, row_capacities

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a\n\nb's don't", "x,. y., ., , .", "<|endoftext|>x a", "É́ ΣΑΣ. ΟΔΟΣ", "日本語 テキスト", "word " * 300, "a" * 5000, None, "Ab c\tD   e"]


def test_encoder_equals_tokenizer():
    tokenizer = load_tokenizer(PATH)
    for text, found in zip(ODD, Encoder(PATH).encode(ODD), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_sweeps_place_all_without_overlap(spark, seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 60, 500])
    counts = {n: rng.choice([1, 3, 40, 5000]) for n in rng.sample(range(1, capacity + 1), rng.randint(1, min(capacity, 30)))}
    held, seen = {}, {n: [] for n in counts}
    for length, a, b, per, first, offset in sweeps(spark, counts, capacity):
        for r in range(a, b):
            held.setdefault(first + (r - a) // per, []).append((offset + (r - a) % per * length, length))
            seen[length].append(r)
    assert all(sorted(seen[n]) == list(range(c)) for n, c in counts.items())
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(held) <= plain_best_fit(counts, capacity) * 1.02 + 2


def plain_best_fit(counts, capacity):
    """Sequences that best fit by falling length needs, a piece at a time."""
    gaps = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            k = bisect_left(gaps, length)
            gap = gaps.pop(k) if k < len(gaps) else capacity
            insort(gaps, gap - length)
    return len(gaps)


def test_successors_and_rank_matches(spark):
    classes = spark.createDataFrame([(10, 3), (8, 2)], "length long, left long")
    gaps = spark.createDataFrame([(9, 0, 1), (8, 5, 4), (7, 9, 1), (12, 20, 9)], "gap long, first long, count long")
    assert sorted((r["gap"], r["length"], r["ahead"]) for r in successors(classes, gaps).collect()) == [(8, 8, 0), (9, 8, 4), (12, 10, 0)]
    room = spark.createDataFrame([(20, 0, 2, 2), (10, 7, 1, 1)], "gap long, first long, count long, per long")
    assert sorted(tuple(r) for r in rank_matches(classes, room).collect()) == [(8, 0, 20, 0, 2, 2, 4), (10, 0, 10, 7, 1, 0, 1), (10, 1, 20, 0, 2, 0, 2)]


def test_pack_rows(spark):
    docs = spark.createDataFrame([(k, t, "x", 7) for k, t in enumerate([*ODD, ODD[2], ODD[2]])], "doc_id long, text string, offset string, length int")
    rows = pack(docs, PATH, capacity=64, with_ids=True).collect()
    assert {r["doc_id"] for r in rows} == set(range(len(ODD) + 2))
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    tokenizer = load_tokenizer(PATH)
    for k, text in enumerate(ODD):
        parts = sorted(by_doc[k], key=lambda r: r["piece"])
        assert sum((r["ids"] for r in parts), []) == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert all(r["length"] == 64 for r in parts[:-1]) and [r["start"] for r in parts] == [64 * i for i in range(len(parts))]
    for pieces in by_sequence.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0, *(n for _, n in pieces[:-1])]).tolist() and sum(pieces[-1]) <= 64
    assert pack(docs.limit(0), PATH).count() == 0


def plan_cost(blocks, plan):
    cost = 0
    for i, to in plan.items():
        n = sum(to.values())
        for rows, each in blocks[i]:
            k = min(n, rows)
            cost, n = cost + k * each, n - k
    return cost


def test_transfers_are_cheapest():
    rng = random.Random(5)
    for _ in range(40):
        shards = rng.randint(1, 5)
        blocks = {i: sorted([(rng.randint(1, 6), float(rng.randint(1, 9))) for _ in range(rng.randint(1, 3))], key=lambda b: b[1]) for i in range(rng.randint(1, 5))}
        counts = {i: sum(n for n, _ in b) for i, b in blocks.items()}
        capacity = row_capacities(counts, shards)
        plan = cheapest_transfers(blocks, capacity)
        after = [counts.get(j, 0) - sum(plan.get(j, {}).values()) + sum(to.get(j, 0) for to in plan.values()) for j in range(shards)]
        assert after == capacity and max(capacity) - min(capacity) <= 1
        least = 0  # each shard must send what is over its capacity, its cheapest rows first
        for i, b in blocks.items():
            n = counts[i] - min(counts[i], capacity[i] if i < shards else 0)
            each = sorted(w for k, w in b for _ in range(k))
            least += sum(each[:n])
        assert plan_cost(blocks, plan) == pytest.approx(least)


CLASHING = "doc_id long, text string, old int, shard string, slot string, old_shard int, salt int, cat int, row int, parts int"


def reshard_rows(k):
    return [(i % 50, None if i % 17 == 0 else "é" * (i * i % 90), None if i % 13 == 0 else -5 if i % 29 == 0 else i % 3 if i % 5 else 6000, "s", "t", 1, 2, 3, 4, 5) for i in range(k)]


@pytest.mark.parametrize("shards", [1, 2, 5, 9])
def test_reshard_and_rewrite(spark, tmp_path, shards):
    rows = [*reshard_rows(211), (None, "n", 4097, "s", "t", 1, 2, 3, 4, 5)]
    docs = spark.createDataFrame(rows, CLASHING)
    found = reshard(docs, F.col("old"), shards).collect()
    slots, old = {}, {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
        old.setdefault(r["old_shard"], []).append(r)
    assert len(found) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) == set(range(shards)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    key = lambda i, n, c, o: (i is None, i or 0, n, c, o)
    want = sorted(key(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), -1 if o is None or o < 0 else o) for i, t, o, *_ in rows)
    assert sorted(key(*r[:4]) for r in found) == want
    for i, mine in old.items():  # the smallest rows go, and no more than must
        moved = sorted(r["size"] for r in mine if r["shard"] != i)
        assert moved == sorted(r["size"] for r in mine)[: len(moved)]
        assert len(moved) == len(mine) - (min(len(mine), len(slots[i])) if 0 <= i < shards else 0)
    plan = plan_shards(docs, F.col("old"), shards)
    files = rewrite_affected(docs, F.col("old"), plan, str(tmp_path / "out"))
    assert files.columns == [*docs.columns, "_slot", "_shard"] and {r["slot"] for r in files.collect()} == {"t"}
    assert sorted(r["_slot"] for r in files.collect()) == sorted(r["slot"] for r in found if r["shard"] in plan.affected)
    assert sorted(map(tuple, rewritten(docs, F.col("old"), shards).select(*found[0].asDict()).collect()), key=str) == sorted(map(tuple, found), key=str)
    assert reshard(docs.limit(0), F.col("old"), shards).count() == 0 == rewritten(docs.limit(0), F.col("old"), shards).count()


def test_nothing_moves_where_shards_are_even(spark):
    docs = spark.createDataFrame([(k, "x" * k, k % 4) for k in range(100)], "doc_id long, text string, old int")
    assert plan_shards(docs, F.col("old"), 4).affected == []
    assert all(r["shard"] == r["old_shard"] for r in rewritten(docs, F.col("old"), 4).collect())


def test_encoder_letters_that_become_marks():
    tokenizer, known = load_tokenizer(PATH), Encoder(PATH)
    words = ["বড়", "जड़", "BELEDİYESİ", "ŞEHRİ", "İstanbul", "שׁ", "Straße", "ΟΔΟΣ", "한국어"]
    odd = [chr(c) for c in range(0x110000) if chr(c).isalpha() and not unicodedata.normalize("NFC", chr(c)).lower().isalpha()]
    texts = [f"{w}{m}" for w in [*words, *("a" + c for c in odd)] for m in ["", ",", "."]]
    for text, found in zip(texts, known.encode(texts), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)
    together = " ".join(texts)
    assert np.frombuffer(next(Encoder(PATH).encode([together])), "<u4").tolist() == tokenizer.encode(together, add_special_tokens=False).ids


def test_resharding_query_reads_written_shards(spark, tmp_path, monkeypatch):
    docs = [(k, None if k % 7 == 0 else "é" * (k % 50), "en") for k in range(300)] + [(5, "é" * 5, "en")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    written = []
    monkeypatch.setattr(sharding, "rewrite_affected", lambda *a: (written.append(a[3]), rewrite_affected(*a))[1])
    rows = registry.op3_flow_resharding(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == sorted((k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t, _ in docs)
    affected = {s for r in rows if r["old_shard"] != r["shard"] for s in (r["old_shard"], r["shard"])}
    files = spark.read.parquet(*written).select("doc_id", "shard", "slot").collect()
    assert affected and sorted(map(tuple, files)) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in rows if r["shard"] in affected)
    slots = {}
    for r in rows:
        assert r["old_shard"] == zlib.crc32(str(r["doc_id"]).encode()) % 32
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
