import hashlib
import random
import re

import pytest

from corvox.llm.components import components
from corvox.llm.exact_dedup import dedup_rows, exact_dedup
from corvox.llm.ngram_join import ngram_components, one_of_each
from corvox.llm.shingles import shingle_sets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, bucket string, page int, n int, lang string"


def table(spark, rows):
    return spark.createDataFrame([(k, t, "b", 1, 2, None) for k, t in rows], SCHEMA)


def near_texts(rng):
    words = [f"w{k}" for k in range(400)]
    rows, k = [], 0
    shared = rng.choices(words, k=40)
    for _ in range(25):
        base = rng.choices(words, k=rng.randint(1, 90)) + (shared if rng.random() < 0.5 else [])
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((k, " ".join(copy)))
            k += 1
    big = rng.choices(words, k=120)
    for _ in range(120):
        copy = list(big)
        copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((k, " ".join(copy)))
        k += 1
    for t in (None, "", "  ", "one", "ONE", "one two", "\x0bone\ttwo", "é é é é é é", "Ab cD ef gh ij", "ab cd ef gh ij", "ab cd ef gh ij"):
        rows.append((k, t))
        k += 1
    return rows


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain_components(rows, pct=80):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= pct * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return {i: (len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows)}


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_all_pairs(spark, seed):
    rows = near_texts(random.Random(seed))
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_components(table(spark, rows)).collect()}
    assert found == plain_components(rows)


def test_join_edges(spark):
    assert ngram_components(table(spark, [(1, "a b c d e f")]).limit(0)).count() == 0
    rows = [(3, "a b c d e f g"), (3, "a b c d e f g"), (None, "A b c d e f g"), (9, None)]
    found = [(r["doc_id"], r["component_id"]) for r in ngram_components(table(spark, rows)).collect()]
    assert sorted(found, key=str) == sorted([(3, 3), (3, 3), (None, 3), (9, 9)], key=str)
    assert {r["doc_id"] for r in one_of_each(table(spark, rows)).collect()} == {3, 9}


def test_shingle_counts():
    texts = [t for _, t in near_texts(random.Random(7))]
    assert [len(s) for s in shingle_sets(texts)] == [len(shingles(t)) for t in texts]


@pytest.mark.parametrize("bucket_rows,depth", [(None, 20), (2, 3), (1, 0), (10**6, 20)])
def test_dedup_equals_plain(spark, bucket_rows, depth):
    rng = random.Random(11)
    texts = ["", None, "A", "a", "É", "é", "x" * 70_000, "same text"]
    rows = [(k, rng.choice(texts) if k % 3 else "same text") for k in range(150)]
    groups = {}
    for k, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(k)
    got = {r["doc_id"]: r for r in exact_dedup(table(spark, rows), bucket_rows=bucket_rows, max_depth=depth).collect()}
    assert len(got) == len(rows)
    for t, ids in groups.items():
        for k in ids:
            r = got[k]
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (max(ids), len(ids), k == max(ids), hashlib.sha256(t.encode()).hexdigest())


def test_dedup_rows_and_repeats(spark):
    rows = [(1, "A"), (1, "a"), (2, "b"), (None, "c"), (None, "b")]
    kept = dedup_rows(table(spark, rows))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted((r["doc_id"] or 0, r["text"].lower()) for r in kept.collect()) == [(0, "c"), (1, "a"), (2, "b")]
    assert exact_dedup(table(spark, rows).limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1040)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {n: find(n) for a, b in edges if a != b for n in (a, b)}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
