"""Edges of the training-data operators, and brute-force versions of those that SQL can't express."""

import gzip
import logging
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corvox.llm import audio as A
from corvox.llm import mixing as M
from corvox.llm import ngram_join as J
from corvox.llm import url_filter as U
from corvox.llm.exact_dedup import dedup_rows
from corvox.llm.langid import Model, identify
from corvox.llm.ngram_join import needed, ngram_components, one_of_each
from corvox.llm.registry import op8_language_id, op10_toxicity
from corvox.llm.shingles import shingle_sets
from corvox.llm.toxicity import Scorer, subwords, toxicity, train
from corvox.llm.warc import format_record, parse_warc, read_warc, resolve_revisits

CLASHING = [
    "doc_id", "text", "_copies", "_mixed", "_copy", "_stay", "_sha_", "_k", "_s", "row", "id", "sha", "stay", "mixed", "copies", "rate",
    "tokens", "u", "h1", "n", "score_", "_scored", "part", "component_id", "n_shingles", "keep_id", "bucket",
]


def clashing(spark, rows):
    return spark.createDataFrame([(k, t, *range(len(CLASHING) - 2)) for k, t in rows], "doc_id long, text string, " + ", ".join(f"`{c}` int" for c in CLASHING[2:]))


def test_clashing_columns(spark):
    rows = [(k, f"some words number {k % 4} and a few others too") for k in range(8)] + [(None, None), (3, "")]
    docs = clashing(spark, rows)
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    quality = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "bad")
    kept = M.mix(docs, labels, quality, {"good": 0.5, "bad": 0.5}, low=1.0, high=1.0)
    assert kept.columns == CLASHING and kept.count() == len(rows) and {r["_copies"] for r in kept.collect()} == {0}
    once = dedup_rows(docs)
    assert once.columns == CLASHING and once.count() == 5 and {r["_sha_"] for r in once.collect()} == {4}
    one = one_of_each(docs)
    assert one.columns == CLASHING and {r["doc_id"] for r in one.collect()} == {0, 1, 2, 3, None}
    scored = toxicity(docs, labels)
    assert scored.columns == [*CLASHING, "score", "predicted"] and scored.count() == len(rows)


def thue_morse(a, b, rounds):
    word = a
    for _ in range(rounds):
        word += word.translate(str.maketrans(a + b, b + a))
    return word


def test_long_words_do_not_collide(spark):
    """Under a polynomial modulo 2**64 with any odd base these two words are one."""
    words = [thue_morse("a", "b", 11), thue_morse("b", "a", 11)]
    for seeds in ((0,), (1,)):
        x, y = shingle_sets(words, 5, seeds)
        assert x.tolist() != y.tolist()
    rows = [(k, w) for k, w in enumerate(words)] + [(k + 2, f"one two {w} three four five") for k, w in enumerate(words)]
    assert [r["component_id"] for r in ngram_components(clashing(spark, rows)).orderBy("doc_id").collect()] == [0, 1, 2, 3]


def test_words_of_all_lengths_have_their_own_hashes():
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("ab", k=n)) for n in range(1, 80) for _ in range(30)} | {"a" * n for n in range(1, 300)})
    for seed in (0, 1):
        found = {int(s[0]) for s in shingle_sets(words, 5, (seed,))}
        assert len(found) == len(words)
    alone = [int(s[0]) for s in shingle_sets(words)]
    assert alone == [int(s[0]) for w in words for s in shingle_sets([w])]  # whatever stands beside them
    first, second = zip(*shingle_sets(["a b c d e f g a b c d e f g"], 5, (0, 1)), strict=True)
    assert len(first[0]) == len(second[0]) == 7


def test_block_pairs_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 3)
    rng = random.Random(5)
    rows = [(k % 2, k, n, rng.randrange(max(1, n - -(-80 * n // 100) + 1)), k, bytes(128)) for k, n in enumerate(rng.choices([1, 2, 3, 4, 5, 16, 20, 24, 25, 30, 31, 38, 100, 125], k=80))]
    entries = spark.createDataFrame(rows, "list long, u long, n int, place int, root long, bits binary")
    met = {}
    for r in J.block_pairs(entries, 80).collect():
        met.setdefault((r["list"], r["x"], r["y"]), []).append((r["mine"], r["u"]))
    together = {tuple(sorted((a, b))) for (_, x, y), mine in met.items() for s, a in mine if s == x for t, b in mine if t == y}
    least = needed(80)
    for la, a, na, pa, _, _ in rows:
        for lb, b, nb, pb, _, _ in rows:
            if a < b and la == lb and min(na, nb) >= least(na, nb) and na - pa >= least(na, nb) and nb - pb >= least(na, nb):
                assert (a, b) in together


def test_join_of_rows_without_ids(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(None, text), (None, text + " more"), (4, text + " words"), (None, "quite another text of more than five words")]
    found = ngram_components(clashing(spark, rows)).collect()
    assert sorted(str(r["component_id"]) for r in found) == ["4", "4", "4", "None"]


def test_broken_warc_files(spark, tmp_path):
    whole = format_record("<1>", "response", "http://a/", "2024-01-01T00:00:00Z", 200, {"ETag": "1"}, b"body" * 500)
    names = lambda data: [r[0] for r in parse_warc(data)]
    packed = gzip.compress(whole)
    assert names(whole + whole[:60]) == ["<1>"] == names(whole + whole[:-900])
    for cut in (3, 15, 40, len(packed) - 40):
        assert names(packed + packed[:cut]) == ["<1>"]
    assert names(whole + whole.replace(b"Content-Length: 2", b"Content-Length: x")) == ["<1>"]
    assert names(whole + b"not a record") == ["<1>"] == names(packed + b"tail") and names(b"") == []
    (tmp_path / "a.warc.gz").write_bytes(packed[:-40])
    (tmp_path / "b.warc.gz").write_bytes(packed)
    (tmp_path / "c.warc").write_bytes(whole.replace(b"Content-Length: ", b"Content-Length: -"))
    assert [r["record_id"] for r in read_warc(spark, str(tmp_path)).collect()] == ["<1>"]


def test_revisits_over_far_spans_and_alike_responses(spark):
    day = 86_400
    rows = [("a", "http://h/", "response", 200, {"x": "old"}, 10), ("b", "http://h/", "response", 200, {"x": "new"}, 5000 * day), ("v", "http://h/", "revisit", 304, {}, 4999 * day), ("w", "http://h/", "revisit", 304, {}, 20_000 * day)]
    rows += [("d", "http://i/", "response", 200, {"x": x}, 10) for x in ("1", "3", "2")] + [("y", "http://i/", "revisit", 304, {}, 20), ("z", None, "revisit", 304, {}, 20), ("q", "http://i/", "revisit", 304, None, None)]
    df = spark.createDataFrame(rows, "record_id string, url string, type string, status int, headers map<string,string>, t long")
    for parts in (1, 7):
        found = {r["record_id"]: (r["source_id"], (r["headers"] or {}).get("x")) for r in resolve_revisits(df.repartition(parts), "t").collect()}
        assert found == {"v": ("a", "old"), "w": ("b", "new"), "y": ("d", "3"), "z": (None, None), "q": (None, None)}


def test_texts_without_letters_are_undetermined(spark):
    docs = spark.createDataFrame([(1, "hello world", "aa"), (2, "guten morgen", "bb"), (3, "\u00b2 \u00b3 \u00bd \u2460", None), (4, "\u2167 42", None), (5, "x\u00b2", None), (None, "hello", None)], "doc_id long, text string, lang string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(docs).collect()}
    assert found[3] == found[4] == ("und", 0.0) and found[5][0] in ("aa", "bb") and found[None][0] == "aa"


def test_null_ids_are_not_held_out(spark, tmp_path):
    docs = [(k, "hello world" if k % 2 else "guten morgen", "aa" if k % 2 else "bb", "s", 1) for k in range(40)] + [(None, "hello", "aa", "s", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, k % 2) for k in range(40)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for query in (op8_language_id, op10_toxicity):
        rows = {r["doc_id"]: r["held_out"] for r in query(spark, str(tmp_path)).collect()}
        assert len(rows) == 41 and rows[None] is False and set(map(type, rows.values())) == {bool}


# -- brute-force versions ---------------------------------------------------------------


def murmur_free_posteriors(spark, docs, labels, domains):
    """Naive Bayes in plain Python; only a word's bucket comes from Spark's hash."""
    words = {k: [w for w in re.split("[ \n\t\r]", t.lower()) if w] for k, t in docs}
    vocabulary = sorted({w for ws in words.values() for w in ws})
    hashed = spark.createDataFrame([(w,) for w in vocabulary], "w string").select("w", F.pmod(F.hash("w"), F.lit(M.BUCKETS)).alias("b"))
    bucket = {r["w"]: r["b"] for r in hashed.collect()}
    counts = {d: Counter() for d in domains}
    for k, d in labels:
        counts[d].update(bucket[w] for w in words[k])
    seen = set().union(*counts.values())
    floor = {d: sum(counts[d].values()) + M.SMOOTH * M.BUCKETS for d in domains}
    of = Counter(d for _, d in labels)
    out = {}
    for k, ws in words.items():
        logs = []
        for d in domains:
            s = sum(math.log(((counts[d][bucket[w]] if bucket[w] in seen else 0) + M.SMOOTH) / floor[d]) for w in ws)
            logs.append(math.log((of[d] + 1) / (len(labels) + len(domains))) + s * min(len(ws), M.EVIDENCE) / max(1, len(ws)))
        e = np.exp(np.array(logs) - max(logs))
        out[k] = len(ws), e / e.sum()
    return out


def plain_rates(tokens, p, target, low, high, steps=20_000):
    """Least squares in a box by plain projected gradient, to the end."""
    a = (p * tokens[:, None]).T / target[:, None]
    x, size = np.full(len(tokens), 1.0), np.linalg.eigvalsh((p * tokens[:, None]).T @ p / np.outer(target, target)).max()
    for _ in range(steps):
        x = np.clip(x - p @ ((a @ x - 1) / target) / size, low, high)
    return a @ x * target


@pytest.mark.parametrize("weights,low,high", [({"good": 0.5, "bad": 0.5}, 0.0, 4.0), ({"good": 0.02, "bad": 0.98}, 0.5, 1.5)])
def test_mixing_against_plain(spark, caplog, weights, low, high):
    rng = random.Random(2)
    common, good, bad = ([f"{c}{k}" for k in range(40)] for c in "cgb")
    docs, labels = [], []
    for k in range(120):
        kind = "good" if k % 3 else "bad"
        docs.append((k, " ".join(rng.choices(common, k=rng.randint(0, 12)) + rng.choices(good if kind == "good" else bad, k=rng.randint(1, 4)))))
        if k % 2:
            labels.append((k, kind))
    table = spark.createDataFrame([*docs, (500, None), (501, "")], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, kind string")
    totals = {}
    with caplog.at_level(logging.WARNING):
        rows = {r["doc_id"]: r for r in M.mixing_rates(table, marks, F.col("kind"), weights, low=low, high=high, totals=totals).collect()}
    domains = sorted(weights)
    want = murmur_free_posteriors(spark, docs, labels, domains)
    for k, (n, p) in want.items():
        assert rows[k]["tokens"] == n and np.allclose([rows[k][f"p_{d}"] for d in domains], p, atol=1e-9)
    assert rows[500]["tokens"] == rows[501]["tokens"] == 0
    tokens, p = np.array([n for n, _ in want.values()], float), np.array([q for _, q in want.values()])
    target = np.array([weights[d] for d in domains]) * tokens.sum()
    reached = np.array([sum(rows[k]["rate"] * n * q[j] for k, (n, q) in want.items()) for j in range(2)])
    best = plain_rates(tokens, p, target, low, high)
    assert np.allclose(reached, best, rtol=0.01) and np.allclose(reached, [totals[d][0] for d in domains], rtol=1e-3)
    missed = np.abs(best / target - 1).max() > 0.011
    assert missed == (low > 0) and missed == any("mixing" in r.message for r in caplog.records)
    assert all(low <= r["rate"] <= high and r["copies"] in (math.floor(r["rate"]), math.floor(r["rate"]) + 1) for r in rows.values())


def test_language_model_against_plain(spark):
    rng = random.Random(8)
    langs = {"aa": "abcde", "bb": "cdefg", "cc": "efghi"}
    docs = [(k, " ".join("".join(rng.choices(langs[x], k=rng.randint(1, 6))) for _ in range(rng.randint(1, 9))), x) for k, x in enumerate(rng.choices(list(langs), k=90))]
    found = {r["doc_id"]: r for r in identify(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    names, totals, table = sorted(langs), {}, {}
    counts = {x: Counter(w for _, t, y in docs if y == x for w in t.split()) for x in names}
    for n in range(6):  # 0: words
        per = {x: counts[x] if n == 0 else Counter() for x in names}
        for x in names if n else ():
            for w, c in counts[x].items():
                for i in range(len(w) + 3 - n):
                    per[x][f"<{w}>"[i : i + n]] += c
        keys = set().union(*per.values())
        totals[n] = len(keys)
        table[n] = {g: [math.log((per[x][g] + 0.5) / (sum(per[x].values()) + 0.5 * len(keys))) for x in names] for g in keys}
    for k, text, _ in docs:
        mean = np.mean([table[0][w] for w in text.split()], axis=0)
        assert found[k]["lang_pred"] == names[int(np.argmax(mean))]
        assert found[k]["score"] == pytest.approx(1 / np.exp((mean - mean.max()) * min(len(text.split()), 25)).sum(), abs=1e-4)
    model = Model([(x, t) for _, t, x in docs])
    for word in ("abcdx", "zz", "ghihg", "xa"):
        n = next((n for n in range(5, 0, -1) if any(f"<{word}>"[i : i + n] in table[n] for i in range(len(word) + 3 - n))), None)
        grams = [table[n][g] for i in range(len(word) + 3 - n) if (g := f"<{word}>"[i : i + n]) in table[n]] if n else [[0, 0, 0]]
        assert np.allclose(model.backoff(word), np.mean(grams, axis=0), atol=1e-5)


def test_first_tree_against_every_split():
    rng = random.Random(6)
    urls = [f"http://{'x' * rng.randint(1, 9)}.com/{'/'.join('a' * rng.randint(0, 3))}?{'&'.join('q' * rng.randint(0, 4))}" for _ in range(120)]
    y = [int(len(u) % 7 < 3) for u in urls]
    model = U.fit(urls, y)
    x, p = model.binned(model.features(urls)), np.mean(y)
    g, h = p - np.array(y), np.full(len(y), p * (1 - p))
    gain = lambda m: g[m].sum() ** 2 / (h[m].sum() + U.RIDGE)
    every = {(f, c): gain(x[:, f] <= c) + gain(x[:, f] > c) - gain(np.full(len(y), True)) for f in range(x.shape[1]) for c in range(U.BINS)}
    feature, cut = model.splits[0]
    assert every[feature[0], cut[0]] == pytest.approx(max(every.values()))
    leaf = U.walk(x, feature, cut)
    for k in range(2**U.DEPTH):
        if (leaf == k).any():
            assert model.leaves[0][k] == pytest.approx(-U.RATE * g[leaf == k].sum() / (h[leaf == k].sum() + U.RIDGE))
    base = model.base + sum(t[U.walk(x, f, c)] for (f, c), t in zip(model.splits, model.leaves, strict=True))
    assert np.allclose(model.margin(urls), base)


def test_toxicity_scores_against_plain():
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefg", k=rng.randint(1, 8))) for _ in range(60)]
    texts = [" ".join(rng.choices(words, k=12)) for _ in range(60)]
    scores, bias = train(texts, [int("a" in t.split()[0]) for t in texts], epochs=5)
    for text, got in zip([*texts, "", "unseen wordz"], Scorer(scores.astype(np.float32), bias).score([*texts, "", "unseen wordz"]), strict=True):
        mean = []
        for w in set(text.split()):
            grams, _ = subwords([w])
            assert len(grams) == 1 + sum(max(0, len(w) + 3 - n) for n in (3, 4, 5))
            mean.append(np.mean(scores[grams]))
        margin = bias + (np.mean(mean) if mean else 0.0)
        assert got == pytest.approx(1 / (1 + math.exp(-min(30.0, max(-30.0, margin)))), abs=1e-5)


def test_training_gradient_against_differences():
    """One small step lowers the loss as the gradient says: losses fall over the first epochs."""
    texts, labels = ["bad awful", "nice day", "bad thing", "fine thing here"], [1, 0, 1, 0]

    def loss(epochs):
        scores = list(Scorer(*train(texts, labels, epochs=epochs, rate=0.01)).score(texts))
        return -sum(math.log(s if y else 1 - s) for s, y in zip(scores, labels, strict=True))

    losses = [loss(e) for e in (1, 5, 10, 20)]
    assert losses == sorted(losses, reverse=True)


def plain_log_mel(payload):
    """Every output sample and bin by its definition, one at a time."""
    x = (np.frombuffer(payload, np.uint8).astype(np.float64) - 128) / 128
    taps = np.arange(A.TAPS) - (A.TAPS - 1) / 2
    h = np.sinc(taps / A.DOWN) * np.hamming(A.TAPS)
    h /= h.sum()
    y = [sum(h[k] * x[i] for k in range(A.TAPS) if 0 <= (i := 2 * n + A.TAPS // 2 - k) < len(x)) for n in range(-(-len(x) // 2))]
    frames = max(1, 1 + -(-(len(y) - A.FRAME) // A.HOP))
    y = np.concatenate([y, np.zeros(frames * A.HOP + A.FRAME - len(y))])
    mel = lambda f: 2595 * math.log10(1 + f / 700)
    edges = [700 * (10 ** ((mel(20) + k * (mel(4000) - mel(20)) / (A.BANDS + 1)) / 2595) - 1) for k in range(A.BANDS + 2)]
    window = [0.5 - 0.5 * math.cos(2 * math.pi * k / A.FRAME) for k in range(A.FRAME)]
    turn = np.exp(-2j * np.pi * np.outer(np.arange(A.FRAME // 2 + 1), np.arange(A.FRAME)) / A.FRAME)
    out = np.zeros((frames, A.BANDS))
    for f in range(frames):
        power = np.abs(turn @ (y[f * A.HOP : f * A.HOP + A.FRAME] * window)) ** 2
        for b in range(A.BANDS):
            lo, mid, hi = edges[b : b + 3]
            shape = [max(0.0, min((v - lo) / (mid - lo), (hi - v) / (hi - mid))) for v in np.arange(A.FRAME // 2 + 1) * 8000 / A.FRAME]
            out[f, b] = 10 * math.log10(power @ shape + 1e-6)
    return out


def plain_segments(mel):
    level = mel.mean(axis=1, dtype=np.float64)
    rest, on, spans, step = np.median(level), None, [], A.HOP * 2 / A.RATE
    for f, v in enumerate(level):
        if on is None and v >= rest + A.RISE_DB:
            on = f
        elif on is not None and v < rest + A.FALL_DB:
            spans.append((on * step, f * step))
            on = None
    return spans + ([(on * step, len(level) * step)] if on is not None else [])


def test_mel_and_segments_against_plain():
    rng = np.random.default_rng(4)
    for n in (64, 640, 3072):
        payload = rng.integers(0, 256, n, dtype=np.uint8).tobytes()
        assert np.allclose(A.log_mel(payload), plain_log_mel(payload), atol=0.05)
    for _ in range(20):
        mel = (rng.normal(size=(60, A.BANDS)) + np.repeat(rng.normal(size=(12, 1)) * 3, 5, axis=0)).astype(np.float32)
        assert np.allclose(A.segments(mel), plain_segments(mel))


def test_pipeline_against_plain(spark, tmp_path):
    """Stages over a small table with planted copies, and plain versions of what each one keeps."""
    rng = random.Random(12)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(60):
        text = " ".join(rng.choices(words, k=rng.randint(8, 60)))
        rows += [(3 * k, text), (3 * k + 1, text.upper() if k % 4 == 0 else text + " tail" if k % 4 == 1 and len(text) > 200 else text[::-1])]
    rows += [(1000, None), (1001, ""), (1002, ""), (1003, "vile scum words")]
    spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, int(k % 9 > 0), 0) for k, _ in rows[:100]], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
    clean = [(r["doc_id"], r["text"]) for r in kept["toxicity"]]
    assert len(clean) == len(rows)  # no toxic label: nothing is rejected
    groups = {}
    for k, t in clean:
        groups.setdefault((t or "").lower(), []).append(k)
    assert sorted(r["doc_id"] for r in kept["exact_dedup"]) == sorted(map(max, groups.values()))
    left = [(r["doc_id"], r["text"]) for r in kept["exact_dedup"]]
    sets = {}
    for k, t in left:
        w = (t or "").lower().split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    links = {(a, b) for a in sets for b in sets if a < b and (i := len(sets[a] & sets[b])) and 100 * i >= 80 * (len(sets[a] | sets[b]))}
    assert links and sorted(r["doc_id"] for r in kept["near_dedup"]) == sorted(set(sets) - {b for _, b in links})
    assert {r["doc_id"] for r in kept["mixing"]} == {r["doc_id"] for r in kept["near_dedup"]}
    copies = Counter(r["doc_id"] for r in kept["mixing"])
    assert max(copies.values()) <= 4 and Counter(r["doc_id"] for r in kept["packing"] if r["piece"] == 0) == copies
    for pieces in {r["sequence_id"]: None for r in kept["packing"]}:
        mine = sorted((r["offset"], r["length"]) for r in kept["packing"] if r["sequence_id"] == pieces)
        assert [o for o, _ in mine] == [sum(n for _, n in mine[:i]) for i in range(len(mine))] and sum(mine[-1]) <= 2048
    assert zlib.crc32(b"") == 0
