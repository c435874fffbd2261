import gzip
import hashlib
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corvox.llm import audio as A
from corvox.llm import warc as W
from corvox.llm.ngram_join import ngram_components

TEXTS = [None, "", "a", "é" * 31, "x" * 64, "words and words " * 900, "words and words " * 900]


def test_digests(spark):
    docs = spark.createDataFrame([(k, t, "f") for k, t in enumerate(TEXTS)], "doc_id long, text string, feature string")
    rows = {r["doc_id"]: r for r in A.audio_digests(docs).collect()}
    for k, t in enumerate(TEXTS):
        raw = (t or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        media = A.encode_wav(payload)
        assert tuple(rows[k])[1:7] == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest())
        assert A.decode_wav(media) == (payload, A.RATE)
    assert rows[5]["feature"] == rows[6]["feature"] != rows[4]["feature"] and rows[0]["feature"] == rows[1]["feature"]
    assert A.audio_digests(docs.limit(0)).count() == 0


def test_resampling_is_a_low_pass():
    t = np.arange(4000) / 16000
    low, high = np.sin(2 * np.pi * 500 * t).astype(np.float32), np.sin(2 * np.pi * 7000 * t).astype(np.float32)
    y = A.resample(low)
    want = np.sin(2 * np.pi * 500 * np.arange(2000) / 8000)
    k = np.argmax([np.dot(y[100:1900], np.roll(want, s)[100:1900]) for s in range(-3, 4)]) - 3
    assert np.abs(y - np.roll(want, k))[100:1900].max() < 0.2 and np.abs(A.resample(high))[100:1900].max() < 0.05
    assert len(A.resample(low, 3, 2)) == 6000


def test_blocks_give_the_same_features(monkeypatch):
    payload = np.random.default_rng(0).integers(0, 256, 40_000, dtype=np.uint8).tobytes()
    whole = A.log_mel(payload)
    monkeypatch.setattr(A, "BLOCK", 4096)
    assert np.allclose(A.log_mel(payload), whole, atol=1e-3)


def test_segments_have_hysteresis():
    mel = np.full((100, A.BANDS), -50.0, np.float32)
    mel[20:30], mel[30:35], mel[60:62] = -40, -49.2, -49.2
    step = A.HOP * A.DOWN / (A.UP * A.RATE)
    assert A.segments(mel) == [pytest.approx((20 * step, 35 * step))]


def test_tensors(spark):
    media = spark.createDataFrame([(1, A.encode_wav(A.payload_of("speech " * 4000))), (2, None)], "clip long, media binary")
    found = A.audio_features(media, "clip", "media").toArrow()
    shaped = A.as_tensor(found["tensor"])
    assert shaped.type.shape == [A.WINDOW, A.BANDS] and len(shaped) == found.num_rows > 1
    assert found["start_s"].to_pylist()[1] == found["end_s"].to_pylist()[0]


def test_warc_round_trip(spark, tmp_path):
    records = [
        ("<1>", "response", "http://a/x", "2024-01-01T00:00:00Z", 200, {"ETag": '"q"', "Date": "1"}, b"body\r\n\r\nmore", None),
        ("<2>", "revisit", "http://a/x", "2024-01-02T00:00:00Z", 304, {"ETag": 'W/"q"'}, b"", "http://netpreserve.org/warc/1.1/revisit/server-not-modified"),
        ("<3>", "metadata", "http://a/x", "2024-01-02T00:00:00Z", None, {}, b"free text", None),
    ]
    data = [W.format_record(*r) for r in records]
    (tmp_path / "a.warc").write_bytes(b"".join(data))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, data)))
    rows = W.read_warc(spark, str(tmp_path)).orderBy("record_id").collect()
    assert len(rows) == 6
    for r, want in zip(rows[::2], records, strict=True):
        assert (r["record_id"], r["type"], r["url"], r["date"], r["status"], bytes(r["body"]), r["profile"]) == (*want[:5], want[6], want[7])
        assert r["headers"] == {k.lower(): v for k, v in want[5].items()}


def test_canonical_urls(spark):
    pairs = [("HTTP://A.Example:80", "http://a.example/"), ("https://A:443/Q?utm_x=1&b=2&utm_y=3#f", "https://a/Q?b=2"), ("http://a?utm_x=1", "http://a/"), ("http://a:8080/?a=1&b", "http://a:8080/?a=1&b"), ("mailto:X", "mailto:X"), (None, None)]
    df = spark.createDataFrame([(u,) for u, _ in pairs], "u string")
    assert [r[0] for r in df.select(W.canonical_url(F.col("u"))).collect()] == [c for _, c in pairs]


def test_revisits_against_plain(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(400):
        full = rng.random() < 0.4
        headers = {"date": str(k), "content-length": str(k), "x": "old" if full else "new"}
        if rng.random() < 0.8:
            headers["etag"] = f'"{rng.integers(3)}"'
        if rng.random() < 0.5:
            headers["last-modified"] = str(rng.integers(3))
        url = None if k % 97 == 0 else f"http://h/{'hot' if rng.random() < 0.5 else rng.integers(9)}"
        rows.append((k, url, "response" if full else "revisit", 200 if full else 304, headers, None if k % 89 == 0 else int(rng.integers(300)), "e"))
    df = spark.createDataFrame(rows, "record_id long, url string, type string, status int, headers map<string,string>, t long, outcome string")
    got = {r["record_id"]: r for r in W.resolve_revisits(df, "t", bucket=50).collect()}
    revisits = [r for r in rows if r[2] == "revisit"]
    assert set(got) == {r[0] for r in revisits}
    for k, url, _, _, h, t, _ in revisits:
        earlier = [(r[5], r[0], r[4]) for r in rows if r[2] == "response" and url and r[1] == url and t is not None and r[5] is not None and r[5] < t]
        r = got[k]
        if not earlier:
            assert r["outcome"] == "orphan" and r["headers"] is None
            continue
        _, source, old = max(earlier, key=lambda e: e[:2])
        name = next((n for n in ("etag", "last-modified") if n in h and n in old), None)
        want = "unchecked" if name is None else "merged" if h[name] == old[name] else "mismatch"
        assert (r["source_id"], r["outcome"]) == (source, want)
        assert r["headers"] == (None if want == "mismatch" else {**old, **{n: v for n, v in h.items() if n != "content-length"}})


def test_pipeline_stages(spark, tmp_path):
    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    seen = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, base)
        docs.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen.append(docs.count())
        if k < 4:
            assert docs.columns == before.columns
        if k == 1:
            assert docs.select(F.lower("text")).distinct().count() <= docs.count()
        if k == 2:
            found = ngram_components(docs).where("n_shingles > 0")
            assert found.select("component_id").distinct().count() == found.count()
    assert seen[0] >= seen[1] >= seen[2] >= seen[3] <= seen[4] and {"doc_id", "piece", "sequence_id", "offset"} <= set(docs.columns)
    assert json.dumps(seen)


def test_digests_come_from_stored_media_and_tensors(spark, tmp_path, monkeypatch):
    stored = {}
    monkeypatch.setattr(A, "materialize", lambda df, label: stored.setdefault(label, df.write.parquet(str(tmp_path / label)) or spark.read.parquet(str(tmp_path / label))), raising=False)
    docs = spark.createDataFrame([(None if k == 3 else 7, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    rows = A.audio_digests(docs).collect()
    assert len(rows) == len(TEXTS)
    media = {r["_row"]: bytes(r["media"]) for r in stored["audio-media"].collect()}
    assert sorted(media.values()) == sorted(A.encode_wav(A.payload_of(t)) for t in TEXTS)
    windows = stored["audio-features"].collect()
    second = A.HOP * A.DOWN / (A.UP * A.RATE)
    for row, data in media.items():
        mine = sorted((r for r in windows if r["_row"] == row), key=lambda r: r["window"])
        mel = A.log_mel(A.decode_wav(data)[0])
        assert [r["window"] for r in mine] == list(range(-(-len(mel) // A.WINDOW))) and round(mine[-1]["end_s"] / second) == len(mel)
        assert np.array_equal(np.concatenate([np.array(r["tensor"], np.float32).reshape(A.WINDOW, A.BANDS) for r in mine])[: len(mel)], mel)
    for r in rows:
        mel = A.log_mel(next(A.decode_wav(m)[0] for m in media.values() if hashlib.sha256(m).hexdigest() == r["media_sha256"]))
        found = dict(x.split("=") for x in r["feature"].split(";"))
        assert (int(found["frames"]), int(found["segments"]), int(found["windows"])) == (len(mel), len(A.segments(mel)), -(-len(mel) // A.WINDOW))
        assert np.allclose([float(x) for x in found["mel"].split(",")], mel.mean(axis=0, dtype=np.float64), atol=0.0502)
        assert len(found["tensors"]) == 8
