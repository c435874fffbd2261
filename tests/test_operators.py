import random
from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from corvox.functions.similarity import edit_ceiling, with_edit_score
from corvox.operators import align as A
from corvox.operators import matching as M
from corvox.operators import qc as Q
from corvox.operators import timing as W
from corvox.operators import verdict as V
from corvox.operators.integrity import integrity_stats, presence
from corvox.operators.report import evaluation_report, failure_types, gate


def test_failure_types_and_rounding(spark):
    sims = [0.10, 0.60, 0.80, 0.95, 0.94996]
    df = spark.createDataFrame([(str(k), s, "x", True, True, True) for k, s in enumerate(sims)], "filename string, similarity double, heard string, boundary_pass boolean, envelope_pass boolean, readable boolean")
    rows = V.evaluate(df).orderBy("filename").collect()
    assert [r["failure_types"] for r in rows] == [["D"], ["A"], ["D"], [], ["D"]]
    assert [r["verdict"] for r in rows] == ["FAIL", "FAIL", "FAIL", "PASS", "PASS"] and rows[4]["failure_reasons"]


def test_tier2_strips_and_passes(spark):
    df = V.evaluate(spark.createDataFrame([("a", 0.8, "x", True, True, True)], "filename string, similarity double, heard string, boundary_pass boolean, envelope_pass boolean, readable boolean"))
    row = V.merge_tier2(df, spark.createDataFrame([("a", 0.97, "y")], "filename string, similarity2 double, heard2 string")).first()
    assert row["verdict"] == "PASS" and row["failure_types"] == [] and row["failure_reasons"] == [] and row["heard"] == "y" and row["recovered"]


def test_curation_gate(spark):
    for low, proceeds in ((20, True), (21, False)):
        rows = spark.createDataFrame([(0.1 if k < low else 0.9,) for k in range(100)], "similarity double")
        assert V.curation_gate(rows).first()["proceeds"] is proceeds
        assert V.curate(rows).count() == (100 - low if proceeds else 100)


def test_empty_report_and_gate_tie(spark):
    schema = "similarity double, boundary_pass boolean, envelope_pass boolean, verdict string, preattack_ms double, tail_silence_ms double, failure_types array<string>"
    empty = spark.createDataFrame([], schema)
    r = evaluation_report(empty).first()
    assert r["total"] == 0 and r["r1_pct"] is None
    assert gate(evaluation_report(empty), failure_types(empty)).first()[:] == (False, None)
    tie = spark.createDataFrame([(0.5, True, True, "FAIL", 1.0, 1.0, ["D"]), (0.5, True, True, "FAIL", 1.0, 1.0, ["A"])], schema)
    assert gate(evaluation_report(tie), failure_types(tie)).first()["dominant"] == "A"


def test_padding_goldens(spark):
    df = spark.createDataFrame([(29, False), (30, False), (1000, False), (None, False), (1000, True)], "g int, f boolean")
    assert [r[0] for r in df.select(W.right_pad(F.col("g"), F.col("f"))).collect()] == [0, 10, 400, 400, 650]


def test_skipped_lines(spark):
    m = spark.createDataFrame([(1, 1), (1, 4), (1, 5)], "s int, line_no int")
    assert sorted(r["line_no"] for r in W.skipped_lines(m, "s").collect()) == [2, 3]


def test_dedupe_policies(spark):
    m = spark.createDataFrame([(1, "f", "b"), (2, "f", "a"), (3, "f", "c")], "pos long, filename string, text string")
    assert [M.dedupe(m, p).first()["text"] for p in ("min", "last", "first")] == ["a", "c", "b"] and M.dedupe(m, "all").count() == 3


def test_neighbours_over_blocks(spark):
    df = spark.createDataFrame([(k, str(k)) for k in range(25)], "pos long, text string")
    rows = M.with_neighbours(df, "text", ["pos"], block=F.floor(F.col("pos") / 4)).orderBy("pos").collect()
    assert rows[0]["prev_text"] == "" and rows[-1]["next_text"] == ""
    assert all(rows[k]["prev_text"] == str(k - 1) and rows[k - 1]["next_text"] == str(k) for k in range(1, 25))


def test_presence(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    found = presence(a, b, ["k"])
    assert {r["k"]: r["status"] for r in found.collect()} == {1: "MISSING", 2: "OK", 3: "ORPHAN"}
    assert integrity_stats(found.withColumn("s", F.lit(1)), "s").first()["verdict"] == "FAIL"


def plain_greedy(lines, files, merges=5, threshold=0.5, confirm=True, limit=10, resync=True):
    """The rules one by one, without pruning: rows (kind or reason, line) over ``files`` of (segment texts, first, last)."""
    norm = {k: A.squeeze(v) for k, v in lines.items()}
    total, pointer, rows = max(lines), min(f[1] for f in files), []

    def note(reason, line):
        if line in lines:
            rows.append((reason, line))

    for texts, _, _ in files:
        i = fails = 0
        while i < len(texts) and pointer <= total:
            if len(A.squeeze(texts[i])) < 2:
                i += 1
                continue
            joined = {m: A.squeeze(" ".join(texts[i : i + m])) for m in range(1, merges + 1) if i + m <= len(texts)}
            options = [(A.score(h, norm[k]) - 0.01 * (k - pointer), -m, -k) for m, h in joined.items() if len(h) >= 3 for k in range(pointer, min(total + 1, pointer + 25)) if len(norm.get(k, "")) >= 2]
            best, m, line = max(options, default=(0, 0, 0))
            m, line = -m, -line
            if best >= threshold:
                if confirm and best < 0.8 and i + m < len(texts) and line + 1 in lines:
                    after, target = A.squeeze(texts[i + m]), norm[line + 1]
                    if len(after) >= 3 and len(target) >= 2 and A.score(after, target) < 0.25:
                        fails, i = fails + 1, i + 1
                        continue
                for k in range(pointer, line):
                    note("SKIPPED", k)
                rows.append(("match", line))
                fails, pointer, i = 0, line + 1, i + m
                continue
            fails += 1
            if fails >= limit:
                fits = [(m, k) for m, h in joined.items() if resync and len(h) >= 3 for k in range(pointer, min(total + 1, pointer + 75)) if len(norm.get(k, "")) >= 2 and A.score(h, norm[k]) >= 0.35]
                if fits:
                    for k in range(pointer, min(fits)[1]):
                        note("RESYNC_SKIP", k)
                    pointer = min(fits)[1]
                else:
                    note("NO_MATCH", pointer)
                    pointer += 1
                fails = 0
            i += 1
    for k in range(pointer, max(f[2] for f in files) + 1):
        note("EOF_UNMATCHED", k)
    return rows


def test_aligner_against_plain_model():
    rng = random.Random(4)
    for round in range(40):
        n = rng.randint(6, 18)
        lines = {k: " ".join("".join(rng.choices("abcdegx", k=rng.randint(1, 6))) for _ in range(rng.randint(1, 6))) for k in range(1, n + 1) if rng.random() < 0.9}
        lines[n] = "the last line"
        segments = []
        for k in sorted(lines):
            if rng.random() < 0.8:
                t = "".join(c for c in lines[k] if rng.random() > 0.25)
                cut = rng.randint(0, len(t))
                segments += [t[:cut], t[cut:]] if rng.random() < 0.4 else [t]
            if rng.random() < 0.2:
                segments.append("".join(rng.choices("qzv", k=rng.randint(1, 8))))
        at, first, mid, last = len(segments) // 2, rng.randint(1, 3), n // 2, rng.randint(n - 3, n + 3)
        parts = [(segments[:at], first, mid), (segments[at:], mid + 1, last)]
        files = [{"file_idx": f, "start_line": a, "end_line": b} for f, (_, a, b) in enumerate(parts)]
        rows = [{"file_idx": f, "seg_idx": i, "text": t} for f, (texts, _, _) in enumerate(parts) for i, t in enumerate(texts)]
        limit = rng.choice((2, 10))
        got = A.align_script(rows, lines, files, A.AlignConfig(fail_limit=limit))
        assert [(r["reason"] or r["kind"], r["line_no"]) for r in got] == plain_greedy(lines, parts, limit=limit), round
        got = A.align_script(rows, lines, files, replace(A.AlignConfig.manager(), start_line=None, log_tail=True))
        assert [(r["reason"] or r["kind"], r["line_no"]) for r in got] == plain_greedy(lines, parts, 3, 0.25, False, 5, False), round


def aligned_lines(segments, lines, first, last, config=A.AlignConfig(), **more):
    rows = A.align_script([{"file_idx": 0, "seg_idx": i, "text": t} for i, t in enumerate(segments)], lines, [{"file_idx": 0, "start_line": first, "end_line": last, **more}], config)
    return [(r["reason"] or r["kind"], r["line_no"]) for r in rows]


def test_aligner_beyond_the_named_range():
    lines = {1: "abcdefgh", 2: "ijklmnop", 3: "qrstuvwx"}
    assert aligned_lines(list(lines.values()), lines, 1, 2) == [("match", 1), ("match", 2), ("match", 3)]  # a name that claims too little
    assert aligned_lines(["abcdefgh"], {1: "abcdefgh", 2: "ijklmnop"}, 1, 5) == [("match", 1), ("EOF_UNMATCHED", 2)]  # only lines that there are
    assert aligned_lines(list(lines.values()), lines, 1, 2, A.AlignConfig.experiment()) == [("match", 1), ("match", 2)]
    assert aligned_lines(["qrstuvwx"], lines, 2, 3, A.AlignConfig.manager()) == [("SKIPPED", 1), ("SKIPPED", 2), ("match", 3)]  # from line 1


def test_aligner_confirmation_needs_three_letters():
    lines = {1: "abcdefghij", 2: "mnopqrst"}
    assert aligned_lines(["abcdefzzz", "zz"], lines, 1, 2)[0] == ("match", 1)
    assert aligned_lines(["abcdefzzz", "zzz"], lines, 1, 2)[0] != ("match", 1)


def test_aligner_resumes_within_a_script():
    lines = {k: chr(96 + k) * 8 for k in range(1, 9)}
    rows = [{"file_idx": k // 5, "seg_idx": k, "text": lines[k]} for k in range(1, 9) if k != 3]
    files = [{"file_idx": 0, "start_line": 1, "end_line": 4}, {"file_idx": 1, "start_line": 5, "end_line": 8}]
    whole = A.align_script(rows, lines, files, A.AlignConfig(checkpoints=True))
    at = next(r for r in whole if r["kind"] == "checkpoint" and r["file_idx"] == 0)
    assert at["line_no"] == 5
    rest = A.align_script(rows, lines, files, A.AlignConfig(checkpoints=True), (1, at["line_no"]))
    assert rest == whole[whole.index(at) + 1 :]


def test_clip_spans():
    seg = lambda a, b, text, words=(): {"file_idx": 0, "seg_idx": 0, "text": text, "start": a, "end": b, "words": list(words)}
    two = [seg(1.0, 2.0, "abc"), seg(2.01, 3.0, "def")]
    assert A.clip_span(two, 0, 1, "abc", A.AlignConfig(), 9000) == (950, 2000)  # next segment 10 ms away
    assert A.clip_span(two, 1, 1, "def", A.AlignConfig(), 3200) == (2009, 3200)  # before: 10 ms; after: none, cut off by the recording
    assert A.clip_span([seg(0.02, 1.0, "abc"), seg(1.3, 2.0, "def")], 0, 1, "abc", A.AlignConfig(), None) == (0, 1280)
    assert A.clip_span(two, 0, 1, "좋습니다", A.AlignConfig(), None) == (950, 2650)
    assert A.clip_span(two, 0, 1, "좋습니다", A.AlignConfig.experiment(), None) == (950, 2500)
    assert A.clip_span(two, 0, 2, "abcdef", A.AlignConfig.manager(), None) == (950, 3050)
    assert A.clip_span([{"file_idx": 0, "seg_idx": 0, "text": "abc"}], 0, 1, "abc", A.AlignConfig(), None) is None


def test_resync_and_limits():
    lines = {k: f"{chr(96 + k) * 12}" for k in range(1, 21)}
    segments = [{"file_idx": 0, "seg_idx": i, "text": "zzzzzzzz"} for i in range(3)]
    rows = A.align_script(segments, lines, [{"file_idx": 0, "start_line": 1, "end_line": 20}], A.AlignConfig(fail_limit=3))
    assert rows[0]["reason"] == "NO_MATCH" and rows[0]["line_no"] == 1 and rows[1]["reason"] == "EOF_UNMATCHED"


def test_refine_drops_foreign_ends():
    ws = [{"word": w, "start": float(k), "end": k + 0.5} for k, w in enumerate(["xqzxqz", "hello", "there", "friend", "zzqqzz"])]
    assert A.refine_words(ws, "hello there friend") == (1.0, 3.5)
    assert A.refine_words(ws[1:2], "hello") is None


def test_refine_keeps_wanted_end_words():
    ws = [{"word": w, "start": float(k), "end": k + 0.5} for k, w in enumerate(["xxxx", "abcdefghij", "k"])]
    assert A.refine_words(ws, "abcdefghijk") == (1.0, 2.5)
    assert A.refine_words(ws[1:], "abcdefghijk") is None  # nothing to gain
    ending = [{"word": w, "start": float(k), "end": k + 0.5} for k, w in enumerate(["qqqqqq", "오늘은", "좋았", "습니다", "zzzzzz"])]
    assert A.refine_words(ending, "오늘은 좋았습니다") == (1.0, 3.5)
    assert A.refine_words([*ending[:3], {"word": "습니", "start": 3.0, "end": 3.5}, {"word": "zzzzzz", "start": 4.0, "end": 4.5}], "오늘은 좋았습니다") == (1.0, 4.5)  # the ending is restored


def test_recovery_equals_all_pairs(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices("abcd", k=8)) for _ in range(60)]
    lines = spark.createDataFrame([(1, k, t) for k, t in enumerate(texts)], "script_id int, line_no int, text string")
    clips = [(1, str(k), rng.randrange(60), "".join(rng.choices("abcd", k=8)) if k % 3 else texts[rng.randrange(60)]) for k in range(30)]
    clips += [(1, "short", 5, "a!"), (1, "none", 5, "zzzzzzzz"), (2, "lost", 5, "abcdabcd"), (1, "null", 5, None)]
    asked = spark.createDataFrame(clips, "script_id int, filename string, expected int, heard string")
    found = A.recover(asked, lines, lambda df: with_edit_score(df, "heard_norm", "line_norm", "least"), edit_ceiling).collect()
    plain = asked.where("length(heard) >= 3").join(lines, "script_id").where(F.abs(F.col("line_no") - F.col("expected")) <= 10).withColumn("s", 1 - F.levenshtein("heard", "text") / 8 + F.when(F.col("line_no") == F.col("expected"), 0.05).otherwise(0.0))
    want = {}
    for r in plain.where("s >= 0.2").orderBy("filename", F.desc(F.round("s", 9)), "line_no").collect():
        want.setdefault(r["filename"], (r["line_no"], round(r["s"], 9)))
    assert {r["filename"]: (r["line_no"], round(r["score"], 9)) for r in found if r["outcome"] == "MATCH"} == want
    assert {r["filename"]: r["outcome"] for r in found if r["outcome"] != "MATCH"} == {"short": "TOO_SHORT", "null": "TOO_SHORT", "none": "NO_MATCH", "lost": "NO_SCRIPT"}
    assert len(found) == len(clips)


def test_quality_of_empty_and_unchecked_rows(spark):
    rows = spark.createDataFrame([("", " ", "a b c", "OK", 0.0), ("", "...", "a b c", "OK", 0.0), ("a b c", "a b c", "a b c", "OK", 1.0), ("", "", "a b c", "FILE_MISSING", 0.0), ("", "", "a b c", None, 0.0)], "heard string, raw_heard string, expected string, status string, similarity double")
    found = Q.quality(rows.withColumns({"prev_text": F.lit(""), "next_text": F.lit("")}), lambda a, b: F.when(a == b, 1.0).otherwise(0.0)).collect()
    assert [(r["issues"], r["verdict"]) for r in found] == [
        (["EMPTY_TRANSCRIPTION"], "PROBLEMATIC"), (["LOW_SIMILARITY"], "PROBLEMATIC"), ([], "GOOD"), (["FILE_MISSING"], "PROBLEMATIC"), ([], "UNKNOWN"),
    ]


def test_truncation_takes_the_first_items(spark):
    rows = spark.createDataFrame([(f"{k}.wav", "오늘은 좋습니다" if k % 2 else "아니다", "오늘은 좋", "OK") for k in range(9)], "filename string, truth string, heard string, status string")
    assert [r["filename"] for r in Q.truncation(rows, max_items=2).orderBy("filename").collect()] == ["1.wav", "3.wav"]


def test_locate():
    rng = np.random.default_rng(0)
    raw = rng.normal(size=4000)
    at, c = M.locate(raw[1500:1700], raw, 100, 14.0)
    assert abs(at - 15.0) < 1e-9 and c > 0.999


def test_scripts_are_rows(spark):
    """No table in Python for each script: its set-up cost more than a short script's alignment."""
    segments = spark.createDataFrame([(k, 0, 0, "hello there") for k in range(20)], "script_id int, file_idx int, seg_idx int, text string")
    lines = spark.createDataFrame([(k, 1, "hello there") for k in range(21)], "script_id int, line_no int, text string")
    files = spark.createDataFrame([(k, 0, 1, 1) for k in range(21)], "script_id int, file_idx int, start_line int, end_line int")
    for found in (A.align(segments, lines, files), A.align_by_line(segments, lines, files)):
        assert "CoGroup" not in found._jdf.queryExecution().toString()
        rows = {r["script_id"]: (r["kind"], r["line_no"]) for r in found.collect()}
        assert rows == {k: ("match" if k < 20 else "skip", 1) for k in range(21)}


def test_best_match_by_words_has_no_cross_join(spark):
    """Equal to the search over all pairs, ties and queries that nothing resembles included."""
    asked = spark.createDataFrame([(1, "a b c"), (2, "zz"), (3, "b  x"), (4, None)], "item_id long, text string")
    told = spark.createDataFrame([(2, 1, "C b"), (1, 3, "b c"), (1, 2, "q"), (5, 1, "a B c d")], "doc_id long, line_no long, text string")
    found = M.best_match_words(asked, told, "item_id", "text", ["doc_id", "line_no"])
    assert "CartesianProduct" not in found._jdf.queryExecution().toString()
    got = {r["item_id"]: tuple(r)[1:] for r in found.collect()}
    assert got == {1: (5, 1, 1.0), 2: (1, 2, 0.0), 3: (1, 3, 1 / 3), 4: (1, 2, None)}


def test_checked_turns_are_made_once(spark, tmp_path):
    """Counting the tasks of shuffled rows ran their shuffles, and texts were normalised again for the blocks' edges."""
    from corvox.plans import catalog

    turns = [(c, t, f"wörter  {c} and_{t}, näher" * (t + 1)) for c in range(900, 1100, 20) for t in range(3)]
    spark.createDataFrame(turns, "conv_id long, turn long, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.sparkContext.setJobGroup("turns", "queries as they are built")
    rows = catalog.checked_cer(spark, str(tmp_path))
    built = spark.sparkContext.statusTracker().getJobIdsForGroup("turns")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(built) <= 1  # the files' schema
    assert rows.count() == len(turns) and not {"_spoken", "_told"} & set(rows.columns)
    assert "a-zA-Z0-9" not in rows._jdf.queryExecution().executedPlan().toString()  # ranges took five times as long as letters listed
    rows.collect()
    assert "ReusedExchange" in rows._jdf.queryExecution().executedPlan().toString()
