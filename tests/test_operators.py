"""Borders, nulls and ties of single operators."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelspark.config import ChunkConfig, ExtractConfig, ReviewConfig
from reelspark.functions import text as T
from reelspark.functions import vectors as V
from reelspark.operators import align, chunking, enrich, extract, intervals, keyframes, metrics, ocr, qa, report, store, validate
from reelspark.sources import artifacts, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def scenes(spark, durations):
    at, rows = 0, []
    for i, d in enumerate(durations):
        rows.append((1, i, at, at + d, d))
        at += d
    return spark.createDataFrame(rows, "video_id long, scene_id int, start_ms long, end_ms long, duration_ms long")


@pytest.mark.parametrize("durations, expected", [([4999, 6000], [[0], [1]]), ([6000, 4999], [[0, 1]]), ([6000, 5000], [[0], [1]]), ([6000, 5001], [[0], [1]]), ([10, 10, 10], [[0, 1, 2]]), ([70000], [[0]])])
def test_merge(spark, durations, expected):
    rows = chunking.merge_scenes(scenes(spark, durations)).orderBy("grp").collect()
    assert [r["merged_scene_ids"] for r in rows] == expected


def test_split_long(spark):
    rows = chunking.merge_scenes(scenes(spark, [130_000]), ChunkConfig(split_long=True)).orderBy("t_start_ms").collect()
    assert [(r["t_start_ms"], r["t_end_ms"]) for r in rows] == [(0, 60000), (60000, 120000), (120000, 130000)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(1, 20_000), min_size=1, max_size=12))
def test_merge_is_a_partition(spark, durations):
    rows = chunking.merge_scenes(scenes(spark, durations)).orderBy("grp").collect()
    assert sum((r["merged_scene_ids"] for r in rows), []) == list(range(len(durations)))
    assert all(a["t_end_ms"] == b["t_start_ms"] for a, b in zip(rows, rows[1:]))


def test_bounds(spark):
    left = spark.createDataFrame([(1, 0, 100)], "k long, a long, b long")
    right = spark.createDataFrame([(1, 1, 100, 150), (1, 2, 50, 60), (1, 3, 0, 0), (1, 4, 100, 100), (1, 5, 99, 200), (2, 6, 0, 50), (1, 7, 60, 50)], "k long, id int, s long, e long")
    found = lambda bounds: {r["id"] for r in intervals.interval_join(left, right, "k", ("a", "b"), ("s", "e"), bounds, 30).collect()}
    assert found("closed") == {1, 2, 3, 4, 5}
    assert found("open") == {2, 5}
    assert found("half_open") == {2, 3, 5}
    assert found("contains") == {2, 3, 4}
    with pytest.raises(ValueError):
        found("other")


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 300), st.integers(0, 80)), max_size=12), st.lists(st.tuples(st.integers(0, 300), st.integers(0, 80)), max_size=12))
def test_interval_join_equals_brute_force(spark, a, b):
    left = spark.createDataFrame([(1, i, s, s + d) for i, (s, d) in enumerate(a)], "k long, i int, a long, b long")
    right = spark.createDataFrame([(1, j, s, s + d) for j, (s, d) in enumerate(b)], "k long, j int, s long, e long")
    got = sorted((r["i"], r["j"]) for r in intervals.interval_join(left, right, "k", ("a", "b"), ("s", "e"), "closed", 50).collect())
    assert got == sorted((i, j) for i, (s, d) in enumerate(a) for j, (t, f) in enumerate(b) if t + f >= s and t <= s + d)


def test_an_interval_without_end_is_an_error(spark):
    ok = spark.createDataFrame([(1, 0, 5)], "k long, a long, b long")
    wide = spark.createDataFrame([(1, 0, 1 << 60)], "k long, s long, e long")
    with pytest.raises(Exception, match="buckets"):
        intervals.interval_join(ok, wide, "k", ("a", "b"), ("s", "e"), "closed", 50).collect()


def test_chapters(spark):
    g = spark.createDataFrame([(1, 1, 0), (1, 2, 10), (1, 3, 99), (2, 1, 5)], "video_id long, grp int, t_start_ms long")
    ch = spark.createDataFrame([(1, 0, "a", 5, 10), (1, 1, "b", 10, 50)], "video_id long, chapter_index int, title string, start_ms long, end_ms long")
    rows = {(r["video_id"], r["grp"]): (r["chapter_index"], r["chapter_title"]) for r in chunking.find_chapter(g, ch).collect()}
    assert rows == {(1, 1): (1, "b"), (1, 2): (1, "b"), (1, 3): (1, "b"), (2, 1): (0, "Unknown")}


def test_text_functions(spark):
    assert one(spark, T.video_id(F.lit("https://h.example/watch?v=abcDEF_-123&x=1"))) == "abcDEF_-123"
    assert one(spark, T.video_id(F.lit("none"))) is None
    with pytest.raises(Exception, match="no video id"):
        one(spark, T.video_id(F.lit("none"), strict=True))
    assert one(spark, T.language_from_filename(F.lit("a.en.vtt"))) == "en"
    assert one(spark, T.language_from_filename(F.lit("a.vtt"))) == "unknown"
    assert one(spark, T.frame_rate(F.lit("30000/1001"))) == pytest.approx(29.97, abs=0.01)
    assert one(spark, T.frame_rate(F.lit("0/0"))) is None
    assert one(spark, T.transcript_line(F.lit(3_661_007), F.lit(3_661_999), F.lit("hi"), F.lit("S1"))) == "[01:01:01.007 -> 01:01:01.999] [S1] hi"
    assert one(spark, T.transcript_line(F.lit(0), F.lit(1), F.lit("hi"))) == "[00:00:00.000 -> 00:00:00.001] hi"
    assert one(spark, T.tokens(F.lit("  A\tb\n c "))) == ["a", "b", "c"]
    for a, o, m in (("", "", ""), ("x", "", "[SPOKEN] x"), ("", "y", "[ON SCREEN] y"), ("x", "y", "[SPOKEN] x [ON SCREEN] y")):
        assert one(spark, T.merged_text(F.lit(a), F.lit(o))) == m
    assert [one(spark, T.verdict(F.lit(v))) for v in (90, 89.9, 70, 69.9)] == ["PASS", "PARTIAL", "PARTIAL", "FAIL"]
    assert [one(spark, T.confidence_color(F.lit(v))) for v in (0.8, 0.79, 0.5, 0.49)] == ["green", "yellow", "yellow", "red"]
    assert one(spark, T.redact(F.lit("mail a.b@c.example.com now"))) == "mail <EMAIL> now"


def test_blocks(spark):
    df = spark.createDataFrame([([("b", [0.0, 5.0], 0.5), ("a", [0.0, 5.0], 0.49), ("c", [9.0, 1.0], 0.9), ("d", [1.0, 1.0], 1.0)],)], "b array<struct<text:string,bbox:array<double>,confidence:double>>")
    row = df.select(T.full_text(F.col("b")).alias("t"), T.confident(F.col("b")).alias("k"), T.frame_confidence(F.col("b")).alias("c"), T.clean_text(F.col("b"), F.array(F.lit("a"), F.lit("c"))).alias("w")).first()
    assert row["t"] == "d c b a" and [k["text"] for k in row["k"]] == ["b", "c", "d"] and row["c"] == pytest.approx(2.89 / 4) and row["w"] == "d b"
    assert one(spark, T.polygon_box(F.array(*[F.array(F.lit(float(x)), F.lit(float(y))) for x, y in ((3, 1), (5, 0), (4, 9))]))) == [3, 0, 5, 9]


def test_dedup(spark):
    ten = [f"w{i}" for i in range(10)]
    rows = [("v", 0, " ".join(ten), 0.5), ("v", 1, " ".join(ten[:9]), 0.6), ("v", 2, " ".join(ten[:9]), 0.6), ("v", 3, "", 0.9), ("v", 4, " ".join(ten), 0.1), ("v", 5, " ".join(ten[:8]), 0.9)]
    kept = sorted(r["frame_id"] for r in ocr.dedup_sequential(spark.createDataFrame(rows, "video_id string, frame_id int, text string, confidence double")).collect())
    assert kept == [1, 3, 4, 5]  # exactly 0.9 replaces only if it is surer; an empty frame stays and parts its neighbours


def test_chrome(spark):
    b = spark.createDataFrame([(1, f, "Play " + ("x x x x" if f == 0 else "y")) for f in range(5)], "video_id long, frame_id int, text string")
    count = lambda mode: {r["token"]: r["n"] for r in ocr.chrome_tokens(b, 0.8, mode).collect()}
    assert count("occurrence") == {"play": 5, "x": 4, "y": 4} and count("frames") == {"play": 5, "y": 4}


def test_alignment(spark):
    p = spark.createDataFrame([("a", "alpha beta", "alpha gamma"), ("b", "", "x"), ("c", "same words", "same words"), ("d", "the of", "the of")], "chunk_id string, asr_text string, ocr_text string")
    assert {r["score"] for r in align.tfidf_cosine(p).collect()} == {0.0}
    s = {r["chunk_id"]: r["score"] for r in align.tfidf_cosine(p, max_df=None).collect()}
    assert s["b"] == 0 and s["c"] == pytest.approx(1) and s["d"] == 0 and 0 < s["a"] < 1


def test_confidences(spark):
    w = spark.createDataFrame([(1, 1, 0.5, None), (1, 1, None, 0.9), (1, 2, None, 0.8)], "video_id long, grp int, score double, probability double")
    get = lambda **k: {r["grp"]: r["asr_confidence"] for r in enrich.asr_confidence(w, **k).collect()}
    assert get() == {1: 0.5, 2: 0.0} and get(use_probability=True) == {1: 0.7, 2: 0.8}


def test_gaps(spark):
    k = spark.createDataFrame([(1, t) for t in (0, 15000, 30001, 60001, 90002)], "video_id long, timestamp_ms long")
    assert [(r["start_ms"], r["severity"]) for r in validate.keyframe_gaps(k).orderBy("start_ms").collect()] == [(15000, "medium"), (30001, "medium"), (60001, "high")]
    v = spark.createDataFrame([(1, 120000)], "video_id long, duration_ms long")
    assert validate.keyframe_gaps(k, ReviewConfig(include_edges=True), v).count() == 4
    s = spark.createDataFrame([(1, 0, 0, 100), (1, 1, 5100, 5200), (1, 2, 10201, 10300), (1, 3, 10250, 10260)], "video_id long, seg_ix int, start_ms long, end_ms long")
    assert [r["start_ms"] for r in validate.asr_gaps(s).collect()] == [5200]


def test_windows(spark):
    v = spark.createDataFrame([(1, 11), (2, 0)], "video_id long, duration_s long")
    s = spark.createDataFrame([(1, 5000, 5000), (1, 7000, 7000), (1, 10500, 99000)], "video_id long, start_ms long, end_ms long")
    k = spark.createDataFrame([(1, 4999, "p/a.jpg"), (1, 11000, "p/b.jpg")], "video_id long, timestamp_ms long, path string")
    b = spark.createDataFrame([(1, "other/a.jpg")], "video_id long, path string")
    rows = validate.coverage_windows(v, s, k, b).orderBy("start_ms").collect()
    assert [(r["start_ms"], r["end_ms"], r["has_asr"], r["has_keyframe"], r["has_ocr"]) for r in rows] == [(0, 5000, False, True, True), (5000, 10000, True, False, False), (10000, 11000, True, False, False)]
    assert {r["video_id"]: r["coverage_pct"] for r in validate.overall_coverage(v, validate.coverage_windows(v, s, k, b)).collect()} == {1: 100.0, 2: 0.0}


def test_flags(spark):
    k = spark.createDataFrame([(1, i, f"p/{i}.jpg") for i in range(4)], "video_id long, frame_id int, path string")
    b = spark.createDataFrame([(1, "q/0.jpg", "123456789", 0.5), (1, "q/1.jpg", "1234", 0.49), (1, "q/1.jpg", "67890", 0.9), (1, "q/2.jpg", "1", 0.1)], "video_id long, path string, text string, confidence double")
    c = spark.createDataFrame([(1, 1, "c1", True, True), (1, 2, "c2", False, False)], "video_id long, grp int, chunk_id string, has_visual boolean, has_speech boolean")
    rows = [(r["flag_type"], r["location"]) for r in validate.quality_flags(k, b, c).orderBy("position").collect()]
    assert rows == [("low_ocr_text", "p/0.jpg"), ("low_ocr_confidence", "p/1.jpg"), ("low_ocr_text", "p/2.jpg"), ("low_ocr_confidence", "p/2.jpg"), ("no_ocr", "p/3.jpg"), ("no_visual", "c2"), ("no_speech", "c2")]


def test_density(spark):
    c = spark.createDataFrame([(1, i, f"c{i}", "x" * n, "", 0, 1000 if i else 0) for i, n in enumerate((5, 5, 9, 1))], "video_id long, grp int, chunk_id string, asr_text string, ocr_text string, t_start_ms long, t_end_ms long")
    rows = validate.content_density(c).orderBy("list", "rank").collect()
    assert [(r["list"], r["chunk_id"]) for r in rows] == [("richest", "c2"), ("richest", "c0"), ("richest", "c1"), ("thinnest", "c0"), ("thinnest", "c1"), ("thinnest", "c3")]
    assert [r["density"] for r in rows if r["chunk_id"] == "c0"] == [0.0, 0.0]


def test_keyframes(spark):
    p = spark.createDataFrame([(1, 0, 0, 99.0, 0), (1, 0, 3, 100.0, 30), (1, 1, 10, 500.0, 70)], "video_id long, scene_id int, offset int, blur_score double, timestamp_ms long")
    first = keyframes.first_sharp(p)
    assert [(r["scene_id"], r["timestamp_ms"]) for r in first.collect()] == [(0, 30)]
    s = scenes(spark, [30_000, 30_001, 5_000])
    assert [r["timestamp_ms"] for r in keyframes.long_scene_times(s).orderBy("timestamp_ms").collect()] == list(range(35_000, 60_001, 5_000))
    numbered = keyframes.number_frames(first, keyframes.long_scene_times(s)).orderBy("frame_id").collect()
    assert numbered[0]["filename"] == "frame_00000.jpg" and [r["frame_id"] for r in numbered] == list(range(7))
    px = spark.createDataFrame([(1, 0, 1, 200.0, [0.0] * 20), (1, 0, 2, 200.0, [40.0] * 2 + [0.0] * 18), (1, 0, 3, 50.0, [99.0] * 20), (1, 0, 4, 200.0, [40.0] * 3 + [0.0] * 17)], "video_id long, scene_id int, timestamp_ms long, blur_score double, pixels array<double>")
    assert [r["timestamp_ms"] for r in keyframes.delta_filter(px, ExtractConfig()).collect()] == [1, 4]


def test_hooks(spark):
    import pandas as pd

    files = spark.createDataFrame([(7,)], "video_id long")

    def model(frames):
        for f in frames:
            for v in f["video_id"]:
                yield pd.DataFrame({"video_id": [v], "seg_ix": [0], "start_s": [1.9999], "end_s": [3.0], "text": ["hi"], "words": [[{"word": "hi", "start_s": 1.0, "end_s": 2.0, "probability": 0.7}]]})

    heard = extract.transcribe(files, model)
    assert heard.first()["start_ms"] == 1999 and extract.transcribe(files).count() == 0
    assert extract.align_words(heard).first()["words"][0]["score"] == 0.7

    def reader(frames):
        for f in frames:
            yield pd.DataFrame({"video_id": f["video_id"], "frame_id": f["frame_id"], "blocks": [[{"text": "t", "polygon": [[1.0, 2.0], [3.0, 0.0]], "confidence": c} for c in (0.5, 0.4)]] * len(f)})

    images = spark.createDataFrame([(7, 0)], "video_id long, frame_id int")
    (block,) = extract.read_text(images, reader).first()["text_blocks"]
    assert block["bbox"] == [1, 0, 3, 2]
    assert extract.read_layout(images).first()["layout_regions"] == []
    sharp = spark.createDataFrame([(bytearray([0, 255] * 8), 4), (bytearray(16), 4)], "gray binary, width int")
    assert [r["blur_score"] > 100 for r in extract.blur_scores(sharp).collect()] == [True, False]
    cuts = spark.createDataFrame([(1, 100, 30.0), (1, 1000, 27.0), (1, 2000, 26.9)], "video_id long, t_ms long, score double")
    found = extract.detect_scenes(cuts, spark.createDataFrame([(1, 3000)], "video_id long, duration_ms long")).orderBy("scene_id").collect()
    assert [(r["start_ms"], r["end_ms"]) for r in found] == [(0, 1000), (1000, 3000)]


def test_scenes_are_measured_from_the_last_kept_cut(spark):
    scores = spark.createDataFrame([(1, t, 30.0) for t in range(200, 2001, 200)] + [(2, 100, 30.0)], "video_id long, t_ms long, score double")
    videos = spark.createDataFrame([(1, 2500), (2, 900), (3, 50)], "video_id long, duration_ms long")
    found = extract.detect_scenes(scores, videos, 27.0, 300).orderBy("video_id", "scene_id").collect()
    assert [(r["video_id"], r["start_ms"]) for r in found] == [(1, 0), (1, 400), (1, 800), (1, 1200), (1, 1600), (1, 2000), (2, 0), (3, 0)]


def test_search_in_parts_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 6)).round(1).tolist()
    v[7], v[11] = [0.0] * 6, v[10]
    e = spark.createDataFrame([(i, x) for i, x in enumerate(v)] + [(500, None)], "vec_id long, embedding array<double>").repartition(3)
    q = e.where("vec_id % 20 = 0 and vec_id < 300").withColumnRenamed("vec_id", "query_id")
    unit = np.array([np.array(x) / (np.linalg.norm(x) or 1) for x in v])
    want = {}
    for i in range(0, 300, 20):
        s = np.round(unit @ unit[i], 12)
        order = sorted(range(300), key=lambda j: (-s[j], j))[:4]
        want |= {(i, rank): j for rank, j in enumerate(order, 1)}
    for most_bytes in (1 << 20, 200):
        rows = store.search_batch(e, q, 4, most_bytes=most_bytes).collect()
        assert {(r["query_id"], r["rank"]): r["vec_id"] for r in rows} == want
    assert store.search_batch(e, q.where("query_id < 0"), 4).count() == 0 == store.search_batch(e.where("vec_id < 0"), q, 4).count()


def test_vectors(spark, tmp_path):
    e = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [4.0, 3.0])], "vec_id long, embedding array<double>")
    assert [r["u"] for r in e.select(V.normalized(F.col("embedding")).alias("u")).collect()][:2] == [[0.6, 0.8], [0.0, 0.0]]
    assert [r["vec_id"] for r in store.search(e, [3.0, 4.0], 2).collect()] == [1, 3]
    assert store.mean_pool(e.where("vec_id <> 2").withColumn("g", F.lit(1)), ("g",)).first()["pooled"] == pytest.approx([0.7, 0.7])
    batch = store.search_batch(e, e.withColumnRenamed("vec_id", "query_id"), 2).where("query_id = 1").orderBy("rank").collect()
    assert [r["vec_id"] for r in batch] == [1, 3]
    points = e.withColumn("video_id", F.lit(5)).withColumn("t_start_ms", F.col("vec_id"))
    store.write_collection(points, f"{tmp_path}/c", {"embedding": 2})
    assert store.verify(spark, f"{tmp_path}/c")["points"] == 3
    with pytest.raises(Exception, match="2 places|3 places"):
        store.write_collection(points, f"{tmp_path}/d", {"embedding": 3})
    new = spark.createDataFrame([(1, [9.0, 9.0]), (4, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert {r["vec_id"]: r["embedding"][0] for r in store.upsert(e, new, ("vec_id",)).collect()} == {1: 9, 2: 0, 3: 4, 4: 1}
    fused = store.fuse(store.search_batch(e, e.withColumnRenamed("vec_id", "query_id"), 2), store.search_batch(e, e.withColumnRenamed("vec_id", "query_id"), 1), "vec_id")
    assert fused.count() == 6


def test_questions(spark):
    replies = ['```json\n[{"question": "q", "answer": 1}]\n```', "oops", '[{"question": "q"}]', '[{"question": "q", "answer": "a", "evidence_type": "spoken"}]', None]
    df = spark.createDataFrame([(str(i), r) for i, r in enumerate(replies)], "chunk_id string, reply string")
    assert [(r["chunk_id"], r["answer"], r["evidence_type"]) for r in qa.parse_pairs(df).orderBy("chunk_id").collect()] == [("0", "1", "both"), ("3", "a", "spoken")]
    asked = one(spark, qa.prompt(F.lit("Intro"), F.lit(1500), F.lit(4000), F.lit(""), F.lit("menu")))
    assert "Intro" in asked and "1.5 s to 4.0 s (2.5 s)" in asked and "[No speech]" in asked and "menu" in asked


def test_metrics(spark):
    assert one(spark, metrics.character_error_rate(F.lit("abcd"), F.lit("abxd"))) == 0.25
    assert one(spark, metrics.character_error_rate(F.lit(""), F.lit("x"))) == 1.0
    ranked = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id long, vec_id long, rank int")
    relevant = spark.createDataFrame([(1, 11), (1, 12), (2, 5)], "query_id long, vec_id long")
    rows = {r["query_id"]: r for r in metrics.retrieval(ranked, relevant, 2).collect()}
    assert rows[1]["recall"] == 0.5 and rows[2]["ndcg"] == 0.0 and 0 < rows[1]["ndcg"] < 1


def test_files(spark, tmp_path):
    p = str(tmp_path)
    df = spark.createDataFrame([(1, 0, "é"), (1, 1, None)], "video_id long, i int, text string")
    sinks.write_jsonl(df, f"{p}/j")
    assert spark.read.schema(df.schema).json(f"{p}/j").orderBy("i").collect() == df.orderBy("i").collect()
    made = []
    make = lambda: made.append(1) or df
    for _ in range(2):
        assert artifacts.or_make(spark, f"{p}/once", make).count() == 2
    assert made == [1]
    (tmp_path / "a.en.vtt").write_text("WEBVTT")
    assert artifacts.caption_files(spark, p).first()["language"] == "en"
    html = report.page({"chunks": 1}, [{"kind": "scene", "left_pct": 1.0, "width_pct": 0.0}], [], [], [{"chunk_id": "<c>", "asr_text": "a"}])
    assert "&lt;c&gt;" in html


def test_captions(spark, tmp_path):
    from reelspark.sources import captions

    (tmp_path / "v1").mkdir()
    (tmp_path / "v1" / "a.en.vtt").write_text("WEBVTT\n\nNOTE x\n\n1\n00:01.500 --> 00:02.000 align:left\n<b>Hi</b>\nthere\n\n01:00:00.000 --> 01:00:01.001\n\n\nnothing")
    rows = captions.read_vtt(spark, str(tmp_path)).orderBy("seg_ix").collect()
    assert [(r["video_id"], r["language"], r["start_ms"], r["end_ms"], r["text"]) for r in rows] == [("v1", "en", 1500, 2000, "Hi there"), ("v1", "en", 3_600_000, 3_601_001, "")]
    lines = spark.createDataFrame([(1, 0, "[00:00:01.000 -> 00:00:02.000] [S1] hi"), (1, 1, "[00:00:03.000 -> 00:00:04.005] bare"), (1, 2, "noise")], "video_id long, line_ix int, line string")
    got = captions.read_transcript(lines).orderBy("seg_ix").collect()
    assert [(r["start_ms"], r["end_ms"], r["speaker"], r["text"]) for r in got] == [(1000, 2000, "S1", "hi"), (3000, 4005, None, "bare")]


def test_extensions(spark):
    from reelspark.operators import extensions as X

    s = spark.createDataFrame([(1, 0, 0, 1, "a"), (1, 1, 1, 2, "a"), (1, 2, 2, 3, None), (1, 3, 3, 4, None), (1, 4, 4, 5, "a")], "video_id long, seg_ix int, start_ms long, end_ms long, speaker string")
    assert [(r["speaker"], r["n"]) for r in X.speaker_turns(s).orderBy("turn").collect()] == [("a", 2), (None, 2), ("a", 1)]
    f = spark.createDataFrame([(1, 0, "a b"), (1, 1, "a b"), (1, 2, ""), (1, 3, "")], "video_id long, frame_id int, text string")
    assert [r["frame_id"] for r in X.changed_text_frames(f).orderBy("frame_id").collect()] == [0, 2, 3]
    t, d = (spark.createDataFrame([(1, x) for x in xs], "video_id long, t_ms long") for xs in ((0, 10, 50), (4, 48)))
    assert X.boundary_error(t, d).first()["mae_ms"] == pytest.approx((4 + 6 + 2) / 3)


def test_written_tables_can_be_deleted(spark):
    import os

    from reelspark.session import discard, materialize

    table = materialize(spark.range(5).toDF("x"), "gone")
    place = table._reelspark_path.removeprefix("file://")
    assert table.count() == 5 and os.path.exists(place)
    discard(table)
    assert not os.path.exists(place)
