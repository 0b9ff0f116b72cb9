"""The golden video through files, all phases, and the numbers that are known of it."""

import glob
import json

import pytest

from reelspark.operators import chunking, timeline, validate
from reelspark.plans import phases
from reelspark.sources import artifacts

from . import golden


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("golden"))
    golden.write(root)
    return artifacts.bundle(spark, f"file://{root}", "*")


def test_timeline(tables):
    t = timeline.build(timeline.chapter_events(tables["chapters"]), timeline.scene_events(tables["scenes"]), timeline.asr_events(tables["segments"]), timeline.keyframe_events(tables["keyframes"]), timeline.ocr_events(tables["frames"]))
    rows = t.orderBy("position").collect()
    assert len(rows) == 121 and [r["position"] for r in rows] == list(range(121))
    assert [r["event_type"] for r in rows[:4]] == ["chapter_start", "scene_start", "keyframe", "ocr_result"]
    assert timeline.summary(t, tables["scenes"]).first()["duration_ms"] == 226300


def test_chunks(tables):
    c = chunking.build_chunks(tables["scenes"], tables["segments"], tables["keyframes"], tables["chapters"]).orderBy("grp").collect()
    assert [r["merged_scene_ids"] for r in c] == [[0], [1], [2, 3, 4], [5, 6], [7], [8], [9], [10], [11]]
    assert [(r["t_start_ms"], r["t_end_ms"]) for r in c] == [(0, 32233), (32233, 78500), (78500, 90400), (90400, 102400), (102400, 110266), (110266, 118333), (118333, 173933), (173933, 182133), (182133, 226300)]
    assert [r["chunk_id"].removeprefix("golden_") for r in c] == "ch0_sc0 ch0_sc1 ch1_sc2 ch1_sc5 ch1_sc7 ch1_sc8 ch2_sc9 ch2_sc10 ch3_sc11".split()
    assert [r["n_segments"] for r in c] == [7, 11, 4, 3, 3, 4, 14, 4, 11]
    assert [len(r["asr_text"]) for r in c] == [502, 711, 256, 273, 171, 203, 876, 157, 597]
    assert [len(r["keyframe_ids"]) for r in c] == [2, 2, 3, 2, 1, 1, 4, 1, 2]


def test_review(tables):
    w = validate.coverage_windows(tables["videos"], tables["segments"], tables["keyframes"], tables["blocks"])
    bare = w.where("not has_asr and not has_keyframe").collect()
    assert w.count() == 46 and [r["start_ms"] for r in bare] == [225000]
    assert validate.overall_coverage(tables["videos"], w).first()["coverage_pct"] == pytest.approx(100 * 45 / 46)
    gaps = [(r["start_ms"], r["end_ms"], r["duration_sec"], r["severity"]) for r in validate.keyframe_gaps(tables["keyframes"]).orderBy("start_ms").collect()]
    assert gaps == [(5000, 32200, 27.2, "medium"), (37233, 78500, 41.267, "high"), (123333, 143333, 20.0, "medium"), (143333, 173333, 30.0, "medium")]
    assert validate.asr_gaps(tables["segments"]).count() == 0
    ch = validate.chapter_coverage(tables["chapters"], tables["scenes"], tables["keyframes"], tables["segments"], tables["blocks"]).orderBy("chapter_index").collect()
    assert [(r["num_scenes"], r["num_keyframes"], r["num_asr_segments"]) for r in ch] == [(1, 4, 13), (6, 7, 12), (1, 5, 16), (0, 2, 14)]
    assert [r["duration_sec"] for r in ch] == [63, 49, 63, 51] and {r["coverage_pct"] for r in ch} == {100.0}


def test_phases(spark, tables, tmp_path):
    out = str(tmp_path)
    t = phases.phase_two(spark, tables, f"file://{out}/two")
    assert {r["stage"] for r in t.table(spark).collect()} >= {"timeline", "chunks", "clean", "align", "enrich", "store", "export"}
    chunks = spark.read.parquet(f"file://{out}/two/chunks_parquet")
    rows = chunks.collect()
    assert len(rows) == 9 and {len(r["text_embedding"]) for r in rows} == {384} and {r["alignment_score"] for r in rows} == {0.0}
    assert all(r["asr_confidence"] == 0.5 and r["ocr_confidence"] == pytest.approx(0.9) for r in rows)
    assert {len(r["provenance"]["video_description"]) for r in rows} == {500}
    (doc,) = glob.glob(f"{out}/two/chunks_json/video_id=golden/*.txt")
    assert json.loads(open(doc).read())["total_chunks"] == 9
    phases.phase_three(spark, tables, chunks, f"file://{out}/three")
    report = spark.read.json(f"file://{out}/three/report").first()
    assert report["chunks"] == 9 and report["gaps"] == 4 and report["verdict"] == "PASS"
    pairs = spark.read.json(f"file://{out}/three/qa_pairs")
    assert pairs.count() == 18 and set(pairs.columns) == {"question", "answer", "evidence_type", "chunk_id", "t_start_ms", "t_end_ms", "chapter_title", "video_id"}

    def broken(frames):
        raise RuntimeError("no model")

    phases.phase_three(spark, tables, chunks, f"file://{out}/four", generator=broken)
    assert spark.read.json(f"file://{out}/four/report").count() == 1


def _each(columns, rows):
    """A model that gives the same rows for every row of its input."""
    import pandas as pd

    def run(frames):
        for f in frames:
            yield pd.DataFrame([(v, *r) for v in f["video_id"] for r in rows], columns=["video_id", *columns])

    return run


def _toy_models():
    def normalizer(frames):
        for f in frames:
            yield f.assign(output=f["path"].str.replace(".mp4", ".wav"), ok=~f["path"].str.contains("broken"))

    def prober(frames):
        for f in frames:
            # the first two tries are blurred; samples change every ten seconds
            pixels = [[float(t // 10_000 % 2 * 100)] * 4 for t in f["timestamp_ms"]]
            yield f.drop(columns="path").assign(blur_score=[200.0 if k or o > 1 else 10.0 for k, o in zip(f["kind"], f["offset"])], pixels=pixels)

    def reader(frames):
        for f in frames:
            blocks = [[{"text": f"label {i}", "polygon": [[0.0, 0.0], [5.0, 5.0]], "confidence": 0.9}, {"text": "faint", "polygon": [[0.0, 0.0]], "confidence": 0.1}] for i in f["frame_id"]]
            yield f[["video_id", "frame_id"]].assign(blocks=blocks)

    word = lambda w, s: {"word": w, "start_s": s, "end_s": s + 0.5, "probability": 0.5}
    said = [(0, 0.5, 2.0, "one two", [word("one", 0.5), word("two", 1.0)]), (1, 3.0, 4.0, "three", [word("three", 3.0)])]
    return phases.Models(
        normalizer=normalizer, durations=_each(["duration_ms"], [(60_000,)]), transcriber=_each(["seg_ix", "start_s", "end_s", "text", "words"], said),
        diarizer=_each(["start_ms", "speaker"], [(500, "A")]), scorer=_each(["t_ms", "score"], [(100, 99.0), (20_000, 30.0), (20_200, 40.0), (30_000, 5.0)]), prober=prober, reader=reader,
    )


def test_phase_one(spark, tmp_path):
    media = spark.createDataFrame([(1, "a.mp4"), (2, "b.mp4"), (3, "broken.mp4")], "video_id long, path string")
    out = f"file://{tmp_path}/one"
    times = phases.phase_one(spark, media, out, _toy_models(), diarize=True)
    assert list(times.seconds) == ["media", "videos", "asr", "transcript", "scenes", "keyframes", "ocr"]
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    assert {(r["video_id"], r["path"]) for r in read("media").collect()} == {(1, "a.wav"), (2, "b.wav")}
    assert [(r["start_ms"], r["end_ms"]) for r in read("scenes").where("video_id = 1").orderBy("scene_id").collect()] == [(0, 20_000), (20_000, 60_000)]
    assert [(r["speaker"], [w["score"] for w in r["words"]]) for r in read("asr").where("video_id = 2").orderBy("seg_ix").collect()] == [("A", [0.5, 0.5]), (None, [0.5])]
    assert read("transcript").where("video_id = 1").first()["transcript"] == "[00:00:00.500 -> 00:00:02.000] [A] one two\n[00:00:03.000 -> 00:00:04.000] three"
    frames = read("keyframes").where("video_id = 1").orderBy("frame_id").collect()
    assert [(r["scene_id"], r["timestamp_ms"]) for r in frames] == [(0, 66), (1, 20_066), (1, 25_000), (1, 30_000), (1, 40_000), (1, 50_000)]
    assert [(r["full_text"], r["total_blocks"]) for r in read("ocr").where("video_id = 1").orderBy("frame_id").collect()] == [(f"label {i}", 1) for i in range(6)]
    phases.phase_one(spark, media, out, phases.Models())  # everything is there
    assert read("ocr").count() == 12
    phases.phase_one(spark, media, out, phases.Models(), skip_existing=False)
    assert read("ocr").count() == 0 and read("media").count() == 3


def test_extract_command(spark, tmp_path, monkeypatch):
    from reelspark import __main__ as cli

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.mp4").write_bytes(b"x")
    assert cli.main(["extract", f"{tmp_path}/in", f"file://{tmp_path}/out", "--models", "tests.test_golden:TOY", "--diarize"]) == 0
    assert spark.read.parquet(f"file://{tmp_path}/out/keyframes").count() == 6


TOY = _toy_models()
