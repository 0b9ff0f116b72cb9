"""What keeps figures in proportion to the input: layouts, plans and sizes of what is held at once."""

import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from reelspark import session
from reelspark.functions import vectors as V
from reelspark.operators import extract, ocr, qa, store
from reelspark.plans import extensions as _e  # noqa: F401
from reelspark.plans import more as _m  # noqa: F401
from reelspark.plans import queries as Q
from reelspark.plans import registry
from reelspark.plans import review as _r  # noqa: F401
from reelspark.session import shared_dir
from reelspark.sources.adapter import Corpus

QUERIES = registry.queries()


def written(spark, label: str) -> list[str]:
    """Data files below the tables of the label in the shared folder."""
    root = shared_dir(spark).removeprefix("file://")
    return [f"{at}/{f}" for d in os.listdir(root) if f"-{label}-" in d for at, _, files in os.walk(f"{root}/{d}") for f in files if f.startswith("part-")]


@pytest.mark.parametrize("name, label", [("src_p1_asr", "segments"), ("src_p3_asr", "segments"), ("src_p1_ocr", "results"), ("src_p3_ocr", "results"), ("sink_timeline_json", "timeline"), ("sink_json", "export")])
def test_documents_of_many_videos_are_lines_of_compressed_files(spark, smallest, name, label):
    before = set(written(spark, label))
    QUERIES[name](spark, smallest).count()
    new = set(written(spark, label)) - before
    assert new and all(f.endswith(".gz") and "video_id=" not in f for f in new)


def plan(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().split("\n")


def test_tokens_of_frames_are_never_keys_with_their_frame(spark):
    rows = [(1, 0, "a b a"), (1, 0, "B c"), (1, 1, "a"), (1, 1, None), (2, 0, "x")]
    found = ocr.chrome_tokens(spark.createDataFrame(rows, "video_id long, frame_id int, text string"), 0.5, "frames")
    assert {tuple(r) for r in found.collect()} == {(1, "a", 2), (1, "b", 1), (1, "c", 1), (2, "x", 1)}
    grouped = [x.split("], [")[0] for x in plan(found) if "Aggregate [" in x]
    assert grouped and not any("frame_id" in x and "token" in x for x in grouped)


def test_the_screen_is_spread_by_its_size(spark, smallest):
    c = Corpus(spark, smallest)
    assert any("RepartitionByExpression" in x for x in plan(c.screen))
    assert c._partitions(1, 1000) > c._partitions(1, 100_000)


def subtree(lines: list[str], at: int) -> list[str]:
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    end = next((i for i in range(at + 1, len(lines)) if depth(lines[i]) <= depth(lines[at])), len(lines))
    return lines[at:end]


def test_segments_find_their_chunks_without_their_texts(spark, smallest):
    lines = plan(Q._chunks(Corpus(spark, smallest)))
    (at,) = [i for i, x in enumerate(lines) if "Join Inner" in x and "_bucket" in x and "_first_r" in x and "seg_ix" in "".join(subtree(lines, i))]
    assert not any("text#" in x for x in subtree(lines, at))


def test_provenance_never_moves_the_texts(spark, smallest):
    lines = plan(Q.enriched(Corpus(spark, smallest)))
    by_video = [subtree(lines, i) for i, x in enumerate(lines) if "Join LeftOuter, (video_id#" in x and "grp#" not in x and "_chrome" not in "".join(subtree(lines, i)[:3])]
    assert not any("asr_text#" in x for s in by_video for x in s)


def test_exports_for_exchange_are_compressed(spark, smallest):
    before = set(written(spark, "chunks") + written(spark, "all"))
    QUERIES["src_p3_chunks"](spark, smallest)
    QUERIES["sink_export_all"](spark, smallest)
    new = set(written(spark, "chunks") + written(spark, "all")) - before
    assert new and all(f.endswith((".gz", ".parquet")) and "video_id=" not in f for f in new)


def test_questions_need_no_join(spark):
    rows = [("a", 1, 0, 5, "T", "said", "shown"), ("a", 2, 5, 9, "T", "more", ""), ("b", 1, 9, 12, "U", "", ""), ("c", 3, 0, 1, "V", "", "only")]
    chunks = spark.createDataFrame(rows, "chunk_id string, video_id long, t_start_ms long, t_end_ms long, chapter_title string, asr_text string, ocr_text string").coalesce(1)
    pairs = qa.generate(chunks)
    assert not any("Join" in x for x in plan(pairs))
    got = sorted((r["chunk_id"], r["answer"], r["t_start_ms"], r["chapter_title"], r["video_id"]) for r in pairs.collect())
    both = [(x, at, v) for x in ("said", "shown", "more") for at, v in ((0, 1), (5, 2))]  # a repeated id takes each reply
    assert got == sorted([("a", x, at, "T", v) for x, at, v in both] + [("c", "only", 0, "V", 3)])


def test_vectors_of_texts_are_made_in_slices_of_arrow(monkeypatch):
    monkeypatch.setattr(session.slices, "__defaults__", (8,))
    texts = ["a b a", None, "", "x " * 50, "b"]
    made = V.hash_embedding(16).func(pa.array(texts))
    assert made.type == pa.list_(pa.float32()) and [len(v) for v in made.to_pylist()] == [16] * 5
    alone = [V.hash_embedding(16).func(pa.array([t], pa.string())).to_pylist()[0] for t in texts]
    assert made.to_pylist() == alone and abs(sum(x * x for x in alone[0]) - 1) < 1e-6 and not any(alone[1])


def test_a_search_holds_a_bounded_number_of_scores(monkeypatch):
    monkeypatch.setattr(store, "SCORES", 200)
    sizes, rounded = [], np.round
    monkeypatch.setattr(store.np, "round", lambda a, *x, **y: sizes.append(a.size) or rounded(a, *x, **y))
    rng = np.random.default_rng(1)
    points, queries = rng.integers(-2, 3, (300, 3)).astype(float), rng.integers(-2, 3, (50, 3)).astype(float)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(a, a + 100)), pa.array(list(points[a : a + 100]))], ["_key", "_v"]) for a in (0, 100, 200)]
    shipped = type("B", (), {"value": (np.arange(50), queries)})
    (out,) = store._nearest(shipped, 4, ("q", "p", "s"))(iter(batches))
    want = [(q, int(p), s[p]) for q, s in enumerate(queries @ points.T) for p in np.lexsort((np.arange(300), -s))[:4]]
    assert sorted(zip(*(out.column(i).to_pylist() for i in range(3)))) == sorted(want)
    assert sizes and max(sizes) <= 200


def test_models_see_few_rows_at_once():
    seen = []

    def model(frames):
        for f in frames:
            seen.append(list(f.index))
            yield f

    made = list(extract.bounded(model, 4)(iter([pd.DataFrame({"x": range(10)}), pd.DataFrame({"x": []})])))
    assert seen == [[0, 1, 2, 3], [0, 1, 2, 3], [0, 1]] and [x for f in made for x in f["x"]] == list(range(10))
