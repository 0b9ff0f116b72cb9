"""Model-backed extraction as hooks: each takes an injectable function over pandas frames, with a deterministic default
that needs no model. What surrounds the models (units, thresholds, order) is native."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vectors as V
from ..schemas import BLOCK, REGION, SEGMENT
from . import keyframes as K

Hook = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def _nothing(columns: list[str]) -> Hook:
    def run(frames):
        for f in frames:
            yield pd.DataFrame({c: pd.Series(dtype=object) for c in columns})

    return run


def bounded(model: Hook, rows: int = 256) -> Hook:
    """The model over frames of at most so many rows: what it makes of a row (each word as an object, say) can take a
    hundred times the row's bytes, and Arrow's batches have 10,000 rows."""

    def run(frames):
        yield from model(f.iloc[at : at + rows].reset_index(drop=True) for f in frames for at in range(0, len(f), rows))

    return run


def normalize_media(files: DataFrame, command: Hook) -> DataFrame:
    """path, output, ok: runs ``command`` (say, a call of an external transcoder) over frames of path."""
    return files.select("path").mapInPandas(command, "path string, output string, ok boolean")


def transcribe(audio: DataFrame, model: Hook | None = None) -> DataFrame:
    """video_id, seg_ix, start_ms, end_ms, text, words: ``model`` gives seconds, which are cut to whole ms."""
    schema = "video_id long, seg_ix int, start_s double, end_s double, text string, words array<struct<word:string,start_s:double,end_s:double,probability:double>>"
    found = audio.mapInPandas(bounded(model or _nothing(["video_id", "seg_ix", "start_s", "end_s", "text", "words"])), schema)
    ms = lambda c: (c * 1000).cast("long")
    words = F.transform("words", lambda w: F.struct(w["word"].alias("word"), ms(w["start_s"]).alias("start"), ms(w["end_s"]).alias("end"), F.lit(None).cast("double").alias("score"), w["probability"].alias("probability")))
    return found.select("video_id", "seg_ix", ms(F.col("start_s")).alias("start_ms"), ms(F.col("end_s")).alias("end_ms"), "text", words.alias("words"))


def align_words(segments: DataFrame, model: Hook | None = None) -> DataFrame:
    """Words with a score: that of ``model`` (video_id, seg_ix, words with score), otherwise their probability, 1.0 if
    they have none. A segment that the model doesn't return keeps its words."""
    aligned = None if model is None else segments.mapInPandas(bounded(model), f"video_id long, seg_ix int, new_words {SEGMENT[SEGMENT.index('words:') + 6:-1]}")
    base = segments if aligned is None else segments.join(aligned, ["video_id", "seg_ix"], "left").withColumn("words", F.coalesce("new_words", "words")).drop("new_words")
    return base.withColumn("words", F.transform("words", lambda w: w.withField("score", F.coalesce(w["score"], w["probability"], F.lit(1.0)))))


def diarize(segments: DataFrame, turns: DataFrame) -> DataFrame:
    """Segments with the speaker of the turn that starts at the same time. turns: video_id, start_ms, speaker."""
    return segments.join(turns.select("video_id", "start_ms", "speaker"), ["video_id", "start_ms"], "left")


def transcript(segments: DataFrame) -> DataFrame:
    """video_id, transcript: one line per segment, in order."""
    lines = segments.select("video_id", "seg_ix", T.transcript_line(F.col("start_ms"), F.col("end_ms"), F.col("text"), F.col("speaker")).alias("line"))
    return lines.groupBy("video_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_ix", "line"))), lambda r: r["line"]), "\n").alias("transcript"))


def detect_scenes(frame_scores: DataFrame, videos: DataFrame, threshold: float = 27.0, min_ms: int = 300) -> DataFrame:
    """Cuts where the content score of a frame reaches the threshold, if the scene so far is long enough.
    frame_scores: video_id, t_ms, score. A hit less than ``min_ms`` behind the last kept cut (the start, at first) is
    passed over. The fold is one JVM aggregate over the sorted hits of a video."""
    hits = frame_scores.where(F.col("score") >= threshold).groupBy("video_id").agg(F.sort_array(F.collect_set(F.col("t_ms").cast("long"))).alias("ts"))
    start = F.struct(F.lit(0).cast("long").alias("last"), F.array().cast("array<bigint>").alias("kept"))
    step = lambda acc, t: F.when(t - acc["last"] >= min_ms, F.struct(t.alias("last"), F.concat(acc["kept"], F.array(t)).alias("kept"))).otherwise(acc)
    kept = hits.select("video_id", F.explode(F.aggregate("ts", start, step, lambda acc: acc["kept"])).alias("t_ms"))
    cuts = kept.union(videos.select("video_id", F.lit(0).cast("long").alias("t_ms"))).distinct()
    return K.scenes_from_cuts(cuts, videos)


def blur_scores(images: DataFrame) -> DataFrame:
    """images: video_id, name, width, gray (bytes)."""
    return images.withColumn("blur_score", V.blur_score("gray", "width"))


def read_text(images: DataFrame, reader: Hook | None = None, least: float = 0.5) -> DataFrame:
    """video_id, frame_id, text_blocks: what ``reader`` sees (polygons), with boxes, weak blocks left out."""
    schema = "video_id long, frame_id int, blocks array<struct<text:string,polygon:array<array<double>>,confidence:double>>"
    found = images.mapInPandas(bounded(reader or _nothing(["video_id", "frame_id", "blocks"])), schema)
    kept = T.confident(F.col("blocks"), least)
    blocks = F.transform(kept, lambda b: F.struct(b["text"].alias("text"), T.polygon_box(b["polygon"]).alias("bbox"), b["polygon"].alias("bbox_polygon"), b["confidence"].alias("confidence")))
    return found.select("video_id", "frame_id", blocks.cast(f"array<{BLOCK}>").alias("text_blocks"))


def read_layout(images: DataFrame, reader: Hook | None = None) -> DataFrame:
    """video_id, frame_id, layout_regions; none without a reader."""
    if reader is None:
        return images.select("video_id", "frame_id", F.array().cast(f"array<{REGION}>").alias("layout_regions"))
    return images.mapInPandas(bounded(reader), f"video_id long, frame_id int, layout_regions array<{REGION}>")


def ocr_frames(keyframes: DataFrame, read: DataFrame) -> DataFrame:
    """One record per keyframe whose image was read."""
    joined = keyframes.join(read, ["video_id", "frame_id"])
    return joined.select("video_id", "frame_id", "scene_id", "timestamp_ms", "path", "text_blocks", T.full_text(F.col("text_blocks")).alias("full_text"), F.size("text_blocks").alias("total_blocks"))


def embed_text(chunks: DataFrame, dim: int = 384, embedder=None) -> DataFrame:
    """chunks with text_embedding of merged_text ('' if null). ``embedder`` is a pandas function of strings."""
    return chunks.withColumn("text_embedding", (embedder or V.hash_embedding(dim))(F.coalesce("merged_text", F.lit(""))))
