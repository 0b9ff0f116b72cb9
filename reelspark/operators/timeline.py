"""The unified timeline: five kinds of events, one order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KINDS = ("chapter", "scene", "asr", "keyframe", "ocr")


def _pairs(df: DataFrame, kind: int, ix: str, names: tuple[str, str], data: list[str]) -> DataFrame:
    """A start and an end event of each row."""
    made = F.to_json(F.struct(*data))
    ends = F.array(*[F.struct(F.col(t).alias("timestamp_ms"), F.lit(n).alias("event_type"), (F.col(ix) * 2 + i).cast("long").alias("item")) for i, (t, n) in enumerate(zip(("start_ms", "end_ms"), names))])
    return df.select("video_id", F.lit(kind).alias("kind"), F.explode(ends).alias("e"), made.alias("data")).select("video_id", "e.*", "kind", "data")


def chapter_events(chapters: DataFrame) -> DataFrame:
    return _pairs(chapters, 0, "chapter_index", ("chapter_start", "chapter_end"), ["chapter_index", "title"])


def scene_events(scenes: DataFrame) -> DataFrame:
    return _pairs(scenes, 1, "scene_id", ("scene_start", "scene_end"), ["scene_id", "duration_ms"])


def _single(df: DataFrame, kind: int, ix: str, at: str, name: str, data: list) -> DataFrame:
    return df.select("video_id", F.col(at).alias("timestamp_ms"), F.lit(name).alias("event_type"), (F.col(ix) * 2).cast("long").alias("item"), F.lit(kind).alias("kind"), F.to_json(F.struct(*data)).alias("data"))


def asr_events(segments: DataFrame) -> DataFrame:
    """word_count is the number of timed words of a segment."""
    return _single(segments, 2, "seg_ix", "start_ms", "asr_segment", ["end_ms", "text", "word_count"])


def keyframe_events(keyframes: DataFrame) -> DataFrame:
    return _single(keyframes, 3, "frame_id", "timestamp_ms", "keyframe", ["frame_id", "scene_id", "filename", "blur_score"])


def ocr_events(frames: DataFrame) -> DataFrame:
    """frames: frame_id, timestamp_ms, full_text and the nested text_blocks; polygons are left out."""
    blocks = F.transform("text_blocks", lambda b: F.struct(b["text"].alias("text"), b["bbox"].alias("bbox"), b["confidence"].alias("confidence")))
    return _single(frames, 4, "frame_id", "timestamp_ms", "ocr_result", ["frame_id", "full_text", F.size("text_blocks").alias("total_blocks"), blocks.alias("text_blocks")])


def build(*events: DataFrame) -> DataFrame:
    """All events of each video in order: by time, ties by kind, then as listed (a start before its end)."""
    every = events[0]
    for e in events[1:]:
        every = every.unionByName(e)
    w = W.partitionBy("video_id").orderBy("timestamp_ms", "kind", "item")
    return every.withColumn("position", F.row_number().over(w) - 1)


def summary(timeline: DataFrame, scenes: DataFrame) -> DataFrame:
    """video_id, total_events, duration_ms: the end of the last scene, not the latest end; 0 without scenes."""
    n = timeline.groupBy("video_id").agg(F.count("*").alias("total_events"))
    last = scenes.groupBy("video_id").agg(F.max_by("end_ms", "scene_id").alias("duration_ms"))
    return n.join(last, "video_id", "left").select("video_id", "total_events", F.coalesce("duration_ms", F.lit(0)).cast("long").alias("duration_ms"))
