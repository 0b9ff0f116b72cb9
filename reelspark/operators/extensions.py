"""Operators beyond the three phases: speaker turns, changes of text, privacy flags, boundary errors, roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T


def speaker_turns(segments: DataFrame) -> DataFrame:
    """Runs of neighbouring segments of one speaker: video_id, turn, speaker, start_ms, end_ms, n."""
    w = W.partitionBy("video_id").orderBy("seg_ix")
    new = F.when(F.col("speaker").eqNullSafe(F.lag("speaker").over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    runs = segments.withColumn("_new", new).withColumn("turn", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)).cast("int"))
    return runs.groupBy("video_id", "turn").agg(F.first("speaker").alias("speaker"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count("*").alias("n"))


def changed_text_frames(frames: DataFrame, least: float = 0.5) -> DataFrame:
    """Frames whose tokens overlap those of the frame before by less than ``least`` (Jaccard); the first one always.
    frames: video_id, frame_id, text."""
    w = W.partitionBy("video_id").orderBy("frame_id")
    t = F.array_distinct(T.tokens(F.col("text")))
    both = frames.select("video_id", "frame_id", t.alias("t")).withColumn("b", F.lag("t").over(w))
    share = F.size(F.array_intersect("t", "b")) / F.size(F.array_union("t", "b"))
    return both.where(F.col("b").isNull() | (F.size(F.array_union("t", "b")) == 0) | (share < F.lit(float(least)))).select("video_id", "frame_id")


def privacy_flags(texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and whether a text shows a mail address, a network address, or a number as long as a card's."""
    c = F.coalesce(F.col(text), F.lit(""))
    return texts.select(key, c.rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}").alias("mail"), c.rlike(r"\b[0-9]{1,3}(\.[0-9]{1,3}){3}\b").alias("address"), c.rlike(r"\b[0-9]{13,16}\b").alias("card"))


def boundary_error(truth: DataFrame, found: DataFrame) -> DataFrame:
    """video_id and the mean distance of each true boundary from the nearest one found: both sides are sorted together
    once, and each truth sees the last one found before and the first one behind it. Null where nothing was found."""
    both = truth.select("video_id", "t_ms", F.lit(1).alias("_true")).union(found.select("video_id", "t_ms", F.lit(0)))
    at = F.when(F.col("_true") == 0, F.col("t_ms"))
    w = W.partitionBy("video_id").orderBy("t_ms", "_true")
    before = F.last(at, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    behind = F.first(at, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))
    near = both.withColumn("_d", F.least(F.col("t_ms") - before, behind - F.col("t_ms"))).where("_true = 1")
    return near.groupBy("video_id").agg(F.avg("_d").alias("mae_ms"))


def chapter_rollup(chunks: DataFrame) -> DataFrame:
    """Chunks and seconds per video and chapter, per video, and in all."""
    return chunks.rollup("video_id", "chapter_index").agg(F.count("*").alias("chunks"), (F.sum(F.col("t_end_ms") - F.col("t_start_ms")) / 1000).alias("seconds"), F.grouping_id().alias("level"))
