"""Confidence, completeness and provenance of chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def asr_confidence(words: DataFrame, keys: tuple[str, ...] = ("video_id", "grp"), use_probability: bool = False) -> DataFrame:
    """Mean score of the words that have one; 0 for a group without any. words: keys, score, probability."""
    score = F.coalesce("score", "probability") if use_probability else F.col("score")
    return words.groupBy(*keys).agg(F.coalesce(F.avg(score), F.lit(0.0)).alias("asr_confidence"))


def with_scores(segments: DataFrame, use_probability: bool = False) -> DataFrame:
    """Segments with score_sum and score_n of their words, summed within the row, so that no word is ever a row."""
    value = lambda w: F.coalesce(w["score"], w["probability"]) if use_probability else w["score"]
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n"))
    add = lambda a, w: F.when(value(w).isNull(), a).otherwise(F.struct((a["total"] + value(w)).alias("total"), (a["n"] + 1).alias("n")))
    summed = segments.withColumn("_scores", F.aggregate("words", start, add))
    return summed.withColumn("score_sum", F.col("_scores.total")).withColumn("score_n", F.col("_scores.n")).drop("_scores")


def ocr_confidence(blocks: DataFrame, keys: tuple[str, ...] = ("video_id", "grp")) -> DataFrame:
    """Mean over the blocks of all frames of a chunk, before any are dropped."""
    return blocks.groupBy(*keys).agg(F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("ocr_confidence"))


def completeness(n_segments: Column, n_keyframes: Column, ocr_text: Column) -> Column:
    return F.struct((n_segments > 0).alias("has_speech"), (n_keyframes > 0).alias("has_visual"), (F.coalesce(ocr_text, F.lit("")) != "").alias("has_ocr_text"))


def provenance(chunks: DataFrame, videos: DataFrame, description_chars: int = 500) -> DataFrame:
    """Chunks with the provenance of their video. Catalyst broadcasts the videos if they are small."""
    made = F.struct(
        F.col("title").alias("video_title"), F.coalesce("channel", F.lit("")).alias("channel"), F.coalesce("upload_date", F.lit("")).alias("publish_date"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), F.coalesce(F.substring("description", 1, description_chars), F.lit("")).alias("video_description"),
    )
    return chunks.join(videos.select("video_id", made.alias("provenance")), "video_id", "left")
