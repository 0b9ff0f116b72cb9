"""Scene merging and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import ChunkConfig
from .intervals import interval_join


def merge_scenes(scenes: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """Groups of scenes: one whose stored duration is below ``min_ms`` joins the group before it. The end is that of the
    last scene. Long scenes stay whole unless ``split_long`` asks for cuts at every ``max_ms``."""
    w = W.partitionBy("video_id").orderBy("scene_id")
    opens = F.when((F.row_number().over(w) == 1) | (F.col("duration_ms") >= config.min_ms), 1).otherwise(0)
    grouped = scenes.withColumn("_opens", opens).withColumn("grp", F.sum("_opens").over(w.rowsBetween(W.unboundedPreceding, 0)).cast("int"))
    merged = grouped.groupBy("video_id", "grp").agg(
        F.min("scene_id").alias("scene_id"), F.min_by("start_ms", "scene_id").alias("t_start_ms"), F.max_by("end_ms", "scene_id").alias("t_end_ms"),
        F.sort_array(F.collect_list("scene_id")).alias("merged_scene_ids"),
    )
    if config.split_long:
        cuts = F.sequence(F.col("t_start_ms"), F.greatest(F.col("t_end_ms") - 1, F.col("t_start_ms")), F.lit(config.max_ms).cast("long"))
        merged = merged.withColumn("_at", F.explode(cuts)).withColumn("t_end_ms", F.least(F.col("_at") + config.max_ms, F.col("t_end_ms"))).withColumn("t_start_ms", F.col("_at")).drop("_at")
    return merged.withColumn("duration_ms", F.col("t_end_ms") - F.col("t_start_ms"))


def scene_membership(groups: DataFrame) -> DataFrame:
    """video_id, grp, scene_id of every merged scene."""
    return groups.select("video_id", "grp", F.explode("merged_scene_ids").alias("scene_id"))


def find_chapter(groups: DataFrame, chapters: DataFrame, key: str = "grp") -> DataFrame:
    """The groups with chapter_index and chapter_title: the first chapter that holds t_start_ms, else the last one of the
    video; without chapters 0 and Unknown."""
    points = groups.select("video_id", key, "t_start_ms", F.col("t_start_ms").alias("_end"))
    spans = chapters.select("video_id", "chapter_index", F.col("title").alias("chapter_title"), "start_ms", F.col("end_ms").alias("ch_end"))
    inside = interval_join(spans, points, "video_id", ("start_ms", "ch_end"), ("t_start_ms", "_end"), "half_open", bucket_ms=600_000)
    best = inside.groupBy("video_id", key).agg(F.min("chapter_index").alias("_ci"), F.min_by("chapter_title", "chapter_index").alias("_ct"))
    last = chapters.groupBy("video_id").agg(F.max("chapter_index").alias("_li"), F.max_by("title", "chapter_index").alias("_lt"))
    out = groups.join(best, ["video_id", key], "left").join(last, "video_id", "left")
    index = F.coalesce("_ci", "_li", F.lit(0)).cast("int").alias("chapter_index")
    return out.select(*groups.columns, index, F.coalesce("_ct", "_lt", F.lit("Unknown")).alias("chapter_title"))


def join_segments(groups: DataFrame, segments: DataFrame) -> DataFrame:
    """Segments that overlap a chunk, ends included: one on a border is in both chunks."""
    spans = groups.select("video_id", "grp", "t_start_ms", "t_end_ms")
    return interval_join(spans, segments, "video_id", ("t_start_ms", "t_end_ms"), ("start_ms", "end_ms"), "closed")


def ordered_text(df: DataFrame, keys: list[str], ix: str, text: str, alias: str, sep: str = " ", more=()) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct(F.col(ix).alias("i"), F.col(text).alias("t"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(rows, lambda r: r["t"]), sep).alias(alias), F.count("*").alias("n"), *more)


def speech_chars(groups: DataFrame, segments: DataFrame) -> DataFrame:
    """video_id, grp, asr_chars: the length of what ``build_chunks`` would make of the texts, without making it."""
    length = F.col("chars") if "chars" in segments.columns else F.length("text")
    lengths = segments.select("video_id", "start_ms", "end_ms", length.alias("_n"))
    return join_segments(groups, lengths).groupBy("video_id", "grp").agg((F.sum("_n") + F.count("*") - 1).alias("asr_chars"))


def join_keyframes(groups: DataFrame, keyframes: DataFrame) -> DataFrame:
    """Keyframes whose scene is merged into the group, by id and never by time."""
    return scene_membership(groups).join(keyframes, ["video_id", "scene_id"])


def join_ocr(chunk_frames: DataFrame, frames: DataFrame) -> DataFrame:
    return chunk_frames.select("video_id", "grp", "frame_id").join(frames, ["video_id", "frame_id"])


def build_chunks(scenes: DataFrame, segments: DataFrame, keyframes: DataFrame, chapters: DataFrame, config: ChunkConfig = ChunkConfig(), said=None) -> DataFrame:
    """The chunk table: identity, span, chapter, speech and keyframes. Each side is aggregated before it is joined. If the
    segments have scores (``enrich.with_scores``), asr_confidence comes of the same join and aggregation as the text.
    said: looks up the texts (and scores) of segments that come without, after each has found its chunks by time."""
    groups = merge_scenes(scenes, config)
    pairs = join_segments(groups, segments)
    pairs = pairs if said is None else said(pairs)
    scored = "score_sum" in pairs.columns
    more = [F.coalesce(F.try_divide(F.sum("score_sum"), F.sum("score_n")), F.lit(0.0)).alias("asr_confidence")] if scored else []
    speech = ordered_text(pairs, ["video_id", "grp"], "seg_ix", "text", "asr_text", more=more).withColumnRenamed("n", "n_segments")
    frames = join_keyframes(groups, keyframes).groupBy("video_id", "grp").agg(F.array_sort(F.collect_list(F.struct("frame_id", "filename"))).alias("_f"))
    out = find_chapter(groups, chapters).join(speech, ["video_id", "grp"], "left").join(frames, ["video_id", "grp"], "left")
    empty = F.array().cast("array<struct<frame_id:int,filename:string>>")
    f = F.coalesce(F.col("_f").cast("array<struct<frame_id:int,filename:string>>"), empty)
    return out.select(
        F.concat(F.col("video_id").cast("string"), F.lit("_ch"), F.col("chapter_index").cast("string"), F.lit("_sc"), F.col("scene_id").cast("string")).alias("chunk_id"),
        "video_id", "grp", F.lit("youtube").alias("source"), "t_start_ms", "t_end_ms", "chapter_index", "chapter_title", "scene_id", "merged_scene_ids",
        F.coalesce("asr_text", F.lit("")).alias("asr_text"), F.coalesce("n_segments", F.lit(0)).alias("n_segments"),
        F.transform(f, lambda x: x["frame_id"]).alias("keyframe_ids"), F.transform(f, lambda x: x["filename"]).alias("keyframe_paths"), (F.size(f) > 0).alias("has_keyframe"),
        *[F.coalesce("asr_confidence", F.lit(0.0)).alias("asr_confidence")] * scored,
    )


def with_ids(groups: DataFrame, chapters: DataFrame) -> DataFrame:
    """The groups with their chapter and chunk_id."""
    made = find_chapter(groups, chapters)
    return made.withColumn("chunk_id", F.concat(F.col("video_id").cast("string"), F.lit("_ch"), F.col("chapter_index").cast("string"), F.lit("_sc"), F.col("scene_id").cast("string")))


def to_public(chunks: DataFrame, *more: str) -> DataFrame:
    """The public columns, in their order, and ``more``; those that no stage has made yet get their defaults."""
    from ..schemas import CHUNK

    types = {}
    for part in spark_fields(chunks, CHUNK):
        types[part.name] = part.dataType
    defaults = {"asr_confidence": F.lit(0.0), "ocr_confidence": F.lit(0.0), "alignment_score": F.lit(0.0), "ocr_text": F.lit(""), "merged_text": F.lit("")}
    cols = [F.col(n) if n in chunks.columns else defaults.get(n, F.lit(None)).cast(t).alias(n) for n, t in types.items() if not n.endswith("_embedding") or n in chunks.columns]
    return chunks.select(*cols, *more)


def spark_fields(df: DataFrame, ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).fields
