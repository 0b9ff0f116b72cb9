"""Coverage, gaps, quality flags and content density."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import ReviewConfig
from ..functions import text as T
from .intervals import interval_join

_C = ReviewConfig()


def coverage_windows(videos: DataFrame, segments: DataFrame, keyframes: DataFrame, blocks: DataFrame, config: ReviewConfig = _C) -> DataFrame:
    """Tumbling windows over [0, duration_s * 1000), the last one cut, with has_asr (open overlap), has_keyframe (half
    open) and has_ocr (a keyframe whose image has a block).

    Segments and keyframes are turned into the ids of the windows that they touch, so there is no inequality join; the
    flags are one aggregation over (video, window)."""
    s = config.window_ms
    total = videos.select("video_id", (F.col("duration_s") * 1000).cast("long").alias("d")).where("d > 0")
    windows = total.select("video_id", "d", F.explode(F.expr(f"sequence(0L, cast((d - 1) div {s} as bigint))")).alias("w"))
    last = F.least(F.ceil(F.col("end_ms") / s), F.ceil(F.col("d") / s)) - 1
    spans = segments.select("video_id", "start_ms", "end_ms").join(total, "video_id").where("start_ms < d and end_ms > 0")
    spans = spans.withColumn("a", F.greatest(F.floor(F.col("start_ms") / s), F.lit(0))).withColumn("b", last).where("b >= a")
    asr = spans.select("video_id", F.explode(F.sequence("a", "b")).alias("w"), F.lit(1).alias("k"))
    named = blocks.select("video_id", T.basename(F.col("path")).alias("name")).distinct()
    frames = keyframes.select("video_id", "timestamp_ms", T.basename(F.col("path")).alias("name")).join(total, "video_id").where("timestamp_ms >= 0 and timestamp_ms < d")
    at = F.floor(F.col("timestamp_ms") / s).alias("w")
    seen = frames.select("video_id", at, F.lit(2).alias("k"))
    read = frames.join(named, ["video_id", "name"], "left_semi").select("video_id", at, F.lit(4).alias("k"))
    flags = asr.union(seen).union(read).groupBy("video_id", "w").agg(F.bit_or("k").alias("k"))
    bit = lambda b: (F.coalesce("k", F.lit(0)).bitwiseAND(F.lit(b)) > 0)
    return windows.join(flags, ["video_id", "w"], "left").select(
        "video_id", (F.col("w") * s).alias("start_ms"), F.least((F.col("w") + 1) * s, F.col("d")).alias("end_ms"), bit(1).alias("has_asr"), bit(2).alias("has_keyframe"), bit(4).alias("has_ocr")
    )


def overall_coverage(videos: DataFrame, windows: DataFrame) -> DataFrame:
    """Percent of windows with speech or a keyframe; 0 without windows."""
    hit = windows.groupBy("video_id").agg((100.0 * F.count_if(F.col("has_asr") | F.col("has_keyframe")) / F.count("*")).alias("pct"))
    return videos.select("video_id").join(hit, "video_id", "left").select("video_id", F.coalesce("pct", F.lit(0.0)).alias("coverage_pct"))


def chapter_coverage(chapters: DataFrame, scenes: DataFrame, keyframes: DataFrame, segments: DataFrame, blocks: DataFrame) -> DataFrame:
    """Per chapter: scenes within it, keyframes in it, segments that overlap it, text blocks of its keyframes' images,
    and 100 or 0 percent. Each side is counted before it is joined."""
    spans = chapters.select("video_id", "chapter_index", F.col("start_ms").alias("c0"), F.col("end_ms").alias("c1"))
    size = 600_000

    def counted(df: DataFrame, a: str, b: str, bounds: str, what: str, value=None) -> DataFrame:
        j = interval_join(spans, df, "video_id", ("c0", "c1"), (a, b), bounds, size)
        return j.groupBy("video_id", "chapter_index").agg((F.count("*") if value is None else F.sum(value)).alias(what))

    per_image = blocks.groupBy("video_id", T.basename(F.col("path")).alias("name")).agg(F.count("*").alias("n_blocks"))
    frames = keyframes.select("video_id", "timestamp_ms", F.col("timestamp_ms").alias("t1"), T.basename(F.col("path")).alias("name"))
    named = frames.join(per_image, ["video_id", "name"], "left")
    sides = [
        counted(scenes.select("video_id", "start_ms", "end_ms"), "start_ms", "end_ms", "contains", "num_scenes"),
        counted(named, "timestamp_ms", "t1", "half_open", "num_keyframes"),
        counted(segments.select("video_id", "start_ms", "end_ms"), "start_ms", "end_ms", "open", "num_asr_segments"),
        counted(named, "timestamp_ms", "t1", "half_open", "num_ocr_blocks", F.coalesce("n_blocks", F.lit(0))),
    ]
    out = chapters.select("video_id", "chapter_index", "title", ((F.col("end_ms") - F.col("start_ms")) / 1000).alias("duration_sec"))
    for side in sides:
        out = out.join(side, ["video_id", "chapter_index"], "left")
    names = ("num_scenes", "num_keyframes", "num_asr_segments", "num_ocr_blocks")
    out = out.select("video_id", "chapter_index", "title", "duration_sec", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names])
    return out.withColumn("coverage_pct", F.when((F.col("num_keyframes") > 0) & (F.col("num_asr_segments") > 0), 100.0).otherwise(0.0))


def keyframe_gaps(keyframes: DataFrame, config: ReviewConfig = _C, videos: DataFrame | None = None) -> DataFrame:
    """Gaps of more than ``keyframe_gap_ms`` between neighbouring keyframes. With ``include_edges`` (and videos) the
    stretches before the first and behind the last count too."""
    points = keyframes.select("video_id", F.col("timestamp_ms").alias("t"))
    if config.include_edges and videos is not None:
        edges = videos.select("video_id", F.explode(F.array(F.lit(0).cast("long"), F.col("duration_ms").cast("long"))).alias("t"))
        points = points.union(edges)
    w = W.partitionBy("video_id").orderBy("t")
    gaps = points.select("video_id", F.col("t").alias("start_ms"), F.lead("t").over(w).alias("end_ms")).where(F.col("end_ms") - F.col("start_ms") > config.keyframe_gap_ms)
    d = F.col("end_ms") - F.col("start_ms")
    return gaps.select("video_id", F.lit("keyframe").alias("gap_type"), "start_ms", "end_ms", (d / 1000).alias("duration_sec"), T.gap_severity(d, config.severe_gap_ms).alias("severity"))


def asr_gaps(segments: DataFrame, config: ReviewConfig = _C) -> DataFrame:
    """Silence of more than ``asr_gap_ms`` between a segment's end and the next one's start."""
    w = W.partitionBy("video_id").orderBy("start_ms", "seg_ix")
    gaps = segments.select("video_id", F.col("end_ms").alias("a"), F.lead("start_ms").over(w).alias("b")).where(F.col("b") - F.col("a") > config.asr_gap_ms)
    return gaps.select("video_id", F.lit("asr").alias("gap_type"), F.col("a").alias("start_ms"), F.col("b").alias("end_ms"), ((F.col("b") - F.col("a")) / 1000).alias("duration_sec"), F.lit("low").alias("severity"))


def _frame_stats(keyframes: DataFrame, blocks: DataFrame, config: ReviewConfig) -> DataFrame:
    """Per keyframe: the length of its joined texts, its blocks, and those of low confidence."""
    per = blocks.groupBy("video_id", T.basename(F.col("path")).alias("name")).agg(
        F.count("*").alias("n"), (F.sum(F.length("text")) + F.count("*") - 1).alias("chars"), F.count_if(F.col("confidence") < F.lit(config.low_confidence)).alias("weak")
    )
    return keyframes.select("video_id", "frame_id", "path", T.basename(F.col("path")).alias("name")).join(per, ["video_id", "name"], "left")


def _flag(df: DataFrame, kind: str, severity: str, description, location, rank, sub: int) -> DataFrame:
    return df.select("video_id", F.lit(kind).alias("flag_type"), F.lit(severity).alias("severity"), description.alias("description"), location.alias("location"), rank.cast("long").alias("rank"), F.lit(sub).alias("sub"))


def flag_no_ocr(keyframes: DataFrame, blocks: DataFrame) -> DataFrame:
    named = blocks.select("video_id", T.basename(F.col("path")).alias("name")).distinct()
    bare = keyframes.withColumn("name", T.basename(F.col("path"))).join(named, ["video_id", "name"], "left_anti")
    return _flag(bare, "no_ocr", "medium", F.lit("The keyframe has no text"), F.col("path"), F.col("frame_id"), 0)


def flag_low_text(keyframes: DataFrame, blocks: DataFrame, config: ReviewConfig = _C) -> DataFrame:
    few = _frame_stats(keyframes, blocks, config).where((F.col("n") > 0) & (F.col("chars") < config.min_text_chars))
    return _flag(few, "low_ocr_text", "low", F.format_string("Little text (%d chars)", "chars"), F.col("path"), F.col("frame_id"), 1)


def flag_low_confidence(keyframes: DataFrame, blocks: DataFrame, config: ReviewConfig = _C) -> DataFrame:
    weak = _frame_stats(keyframes, blocks, config).where("weak > 0")
    return _flag(weak, "low_ocr_confidence", "low", F.concat(F.col("weak").cast("string"), F.lit(f" blocks below confidence {config.low_confidence}")), F.col("path"), F.col("frame_id"), 2)


def flag_no_visual(chunks: DataFrame) -> DataFrame:
    return _flag(chunks.where("not has_visual"), "no_visual", "high", F.lit("The chunk shows nothing"), F.col("chunk_id"), F.col("grp"), 3)


def flag_no_speech(chunks: DataFrame) -> DataFrame:
    return _flag(chunks.where("not has_speech"), "no_speech", "medium", F.lit("The chunk has no speech"), F.col("chunk_id"), F.col("grp"), 4)


def quality_flags(keyframes: DataFrame, blocks: DataFrame, chunks: DataFrame, config: ReviewConfig = _C) -> DataFrame:
    """All flags with their place in the list of their video: keyframe by keyframe, then chunk by chunk."""
    every = flag_no_ocr(keyframes, blocks).union(flag_low_text(keyframes, blocks, config)).union(flag_low_confidence(keyframes, blocks, config)).union(flag_no_visual(chunks)).union(flag_no_speech(chunks))
    w = W.partitionBy("video_id").orderBy((F.col("sub") >= 3).cast("int"), "rank", "sub")
    return every.withColumn("position", F.row_number().over(w)).drop("rank", "sub")


def content_density(chunks: DataFrame, top: int = 3) -> DataFrame:
    """The richest and the thinnest chunks of each video by characters of speech and screen, ties in chunk order; the
    thinnest are the last of the falling order, so both lists may share chunks.
    chunks: video_id, grp, chunk_id, t_start_ms, t_end_ms, and asr_chars and ocr_chars, or else asr_text and ocr_text."""
    chars = lambda n: F.coalesce(f"{n}_chars", F.lit(0)) if f"{n}_chars" in chunks.columns else F.length(f"{n}_text")
    a, o, d = chars("asr").cast("long"), chars("ocr").cast("long"), (F.col("t_end_ms") - F.col("t_start_ms")) / 1000
    scored = chunks.select("video_id", "grp", "chunk_id", (a + o).alias("total_text_chars"), a.alias("asr_chars"), o.alias("ocr_chars"), d.alias("duration_sec"), F.when(d > 0, (a + o) / d).otherwise(0.0).alias("density"))
    down = W.partitionBy("video_id").orderBy(F.col("total_text_chars").desc(), "grp")
    up = W.partitionBy("video_id").orderBy("total_text_chars", F.col("grp").desc())
    ranked = scored.withColumn("r", F.row_number().over(down)).withColumn("s", F.row_number().over(up)).where((F.col("r") <= top) | (F.col("s") <= top))
    lists = F.array_compact(F.array(F.when(F.col("r") <= top, F.lit("richest")), F.when(F.col("s") <= top, F.lit("thinnest"))))
    return ranked.withColumn("list", F.explode(lists)).drop("s", "grp").withColumnRenamed("r", "rank")
