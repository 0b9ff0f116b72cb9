"""Clean-up of on-screen text: chrome tokens, sequential de-duplication, chunk text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def chrome_tokens(blocks: DataFrame, share: float = 0.8, mode: str = "occurrence") -> DataFrame:
    """video_id, token of what belongs to the player or program rather than to the content.

    occurrence: a token counts as often as it stands there; frames: once per frame. It is chrome from ``share`` times
    the number of frames on. blocks: video_id, frame_id, text."""
    if mode not in ("occurrence", "frames"):
        raise ValueError("mode is occurrence or frames")
    n = blocks.groupBy("video_id").agg(F.count_distinct("frame_id").alias("frames"))
    if mode == "frames":  # a frame's tokens are made different within its row, so that none is ever a key with its frame
        own = F.array_distinct(F.flatten(F.collect_list(F.array_distinct(T.tokens(F.col("text"))))))
        words = blocks.groupBy("video_id", "frame_id").agg(own.alias("_own")).select("video_id", F.explode("_own").alias("token"))
    else:
        words = blocks.select("video_id", F.explode(T.tokens(F.col("text"))).alias("token"))
    counts = words.groupBy("video_id", "token").agg(F.count("*").alias("n"))
    return counts.join(n, "video_id").where(F.col("n") >= F.col("frames") * F.lit(float(share))).select("video_id", "token", "n")


def dedup_sequential(frames: DataFrame, overlap: float = 0.9, group: str = "video_id") -> DataFrame:
    """Frames that remain of each group: in order, a frame whose token set overlaps the last kept one by ``overlap`` or
    more is dropped, or replaces it if its confidence is higher. Without tokens on either side a frame is kept.

    frames: group, frame_id, text, confidence. The fold is one JVM aggregate over the group's sorted frames; it carries
    the kept ids and the last kept frame."""
    item = F.struct(F.col("frame_id").cast("long").alias("id"), F.array_distinct(T.tokens(F.col("text"))).alias("tokens"), F.col("confidence").cast("double").alias("conf"))
    sorted_ = frames.groupBy(group).agg(F.array_sort(F.collect_list(item)).alias("xs"))
    start = F.struct(F.array().cast("array<bigint>").alias("kept"), F.array().cast("array<string>").alias("tokens"), F.lit(float("-inf")).alias("conf"))

    def step(acc, x):
        larger = F.greatest(F.size(acc["tokens"]), F.size(x["tokens"]))
        common = F.size(F.array_intersect(acc["tokens"], x["tokens"]))
        fresh = (F.size(acc["tokens"]) == 0) | (F.size(x["tokens"]) == 0) | (common / larger < F.lit(float(overlap)))
        taken = F.struct(F.concat(acc["kept"], F.array(x["id"])).alias("kept"), x["tokens"].alias("tokens"), x["conf"].alias("conf"))
        instead = F.struct(F.concat(F.slice(acc["kept"], 1, F.greatest(F.size(acc["kept"]) - 1, F.lit(0))), F.array(x["id"])).alias("kept"), x["tokens"].alias("tokens"), x["conf"].alias("conf"))
        return F.when(fresh, taken).when(x["conf"] > acc["conf"], instead).otherwise(acc)

    return sorted_.select(group, F.explode(F.aggregate("xs", start, step, lambda a: a["kept"])).alias("frame_id"))


def _told(blocks: DataFrame, chrome: DataFrame) -> DataFrame:
    """Blocks with _content: whether they have a token that isn't chrome. A video's chrome is one array (no longer than a
    frame has tokens, on average, by 1 / share), so no token is ever exploded or shuffled here."""
    per_video = chrome.groupBy("video_id").agg(F.collect_list("token").alias("_chrome"))
    none = F.array().cast("array<string>")
    return blocks.join(per_video, "video_id", "left").withColumn("_content", F.size(F.array_except(T.tokens(F.col("text")), F.coalesce("_chrome", none))) > 0)


def clean_frames(blocks: DataFrame, chrome: DataFrame, more_keys: tuple[str, ...] = ()) -> DataFrame:
    """video_id, frame_id, text: each frame's text in reading order without blocks of chrome tokens only; and, if the
    blocks have a confidence, its sum and number over all blocks. Grouping by frame reuses the partitioning by video.
    more_keys: columns of the blocks that a frame has one value of, such as its chunk."""
    kept = F.array_sort(F.collect_list(F.when(F.col("_content"), F.struct("y", "x", "block_ix", "text"))))
    more = [F.sum("confidence").alias("conf_sum"), F.count("confidence").alias("conf_n")] if "confidence" in blocks.columns else []
    return _told(blocks, chrome).groupBy("video_id", "frame_id", *more_keys).agg(F.array_join(F.transform(kept, lambda b: b["text"]), " ").alias("text"), *more)


def chunk_text(chunk_frames: DataFrame | None, cleaned: DataFrame, keys: tuple[str, ...] = ("video_id", "grp")) -> DataFrame:
    """Non-empty frame texts of each chunk, in order, between bars; '' for a chunk without any. With the sums of
    ``clean_frames`` ocr_confidence, the mean over all blocks (null without any), comes of the same aggregation.
    chunk_frames: None if the frames have the keys already; then chunks whose frames have no blocks are left out, and a
    partitioning by video serves, so that no text moves."""
    rows = cleaned if chunk_frames is None else chunk_frames.select(*keys, "frame_id").join(cleaned, ["video_id", "frame_id"], "left")
    texts = F.array_sort(F.collect_list(F.struct("frame_id", F.coalesce("text", F.lit("")).alias("t"))))
    more = [F.try_divide(F.sum("conf_sum"), F.sum("conf_n")).alias("ocr_confidence")] if "conf_sum" in cleaned.columns else []
    return rows.groupBy(*keys).agg(T.joined_frames(F.transform(texts, lambda r: r["t"])).alias("ocr_text"), *more)


def screen_chars(chunk_frames: DataFrame, blocks: DataFrame, chrome: DataFrame, keys: tuple[str, ...] = ("video_id", "grp")) -> DataFrame:
    """keys, ocr_chars: the length of what ``chunk_text`` would make, by partial sums, without making any text."""
    told = _told(blocks, chrome).where("_content").groupBy("video_id", "frame_id").agg((F.sum(F.length("text")) + F.count("*") - 1).alias("_n"))
    rows = chunk_frames.select(*keys, "frame_id").join(told, ["video_id", "frame_id"])
    return rows.groupBy(*keys).agg((F.sum("_n") + 3 * (F.count("*") - 1)).alias("ocr_chars"))


def by_frame(blocks: DataFrame) -> DataFrame:
    """Blocks gathered by the base name of their image, within a video."""
    return blocks.groupBy("video_id", T.basename(F.col("path")).alias("name")).agg(F.count("*").alias("n_blocks"), F.array_sort(F.collect_list(F.struct("block_ix", "text"))).alias("blocks"))
