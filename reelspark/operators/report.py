"""The report of a video: numbers, positions on the strip, and a page of HTML."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T

CSS = "body{font:15px/1.5 sans-serif;max-width:60rem;margin:auto}.strip{position:relative;height:3rem;background:#eee}.strip i{position:absolute;height:100%;opacity:.5}.chapter{background:#69c}.gap{background:#c66}.scene,.keyframe{width:1px;background:#333}td,th{text-align:left;padding:.2rem .6rem}"


def assemble(videos: DataFrame, coverage: DataFrame, **counted: DataFrame) -> DataFrame:
    """A row per video: duration, coverage, verdict and the number of rows of each given table (0 if none)."""
    out = videos.select("video_id", "duration_s").join(coverage, "video_id", "left")
    for name, df in counted.items():
        out = out.join(df.groupBy("video_id").agg(F.count("*").alias(name)), "video_id", "left")
    return out.select("video_id", "duration_s", F.coalesce("coverage_pct", F.lit(0.0)).alias("coverage_pct"), T.verdict(F.coalesce("coverage_pct", F.lit(0.0))).alias("verdict"), *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in counted])


def strip_positions(videos: DataFrame, chapters: DataFrame, scenes: DataFrame, keyframes: DataFrame, gaps: DataFrame) -> DataFrame:
    """Left edge and width in percent of the duration, for chapters, scenes, keyframes and gaps."""
    d = videos.select("video_id", (F.col("duration_s") * 1000).alias("_d")).where("_d > 0")
    zero = F.lit(0).cast("long")
    parts = [(chapters, "chapter", "start_ms", F.col("end_ms") - F.col("start_ms")), (scenes, "scene", "start_ms", zero), (keyframes, "keyframe", "timestamp_ms", zero), (gaps, "gap", "start_ms", F.col("end_ms") - F.col("start_ms"))]
    every = None
    for df, kind, at, width in parts:
        one = df.select("video_id", F.lit(kind).alias("kind"), F.col(at).cast("long").alias("at_ms"), width.cast("long").alias("width_ms"))
        every = one if every is None else every.union(one)
    return every.join(d, "video_id").select("video_id", "kind", "at_ms", (F.col("at_ms") / F.col("_d") * 100).alias("left_pct"), (F.col("width_ms") / F.col("_d") * 100).alias("width_pct"))


def chunk_images(chunks: DataFrame, images: DataFrame) -> DataFrame:
    """Each keyframe path of a chunk with its image, by the whole path, else by the base name within the video."""
    paths = chunks.select("video_id", "chunk_id", F.posexplode("keyframe_paths").alias("i", "path")).withColumn("name", T.basename(F.col("path")))
    whole = images.select("video_id", F.col("path").alias("path"), F.col("image").alias("_by_path"))
    base = images.groupBy("video_id", T.basename(F.col("path")).alias("name")).agg(F.min_by("image", "path").alias("_by_name"))
    out = paths.join(whole, ["video_id", "path"], "left").join(base, ["video_id", "name"], "left")
    return out.select("video_id", "chunk_id", "i", "path", F.coalesce("_by_path", "_by_name").alias("image"))


def issues(gaps: DataFrame, flags: DataFrame, most: int = 20) -> DataFrame:
    """What the section of gaps shows of each video: every keyframe gap, and the first flags; each list with its places,
    and the number of its rows before any were left out."""
    w = W.partitionBy("video_id").orderBy("start_ms")
    n = lambda df: df.groupBy("video_id").agg(F.count("*").alias("total"))
    span = F.format_string("%.1fs - %.1fs (%.1fs)", F.col("start_ms") / 1000, F.col("end_ms") / 1000, F.col("duration_sec"))
    listed = gaps.withColumn("position", F.row_number().over(w)).join(n(gaps), "video_id")
    a = listed.select("video_id", F.lit("gap").alias("list"), "position", "total", F.col("gap_type").alias("issue"), "severity", span.alias("description"))
    b = shown_flags(flags, most).join(n(flags), "video_id")
    return a.union(b.select("video_id", F.lit("flag"), "position", "total", "flag_type", "severity", F.concat("description", F.lit(" - "), T.basename(F.col("location")))))


def shown_flags(flags: DataFrame, most: int = 20) -> DataFrame:
    """The first flags of each video's list, as the report shows them."""
    return flags.where(F.col("position") <= most)


def page(summary: dict, strip: list[dict], gaps: list[dict], flags: list[dict], chunks: list[dict]) -> str:
    """The HTML of one video, from rows that the caller has gathered for that video alone."""
    e = lambda x: html.escape(str(x))
    numbers = "".join(f"<tr><th>{e(k)}</th><td>{e(v)}</td></tr>" for k, v in summary.items())
    bars = "".join(f'<i class="{e(s["kind"])}" style="left:{s["left_pct"]:.3f}%;width:{max(s["width_pct"], 0.05):.3f}%"></i>' for s in strip)
    listed = "".join(f"<li>{e(g['gap_type'])} {g['start_ms'] / 1000:.1f}-{g['end_ms'] / 1000:.1f} s ({e(g['severity'])})</li>" for g in gaps)
    flagged = "".join(f"<li>{e(f['severity'])}: {e(f['description'])} ({e(f['location'])})</li>" for f in flags)
    parts = "".join(f"<section><h3>{e(c['chunk_id'])}</h3><p>{e(c['asr_text'])}</p><p>{e(c.get('ocr_text', ''))}</p></section>" for c in chunks)
    return f'<!DOCTYPE html><html><head><meta charset="utf-8"><style>{CSS}</style></head><body><table>{numbers}</table><div class="strip">{bars}</div><ul>{listed}</ul><ul>{flagged}</ul>{parts}</body></html>'


def overlay(frames: DataFrame, draw) -> DataFrame:
    """Annotated images: ``draw`` gets frames of video_id, frame_id, content and blocks and gives video_id, frame_id,
    image; the colour of a block is functions.text.confidence_color."""
    return frames.mapInPandas(draw, "video_id long, frame_id int, image binary")


def pages(summary: DataFrame, strip: DataFrame, gaps: DataFrame, flags: DataFrame, chunks: DataFrame) -> DataFrame:
    """video_id and html: the page of every video, made where its rows are. What a page shows of a video is gathered per
    video, the flags only as far as they are shown."""
    import pandas as pd

    def listed(df: DataFrame, name: str, order: list[str]) -> DataFrame:
        rest = [c for c in df.columns if c != "video_id"]
        return df.groupBy("video_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct(*order, *[c for c in rest if c not in order])))).alias(name))

    out = summary.select("video_id", F.to_json(F.struct(*[c for c in summary.columns if c != "video_id"])).alias("_summary"))
    parts = {"_strip": (strip, ["at_ms", "kind"]), "_gaps": (gaps, ["start_ms"]), "_flags": (flags, ["position"]), "_chunks": (chunks, ["t_start_ms"])}
    for name, (df, order) in parts.items():
        out = out.join(listed(df, name, order), "video_id", "left")

    def run(frames):
        import json

        read = lambda x: json.loads(x) if isinstance(x, str) else []
        for f in frames:
            made = [page(json.loads(s), *(read(x) for x in rest)) for s, *rest in zip(f["_summary"], f["_strip"], f["_gaps"], f["_flags"], f["_chunks"])]
            yield pd.DataFrame({"video_id": f["video_id"], "html": made})

    kind = summary.schema["video_id"].dataType.simpleString()
    return out.mapInPandas(run, f"video_id {kind}, html string")
