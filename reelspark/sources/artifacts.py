"""Readers of the JSON artefacts of videos, many videos at once: the video is the folder an artefact lies in."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import text as T


def video_paths(root: str, video: str) -> dict[str, str]:
    """Where the artefacts of a video lie."""
    base = f"{root}/{video}"
    return {"metadata": f"{base}/source/metadata.json", **{n: f"{base}/{n}.json" for n in ("asr", "scenes", "keyframes", "ocr")}, "transcript": f"{base}/transcript.txt", "frames": f"{base}/keyframes", "chunks": f"{base}/chunks.json"}


def read_json(spark: SparkSession, path: str, schema: str, depth: int = 2) -> DataFrame:
    """One document per file, with the video's name: the ``depth``-th last part of the path."""
    df = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return df.withColumn("video_id", F.element_at(F.split(F.input_file_name(), "/"), -depth))


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def or_make(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at ``path`` if it is complete; otherwise ``make()``, written there."""
    if not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def project_metadata(info: DataFrame, column: str = "info") -> DataFrame:
    """The public fields of an info document (JSON text): scalars, arrays ([] if missing), chapters, caption languages."""
    schema = S.METADATA.split(", chapters ")[0] + ", chapters array<struct<title:string,start_time:double,end_time:double>>, subtitles map<string,string>, automatic_captions map<string,string>"
    m = info.withColumn("_m", F.from_json(column, schema)).select("_m.*")
    empty = F.array().cast("array<string>")
    keys = lambda c: F.coalesce(F.array_sort(F.map_keys(c)), empty)
    return m.withColumn("tags", F.coalesce("tags", empty)).withColumn("categories", F.coalesce("categories", empty)).withColumn("subtitles_available", keys("subtitles")).withColumn("automatic_captions_available", keys("automatic_captions")).drop("subtitles", "automatic_captions")


def list_captions(files: DataFrame) -> DataFrame:
    """path and language of caption files (*.vtt)."""
    return files.where(F.col("path").endswith(".vtt")).select("path", T.language_from_filename(T.basename(F.col("path"))).alias("language"))


def caption_files(spark: SparkSession, root: str) -> DataFrame:
    return list_captions(spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.vtt").load(root).select("path"))


def project_probe(probes: DataFrame, column: str = "probe") -> DataFrame:
    """duration and the first video and audio stream of a media probe (JSON text)."""
    p = probes.withColumn("_p", F.from_json(column, S.PROBE))
    stream = lambda kind: F.get(F.filter("_p.streams", lambda s: s["codec_type"] == kind), 0)
    v, a = stream("video"), stream("audio")
    return p.select(
        *[c for c in probes.columns if c != column], F.coalesce(F.col("_p.format.duration").cast("double"), F.lit(0.0)).alias("duration"),
        v["codec_name"].alias("video_codec"), v["width"].alias("width"), v["height"].alias("height"), T.frame_rate(F.coalesce(v["r_frame_rate"], F.lit("0/1"))).alias("fps"),
        a["codec_name"].alias("audio_codec"), a["sample_rate"].alias("sample_rate"), a["channels"].alias("channels"),
    )


def metadata(docs: DataFrame) -> DataFrame:
    """Video rows with the defaults of missing fields, duration in seconds and ms."""
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("description", "channel", "upload_date")]
    return docs.select("video_id", "title", *text, F.col("duration").alias("duration_s"), (F.col("duration") * 1000).cast("long").alias("duration_ms"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags"))


def chapters(docs: DataFrame) -> DataFrame:
    """Chapters in ms: seconds times 1000, cut towards zero."""
    rows = docs.select("video_id", F.posexplode("chapters").alias("chapter_index", "c"))
    ms = lambda c: (F.col(c) * 1000).cast("long")
    return rows.select("video_id", "chapter_index", F.col("c.title").alias("title"), ms("c.start_time").alias("start_ms"), ms("c.end_time").alias("end_ms"))


def segments(docs: DataFrame) -> DataFrame:
    """Speech segments; confidence is 1.0 where the producer gives none, words are [] where there are none."""
    rows = docs.select("video_id", F.posexplode("segments").alias("seg_ix", "s"))
    words = F.coalesce("s.words", F.array().cast(f"array<{S.WORD}>"))
    return rows.select("video_id", "seg_ix", F.col("s.start").alias("start_ms"), F.col("s.end").alias("end_ms"), F.col("s.text").alias("text"), F.col("s.speaker").alias("speaker"), F.coalesce("s.confidence", F.lit(1.0)).alias("confidence"), words.alias("words"), F.size(words).alias("word_count"))


def words(segments_: DataFrame) -> DataFrame:
    return segments_.select("video_id", "seg_ix", F.posexplode("words").alias("word_ix", "w")).select("video_id", "seg_ix", "word_ix", "w.*")


def scenes(docs: DataFrame) -> DataFrame:
    return docs.select("video_id", F.explode("scenes").alias("s")).select("video_id", "s.*")


def keyframes(docs: DataFrame, root: str | None = None) -> DataFrame:
    """Keyframes; with ``root`` their paths are rebuilt from the file name."""
    out = docs.select("video_id", F.explode("keyframes").alias("k")).select("video_id", "k.*")
    return out if root is None else out.withColumn("path", F.concat_ws("/", F.lit(root), "video_id", F.lit("keyframes"), "filename"))


def frames(docs: DataFrame) -> DataFrame:
    """Read frames with nested blocks."""
    rows = docs.select("video_id", F.explode("results").alias("r")).select("video_id", "r.*")
    return rows.drop("layout_regions", "total_regions").withColumnRenamed("image_path", "path").withColumn("text_blocks", F.coalesce("text_blocks", F.array().cast(f"array<{S.BLOCK}>")))


def blocks(frames_: DataFrame) -> DataFrame:
    """One row per text block: its outline is the polygon, else the corners of the box; confidence 1.0 if missing."""
    rows = frames_.select("video_id", "frame_id", "path", F.posexplode("text_blocks").alias("block_ix", "b"))
    box = [F.get("b.bbox", i) for i in range(4)]
    corners = F.array(*[F.array(box[i], box[j]) for i, j in ((0, 1), (2, 1), (2, 3), (0, 3))])
    return rows.select("video_id", "frame_id", "path", "block_ix", F.col("b.text").alias("text"), F.get("b.bbox", 0).alias("x"), F.get("b.bbox", 1).alias("y"), F.coalesce("b.confidence", F.lit(1.0)).alias("confidence"), F.coalesce("b.bbox_polygon", corners).alias("outline"))


def chunk_view(chunks: DataFrame) -> DataFrame:
    """The flat view of exported chunks that the review works on, with defaults for what they lack."""
    c = lambda n, d: F.coalesce(n, F.lit(d))
    ids = F.col("merged_scene_ids") if "merged_scene_ids" in chunks.columns else F.array("scene_id")
    return chunks.select(
        "video_id", "chunk_id", "t_start_ms", "t_end_ms", ((F.col("t_end_ms") - F.col("t_start_ms")) / 1000).alias("duration_sec"), "chapter_index", "chapter_title", F.array("scene_id").alias("scene_indices"), ids.alias("merged_scene_ids"),
        c("asr_text", "").alias("asr_text"), c("ocr_text", "").alias("ocr_text_raw"), c("ocr_text", "").alias("ocr_text_cleaned"), c("merged_text", "").alias("merged_text"), "keyframe_paths",
        c("completeness.has_speech", False).alias("has_speech"), c("completeness.has_visual", False).alias("has_visual"), c("completeness.has_ocr_text", False).alias("has_ocr"),
        c("asr_confidence", 1.0).alias("asr_confidence"), c("ocr_confidence", 1.0).alias("ocr_confidence"), c("alignment_score", 0.0).alias("alignment_score"),
    )


def bundle(spark: SparkSession, root: str, videos: str = "*", views: bool = True) -> dict[str, DataFrame]:
    """All artefacts of the videos under ``root``; with ``views`` each is a temporary view of its name too."""
    p = video_paths(root, videos)
    out = {}
    meta = read_json(spark, p["metadata"], S.METADATA, 3)
    out["videos"], out["chapters"] = metadata(meta), chapters(meta)
    out["scenes"] = scenes(read_json(spark, p["scenes"], S.SCENES))
    out["keyframes"] = keyframes(read_json(spark, p["keyframes"], S.KEYFRAMES))
    out["segments"] = segments(read_json(spark, p["asr"], S.ASR))
    out["frames"] = frames(read_json(spark, p["ocr"], S.OCR))
    out["blocks"] = blocks(out["frames"])
    if views:
        for name, df in out.items():
            df.createOrReplaceTempView(name)
    return out


def media_files(spark: SparkSession, root: str, glob: str = "*.mp4") -> DataFrame:
    """Files of media that are already there; fetching them is no part of this engine."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)


def local(path: str) -> str:
    return f"file://{os.path.abspath(path)}"
