"""Caption files (WebVTT) as speech segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T

_TIME = r"(?:(\d+):)?(\d{2}):(\d{2})\.(\d{3})"
_CUE = rf"^\s*{_TIME}\s+-->\s+{_TIME}"


def _ms(line: Column, at: int) -> Column:
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(line, _CUE, at + i), F.lit("")).cast("long"), F.lit(0))
    return part(0) * 3_600_000 + part(1) * 60_000 + part(2) * 1000 + part(3)


def parse_vtt(files: DataFrame) -> DataFrame:
    """files: video_id, text. A row per cue: seg_ix, start_ms, end_ms, text with its lines joined by a space and tags
    left out. Blocks without a time line (header, notes, styles) are skipped."""
    blocks = files.select("video_id", F.posexplode(F.split(F.regexp_replace("text", "\r\n?", "\n"), r"\n{2,}")).alias("_b", "block"))
    lines = F.split("block", "\n")
    cues = blocks.withColumn("lines", lines).withColumn("at", F.array_position(F.transform("lines", lambda x: x.rlike(_CUE)), F.lit(True))).where("at > 0")
    time = F.element_at("lines", F.col("at").cast("int"))
    said = F.array_join(F.expr("slice(lines, cast(at as int) + 1, greatest(size(lines) - cast(at as int), 0))"), " ")
    ix = F.row_number().over(W.partitionBy("video_id").orderBy("_b")) - 1
    return cues.select("video_id", ix.cast("int").alias("seg_ix"), _ms(time, 1).alias("start_ms"), _ms(time, 5).alias("end_ms"), F.trim(F.regexp_replace(said, "<[^>]*>", "")).alias("text"))


def to_vtt(segments: DataFrame) -> DataFrame:
    """video_id and the text of a caption file with the video's segments in order."""
    cue = F.concat(T.timestamp(F.col("start_ms")), F.lit(" --> "), T.timestamp(F.col("end_ms")), F.lit("\n"), F.col("text"))
    cues = F.array_sort(F.collect_list(F.struct("seg_ix", cue.alias("c"))))
    return segments.groupBy("video_id").agg(F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform(cues, lambda x: x["c"]), "\n\n"), F.lit("\n")).alias("text"))


def read_vtt(spark: SparkSession, path: str) -> DataFrame:
    """Cues of the caption files under ``path`` with the language of each file; the video is the folder of the file."""
    files = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.vtt").load(path)
    named = files.select(F.col("_metadata.file_path").alias("p"), F.col("value").alias("text"))
    cues = parse_vtt(named.select(F.col("p").alias("video_id"), "text"))
    return cues.withColumn("language", T.language_from_filename(T.basename(F.col("video_id")))).withColumn("video_id", F.element_at(F.split("video_id", "/"), -2))


def read_transcript(lines: DataFrame) -> DataFrame:
    """lines: video_id, line_ix, line of ``[start -> end] [speaker]? text``, as segments; other lines are skipped."""
    clock = r"(\d+):(\d{2}):(\d{2})\.(\d{3})"
    pattern = rf"^\[{clock} -> {clock}\] (?:\[([^\]]*)\] )?(.*)$"
    g = lambda i: F.regexp_extract("line", pattern, i)
    ms = lambda a: g(a).cast("long") * 3_600_000 + g(a + 1).cast("long") * 60_000 + g(a + 2).cast("long") * 1000 + g(a + 3).cast("long")
    rows = lines.where(F.col("line").rlike(pattern))
    return rows.select("video_id", F.col("line_ix").alias("seg_ix"), ms(1).alias("start_ms"), ms(5).alias("end_ms"), F.nullif(g(9), F.lit("")).alias("speaker"), g(10).alias("text"))
