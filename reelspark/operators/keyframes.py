"""Scene spans from cuts, and the choice of keyframes from probed frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import ExtractConfig
from ..functions import vectors as V


def scenes_from_cuts(cuts: DataFrame, videos: DataFrame) -> DataFrame:
    """cuts: video_id, t_ms. A scene runs from a cut to the next one, the last to the video's duration_ms."""
    w = W.partitionBy("video_id").orderBy("t_ms")
    rows = cuts.join(videos.select("video_id", "duration_ms"), "video_id")
    end = F.coalesce(F.lead("t_ms").over(w), F.col("duration_ms"))
    out = rows.select("video_id", (F.row_number().over(w) - 1).cast("int").alias("scene_id"), F.col("t_ms").alias("start_ms"), end.alias("end_ms"))
    return out.withColumn("duration_ms", F.col("end_ms") - F.col("start_ms"))


def first_sharp(probes: DataFrame, config: ExtractConfig = ExtractConfig()) -> DataFrame:
    """The first sharp frame among the first tries of each scene; scenes without one have none.
    probes: video_id, scene_id, offset (0..), blur_score and more."""
    good = probes.where(F.col("offset").between(0, config.first_sharp_tries - 1) & (F.col("blur_score") >= F.lit(config.blur_threshold)))
    row = F.struct(*[c for c in probes.columns if c not in ("video_id", "scene_id")])
    return good.groupBy("video_id", "scene_id").agg(F.min_by(row, "offset").alias("r")).select("video_id", "scene_id", "r.*")


def long_scene_times(scenes: DataFrame, config: ExtractConfig = ExtractConfig()) -> DataFrame:
    """Probe times of scenes longer than ``long_scene_ms``: every step after the start, while before the end."""
    long = scenes.where((F.col("duration_ms") > config.long_scene_ms) & (F.col("start_ms") + config.long_scene_step_ms < F.col("end_ms")))
    return long.select("video_id", "scene_id", F.explode(F.expr(f"sequence(start_ms + {config.long_scene_step_ms}L, end_ms - 1, {config.long_scene_step_ms}L)")).alias("timestamp_ms"))


def delta_filter(samples: DataFrame, config: ExtractConfig = ExtractConfig()) -> DataFrame:
    """Samples of a scene that are sharp and differ from the last kept sample (the first has none before it).
    samples: video_id, scene_id, timestamp_ms, blur_score, pixels (an array)."""
    item = F.struct(F.col("timestamp_ms").alias("t"), F.col("blur_score").cast("double").alias("blur"), F.col("pixels").cast("array<double>").alias("px"))
    start = F.struct(F.array().cast("array<bigint>").alias("kept"), F.lit(None).cast("array<double>").alias("px"))

    def step(acc, x):
        ok = (x["blur"] >= F.lit(config.blur_threshold)) & (acc["px"].isNull() | V.changed(acc["px"], x["px"], config.pixel_delta, config.pixel_share))
        return F.when(ok, F.struct(F.concat(acc["kept"], F.array(x["t"])).alias("kept"), x["px"].alias("px"))).otherwise(acc)

    folded = samples.groupBy("video_id", "scene_id").agg(F.array_sort(F.collect_list(item)).alias("xs"))
    return folded.select("video_id", "scene_id", F.explode(F.aggregate("xs", start, step, lambda a: a["kept"])).alias("timestamp_ms"))


def number_frames(first: DataFrame, sampled: DataFrame) -> DataFrame:
    """Both kinds together with a dense frame_id: scene by scene, the first sharp frame before the samples."""
    both = first.select("video_id", "scene_id", "timestamp_ms", F.lit(0).alias("kind")).union(sampled.select("video_id", "scene_id", "timestamp_ms", F.lit(1).alias("kind")))
    w = W.partitionBy("video_id").orderBy("scene_id", "kind", "timestamp_ms")
    numbered = both.withColumn("frame_id", (F.row_number().over(w) - 1).cast("int"))
    return numbered.withColumn("filename", F.format_string("frame_%05d.jpg", "frame_id"))
