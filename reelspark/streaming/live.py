"""Streaming forms of the timeline analytics (an extension): the same results as the batch operators."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, at: str = "ts", window: str = "5 seconds", late: str = "1 minute", keys: tuple[str, ...] = ("user_id", "event_type")) -> DataFrame:
    """Rows per tumbling window and keys; what comes later than ``late`` is dropped by the watermark."""
    stamped = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    counted = stamped.groupBy(F.window(at, window), *keys).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def talk_spurts(segments: DataFrame, at: str = "ts", gap: str = "5 seconds", late: str = "1 minute", key: str = "user_id") -> DataFrame:
    """Sessions of speech: segments whose starts are less than ``gap`` apart."""
    stamped = segments.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    spurts = stamped.groupBy(F.session_window(at, gap), key).agg(F.count("*").alias("n"))
    return spurts.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "n")


def keyframe_gaps(keyframes: DataFrame, gap_ms: int = 15_000, key: str = "video_id") -> DataFrame:
    """Gaps between keyframes as they come in, with the last time of each video as state. Times within one micro-batch
    are put in order; a time before the state is ignored."""

    def step(k, frames, state):
        last = state.get[0] if state.exists else None
        out = []
        for f in frames:
            for t in sorted(f["timestamp_ms"]):
                if last is not None and t < last:
                    continue
                if last is not None and t - last > gap_ms:
                    out.append((k[0], int(last), int(t), (t - last) / 1000))
                last = int(t)
        if last is not None:
            state.update((last,))
        yield pd.DataFrame(out, columns=[key, "start_ms", "end_ms", "duration_sec"])

    return keyframes.select(key, "timestamp_ms").groupBy(key).applyInPandasWithState(step, f"{key} long, start_ms long, end_ms long, duration_sec double", "last long", "append", "NoTimeout")
