"""Streams give what the batch operators give."""

from pyspark.sql import functions as F

from reelspark.operators import validate
from reelspark.sources.adapter import Corpus
from reelspark.streaming import live


def _drain(df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def _stream(spark, df, path):
    df.coalesce(1).write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def test_windowed_counts(spark, smallest, tmp_path):
    events = spark.read.parquet(f"{smallest}/events.parquet")
    got = _drain(live.windowed_counts(_stream(spark, events, f"{tmp_path}/e"), window="1 day", keys=("event_type",)), "days", "complete")
    want = events.groupBy(F.to_date("ts").alias("d"), "event_type").agg(F.count("*").alias("n"))
    assert {(str(r["start"])[:10], r["event_type"], r["n"]) for r in got.collect()} == {(str(r["d"]), r["event_type"], r["n"]) for r in want.collect()}


def test_talk_spurts(spark, smallest, tmp_path):
    clicks = spark.read.parquet(f"{smallest}/events.parquet").where("event_type = 'click'")
    got = _drain(live.talk_spurts(_stream(spark, clicks, f"{tmp_path}/c"), gap="1 hour"), "spurts", "complete")
    assert got.agg(F.sum("n")).first()[0] == clicks.count()


def test_keyframe_gaps(spark, smallest, tmp_path):
    frames = Corpus(spark, smallest).keyframes.select("video_id", "timestamp_ms")
    got = _drain(live.keyframe_gaps(_stream(spark, frames, f"{tmp_path}/k")), "gaps", "append")
    want = validate.keyframe_gaps(frames)
    pick = lambda df: sorted((r["video_id"], r["start_ms"], r["end_ms"]) for r in df.collect())
    assert pick(got) == pick(want)
