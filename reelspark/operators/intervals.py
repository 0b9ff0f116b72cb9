"""Interval joins with an explicit rule for the borders, keyed and cut into time buckets.

A pure inequality join would become a nested loop over each key. Here both sides are spread over the buckets that they
touch, joined on (key, bucket), and a pair is taken only in its first common bucket, so nothing needs a distinct and a
hot key is spread over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A longer interval than this is a mistake in the data (70 days, by the minute), and would be spread without end.
MOST_BUCKETS = 100_000
BOUNDS = ("closed", "open", "half_open", "contains")


def matches(bounds: str, ls: Column, le: Column, rs: Column, re: Column) -> Column:
    """closed: touching ends overlap. open: they don't. half_open: the point rs lies in [ls, le). contains: [rs, re]
    lies within [ls, le]."""
    if bounds == "closed":
        return (re >= ls) & (rs <= le)
    if bounds == "open":
        return (re > ls) & (rs < le)
    if bounds == "half_open":
        return (rs >= ls) & (rs < le)
    if bounds == "contains":
        return (rs >= ls) & (re <= le)
    raise ValueError(f"bounds is one of {BOUNDS}")


def interval_join(left: DataFrame, right: DataFrame, key: str, l: tuple[str, str], r: tuple[str, str], bounds: str, bucket_ms: int = 60_000) -> DataFrame:
    """Columns of both sides (key once) for each matching pair. Intervals are [start, end] with start <= end; those that
    end before they start match nothing, and one over more than MOST_BUCKETS buckets is an error."""
    number = lambda c: F.floor(F.col(c) / bucket_ms)

    def spread(df, s, e, name):
        wide = F.raise_error(F.concat(F.lit(f"an interval over more than {MOST_BUCKETS} buckets: "), F.col(s).cast("string"), F.lit(" to "), F.col(e).cast("string")))
        buckets = F.when(number(e) - number(s) < MOST_BUCKETS, F.sequence(number(s), number(e))).otherwise(wide.cast("array<bigint>"))
        return df.where(F.col(e) >= F.col(s)).withColumn(name, F.explode(buckets))

    a = spread(left, *l, "_bucket").withColumn("_first_l", number(l[0]))
    b = spread(right.withColumnRenamed(key, "_key"), *r, "_bucket_r").withColumn("_first_r", number(r[0]))
    on = (F.col(key) == F.col("_key")) & (F.col("_bucket") == F.col("_bucket_r")) & (F.col("_bucket") == F.greatest("_first_l", "_first_r"))
    joined = a.join(b, on & matches(bounds, F.col(l[0]), F.col(l[1]), F.col(r[0]), F.col(r[1])))
    return joined.drop("_key", "_bucket", "_bucket_r", "_first_l", "_first_r")


def as_of(points: DataFrame, starts: DataFrame, key: str, at: str, start: str, value: str) -> DataFrame:
    """Each point with the ``value`` of the last start at or before it (null before the first): one sort of the union
    of both sides by key and time, no join."""
    from pyspark.sql import Window as W

    p = points.select(F.col(key).alias("_k"), F.col(at).alias("_t"), F.lit(1).alias("_side"), F.struct(*[F.col(c) for c in points.columns]).alias("_row"))
    s = starts.select(F.col(key).alias("_k"), F.col(start).alias("_t"), F.lit(0).alias("_side"), F.col(value).alias("_value"))
    both = p.unionByName(s, allowMissingColumns=True)
    w = W.partitionBy("_k").orderBy("_t", "_side").rowsBetween(W.unboundedPreceding, 0)
    return both.withColumn("_found", F.last("_value", ignorenulls=True).over(w)).where("_side = 1").select("_row.*", F.col("_found").alias(value))
