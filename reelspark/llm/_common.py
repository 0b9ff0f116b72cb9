"""Shared plumbing of the training-data operators: tables, folds and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import SLICE_BYTES, discard, fresh_path, materialize, ship, slices  # noqa: F401  (for the operators)

HASH_SPACE = 1 << 31
#: Bytes of a usual row group.
ROW_GROUP = 128 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The same rows over all cores, if they come of fewer files than there are cores and of less than a usual row group
    each: Parquet is read by row groups, so that such a table would be one task's. A larger table stays as it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * ROW_GROUP and len(df.inputFiles()) < cores else df


def remainder(column, modulus: int):
    """crc32 of an id as text, modulo."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(modulus)


def bounded_sample(df: DataFrame, key: str, bound: int, *values) -> DataFrame:
    """At most ``bound`` keys, those of the smallest hashes, each with the aggregates ``values``: a fraction by hash first,
    so that no task sorts much and few rows are shuffled."""
    n = df.agg(F.approx_count_distinct(key, 0.02)).first()[0]  # only the fraction hangs on it, with a margin of 20 %
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(HASH_SPACE))
    if n > bound:
        df = df.where(place < F.lit(int(HASH_SPACE * min(1.0, 1.2 * bound / n + 1e-4))))
    return df.groupBy(key).agg(*values).orderBy(place, F.col(key)).limit(bound)
