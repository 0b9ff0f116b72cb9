"""A vector table with upserts and exact search."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import vectors as V

#: Most bytes of query vectors that are sent to the executors at once.
QUERY_BYTES = 32 << 20
#: Most scores that a worker holds at once, unless a single point has more.
SCORES = 2 << 20


def mean_pool(frames: DataFrame, keys: tuple[str, ...], vector: str = "embedding") -> DataFrame:
    """Mean of the unit vectors of each group, place by place; the mean isn't brought to unit length."""
    unit = V.normalized(F.col(vector))
    places = frames.select(*keys, F.posexplode(unit).alias("i", "x"))
    means = places.groupBy(*keys, "i").agg(F.avg("x").alias("x"))
    return means.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda r: r["x"]).alias("pooled"))


def checked(vectors: DataFrame, column: str, dim: int) -> DataFrame:
    """The same rows; fails on a vector of another length."""
    ok = F.when(F.size(column) != dim, F.raise_error(F.lit(f"{column} must have {dim} places"))).otherwise(F.col(column))
    return vectors.withColumn(column, ok)


def upsert(current: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("video_id", "chunk_id")) -> DataFrame:
    """Rows of ``new`` replace those with the same keys; the rest stay."""
    return current.join(new, list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def write_collection(points: DataFrame, path: str, dims: dict[str, int], partition: str = "video_id", order: str = "t_start_ms") -> None:
    """Create or overwrite the partitions of the videos in ``points``: partitioned by video, sorted by time, so that
    filters on either prune files and row groups. Fails without points or on false lengths."""
    for column, dim in dims.items():
        points = checked(points, column, dim)
    if points.isEmpty():
        raise ValueError("no vectors to store")
    points.repartition(partition).sortWithinPartitions(partition, order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def verify(spark: SparkSession, path: str) -> dict:
    df = spark.read.parquet(path)
    return {"points": df.count(), "sample": [r.asDict() for r in df.limit(1).collect()]}


def search(points: DataFrame, query: list[float], k: int = 5, vector: str = "embedding", key: str = "vec_id", where=None) -> DataFrame:
    """The k points of the highest cosine to one query; ties by key. Spark plans a top-k, not a sort."""
    rows = points if where is None else points.where(where)
    q = F.array(*[F.lit(float(x)) for x in query])
    return rows.withColumn("score", V.cosine(F.col(vector), q)).orderBy(F.col("score").desc(), key).limit(k)


def search_batch(points: DataFrame, queries: DataFrame, k: int = 5, vector: str = "embedding", key: str = "vec_id", query_key: str = "query_id", most_bytes: int = QUERY_BYTES) -> DataFrame:
    """The k best points by cosine for every query of a stated set; ties by key. Keys are whole numbers.

    Queries go over the points in parts of at most ``most_bytes``, each of checked size and sent to all executors once: so
    many points as make SCORES scores are one matrix product, of which only what reaches the k best so far of a query is sorted. Repeated keys are rows like
    others; a zero vector has cosine 0 with everything; vectors of another length than the first query's are an error."""
    unit = lambda df, name: df.select(F.col(name).cast("long").alias("_key"), V.normalized(F.col(vector)).alias("_v"))
    q = unit(queries, query_key).where("_key is not null")
    schema = f"{query_key} long, {key} long, score double"
    size = q.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("_v")), F.lit(1)).alias("dim")).first()
    parts = max(1, -(-size["n"] * 8 * (max(size["dim"], 1) + 1) // most_bytes))
    spark, best = points.sparkSession, None
    rows = q.withColumn("_part", F.pmod(F.xxhash64("_key"), F.lit(parts))) if parts > 1 else q
    for part in range(parts):
        mine = (rows.where(F.col("_part") == part).drop("_part") if parts > 1 else rows).toArrow()
        ids, matrix = _matrix(mine["_key"], mine["_v"])
        one = unit(points, key).mapInArrow(_nearest(spark.sparkContext.broadcast((ids, matrix)), k, (query_key, key, "score")), schema)
        best = one if best is None else best.union(one)
    outer = W.partitionBy(query_key).orderBy(F.col("score").desc(), key)
    return best.withColumn("rank", F.row_number().over(outer)).where(F.col("rank") <= k).select(query_key, key, "score", "rank")


def _matrix(keys, vectors) -> tuple[np.ndarray, np.ndarray]:
    keys = np.asarray(keys.to_pylist(), dtype=np.int64)
    rows = [np.asarray(v, dtype=np.float64) for v in vectors.to_pylist()]
    return keys, np.stack(rows) if rows else np.zeros((0, 0))


def _nearest(shipped, k: int, names: tuple[str, ...]):
    import pyarrow as pa

    def run(batches):
        ids, matrix = shipped.value
        rows, best, found = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)  # query, score and key of the best so far
        floor = np.full(len(ids), -np.inf)  # what a score has to reach
        for batch in batches:
            if not len(ids) or not batch.num_rows:
                continue
            mask = [v is not None for v in batch.column("_v").to_pylist()]
            batch = batch.filter(pa.array(mask)) if not all(mask) else batch
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, max(1, min(1024, SCORES // len(ids)) if len(rows) else min(k, SCORES // len(ids))))
                at += part.num_rows
                keys, vectors = _matrix(part.column("_key"), part.column("_v"))
                scores = matrix @ vectors.T
                np.round(scores, 12, out=scores)  # so that equal vectors tie
                q, p = np.nonzero(~(scores < floor[:, None]))
                rows, best, found = np.concatenate([rows, q]), np.concatenate([best, scores[q, p]]), np.concatenate([found, keys[p]])
                order = np.lexsort((found, -best, rows))
                place = np.arange(len(order)) - np.searchsorted(rows[order], rows[order])
                order = order[place < k]
                rows, best, found = rows[order], best[order], found[order]
                full = place[place < k] == k - 1
                floor[rows[full]] = best[full]
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(found), pa.array(best)], list(names))

    return run


def scroll_range(points: DataFrame, low: int, high: int, column: str = "t_start_ms") -> DataFrame:
    return points.where(F.col(column).between(low, high))


def scroll(points: DataFrame, n: int, key: str) -> DataFrame:
    return points.orderBy(key).limit(n)


def fuse(a: DataFrame, b: DataFrame, key: str, query_key: str = "query_id", constant: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of two ranked lists per query (an extension)."""
    both = a.select(query_key, key, "rank").union(b.select(query_key, key, "rank"))
    return both.groupBy(query_key, key).agg(F.sum(1.0 / (constant + F.col("rank"))).alias("score"))
