"""A bounded, labelled training sample of document statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import docstats
from ._common import bounded_sample

#: Most labelled rows that a quality model learns from.
SAMPLE_ROWS = 20_000


def _measure(batches):
    for batch in batches:
        c = [docstats.counts(x) for x in batch.column("_text").to_pylist()]
        flat = [np.asarray(x, dtype=np.float64).tobytes() for x in c]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_y"), pa.array(flat, pa.binary())], ["id", "y", "c"])


def training_rows(docs: DataFrame, labels: DataFrame, only=None, bound: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Counts and labels of at most ``bound`` labelled documents (``only``: a condition on doc_id).

    Null labels and ids are left out; of contradicting labels of one id the smaller counts, and of several texts that of
    the smallest counts, so that repeated rows take no place of others. The sample of ids is bounded, so it is broadcast and the texts are never shuffled."""
    named = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y")).where("_id is not null and _y is not null")
    if only is not None:
        named = named.where(only(F.col("_id")))
    ids = bounded_sample(named, "_id", bound, F.min("_y").alias("_y"))
    texts = docs.select(F.col("doc_id").cast("string").alias("_id"), F.col("text").cast("binary").alias("_text"))
    sampled = texts.join(F.broadcast(ids.select(F.col("_id").cast("string").alias("_id"), "_y")), "_id").select("_id", "_text", "_y")
    rows = sampled.mapInArrow(_measure, "id string, y int, c binary").groupBy("id").agg(F.first("y").alias("y"), F.min("c").alias("c")).collect()
    rows.sort(key=lambda r: (bytes(r["c"]), r["y"]))
    x = np.frombuffer(b"".join(bytes(r["c"]) for r in rows), dtype=np.float64).reshape(-1, len(docstats.COUNTS))
    return x, np.array([r["y"] > 0 for r in rows], dtype=np.float64)
