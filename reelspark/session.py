"""What a session needs besides data: this package on every worker, and the folder that all executors share."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a worker holds as Python objects at once; a longer text is alone.
SLICE_BYTES = 2 << 20


def ship(spark: SparkSession) -> None:
    """Give every Python worker this package, whether or not it is installed there (once for each context)."""
    sc = spark.sparkContext
    if getattr(sc, "_reelspark_shipped", False):
        return
    root = Path(__file__).resolve().parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    place = os.path.join(tempfile.mkdtemp(prefix="reelspark-"), "reelspark.zip")
    Path(place).write_bytes(buffer.getvalue())
    sc.addPyFile(place)
    sc._reelspark_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session. Only where that is unset and the master is
    local (tests, one machine) a temporary folder stands in for it; on a cluster it has to be set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        sc = spark.sparkContext
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not getattr(sc, "_reelspark_dir", None):
            sc._reelspark_dir = "file://" + tempfile.mkdtemp(prefix="reelspark-shared-")
        found = sc._reelspark_dir
    return found.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-{label}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write and reread a table in the shared folder: lineage ends there, a lost executor costs nothing, and Spark
    knows its true size, so that it broadcasts the table only if it is below the broadcast threshold."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out._reelspark_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote and that nothing will read again."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._reelspark_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches, column, most: int = SLICE_BYTES):
    """The same rows in batches of at most so many bytes of a text column (its name or place), or of one row: an Arrow batch
    has 10,000 rows, however long."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
            yield batch.slice(at, end - at)
            at = end
