"""Exports: JSON lines, Parquet, single JSON documents, images of reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, compression: str = "none") -> str:
    df.write.mode("overwrite").option("ignoreNullFields", False).option("compression", compression).json(path)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_json_per_video(df: DataFrame, path: str, order: str, name: str = "items", folders: bool = True) -> str:
    """One JSON document per video, of its rows in order: a video's rows are the unit that is gathered, never a table. With
    ``folders`` each lies in the folder of its video; without, the documents are the lines of a compressed file per task, as
    hundreds of thousands of files take far longer to commit and to list than to write."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*df.columns).alias("r"))))
    doc = df.groupBy("video_id").agg(F.transform(rows, lambda x: x["r"]).alias(name))
    lines = doc.select("video_id", F.to_json(F.struct("video_id", F.size(name).alias(f"total_{name}"), name), {"ignoreNullFields": "false"}).alias("value"))
    if folders:
        lines.write.mode("overwrite").partitionBy("video_id").text(path)
    else:
        lines.select("value").write.mode("overwrite").option("compression", "gzip").text(path)
    return path


def write_document(df: DataFrame, path: str) -> str:
    """Rows that are documents already (a report per video), one JSON line each, in a folder per video."""
    df.select("video_id", F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").partitionBy("video_id").text(path)
    return path


def export_all(chunks: DataFrame, path: str, order: str = "t_start_ms", compression: str = "none", folders: bool = True) -> dict[str, str]:
    """The three formats of a chunk table. It is written once as Parquet, and the others are made from that. compression is
    of the JSON lines, folders as for ``write_json_per_video``."""
    out = {"parquet": write_parquet(chunks, f"{path}/chunks_parquet")}
    back = chunks.sparkSession.read.parquet(out["parquet"])
    return out | {"jsonl": write_jsonl(back, f"{path}/chunks_jsonl", compression), "json": write_json_per_video(back, f"{path}/chunks_json", order, "chunks", folders)}
