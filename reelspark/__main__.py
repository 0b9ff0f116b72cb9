"""python -m reelspark: list or run the registered queries, or run one of the three phases."""

from __future__ import annotations

import argparse
import importlib


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="reelspark", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="names of the registered queries")
    one = sub.add_parser("query", help="run a query over a folder of tables")
    one.add_argument("name")
    one.add_argument("tables")
    one.add_argument("--out", help="write Parquet there instead of showing rows")
    ex = sub.add_parser("extract", help="media to scenes, keyframes, speech and screen text, with models of your own")
    ex.add_argument("media", help="folder of media files")
    ex.add_argument("out")
    ex.add_argument("--pattern", default="*.mp4")
    ex.add_argument("--models", help="module:name of a plans.phases.Models")
    ex.add_argument("--no-align", action="store_true")
    ex.add_argument("--diarize", action="store_true")
    ex.add_argument("--scene-threshold", type=float, default=27.0)
    ex.add_argument("--blur-threshold", type=float, default=100.0)
    ex.add_argument("--no-skip", action="store_true", help="make again what is there already")
    for name in ("align", "review"):
        x = sub.add_parser(name, help={"align": "timeline, chunks, vectors and exports", "review": "coverage, flags, questions"}[name])
        x.add_argument("root")
        x.add_argument("out")
        x.add_argument("--videos", default="*")
        x.add_argument("--corrected", action="store_true", help="alignment scores that count shared words")
        x.add_argument("--report-only", action="store_true", help="no questions")
    a = p.parse_args(argv)

    from .plans import extensions, more, queries, registry, review  # noqa: F401  (they register)

    if a.command == "list":
        print("\n".join(registry.PLANS))
        return 0

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from .config import ExtractConfig
    from .plans import phases
    from .sources import artifacts

    spark = SparkSession.builder.appName("reelspark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "query":
        df = registry.queries()[a.name](spark, a.tables)
        df.write.mode("overwrite").parquet(a.out) if a.out else df.show(truncate=80)
        return 0
    if a.command == "extract":
        module, _, attribute = (a.models or "").partition(":")
        models = getattr(importlib.import_module(module), attribute) if module else phases.Models()
        config = ExtractConfig(scene_threshold=a.scene_threshold, blur_threshold=a.blur_threshold)
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", a.pattern).load(a.media).select("path")
        media = files.select(F.xxhash64("path").alias("video_id"), "path")
        phases.phase_one(spark, media, a.out, models, config, not a.no_align, a.diarize, not a.no_skip).table(spark).show(truncate=False)
        return 0
    tables = artifacts.bundle(spark, a.root, a.videos)
    if a.command == "align":
        times = phases.phase_two(spark, tables, a.out, faithful=not a.corrected)
    else:
        times = phases.phase_three(spark, tables, spark.read.parquet(f"{a.out}/chunks_parquet"), f"{a.out}/review", report_only=a.report_only)
    times.table(spark).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
