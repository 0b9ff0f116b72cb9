"""The three phases end to end, over many videos at once.

Each stage is a plan; what several stages read is written once. Phases one and two stop at the first failing stage,
phase three goes on without questions if their generator fails as a whole."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ChunkConfig, ExtractConfig, ReviewConfig
from ..functions import text as T
from ..operators import align, chunking, enrich, extract, ocr, qa, report, store, timeline, validate
from ..operators import keyframes as K
from ..session import materialize, ship
from ..sources import artifacts, sinks


@dataclass
class Timings:
    """Seconds by stage, and their share of the whole."""

    seconds: dict[str, float] = field(default_factory=dict)

    def stage(self, name: str, make):
        began = time.monotonic()
        out = make()
        self.seconds[name] = time.monotonic() - began
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        total = sum(self.seconds.values()) or 1.0
        return spark.createDataFrame([(k, v, 100 * v / total) for k, v in self.seconds.items()], "stage string, seconds double, percent double")


@dataclass(frozen=True)
class Models:
    """What phase one needs beyond Spark, each a function over pandas frames; a stage without one has no rows.

    normalizer: path to path, output, ok. durations: video_id, path to video_id, duration_ms. transcriber, aligner, reader
    and layout: see ``operators.extract``. diarizer: video_id, path to video_id, start_ms, speaker. scorer: video_id, path
    to video_id, t_ms, score of the frames. prober: video_id, scene_id, kind, offset, timestamp_ms, path to the same
    without path, with blur_score and pixels."""

    normalizer: extract.Hook | None = None
    durations: extract.Hook | None = None
    transcriber: extract.Hook | None = None
    aligner: extract.Hook | None = None
    diarizer: extract.Hook | None = None
    scorer: extract.Hook | None = None
    prober: extract.Hook | None = None
    reader: extract.Hook | None = None
    layout: extract.Hook | None = None


_PROBE = "video_id long, scene_id int, kind int, offset int, timestamp_ms long, blur_score double, pixels array<double>"


def phase_one(spark: SparkSession, media: DataFrame, out: str, models: Models = Models(), config: ExtractConfig = ExtractConfig(), align_words: bool = True, diarize: bool = False, skip_existing: bool = True) -> Timings:
    """Media to scenes, keyframes, speech with words and speakers, transcript and screen text: tables under ``out``, each
    skipped if it is complete there already. media: video_id (a long), path. The first stage that fails ends the run."""
    ship(spark)
    t = Timings()

    def stage(name: str, make) -> DataFrame:
        path = f"{out}/{name}"
        if skip_existing:
            return t.stage(name, lambda: artifacts.or_make(spark, path, make))
        t.stage(name, lambda: make().write.mode("overwrite").parquet(path))
        return spark.read.parquet(path)

    def through(df: DataFrame, model, schema: str) -> DataFrame:
        return spark.createDataFrame([], schema) if model is None else df.mapInPandas(model, schema)

    def normalized() -> DataFrame:
        if models.normalizer is None:
            return media.select("video_id", "path")
        done = extract.normalize_media(media, models.normalizer)
        return media.select("video_id", "path").join(done, "path").where("ok").select("video_id", F.col("output").alias("path"))

    def speech() -> DataFrame:
        found = extract.transcribe(files, models.transcriber)
        found = extract.align_words(found, models.aligner) if align_words else found
        if not diarize:
            return found.withColumn("speaker", F.lit(None).cast("string"))
        return extract.diarize(found, through(files, models.diarizer, "video_id long, start_ms long, speaker string"))

    def keyframes() -> DataFrame:
        first = scenes.select("video_id", "scene_id", F.lit(0).alias("kind"), F.posexplode(F.sequence(F.lit(0), F.lit(config.first_sharp_tries - 1))).alias("offset", "_o"), "start_ms")
        first = first.select("video_id", "scene_id", "kind", "offset", (F.col("start_ms") + F.col("offset") * config.first_step_ms).alias("timestamp_ms"))
        samples = K.long_scene_times(scenes, config).select("video_id", "scene_id", F.lit(1).alias("kind"), F.lit(0).alias("offset"), "timestamp_ms")
        probes = materialize(through(first.union(samples).join(files, "video_id"), models.prober, _PROBE), "probes")
        sharp = K.first_sharp(probes.where("kind = 0"), config).select("video_id", "scene_id", "timestamp_ms")
        return K.number_frames(sharp, K.delta_filter(probes.where("kind = 1"), config))

    def screen() -> DataFrame:
        images = frames.join(files, "video_id").withColumn("path", F.concat_ws("/", F.lit(f"{out}/frames"), F.col("video_id").cast("string"), "filename"))
        read = extract.read_text(images, models.reader, config.ocr_confidence)
        return extract.ocr_frames(images, read).join(extract.read_layout(images, models.layout), ["video_id", "frame_id"], "left")

    files = stage("media", normalized)
    videos = stage("videos", lambda: through(files, models.durations, "video_id long, duration_ms long"))
    segments = stage("asr", speech)
    stage("transcript", lambda: extract.transcript(segments))
    scores = lambda: through(files, models.scorer, "video_id long, t_ms long, score double")
    scenes = stage("scenes", lambda: extract.detect_scenes(scores(), videos, config.scene_threshold, round(config.scene_min_len_s * 1000)))
    frames = stage("keyframes", keyframes)
    stage("ocr", screen)
    return t


def phase_two(spark: SparkSession, tables: dict[str, DataFrame], out: str, config: ChunkConfig = ChunkConfig(), faithful: bool = True) -> Timings:
    """Timeline, chunks, clean-up, alignment, enrichment, vectors and exports, for the tables of ``artifacts.bundle``."""
    ship(spark)
    t = Timings()
    frames, blocks = tables["frames"], tables["blocks"]
    events = t.stage("timeline", lambda: materialize(timeline.build(
        timeline.chapter_events(tables["chapters"]), timeline.scene_events(tables["scenes"]), timeline.asr_events(tables["segments"]),
        timeline.keyframe_events(tables["keyframes"]), timeline.ocr_events(frames)), "timeline"))
    sinks.write_json_per_video(events, f"{out}/timeline", "position", "events")
    groups = chunking.merge_scenes(tables["scenes"], config)
    chunks = t.stage("chunks", lambda: materialize(chunking.build_chunks(tables["scenes"], enrich.with_scores(tables["segments"]), tables["keyframes"], tables["chapters"], config), "chunks"))
    shown = chunking.join_keyframes(groups, tables["keyframes"])
    read = t.stage("clean", lambda: materialize(ocr.chunk_text(shown, ocr.clean_frames(blocks, ocr.chrome_tokens(blocks, config.chrome_share))), "ocr"))
    both = chunks.join(read, ["video_id", "grp"], "left").withColumn("ocr_text", F.coalesce("ocr_text", F.lit("")))
    both = both.withColumn("merged_text", T.merged_text(F.col("asr_text"), F.col("ocr_text")))
    scored = t.stage("align", lambda: materialize(align.with_scores(both, max_df=0.95 if faithful else None), "scores"))
    full = scored.withColumn("ocr_confidence", F.coalesce("ocr_confidence", F.lit(0.0)))
    full = full.withColumn("completeness", enrich.completeness(F.col("n_segments"), F.size("keyframe_ids"), F.col("ocr_text")))
    full = extract.embed_text(enrich.provenance(full, tables["videos"], config.description_chars), config.text_dim)
    public = t.stage("enrich", lambda: materialize(chunking.to_public(full), "public"))
    t.stage("store", lambda: store.write_collection(public, f"{out}/vectors", {"text_embedding": config.text_dim}))
    t.stage("export", lambda: sinks.export_all(public, out))
    return t


def phase_three(spark: SparkSession, tables: dict[str, DataFrame], chunks: DataFrame, out: str, config: ReviewConfig = ReviewConfig(), generator=qa.template_replies, report_only: bool = False) -> Timings:
    """Coverage, gaps, flags and density of exported chunks, and their questions."""
    ship(spark)
    t = Timings()
    view = artifacts.chunk_view(chunks).withColumn("grp", F.row_number().over(_order())).withColumn("ocr_text", F.col("ocr_text_cleaned"))
    windows = validate.coverage_windows(tables["videos"], tables["segments"], tables["keyframes"], tables["blocks"], config)
    pct = t.stage("coverage", lambda: materialize(validate.overall_coverage(tables["videos"], windows), "coverage"))
    gaps = validate.keyframe_gaps(tables["keyframes"], config).union(validate.asr_gaps(tables["segments"], config))
    flags = validate.quality_flags(tables["keyframes"], tables["blocks"], view, config)
    t.stage("gaps", lambda: gaps.write.mode("overwrite").parquet(f"{out}/gaps"))
    t.stage("flags", lambda: flags.write.mode("overwrite").parquet(f"{out}/flags"))
    t.stage("density", lambda: validate.content_density(view, config.top).write.mode("overwrite").parquet(f"{out}/density"))
    summary = report.assemble(tables["videos"], pct, scenes=tables["scenes"], keyframes=tables["keyframes"], segments=tables["segments"], blocks=tables["blocks"], chunks=view, gaps=gaps)
    t.stage("report", lambda: sinks.write_document(summary, f"{out}/report"))
    if not report_only:
        try:
            t.stage("questions", lambda: sinks.write_jsonl(qa.generate(view, generator), f"{out}/qa_pairs"))
        except Exception as e:  # the report stands without questions
            t.seconds["questions"] = 0.0
            print(f"no questions: {type(e).__name__}")
    return t


def _order():
    from pyspark.sql import Window

    return Window.partitionBy("video_id").orderBy("t_start_ms")
