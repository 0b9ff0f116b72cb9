"""Further registered queries: model hooks with stand-ins, exchange files, pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import extract, qa, report, store, validate
from ..session import fresh_path
from ..sources import artifacts as A
from ..sources import sinks
from .queries import _QA, _chunks, _replies, _scene_docs, _texts
from .registry import query
from .review import _KG, _UNION, _WIN, _flags, _windows


def _turns(c):
    """Turns of conversations as sound: a stand-in model hears turn n from 1.5 n to 1.5 n + 1.2345 seconds."""
    return c.table("conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").cast("int").alias("seg_ix"), "text")


def _listen(frames):
    for f in frames:
        start = f["seg_ix"] * 1.5
        words = [[{"word": w, "start_s": s, "end_s": s + 0.1, "probability": 0.25} for w in (t or "").split()] for s, t in zip(start, f["text"])]
        yield f[["video_id", "seg_ix"]].assign(start_s=start, end_s=start + 1.2345, text=f["text"], words=words)[["video_id", "seg_ix", "start_s", "end_s", "text", "words"]]


_HEARD = "heard AS (SELECT conv_id AS video_id, turn AS seg_ix, CAST(floor(turn * 1500) AS BIGINT) AS start_ms, CAST(floor(turn * 1500 + 1234.5) AS BIGINT) AS end_ms, text, role AS speaker FROM conversations)"


@query("udtf_transcribe", "video_id:l seg_ix:l start_ms:l end_ms:l text:s", _HEARD + "@@SELECT * FROM heard")
def _(c):
    return extract.transcribe(_turns(c), _listen)


@query("udtf_align_words", "video_id:l seg_ix:l words:l score:d spoken:s", _HEARD + r"@@SELECT *, len(w) AS words, len(w) * 0.25::DOUBLE AS score, array_to_string(w, ' ') AS spoken FROM (SELECT *, list_filter(string_split_regex(text, '\s+'), lambda t: t <> '') AS w FROM heard)")
def _(c):
    aligned = extract.align_words(extract.transcribe(_turns(c), _listen))
    return aligned.select("video_id", "seg_ix", F.aggregate("words", F.lit(0.0), lambda a, w: a + w["score"]).alias("score"), F.array_join("words.word", " ").alias("spoken"), F.size("words").alias("words"))


@query("asr_orchestrate", "video_id:l transcript:s", _HEARD + """@@SELECT video_id, string_agg('[' || printf('%02d:%02d:%02d.%03d', start_ms // 3600000, start_ms // 60000 % 60, start_ms // 1000 % 60, start_ms % 1000) || ' -> '
  || printf('%02d:%02d:%02d.%03d', end_ms // 3600000, end_ms // 60000 % 60, end_ms // 1000 % 60, end_ms % 1000) || '] [' || speaker || '] ' || text, chr(10) ORDER BY seg_ix) AS transcript FROM heard GROUP BY 1""")
def _(c):
    heard = extract.align_words(extract.transcribe(_turns(c), _listen))
    turns = c.table("conversations").select(F.col("conv_id").alias("video_id"), (F.col("turn") * 1500).cast("long").alias("start_ms"), F.col("role").alias("speaker"))
    return extract.transcript(extract.diarize(heard, turns))


def _read(frames):
    """A stand-in for a reader of images: each line of a document is a block, every second one too faint."""
    for f in frames:
        blocks = [[{"text": x, "polygon": [[0.0, 20.0 * i], [10.0, 20.0 * i + 16]], "confidence": 0.9 if i % 2 == 0 else 0.4} for i, x in enumerate((t or "").split("\n"))] for t in f["text"]]
        yield f[["video_id", "frame_id"]].assign(blocks=blocks)


def _images(c):
    return c.documents.select(F.col("doc_id").alias("video_id"), F.lit(0).alias("frame_id"), "text")


@query("udtf_ocr", "video_id:l blocks:l bottom:d full_text:s", """SELECT doc_id AS video_id, (n + 1) // 2 AS blocks, 20.0 * ((n - 1) // 2 * 2) + 16 AS bottom, array_to_string(l[1:n:2], ' ') AS full_text FROM (SELECT doc_id, string_split(text, chr(10)) AS l, len(string_split(text, chr(10))) AS n FROM documents)""")
def _(c):
    b = extract.read_text(_images(c), _read)
    return b.select("video_id", F.size("text_blocks").alias("blocks"), F.array_max(F.transform("text_blocks", lambda x: F.get(x["bbox"], 3))).alias("bottom"), T.full_text(F.col("text_blocks")).alias("full_text"))


def _lay_out(frames):
    """A stand-in for a layout model: each line is a region, the first one a title."""
    for f in frames:
        regions = [[{"type": "text" if i else "title", "bbox": [0.0, 20.0 * i, 10.0, 20.0 * i + 16], "confidence": 0.5 + 0.25 * (i % 2)} for i, _ in enumerate((t or "").split("\n"))] for t in f["text"]]
        yield f[["video_id", "frame_id"]].assign(layout_regions=regions)


@query("udtf_layout", "video_id:l regions:l titles:l bottom:d confidence:d none:l", "SELECT doc_id AS video_id, n AS regions, 1 AS titles, 20.0 * (n - 1) + 16 AS bottom, 0.5 * n + 0.25 * (n // 2) AS confidence, 0 AS none FROM (SELECT doc_id, len(string_split(coalesce(text, ''), chr(10))) AS n FROM documents)")
def _(c):
    r, bare = extract.read_layout(_images(c), _lay_out), extract.read_layout(_images(c)).select("video_id", F.size("layout_regions").alias("none"))
    total = F.aggregate("layout_regions", F.lit(0.0), lambda a, x: a + x["confidence"])
    titles = F.size(F.filter("layout_regions", lambda x: x["type"] == "title"))
    return r.select("video_id", F.size("layout_regions").alias("regions"), titles.alias("titles"), F.array_max(F.transform("layout_regions", lambda x: F.get(x["bbox"], 3))).alias("bottom"), total.alias("confidence")).join(bare, "video_id")


@query("udf_qa_generate", "chunk_id:s question:s evidence_type:s", "SELECT chunk_id, 'What is said here?' AS question, 'spoken' AS evidence_type FROM texts WHERE asr_text <> '' UNION ALL SELECT chunk_id, 'What is shown here?', 'visual' FROM texts WHERE ocr_text <> ''")
def _(c):
    return qa.generate(_texts(c))


def _fails_on_silence(frames):
    for f in frames:
        if (f["asr_text"] == "").any():
            raise RuntimeError("nothing was said")
        yield from qa.template_replies(iter([f]))


@query("qa_loop", "chunk_id:s evidence_type:s", "SELECT chunk_id, 'spoken' AS evidence_type FROM texts WHERE asr_text <> '' UNION ALL SELECT chunk_id, 'visual' FROM texts WHERE asr_text <> '' AND ocr_text <> ''")
def _(c):
    return qa.generate(_texts(c), _fails_on_silence)


@query("sink_qa_jsonl", "event_id:l question:s answer:s evidence_type:s", _QA + "@@SELECT * FROM qa")
def _(c):
    path = fresh_path(c.spark, "qa")
    pairs = qa.parse_pairs(_replies(c))
    sinks.write_jsonl(pairs, path)
    return c.spark.read.schema(pairs.schema).json(path)


@query("sink_coverage_json", "video_id:l coverage_pct:d gaps:l", _WIN + ", " + _KG + "@@SELECT v.video_id, p.coverage_pct, (SELECT count(*) FROM kg WHERE kg.video_id = v.video_id) AS gaps FROM videos v JOIN pct p USING (video_id)")
def _(c):
    path = fresh_path(c.spark, "coverage")
    pct = validate.overall_coverage(c.videos.select("video_id"), _windows(c))
    sinks.write_document(report.assemble(c.videos, pct, gaps=validate.keyframe_gaps(c.keyframes)), path)
    return c.spark.read.schema("video_id long, coverage_pct double, gaps long").json(path)


@query("sink_phase1_json", "video_id:l n:l last:l", "SELECT video_id, count(*) AS n, max(end_ms) AS last FROM scenes GROUP BY 1")
def _(c):
    return A.scenes(_scene_docs(c)).groupBy("video_id").agg(F.count("*").alias("n"), F.max("end_ms").alias("last"))


@query("sink_export_all", "format:s n:l", "SELECT 'parquet' AS format, count(*) AS n FROM chunks UNION ALL SELECT 'jsonl', count(*) FROM chunks UNION ALL SELECT 'json', count(*) FROM chunks")
def _(c):
    paths = sinks.export_all(_chunks(c), fresh_path(c.spark, "all"), compression="gzip", folders=False)
    lines = lambda df, name: df.select(F.lit(name).alias("format")).groupBy("format").agg(F.count("*").alias("n"))
    docs = c.spark.read.text(paths["json"]).select(F.lit("json").alias("format"), F.get_json_object("value", "$.total_chunks").cast("long").alias("k")).groupBy("format").agg(F.sum("k").alias("n"))
    return lines(c.spark.read.parquet(paths["parquet"]), "parquet").union(lines(c.spark.read.text(paths["jsonl"]), "jsonl")).union(docs)


@query("sink_html", "video_id:l title:s chunks:s listed:l bars:l", _KG + ", " + _UNION + """@@SELECT v.video_id, v.title, (SELECT string_agg(chunk_id, ',' ORDER BY t_start_ms, chunk_id) FROM chunks x WHERE x.video_id = v.video_id) AS chunks,
  (SELECT count(*) FROM kg x WHERE x.video_id = v.video_id) + (SELECT count(*) FROM flags x WHERE x.video_id = v.video_id AND position <= 20) AS listed,
  CASE WHEN v.duration_s > 0 THEN (SELECT count(*) FROM chapters x WHERE x.video_id = v.video_id) + (SELECT count(*) FROM scenes x WHERE x.video_id = v.video_id) + (SELECT count(*) FROM keyframes x WHERE x.video_id = v.video_id) + (SELECT count(*) FROM kg x WHERE x.video_id = v.video_id) ELSE 0 END AS bars FROM videos v""")
def _(c):
    gaps = validate.keyframe_gaps(c.keyframes)
    summary = c.videos.select("video_id", "title", "duration_s")
    strip = report.strip_positions(c.videos, c.chapters, c.scenes, c.keyframes, gaps)
    chunks = _texts(c).select("video_id", "t_start_ms", "chunk_id", "asr_text", "ocr_text")
    made = report.pages(summary, strip, gaps, report.shown_flags(_flags(c)), chunks)
    ids = F.regexp_extract_all("html", F.lit("<section><h3>([^<]*)</h3>"), F.lit(1))
    return made.select("video_id", F.regexp_extract("html", "<tr><th>title</th><td>([^<]*)</td></tr>", 1).alias("title"), F.array_join(ids, ",").alias("chunks"), F.regexp_count("html", F.lit("<li>")).alias("listed"), F.regexp_count("html", F.lit('<i class=')).alias("bars"))


@query("src_skip_existing", "n:l made:l", "SELECT count(*) AS n, 1 AS made FROM scenes")
def _(c):
    path, made = fresh_path(c.spark, "once"), []
    for _ in range(2):
        again = A.or_make(c.spark, path, lambda: made.append(1) or c.scenes)
    return again.agg(F.count("*").alias("n"), F.lit(len(made)).alias("made"))


@query("src_paths", "video_id:l scenes:s", "SELECT video_id, 'data/' || video_id || '/scenes.json' AS scenes FROM videos")
def _(c):
    return c.events.select("video_id").distinct().select("video_id", F.format_string(A.video_paths("data", "%s")["scenes"], F.col("video_id").cast("string")).alias("scenes"))


@query("vec_payload_index", "vec_id:l label:l", "SELECT vec_id, label FROM embeddings WHERE label = 2 AND vec_id BETWEEN 10 AND 400")
def _(c):
    path = fresh_path(c.spark, "indexed")
    store.write_collection(c.table("embeddings").withColumn("t_start_ms", F.col("vec_id")), path, {"embedding": 64}, "label")
    return store.scroll_range(c.spark.read.parquet(path).where("label = 2"), 10, 400)


_HALF = ", ".join(f"{n} AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS u FROM (SELECT vec_id, embedding[{a}:{b}]::DOUBLE[] AS e FROM embeddings))" for n, a, b in (("left_half", 1, 32), ("right_half", 33, 64)))
_RANKED = ", ".join(f"{n}_ranked AS (SELECT * FROM (SELECT a.vec_id AS query_id, b.vec_id, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_sum(list_transform(range(1, 33), lambda i: a.u[i] * b.u[i])), 12) DESC, b.vec_id) AS rank FROM {n} a, {n} b WHERE a.vec_id % 20 = 0) WHERE rank <= 5)" for n in ("left_half", "right_half"))


@query("ext_late_fusion", "query_id:l vec_id:l score:d", _HALF + ", " + _RANKED + "@@SELECT query_id, vec_id, sum(1.0::DOUBLE / (60 + rank)) AS score FROM (SELECT * FROM left_half_ranked UNION ALL SELECT * FROM right_half_ranked) GROUP BY 1, 2")
def _(c):
    """Two rankings of the same points, by the halves of their vectors, as if these were of text and image."""
    e = c.table("embeddings")
    found = []
    for at in (1, 33):
        half = e.select("vec_id", F.slice("embedding", at, 32).alias("embedding"))
        found.append(store.search_batch(half, half.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), 5))
    return store.fuse(*found, "vec_id")
