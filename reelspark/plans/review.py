"""The registered queries of the review: coverage, gaps, flags, density, report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import ReviewConfig
from ..functions import text as T
from ..operators import chunking, ocr, report, validate
from .queries import _chunks, _groups
from .registry import query

_WIN = """w AS (SELECT video_id, d, unnest(range(0, d, 5000)) AS start_ms FROM (SELECT video_id, duration_s * 1000 AS d FROM videos)),
win AS (SELECT w.video_id, w.start_ms, least(w.start_ms + 5000, w.d) AS end_ms FROM w),
wa AS (SELECT DISTINCT w.video_id, w.start_ms FROM win w JOIN segments s ON s.video_id = w.video_id AND s.start_ms < w.end_ms AND s.end_ms > w.start_ms),
wk AS (SELECT w.video_id, w.start_ms, bool_or(b.frame_id IS NOT NULL) AS o FROM win w JOIN keyframes k ON k.video_id = w.video_id AND k.timestamp_ms >= w.start_ms AND k.timestamp_ms < w.end_ms
  LEFT JOIN (SELECT DISTINCT video_id, frame_id FROM blocks) b ON b.video_id = k.video_id AND b.frame_id = k.frame_id GROUP BY 1, 2),
covered AS (SELECT win.video_id, win.start_ms, win.end_ms, wa.start_ms IS NOT NULL AS has_asr, wk.start_ms IS NOT NULL AS has_keyframe, coalesce(wk.o, false) AS has_ocr
  FROM win LEFT JOIN wa ON wa.video_id = win.video_id AND wa.start_ms = win.start_ms LEFT JOIN wk ON wk.video_id = win.video_id AND wk.start_ms = win.start_ms),
pct AS (SELECT video_id, 100.0 * count(*) FILTER (WHERE has_asr OR has_keyframe) / count(*) AS coverage_pct FROM covered GROUP BY 1)"""


def _windows(c):
    return validate.coverage_windows(c.videos.select("video_id", "duration_s"), c.segments, c.keyframes, c.blocks)


@query("cov_windows", "video_id:l start_ms:l end_ms:l has_asr:b has_keyframe:b has_ocr:b", _WIN + "@@SELECT * FROM covered")
def _(c):
    return _windows(c)


@query("cov_overall", "video_id:l coverage_pct:d", _WIN + "@@SELECT v.video_id, coalesce(p.coverage_pct, 0) AS coverage_pct FROM videos v LEFT JOIN pct p USING (video_id)")
def _(c):
    return validate.overall_coverage(c.videos.select("video_id"), _windows(c))


@query("cov_chapter", "video_id:l chapter_index:l title:s duration_sec:d num_scenes:l num_keyframes:l num_asr_segments:l num_ocr_blocks:l coverage_pct:d",
       """SELECT *, CASE WHEN num_keyframes > 0 AND num_asr_segments > 0 THEN 100.0 ELSE 0.0 END AS coverage_pct FROM (SELECT c.video_id, c.chapter_index, c.title, (c.end_ms - c.start_ms) / 1000.0 AS duration_sec,
  (SELECT count(*) FROM scenes s WHERE s.video_id = c.video_id AND s.start_ms >= c.start_ms AND s.end_ms <= c.end_ms) AS num_scenes,
  (SELECT count(*) FROM keyframes k WHERE k.video_id = c.video_id AND k.timestamp_ms >= c.start_ms AND k.timestamp_ms < c.end_ms) AS num_keyframes,
  (SELECT count(*) FROM segments a WHERE a.video_id = c.video_id AND a.start_ms < c.end_ms AND a.end_ms > c.start_ms) AS num_asr_segments,
  (SELECT count(*) FROM keyframes k JOIN blocks b USING (video_id, frame_id) WHERE k.video_id = c.video_id AND k.timestamp_ms >= c.start_ms AND k.timestamp_ms < c.end_ms) AS num_ocr_blocks FROM chapters c)""")
def _(c):
    return validate.chapter_coverage(c.chapters, c.scenes, c.keyframes, c.segments, c.blocks)


_GAP = "video_id:l gap_type:s start_ms:l end_ms:l duration_sec:d severity:s"
_KG = "kg AS (SELECT video_id, 'keyframe' AS gap_type, a AS start_ms, b AS end_ms, (b - a) / 1000.0 AS duration_sec, CASE WHEN b - a > 30000 THEN 'high' ELSE 'medium' END AS severity FROM (SELECT video_id, timestamp_ms AS a, lead(timestamp_ms) OVER (PARTITION BY video_id ORDER BY timestamp_ms) AS b FROM keyframes) WHERE b - a > 15000)"


@query("gap_keyframe", _GAP, _KG + "@@SELECT * FROM kg")
def _(c):
    return validate.keyframe_gaps(c.keyframes)


@query("gap_asr", _GAP, "SELECT video_id, 'asr' AS gap_type, a AS start_ms, b AS end_ms, (b - a) / 1000.0 AS duration_sec, 'low' AS severity FROM (SELECT video_id, end_ms AS a, lead(start_ms) OVER (PARTITION BY video_id ORDER BY start_ms, seg_ix) AS b FROM segments) WHERE b - a > 5000")
def _(c):
    return validate.asr_gaps(c.segments)


_FLAG = "video_id:l flag_type:s severity:s description:s location:s"
_STATS = "(SELECT k.video_id, k.frame_id, k.path, count(b.block_ix) AS n, sum(length(b.text)) + count(b.block_ix) - 1 AS chars, count(*) FILTER (WHERE b.confidence < 0.5::DOUBLE) AS weak FROM keyframes k LEFT JOIN {0} b USING (video_id, frame_id) GROUP BY ALL)"
_F = {
    "flag_no_ocr": "SELECT video_id, 'no_ocr' AS flag_type, 'medium' AS severity, 'The keyframe has no text' AS description, path AS location, frame_id AS rank, 0 AS sub FROM {s} WHERE n = 0",
    "flag_low_text": "SELECT video_id, 'low_ocr_text' AS flag_type, 'low' AS severity, 'Little text (' || chars || ' chars)' AS description, path AS location, frame_id AS rank, 1 AS sub FROM {s} WHERE n > 0 AND chars < 10",
    "flag_low_conf": "SELECT video_id, 'low_ocr_confidence' AS flag_type, 'low' AS severity, weak || ' blocks below confidence 0.5' AS description, path AS location, frame_id AS rank, 2 AS sub FROM {s} WHERE weak > 0",
    "flag_no_visual": "SELECT video_id, 'no_visual' AS flag_type, 'high' AS severity, 'The chunk shows nothing' AS description, chunk_id AS location, grp AS rank, 3 AS sub FROM chunks WHERE NOT has_keyframe",
    "flag_no_speech": "SELECT video_id, 'no_speech' AS flag_type, 'medium' AS severity, 'The chunk has no speech' AS description, chunk_id AS location, grp AS rank, 4 AS sub FROM chunks WHERE n_segments = 0",
}


def _sql(name: str, blocks: str) -> str:
    return _F[name].replace("{s}", _STATS.format(blocks))


def _flag_chunks(c):
    return _chunks(c).select("video_id", "grp", "chunk_id", F.col("has_keyframe").alias("has_visual"), (F.col("n_segments") > 0).alias("has_speech"))


query("flag_no_ocr", _FLAG, _sql("flag_no_ocr", "blocks"))(lambda c: validate.flag_no_ocr(c.keyframes, c.blocks))
query("flag_low_text", _FLAG, _sql("flag_low_text", "blocks").replace("chars < 10", "chars < 60"))(lambda c: validate.flag_low_text(c.keyframes, c.blocks, ReviewConfig(min_text_chars=60)))
query("flag_low_conf", _FLAG, _sql("flag_low_conf", "raw_blocks"))(lambda c: validate.flag_low_confidence(c.keyframes, c.raw_blocks))
query("flag_no_visual", _FLAG, _sql("flag_no_visual", ""))(lambda c: validate.flag_no_visual(_flag_chunks(c)))
query("flag_no_speech", _FLAG, _sql("flag_no_speech", ""))(lambda c: validate.flag_no_speech(_flag_chunks(c)))

_UNION = "flags AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY CAST(sub >= 3 AS INTEGER), rank, sub) AS position FROM (" + " UNION ALL ".join(_sql(n, "raw_blocks" if n == "flag_low_conf" else "blocks") for n in ("flag_no_ocr", "flag_low_text", "flag_no_visual", "flag_no_speech")) + "))"


def _flags(c):
    return validate.quality_flags(c.keyframes, c.blocks, _flag_chunks(c))


@query("flag_union", _FLAG + " position:l", _UNION + "@@SELECT * FROM flags")
def _(c):
    return _flags(c)


@query("grp_ocr_by_frame", "video_id:l name:s n_blocks:l", "SELECT video_id, split_part(path, '/', -1) AS name, count(*) AS n_blocks FROM blocks GROUP BY 1, 2")
def _(c):
    return ocr.by_frame(c.blocks)


@query("density_topk", "video_id:l chunk_id:s rank:l total_text_chars:l asr_chars:l ocr_chars:l density:d list:s", """dens AS (SELECT video_id, grp, chunk_id, length(asr_text) + length(ocr_text) AS total_text_chars, length(asr_text) AS asr_chars, length(ocr_text) AS ocr_chars,
  CASE WHEN t_end_ms > t_start_ms THEN (length(asr_text) + length(ocr_text)) / ((t_end_ms - t_start_ms) / 1000.0::DOUBLE) ELSE 0 END AS density FROM texts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY total_text_chars DESC, grp) AS rank, row_number() OVER (PARTITION BY video_id ORDER BY total_text_chars, grp DESC) AS up FROM dens)
@@SELECT *, 'richest' AS list FROM ranked WHERE rank <= 3 UNION ALL SELECT *, 'thinnest' FROM ranked WHERE up <= 3""")
def _(c):
    groups, blocks = _groups(c), c.kept_blocks(c.keyframes)
    chars = ocr.screen_chars(chunking.join_keyframes(groups, c.keyframes), blocks, ocr.chrome_tokens(blocks))
    named = chunking.with_ids(groups, c.chapters)
    return validate.content_density(named.join(chunking.speech_chars(groups, c._with_text(c.spoken)), ["video_id", "grp"], "left").join(chars, ["video_id", "grp"], "left"))


@query("report_assemble", "video_id:l duration_s:l coverage_pct:d verdict:s scenes:l keyframes:l segments:l chunks:l gaps:l", _WIN + ", " + _KG + """@@SELECT v.video_id, v.duration_s, p.coverage_pct, CASE WHEN p.coverage_pct >= 90 THEN 'PASS' WHEN p.coverage_pct >= 70 THEN 'PARTIAL' ELSE 'FAIL' END AS verdict,
  (SELECT count(*) FROM scenes x WHERE x.video_id = v.video_id) AS scenes, (SELECT count(*) FROM keyframes x WHERE x.video_id = v.video_id) AS keyframes, (SELECT count(*) FROM segments x WHERE x.video_id = v.video_id) AS segments,
  (SELECT count(*) FROM groups x WHERE x.video_id = v.video_id) AS chunks, (SELECT count(*) FROM kg x WHERE x.video_id = v.video_id) AS gaps FROM videos v JOIN pct p USING (video_id)""")
def _(c):
    pct = validate.overall_coverage(c.videos.select("video_id"), _windows(c))
    return report.assemble(c.videos, pct, scenes=c.scenes, keyframes=c.keyframes, segments=c.segments, chunks=_chunks(c), gaps=validate.keyframe_gaps(c.keyframes))


@query("rpt_summary", "video_id:l title:s duration_s:l coverage_pct:d verdict:s segments:l scenes:l keyframes:l blocks:l chunks:l", _WIN + """@@SELECT v.video_id, v.title, v.duration_s, p.coverage_pct, CASE WHEN p.coverage_pct >= 90 THEN 'PASS' WHEN p.coverage_pct >= 70 THEN 'PARTIAL' ELSE 'FAIL' END AS verdict,
  (SELECT count(*) FROM segments x WHERE x.video_id = v.video_id) AS segments, (SELECT count(*) FROM scenes x WHERE x.video_id = v.video_id) AS scenes, (SELECT count(*) FROM keyframes x WHERE x.video_id = v.video_id) AS keyframes,
  (SELECT count(*) FROM blocks x WHERE x.video_id = v.video_id) AS blocks, (SELECT count(*) FROM groups x WHERE x.video_id = v.video_id) AS chunks FROM videos v JOIN pct p USING (video_id)""")
def _(c):
    pct = validate.overall_coverage(c.videos.select("video_id"), _windows(c))
    return report.assemble(c.videos, pct, segments=c.segments, scenes=c.scenes, keyframes=c.keyframes, blocks=c.blocks, chunks=_groups(c)).join(c.videos.select("video_id", "title"), "video_id")


@query("rpt_timeline_pct", "video_id:l kind:s at_ms:l left_pct:d width_pct:d", _KG + """@@SELECT p.video_id, kind, at_ms, at_ms / (v.duration_s * 1000)::DOUBLE * 100 AS left_pct, width_ms / (v.duration_s * 1000)::DOUBLE * 100 AS width_pct FROM (SELECT video_id, 'chapter' AS kind, start_ms AS at_ms, end_ms - start_ms AS width_ms FROM chapters
  UNION ALL SELECT video_id, 'scene', start_ms, 0 FROM scenes UNION ALL SELECT video_id, 'keyframe', timestamp_ms, 0 FROM keyframes UNION ALL SELECT video_id, 'gap', start_ms, end_ms - start_ms FROM kg) p JOIN videos v USING (video_id) WHERE v.duration_s > 0""")
def _(c):
    return report.strip_positions(c.videos, c.chapters, c.scenes, c.keyframes, validate.keyframe_gaps(c.keyframes))


@query("rpt_chunk_details", "chunk_id:s path:s image:s", "SELECT chunk_id, path, 'annotated/' || path AS image FROM (SELECT chunk_id, unnest(keyframe_paths) AS path FROM chunks)")
def _(c):
    images = c.keyframes.select("video_id", "path", F.concat(F.lit("annotated/"), "filename").alias("image"))
    return report.chunk_images(_chunks(c), images)


_SEC = "(({0} + 50) // 1000) || '.' || (({0} + 50) // 100 % 10) || 's'"


@query("rpt_gaps", "video_id:l list:s position:l total:l issue:s severity:s description:s", _UNION + ", " + _KG + f"""@@SELECT video_id, 'gap' AS list, row_number() OVER (PARTITION BY video_id ORDER BY start_ms) AS position, count(*) OVER (PARTITION BY video_id) AS total, gap_type AS issue, severity,
  {_SEC.format('start_ms')} || ' - ' || {_SEC.format('end_ms')} || ' (' || {_SEC.format('(end_ms - start_ms)')} || ')' AS description FROM kg
  UNION ALL SELECT * FROM (SELECT video_id, 'flag', position, count(*) OVER (PARTITION BY video_id) AS total, flag_type, severity, description || ' - ' || split_part(location, '/', -1) FROM flags) WHERE position <= 20""")
def _(c):
    return report.issues(validate.keyframe_gaps(c.keyframes), _flags(c))


@query("fn_conf_color", "doc_id:l color:s", "SELECT doc_id, CASE WHEN c >= 0.8::DOUBLE THEN 'green' WHEN c >= 0.5::DOUBLE THEN 'yellow' ELSE 'red' END AS color FROM (SELECT doc_id, (doc_id % 11) / 10.0::DOUBLE AS c FROM documents)")
def _(c):
    return c.documents.select("doc_id", T.confidence_color((F.col("doc_id") % 11) / F.lit(10.0)).alias("color"))


@query("fn_verdict", "doc_id:l verdict:s", "SELECT doc_id, CASE WHEN p >= 90 THEN 'PASS' WHEN p >= 70 THEN 'PARTIAL' ELSE 'FAIL' END AS verdict FROM (SELECT doc_id, doc_id % 101 AS p FROM documents)")
def _(c):
    return c.documents.select("doc_id", T.verdict(F.col("doc_id") % 101).alias("verdict"))


@query("fn_base64", "doc_id:l b64:s", "SELECT doc_id, base64(encode(text)) AS b64 FROM documents")
def _(c):
    return c.documents.select("doc_id", F.regexp_replace(T.file_base64(F.col("text").cast("binary")), "\r\n", "").alias("b64"))
