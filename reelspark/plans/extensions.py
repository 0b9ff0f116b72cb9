"""Registered queries of what goes beyond the three phases, and of hooks that SQL can still check."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import extensions as X
from ..operators import extract, report
from ..sources import captions
from .queries import _chunks
from .registry import query


@query("src_normalize_media", "path:s output:s ok:b", "SELECT 'in/' || doc_id || '.mp4' AS path, CASE WHEN doc_id % 7 <> 3 THEN 'in/' || doc_id || '.wav' END AS output, doc_id % 7 <> 3 AS ok FROM documents")
def _(c):
    """A stand-in for a transcoder that can't read every seventh file."""

    def command(frames):
        for f in frames:
            ok = f["path"].str.extract(r"(\d+)")[0].astype(int) % 7 != 3
            yield f.assign(output=f["path"].str.replace(".mp4", ".wav").where(ok, None), ok=ok)

    return extract.normalize_media(c.documents.select(F.concat(F.lit("in/"), F.col("doc_id").cast("string"), F.lit(".mp4")).alias("path")), command)


@query("src_vtt", "video_id:l seg_ix:l start_ms:l end_ms:l text:s", r"SELECT conv_id AS video_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS seg_ix, turn * 1500 AS start_ms, turn * 1500 + 1234 AS end_ms, trim(regexp_replace(text, '\s+', ' ', 'g'), ' ') AS text FROM conversations")
def _(c):
    t = c.table("conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").alias("seg_ix"), (F.col("turn") * 1500).alias("start_ms"), (F.col("turn") * 1500 + 1234).alias("end_ms"), F.trim(F.regexp_replace("text", r"\s+", " ")).alias("text"))
    return captions.parse_vtt(captions.to_vtt(t))


@query("src_transcript", "video_id:l seg_ix:l start_ms:l end_ms:l speaker:s", "SELECT * FROM segments")
def _(c):
    bare = c.segments.withColumn("text", F.regexp_replace("text", "\n", " "))
    lines = extract.transcript(bare).select("video_id", F.posexplode(F.split("transcript", "\n")).alias("line_ix", "line"))
    return captions.read_transcript(lines)


@query("sink_overlay", "video_id:l frame_id:l image:s", """SELECT video_id, frame_id, string_agg(CAST(x AS INTEGER) || ',' || CAST(y AS INTEGER) || ' ' || CASE WHEN confidence >= 0.8::DOUBLE THEN 'green' WHEN confidence >= 0.5::DOUBLE THEN 'yellow' ELSE 'red' END || ' ' || length(text), ';' ORDER BY block_ix) AS image FROM raw_blocks GROUP BY 1, 2""")
def _(c):
    """A stand-in for drawing: the corner, colour and length of every block as text."""

    def draw(frames):
        for f in frames:
            image = [";".join(f"{int(b['x'])},{int(b['y'])} {b['color']} {b['n']}" for b in blocks).encode() for blocks in f["blocks"]]
            yield f[["video_id", "frame_id"]].assign(image=image)

    block = F.struct("block_ix", "x", "y", T.confidence_color(F.col("confidence")).alias("color"), F.length("text").alias("n"))
    drawn = report.overlay(c.raw_blocks.groupBy("video_id", "frame_id").agg(F.array_sort(F.collect_list(block)).alias("blocks")), draw)
    return drawn.withColumn("image", F.col("image").cast("string"))


@query("rpt_css", "selector:s declarations:l", "SELECT unnest(['body', '.strip', '.strip i', '.chapter', '.gap', '.scene,.keyframe', 'td,th']) AS selector, unnest([3, 3, 3, 1, 1, 2, 2]) AS declarations")
def _(c):
    """The rules of the report's style sheet, as every page carries it."""
    page = F.regexp_extract(F.lit(report.page({}, [], [], [], [])), "<style>(.*?)</style>", 1)
    rule = c.spark.range(1).select(F.explode(F.regexp_extract_all(page, F.lit("([^{}]+\\{[^}]*)\\}"), F.lit(1))).alias("r"))
    return rule.select(F.substring_index("r", "{", 1).alias("selector"), (F.size(F.split(F.substring_index("r", "{", -1), ";"))).alias("declarations"))


@query("ext_speaker_turns", "video_id:l turn:l speaker:s start_ms:l end_ms:l n:l", """runs AS (SELECT *, sum(CASE WHEN p IS NOT NULL AND p = speaker THEN 0 ELSE 1 END) OVER (PARTITION BY video_id ORDER BY seg_ix) AS turn FROM (SELECT *, lag(speaker) OVER (PARTITION BY video_id ORDER BY seg_ix) AS p FROM segments))
@@SELECT video_id, turn, min(speaker) AS speaker, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n FROM runs GROUP BY 1, 2""")
def _(c):
    return X.speaker_turns(c.segments)


@query("ext_delta_ocr", "video_id:s frame_id:l", r"""tok AS (SELECT video_id, frame_id, list_distinct(list_filter(string_split_regex(lower(text), '\s+'), lambda t: t <> '')) AS t FROM screen), lagged AS (SELECT *, lag(t) OVER (PARTITION BY video_id ORDER BY frame_id) AS b FROM tok)
@@SELECT video_id, frame_id FROM lagged WHERE b IS NULL OR len(list_distinct(list_concat(t, b))) = 0 OR len(list_intersect(t, b)) / len(list_distinct(list_concat(t, b)))::DOUBLE < 0.1::DOUBLE""")
def _(c):
    return X.changed_text_frames(c.screen, 0.1)


@query("ext_privacy_flags", "doc_id:l mail:b address:b card:b", r"SELECT doc_id, regexp_matches(coalesce(text, ''), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') AS mail, regexp_matches(coalesce(text, ''), '\b[0-9]{1,3}(\.[0-9]{1,3}){3}\b') AS address, regexp_matches(coalesce(text, ''), '\b[0-9]{13,16}\b') AS card FROM documents")
def _(c):
    return X.privacy_flags(c.documents)


@query("ext_boundary_mae", "video_id:l mae_ms:d", "SELECT t.video_id, avg(t.d) AS mae_ms FROM (SELECT k.video_id, k.frame_id, min(abs(k.timestamp_ms - s.start_ms)) AS d FROM keyframes k LEFT JOIN scenes s USING (video_id) GROUP BY 1, 2) t GROUP BY 1")
def _(c):
    return X.boundary_error(c.keyframes.select("video_id", F.col("timestamp_ms").alias("t_ms")), c.scenes.select("video_id", F.col("start_ms").alias("t_ms")))


@query("ext_rollup", "video_id:l chapter_index:l chunks:l seconds:d level:l", "SELECT coalesce(video_id, -1) AS video_id, coalesce(chapter_index, -1) AS chapter_index, count(*) AS chunks, sum(t_end_ms - t_start_ms) / 1000.0 AS seconds, grouping(video_id, chapter_index) AS level FROM chunks GROUP BY ROLLUP (video_id, chapter_index)")
def _(c):
    return X.chapter_rollup(_chunks(c)).fillna(-1, ["video_id", "chapter_index"])
