"""Column functions over text, boxes and frames of recognised text. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Function words that the alignment score ignores.
STOP_WORDS = tuple(
    "a about above after again against all am an and any are as at be because been before being below between both but by can could did do does doing "
    "down during each few for from further had has have having he her here hers herself him himself his how i if in into is it its itself just me more "
    "most my myself no nor not now of off on once only or other our ours ourselves out over own same she should so some such than that the their theirs "
    "them themselves then there these they this those through to too under until up very was we were what when where which while who whom why will with "
    "would you your yours yourself yourselves".split()
)
VIDEO_ID_PATTERNS = (r"(?:v=|/)([0-9A-Za-z_-]{11})", r"embed/([0-9A-Za-z_-]{11})", r"^([0-9A-Za-z_-]{11})$")


def video_id(url: Column, strict: bool = False) -> Column:
    """The 11 characters that name a video in a URL, by the first pattern that matches; otherwise null, or an error."""
    found = [F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in VIDEO_ID_PATTERNS]
    if strict:
        found.append(F.raise_error(F.concat(F.lit("no video id in "), url)).cast("string"))
    return F.coalesce(*found)


def language_from_filename(name: Column) -> Column:
    """``clip.en.vtt`` is en; without a part between two dots the language is unknown."""
    parts = F.split(name, r"\.")
    return F.when(F.size(parts) >= 3, F.element_at(parts, -2)).otherwise(F.lit("unknown"))


def frame_rate(ratio: Column) -> Column:
    """``30000/1001`` as a number; null for a zero denominator."""
    parts = F.split(ratio, "/")
    return F.try_divide(F.get(parts, 0).cast("double"), F.coalesce(F.get(parts, 1).cast("double"), F.lit(1.0)))


def timestamp(ms: Column) -> Column:
    """HH:MM:SS.mmm"""
    s = F.floor(ms / 1000)
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60, ms % 1000)


def transcript_line(start: Column, end: Column, text: Column, speaker: Column | None = None) -> Column:
    who = F.lit("") if speaker is None else F.when(F.coalesce(speaker, F.lit("")) != "", F.concat(F.lit("["), speaker, F.lit("] "))).otherwise("")
    return F.concat(F.lit("["), timestamp(start), F.lit(" -> "), timestamp(end), F.lit("] "), who, text)


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda t: t != "")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def polygon_box(polygon: Column) -> Column:
    """[x_min, y_min, x_max, y_max]"""
    x, y = F.transform(polygon, lambda p: F.get(p, 0)), F.transform(polygon, lambda p: F.get(p, 1))
    return F.array(F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y))


def confident(blocks: Column, least: float = 0.5) -> Column:
    return F.filter(blocks, lambda b: b["confidence"] >= F.lit(float(least)))


def reading_order(blocks: Column) -> Column:
    """Blocks from top to bottom, then left to right, then as they came."""
    keyed = F.transform(blocks, lambda b, i: F.struct(F.get(b["bbox"], 1).alias("y"), F.get(b["bbox"], 0).alias("x"), i.alias("i"), b["text"].alias("text")))
    return F.array_sort(keyed)


def full_text(blocks: Column) -> Column:
    return F.array_join(F.transform(reading_order(blocks), lambda b: b["text"]), " ")


def clean_text(blocks: Column, chrome: Column) -> Column:
    """The text of a frame without blocks that consist of chrome tokens only, or of none."""
    kept = F.filter(reading_order(blocks), lambda b: F.exists(tokens(b["text"]), lambda t: ~F.array_contains(chrome, t)))
    return F.array_join(F.transform(kept, lambda b: b["text"]), " ")


def frame_confidence(blocks: Column) -> Column:
    return F.aggregate(blocks, F.lit(0.0), lambda a, b: a + b["confidence"]) / F.greatest(F.size(blocks), F.lit(1))


def joined_frames(texts: Column) -> Column:
    return F.coalesce(F.array_join(F.filter(texts, lambda t: t != ""), " | "), F.lit(""))


def merged_text(asr: Column, ocr: Column) -> Column:
    spoken = F.when(asr != "", F.concat(F.lit("[SPOKEN] "), asr))
    shown = F.when(ocr != "", F.concat(F.lit("[ON SCREEN] "), ocr))
    return F.concat_ws(" ", spoken, shown)


def confidence_color(confidence: Column) -> Column:
    return F.when(confidence >= F.lit(0.8), "green").when(confidence >= F.lit(0.5), "yellow").otherwise("red")


def verdict(coverage: Column) -> Column:
    return F.when(coverage >= 90, "PASS").when(coverage >= 70, "PARTIAL").otherwise("FAIL")


def gap_severity(ms: Column, severe_ms: int = 30_000) -> Column:
    return F.when(ms > severe_ms, "high").otherwise("medium")


def redact(text: Column) -> Column:
    """Mail addresses, card and phone numbers and network addresses replaced by their kind (an extension)."""
    out = F.regexp_replace(text, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<EMAIL>")
    out = F.regexp_replace(out, r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "<IP>")
    out = F.regexp_replace(out, r"\b\d{13,16}\b", "<CARD>")
    return F.regexp_replace(out, r"\+\d[ \d()-]{7,}\d", "<PHONE>")


def file_base64(content: Column) -> Column:
    return F.base64(content)
