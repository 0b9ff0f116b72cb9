"""Question-answer pairs: prompts, replies, parsing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import QA_PAIRS
from ..session import slices

FENCE = "```"


def prompt(chapter: Column, start_ms: Column, end_ms: Column, asr: Column, ocr: Column, pairs: int = 3) -> Column:
    """The request for one chunk; missing speech or text is said in words."""
    s, e = (start_ms / 1000).cast("double"), (end_ms / 1000).cast("double")
    say = lambda c, alt: F.coalesce(F.nullif(c, F.lit("")), F.lit(alt))
    head = F.format_string("Write %d questions with answers about one part of a tutorial.\nChapter: %s\nFrom %.1f s to %.1f s (%.1f s)\n", F.lit(pairs), chapter, s, e, (end_ms - start_ms) / 1000)
    rule = "\nReply with a JSON array of objects with the keys question, answer and evidence_type, which is spoken, visual or both. Ask at least once about what is visible."
    return F.concat(head, F.lit("Said:\n"), say(asr, "[No speech]"), F.lit("\nShown:\n"), say(ocr, "[No on-screen text]"), F.lit(rule))


def strip_fence(reply: Column) -> Column:
    """The reply without a fence of back-quotes: its first and last line go if it has more than two lines, then a
    leading ```json and a trailing fence."""
    t = F.regexp_replace(reply, r"^\s+|\s+$", "")
    lines = F.split(t, "\n")
    t = F.when(t.startswith(FENCE) & (F.size(lines) > 2), F.array_join(F.slice(lines, 2, F.greatest(F.size(lines) - 2, F.lit(0))), "\n")).otherwise(t)
    t = F.regexp_replace(F.regexp_replace(t, r"^```json", ""), r"```$", "")
    return F.regexp_replace(t, r"^\s+|\s+$", "")


def parse_pairs(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """A row per pair with the other columns of ``replies``. What isn't a JSON array gives no rows, a pair without
    question or answer is dropped, and missing evidence is both."""
    parsed = F.from_json(strip_fence(F.col(reply)), QA_PAIRS)
    rows = replies.withColumn("_p", F.explode(parsed)).where("_p.question is not null and _p.answer is not null")
    return rows.select(*[c for c in replies.columns if c != reply], F.col("_p.question").alias("question"), F.col("_p.answer").alias("answer"), F.coalesce("_p.evidence_type", F.lit("both")).alias("evidence_type"))


def attach_chunk(pairs: DataFrame, chunks: DataFrame) -> DataFrame:
    """The eight public columns of a pair."""
    keys = chunks.select("chunk_id", "t_start_ms", "t_end_ms", "chapter_title", "video_id")
    return pairs.select("chunk_id", "question", "answer", "evidence_type").join(keys, "chunk_id")


def template_replies(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The default generator: no model, one pair from each kind of text that a chunk has."""
    import json

    for f in frames:
        out = []
        for a, o in zip(f["asr_text"], f["ocr_text"]):
            pairs = [{"question": q, "answer": t, "evidence_type": k} for q, t, k in (("What is said here?", a, "spoken"), ("What is shown here?", o, "visual")) if t]
            out.append(json.dumps(pairs, ensure_ascii=False))
        yield f[["chunk_id"]].assign(reply=out)


def generate(chunks: DataFrame, generator: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] = template_replies) -> DataFrame:
    """Pairs of all chunks, with the public columns of ``attach_chunk``. ``generator`` gets frames of chunk_id, prompt,
    asr_text, ocr_text and gives chunk_id, reply; a frame on which it fails is tried chunk by chunk, and a chunk on which it
    fails has no pairs. Frames are of bounded bytes, and a reply gets the other columns of its chunk in the frame that it
    comes of, so that the chunks are made once and never joined."""
    sees, keys = ["chunk_id", "prompt", "asr_text", "ocr_text"], ["t_start_ms", "t_end_ms", "chapter_title", "video_id"]

    def replies(f: pd.DataFrame) -> list[pd.DataFrame]:
        try:
            return list(generator(iter([f])))
        except Exception:
            if len(f) > 1:
                return [r for i in range(len(f)) for r in replies(f.iloc[i : i + 1])]
            return [f[["chunk_id"]].assign(reply="[]")]

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in slices(batches, "prompt"):
            f = batch.select(sees).to_pandas()
            for r in replies(f):
                reply = pa.RecordBatch.from_pandas(r[["chunk_id", "reply"]], pa.schema([("chunk_id", pa.string()), ("reply", pa.string())]), preserve_index=False)
                of: dict = {}
                for i, x in enumerate(batch.column("chunk_id").to_pylist()):
                    of.setdefault(x, []).append(i)
                # as a join would: a repeated chunk_id takes each reply to it, one that isn't in the frame none
                pairs = [(i, j) for j, x in enumerate(reply.column("chunk_id").to_pylist()) if x is not None for i in of.get(x, ())]
                own, said = (pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pc.take(reply.column(n), said) for n in ("chunk_id", "reply")] + [pc.take(batch.column(n), own) for n in keys], ["chunk_id", "reply", *keys])

    asked = chunks.select("chunk_id", prompt(F.col("chapter_title"), F.col("t_start_ms"), F.col("t_end_ms"), F.col("asr_text"), F.col("ocr_text")).alias("prompt"), "asr_text", "ocr_text", *keys)
    types = {f.name: f.dataType.simpleString() for f in asked.schema}
    made = asked.mapInArrow(run, "chunk_id string, reply string, " + ", ".join(f"{k} {types[k]}" for k in keys))
    return parse_pairs(made).select("chunk_id", "question", "answer", "evidence_type", *keys)
