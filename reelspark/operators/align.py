"""How well speech and screen agree: TF-IDF cosine of the two texts of a chunk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import STOP_WORDS

#: Words of two or more word characters.
WORD = r"(?U)\b\w\w+\b"


def tfidf_cosine(pairs: DataFrame, key: str = "chunk_id", max_df: float | None = 0.95) -> DataFrame:
    """key, score for the columns asr_text and ocr_text.

    The vocabulary is fitted on the two texts of one chunk. With ``max_df`` = 0.95 a word of both texts is dropped for
    being too common, so the score is always 0; None keeps it and gives the score that is meant. Texts without words
    score 0. A shared word has idf 1, one of a single text ln(3/2) + 1."""
    if max_df is not None and max_df * 2 < 2:
        return pairs.select(key, F.lit(0.0).alias("score"))
    sides = pairs.select(key, F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("asr_text").alias("t")), F.struct(F.lit(1).alias("side"), F.col("ocr_text").alias("t")))).alias("s"))
    words = sides.select(key, F.col("s.side").alias("side"), F.explode(F.regexp_extract_all(F.lower("s.t"), F.lit(WORD), F.lit(0))).alias("w"))
    words = words.where(~F.col("w").isin(*STOP_WORDS))
    tf = words.groupBy(key, "w").agg(F.sum((F.col("side") == 0).cast("int")).alias("a"), F.sum((F.col("side") == 1).cast("int")).alias("b"))
    idf = F.when((F.col("a") > 0) & (F.col("b") > 0), 1.0).otherwise(F.log(F.lit(1.5)) + 1)
    x, y = F.col("a") * idf, F.col("b") * idf
    sums = tf.groupBy(key).agg(F.sum(x * y).alias("d"), F.sum(x * x).alias("p"), F.sum(y * y).alias("q"))
    score = F.when((F.col("p") > 0) & (F.col("q") > 0), F.col("d") / (F.sqrt("p") * F.sqrt("q"))).otherwise(0.0)
    return pairs.select(key).join(sums.select(key, score.alias("score")), key, "left").select(key, F.coalesce("score", F.lit(0.0)).alias("score"))


def with_scores(chunks: DataFrame, key: str = "chunk_id", max_df: float | None = 0.95) -> DataFrame:
    """The chunks with alignment_score. Where that is known to be 0 it is no join."""
    if max_df is not None and max_df * 2 < 2:
        return chunks.withColumn("alignment_score", F.lit(0.0))
    return chunks.join(tfidf_cosine(chunks, key, max_df).withColumnRenamed("score", "alignment_score"), key)


def average(scores: DataFrame) -> DataFrame:
    """One row; null without chunks."""
    return scores.agg(F.avg("score").alias("avg_alignment"))
