"""Metrics of extraction and retrieval (extensions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def character_error_rate(truth: Column, read: Column) -> Column:
    """Edit distance by the length of the truth; 0 for two empty texts, 1 for text where there is none."""
    n = F.length(truth)
    return F.when(n > 0, F.levenshtein(truth, read) / n).otherwise(F.when(F.length(read) > 0, 1.0).otherwise(0.0))


def retrieval_by_class(ranked: DataFrame, queries: DataFrame, items: DataFrame, k: int, query: str = "query_id", item: str = "vec_id", label: str = "label") -> DataFrame:
    """``retrieval`` where the items of a query's label are relevant to it: their number is one count for each label, and
    only what was found is looked up, so that no pairs of a label are ever formed."""
    total = queries.join(items.groupBy(label).agg(F.count("*").alias("n")), label).select(query, "n", F.col(label).alias("_own"))
    found = ranked.where(F.col("rank") <= k).join(items.select(item, label), item).join(total.select(query, "_own"), query).where(F.col(label).eqNullSafe(F.col("_own")))
    return _scored(total.drop("_own"), found, k, query)


def retrieval(ranked: DataFrame, relevant: DataFrame, k: int, query: str = "query_id", item: str = "vec_id") -> DataFrame:
    """query, recall and ndcg at k. ranked: query, item, rank (from 1); relevant: query, item."""
    total = relevant.groupBy(query).agg(F.count("*").alias("n"))
    return _scored(total, ranked.where(F.col("rank") <= k).join(relevant, [query, item], "left_semi"), k, query)


def _scored(total: DataFrame, found: DataFrame, k: int, query: str) -> DataFrame:
    hits = found.groupBy(query).agg(F.count("*").alias("h"), F.sum(1 / F.log2(F.col("rank") + 1)).alias("dcg"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int")), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + 1))
    return total.join(hits, query, "left").select(query, (F.coalesce("h", F.lit(0)) / F.col("n")).alias("recall"), (F.coalesce("dcg", F.lit(0.0)) / ideal).alias("ndcg"))
