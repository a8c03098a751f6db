"""Rank quality of a result list against expected documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rank_quality(hits: DataFrame, expected: DataFrame, k: int) -> DataFrame:
    """Per query: is the expected document first, is it among the first ``k``, and 1 / its rank."""
    found = hits.filter(F.col("rank") <= k).select("query_id", F.col("id").alias("expected_id"), "rank")
    joined = expected.select("query_id", "expected_id").join(found, ["query_id", "expected_id"], "left")
    return joined.groupBy("query_id").agg(
        F.max(F.when(F.col("rank") == 1, 1).otherwise(0)).alias("hit_at_1"),
        F.max(F.when(F.col("rank").isNotNull(), 1).otherwise(0)).alias("hit_at_k"),
        F.coalesce(F.max(1.0 / F.col("rank")), F.lit(0.0)).alias("reciprocal_rank"),
    )


def quality_summary(per_query: DataFrame) -> DataFrame:
    return per_query.agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.avg("hit_at_1").alias("hit_at_1"),
        F.avg("hit_at_k").alias("hit_at_k"),
        F.avg("reciprocal_rank").alias("mrr"),
    )
