"""The whole job for a set of offers: keywords, vectors, hybrid search, scoring, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchweave.functions.text import default_keywords
from matchweave.operators.analysis import analysed_hits, match_report
from matchweave.operators.fusion import BROADCAST_HITS, Corpus, hybrid_search
from matchweave.operators.inference import CompleteFn, EmbedFn, embed
from matchweave.operators.scale import within
from matchweave.schemas import DOCUMENT_TASK, MATCH_TOP_K
from matchweave.session import durable


def keyword_map(spark, entries: dict[str, str]) -> DataFrame:
    """``filename, keywords`` of the named offers."""
    return spark.createDataFrame(list(entries.items()), "filename string, keywords string")


def with_keywords(offers: DataFrame, keywords: DataFrame) -> DataFrame:
    """Keywords of each offer from ``filename, keywords``, or its name with spaces."""
    found = offers.join(keywords.select("filename", F.col("keywords").alias("_kw")), "filename", "left")
    return found.withColumn("keywords", F.coalesce("_kw", default_keywords(F.col("filename")))).drop("_kw")


@dataclass(frozen=True)
class Matches:
    """Results for the requested offers; names without an offer are listed apart."""

    reports: DataFrame
    analysed: DataFrame
    unmatched: DataFrame


def match_offers(
    requested: DataFrame,
    offers: DataFrame,
    documents: DataFrame,
    keywords: DataFrame,
    embed_fn: EmbedFn,
    complete_fn: CompleteFn,
    dim: int,
    k: int = MATCH_TOP_K,
    posts: DataFrame | None = None,
) -> Matches:
    """Match the offers named in ``requested`` (``filename``) against stored documents.

    The vectors of the offers and the analysed hits are checkpointed, so that no model call is made
    twice however often the results are read.
    """
    names = requested.select("filename").distinct()
    unmatched = names.join(offers.select("filename"), "filename", "left_anti")
    wanted = offers.join(names, "filename", "left_semi").select(
        F.col("filename").alias("query_id"), "filename", "raw_text"
    )
    queries = durable(embed(with_keywords(wanted, keywords), embed_fn, dim, task=DOCUMENT_TASK))
    hits = hybrid_search(queries, Corpus.of(documents), dim, k, posts=posts)
    few = within(queries.select("query_id"), BROADCAST_HITS // k)
    analysed = durable(
        analysed_hits(hits, documents, queries.select("query_id", "raw_text"), complete_fn, few)
    )
    return Matches(match_report(analysed), analysed, unmatched)
