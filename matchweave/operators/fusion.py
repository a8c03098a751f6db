"""Hybrid retrieval: nearest vectors and best keyword matches fused by reciprocal rank."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchweave.functions import vectors as V
from matchweave.operators.fulltext import fulltext_search, postings, query_terms
from matchweave.operators.scale import top_per_key, within
from matchweave.operators.vector_search import valid_vectors, vector_search
from matchweave.schemas import HYBRID_TOP_K, LIST_DEPTH, RRF_K

#: Fused rows that may be broadcast to the name lookup.
BROADCAST_HITS = 500_000


@dataclass(frozen=True)
class Corpus:
    """The column groups of a document table that retrieval reads.

    Kept apart so that the vector side never reads text and the keyword side never reads vectors,
    also when they come from different tables.
    """

    vectors: DataFrame  # id, embedding (null allowed)
    texts: DataFrame  # id, raw_text
    names: DataFrame  # id, filename, name

    @classmethod
    def of(cls, table: DataFrame, name: str = "title") -> Corpus:
        return cls(
            table.select("id", "embedding"),
            table.select("id", "raw_text"),
            table.select("id", "filename", F.col(name).alias("name")),
        )


def reciprocal_rank(rank: F.Column, rrf_k: int) -> F.Column:
    return F.coalesce(F.lit(1.0) / (F.lit(rrf_k) + rank), F.lit(0.0))


def fuse(vector_hits: DataFrame, text_hits: DataFrame, rrf_k: int = RRF_K) -> DataFrame:
    """Full outer join of two ranked lists; a document missing from a list adds nothing for it."""
    v = vector_hits.select(
        "query_id", "id", F.col("score").alias("vec_score"), F.col("rank").alias("vec_rank")
    )
    t = text_hits.select("query_id", "id", F.col("score").alias("text_score"), F.col("rank").alias("text_rank"))
    score = reciprocal_rank(F.col("vec_rank"), rrf_k) + reciprocal_rank(F.col("text_rank"), rrf_k)
    return v.join(t, ["query_id", "id"], "full_outer").withColumn("rrf_score", score)


def with_missing_vectors(hits: DataFrame, queries: DataFrame, vectors: DataFrame, dim: int, depth: int) -> DataFrame:
    """Let documents without a vector fill the end of a vector list shorter than ``depth``.

    They sort after every distance. Only a corpus with fewer than ``depth`` vectors is affected, so
    at most ``depth`` ids are looked up.
    """
    n_valid = valid_vectors(vectors, dim).limit(depth).count()
    if n_valid >= depth:
        return hits
    missing = vectors.filter(F.col("embedding").isNull()).orderBy("id").limit(depth - n_valid).select("id")
    ids = [row.id for row in missing.collect()]
    if not ids:
        return hits
    tail = (
        queries.filter(V.has_dim(F.col("embedding"), dim))
        .select("query_id", F.posexplode(F.lit(ids)).alias("_p", "id"))
        .select(
            "query_id",
            F.col("id").cast("bigint").alias("id"),
            F.lit(None).cast("double").alias("score"),
            F.lit(None).cast("double").alias("distance"),
            (F.col("_p") + (n_valid + 1)).cast("bigint").alias("rank"),
        )
    )
    return hits.unionByName(tail)


def with_names(hits: DataFrame, names: DataFrame, rows_bound: int | None) -> DataFrame:
    """Look up file and display names last, for the final hits only."""
    side = F.broadcast(hits) if rows_bound is not None and rows_bound <= BROADCAST_HITS else hits
    return names.join(side, "id")


def hits_bound(queries: DataFrame, k: int) -> int | None:
    """Most hits ``queries`` can have at ``k`` each, or None beyond what may be broadcast."""
    if not within(queries, BROADCAST_HITS // k):
        return None
    return BROADCAST_HITS


def hybrid_search(
    queries: DataFrame,
    corpus: Corpus,
    dim: int,
    k: int = HYBRID_TOP_K,
    rrf_k: int = RRF_K,
    depth: int = LIST_DEPTH,
    posts: DataFrame | None = None,
) -> DataFrame:
    """Best ``k`` documents per query from the fused lists.

    ``queries`` holds ``query_id, embedding, keywords``. Pass stored postings as ``posts`` to skip
    tokenising the corpus.
    """
    vector_hits = with_missing_vectors(
        vector_search(queries, corpus.vectors, depth, dim), queries, corpus.vectors, dim, depth
    )
    posts = postings(corpus.texts) if posts is None else posts
    text_hits = fulltext_search(query_terms(queries), posts, depth)
    order = [F.col("rrf_score").desc(), F.col("id").asc()]
    top = top_per_key(fuse(vector_hits, text_hits, rrf_k), "query_id", order, k)
    return with_names(top, corpus.names, hits_bound(queries.select("query_id"), k)).select(
        "query_id",
        "id",
        "filename",
        "name",
        "rrf_score",
        "vec_score",
        "text_score",
        "vec_rank",
        "text_rank",
        "rank",
    )
