"""Exact cosine search: many query vectors against a corpus, without emitting all pairs.

Corpus vectors stream through Arrow batches and are multiplied with a block of query vectors;
only the best ``k`` per query leave a task. Query sets that fit ``QUERY_BYTES`` are broadcast,
larger ones are cut into blocks on both sides and paired block by block. With more than ``TASKS`` tasks, a
small share of the corpus is searched first: its ``k``-th distance bounds what may leave the tasks that
search the rest, so that the number of hits does not grow with the number of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchweave.functions import vectors as V
from matchweave.operators.scale import dense_index, top_per_key, union_all
from matchweave.session import durable

#: Query matrix that may be broadcast.
QUERY_BYTES = 64 << 20
#: Query rows multiplied at once, and bytes of a block's vectors in the two-sided form.
TILE = 512
BLOCK_BYTES = 32 << 20
#: Tasks whose best ``k`` are merged without a bound. The share that bounds more tasks than that is one in as many of the
#: corpus; where there are more than the square of it, a share of that share bounds the share.
TASKS = 16
#: Distances are compared at this many decimals, so copies of one vector tie and fall to the id.
DECIMALS = 12


def valid_vectors(df: DataFrame, dim: int, column: str = "embedding") -> DataFrame:
    return df.filter(V.has_dim(F.col(column), dim))


def invalid_vectors(df: DataFrame, dim: int, column: str = "embedding") -> DataFrame:
    """Rows whose vector is missing or has another dimension, with the size found."""
    return df.filter(~V.has_dim(F.col(column), dim)).withColumn("found_dim", F.size(column))


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; an all-zero row becomes NaN."""
    matrix = matrix.astype(np.float64, copy=False)
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    with np.errstate(divide="ignore", invalid="ignore"):
        return matrix / norms[:, None]


def arrow_matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def distances(queries: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    dist = np.round(1.0 - np.clip(queries @ corpus.T, -1.0, 1.0), DECIMALS)
    return np.where(np.isnan(dist), np.inf, dist)


class BestK:
    """The ``k`` nearest ids seen so far for each query row, ties by id.

    Hits are kept tile by tile: a new block of distances is merged with the hits of its own tile only.
    """

    def __init__(self, n_queries: int, k: int, limit: np.ndarray | None = None):
        self.k = k
        self.limit = np.full(n_queries, np.inf) if limit is None else limit.astype(np.float64)
        self.tiles: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def add(self, first_row: int, dist: np.ndarray, ids: np.ndarray) -> None:
        limit = self.limit[first_row : first_row + len(dist)]
        if dist.shape[1] > self.k:
            limit = np.minimum(limit, np.partition(dist, self.k - 1, axis=1)[:, self.k - 1])
        row, col = np.nonzero(dist <= limit[:, None])
        row, dist, ids = row + first_row, dist[row, col], ids[col]
        if first_row in self.tiles:
            row, dist, ids = (np.concatenate(x) for x in zip(self.tiles[first_row], (row, dist, ids)))
        order = np.lexsort((ids, dist, row))
        row, dist, ids = row[order], dist[order], ids[order]
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, int)
        sizes = np.diff(np.r_[starts, len(row)])
        place = np.arange(len(row)) - np.repeat(starts, sizes)
        keep, full = place < self.k, place == self.k - 1
        self.tiles[first_row] = row[keep], dist[keep], ids[keep]
        self.limit[row[full]] = dist[full]

    def hits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query rows, distances (NaN for a zero vector) and ids."""
        if not self.tiles:
            return np.empty(0, dtype=np.int64), np.empty(0), np.empty(0, dtype=np.int64)
        row, dist, ids = (np.concatenate(x) for x in zip(*self.tiles.values()))
        return row, np.where(np.isinf(dist), np.nan, dist), ids


def _hit_schema(query_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", query_type),
            T.StructField("id", T.LongType()),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def _broadcast_topk(
    queries: pd.DataFrame, query_type: T.DataType, corpus: DataFrame, k: int, dim: int, limits: np.ndarray | None = None
) -> DataFrame:
    matrix = unit_rows(np.stack(queries["embedding"].to_numpy())) if len(queries) else np.empty((0, dim))
    shared = corpus.sparkSession.sparkContext.broadcast((queries["query_id"].to_numpy(), matrix, limits))
    schema = _hit_schema(query_type)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, unit_queries, limits = shared.value
        best = BestK(len(query_ids), k, limits)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            unit_corpus = unit_rows(arrow_matrix(batch.column("embedding"), dim))
            for first in range(0, len(unit_queries), TILE):
                best.add(first, distances(unit_queries[first : first + TILE], unit_corpus), ids)
        row, distance, found = best.hits()
        yield pa.RecordBatch.from_pydict(
            {"query_id": query_ids[row], "id": found, "distance": pa.array(distance, from_pandas=False)}
        )

    return corpus.select("id", "embedding").mapInArrow(nearest, schema)


def _fresh(side: str, *columns: str) -> list[F.Column]:
    return [F.col(c).alias(f"{side}{c}") for c in columns]


def block_rows(dim: int, block: int | None = None) -> int:
    """Rows of a block: as asked, or as many as fit ``BLOCK_BYTES``."""
    return block or max(TILE, BLOCK_BYTES // (8 * dim))


def blocked_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    dim: int,
    cell: str | None = None,
    corpus_block: int | None = None,
    query_block: int | None = None,
) -> DataFrame:
    """Nearest ``k`` per query with both sides cut into bounded blocks.

    Rows meet only within equal ``cell`` values (everywhere, if no cell is given). A cell with
    more rows than a block is sliced on either side, so one crowded cell becomes many tasks. A column
    ``limit`` of the queries keeps hits beyond that distance inside the task.
    """
    left = queries.withColumn("_cell", F.col(cell) if cell else F.lit(0))
    right = corpus.withColumn("_cell", F.col(cell) if cell else F.lit(0))
    limit = F.col("limit") if "limit" in queries.columns else F.lit(float("inf"))

    def slices(df: DataFrame, block: int, out: str) -> DataFrame:
        return df.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(out))

    sizes = slices(left, block_rows(dim, query_block), "_qn").join(slices(right, block_rows(dim, corpus_block), "_cn"), "_cell")
    left = (
        left.join(F.broadcast(sizes), "_cell")
        .withColumn("_q", F.pmod(F.xxhash64("query_id"), F.col("_qn")).cast("int"))
        .withColumn("_c", F.explode(F.sequence(F.lit(0), F.col("_cn") - 1)))
        .select(*_fresh("l", "_cell", "_q", "_c"), "query_id", F.col("embedding").alias("q_vec"), limit.alias("q_limit"))
    )
    right = (
        right.join(F.broadcast(sizes), "_cell")
        .withColumn("_c", F.pmod(F.xxhash64("id"), F.col("_cn")).cast("int"))
        .withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_qn") - 1)))
        .select(*_fresh("r", "_cell", "_q", "_c"), "id", F.col("embedding").alias("c_vec"))
    )

    def nearest(query_rows: pd.DataFrame, corpus_rows: pd.DataFrame) -> pd.DataFrame:
        best = BestK(len(query_rows), k, query_rows["q_limit"].to_numpy())
        if len(query_rows) and len(corpus_rows):
            unit_queries = unit_rows(np.stack(query_rows["q_vec"].to_numpy()))
            unit_corpus = unit_rows(np.stack(corpus_rows["c_vec"].to_numpy()))
            ids = corpus_rows["id"].to_numpy()
            for first in range(0, len(unit_queries), TILE):
                best.add(first, distances(unit_queries[first : first + TILE], unit_corpus), ids)
        query_ids = query_rows["query_id"].to_numpy()
        row, distance, found = best.hits()
        return pd.DataFrame({"query_id": query_ids[row], "id": found, "distance": distance})

    schema = _hit_schema(queries.schema["query_id"].dataType)
    paired = left.groupBy("l_cell", "l_q", "l_c").cogroup(right.groupBy("r_cell", "r_q", "r_c"))
    # pandas gives NaN, the distance of a vector without length, as null
    return paired.applyInPandas(nearest, schema).withColumn("distance", F.coalesce("distance", F.lit(float("nan"))))


def kth_distances(hits: DataFrame, k: int, name: str = "query_id") -> DataFrame:
    """``name, limit``: the distance of the ``k``-th hit of each query that has so many."""
    ranked = ranked_hits(hits, k).filter(F.col("rank") == k).filter(~F.isnan("distance"))
    return ranked.select(F.col("query_id").alias(name), F.col("distance").alias("limit"))


def bounding_shares(tasks: int) -> list[int]:
    """One in how many corpus rows is searched ahead of the others, the smallest share first."""
    shares, share = [], TASKS
    while tasks > share:
        shares.insert(0, share)
        share *= TASKS
    return shares


def _share(corpus: DataFrame, share: int, first: bool) -> DataFrame:
    """A share of the corpus by a hash of the id; the first one in few tasks, so that not each sends its best ``k``."""
    rows = corpus.filter(F.pmod(F.xxhash64("id"), F.lit(share)) == 0)
    return rows.repartition(TASKS) if first else rows


def search_hits(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    dim: int,
    query_bytes: int = QUERY_BYTES,
    corpus_block: int | None = None,
    query_block: int | None = None,
) -> DataFrame:
    """``query_id, id, distance`` that leave the tasks of ``vector_search``: the ``k`` nearest of each query, and some more.

    A bound is the distance of a query's ``k``-th hit in a share of the corpus, so about ``k * TASKS`` rows of the whole lie
    within it, however many tasks look for them.
    """
    max_rows = max(1, query_bytes // (8 * dim))
    head = queries.limit(max_rows + 1).toPandas()
    kind = queries.schema["query_id"].dataType
    if len(head) <= max_rows:
        limits = None
        for i, share in enumerate(bounding_shares(corpus.rdd.getNumPartitions())):
            hits = _broadcast_topk(head, kind, _share(corpus, share, not i), k, dim, limits)
            known = kth_distances(hits, k).toPandas().set_index("query_id")["limit"]
            limits = head["query_id"].map(known).fillna(np.inf).to_numpy()
        return _broadcast_topk(head, kind, corpus, k, dim, limits)
    blocks = -(-corpus.count() // block_rows(dim, corpus_block))
    bounded = queries
    for share in bounding_shares(blocks):
        near = blocked_topk(bounded, _share(corpus, share, False), k, dim, None, corpus_block, query_block)
        # written, so that each share is searched once
        limits = durable(kth_distances(near, k, "_of"))
        bounded = queries.join(limits, F.col("query_id").eqNullSafe(F.col("_of")), "left").drop("_of")
        bounded = bounded.withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    return blocked_topk(bounded, corpus, k, dim, None, corpus_block, query_block)


def vector_search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    dim: int,
    query_bytes: int = QUERY_BYTES,
    corpus_block: int | None = None,
    query_block: int | None = None,
) -> DataFrame:
    """The ``k`` corpus vectors nearest to each query: ``query_id, id, score, distance, rank``.

    ``queries`` holds ``query_id, embedding`` and ``corpus`` holds ``id, embedding``. Rows without
    a valid vector take no part. Swap the arguments to search in the other direction. Blocks of the two-sided
    form have as many rows as the caller asks for, or as fit ``BLOCK_BYTES``.
    """
    queries = valid_vectors(queries.select("query_id", "embedding"), dim)
    corpus = valid_vectors(corpus.select("id", "embedding"), dim)
    return ranked_hits(search_hits(queries, corpus, k, dim, query_bytes, corpus_block, query_block), k)


def ranked_hits(hits: DataFrame, k: int) -> DataFrame:
    order = [F.col("distance").asc(), F.col("id").asc()]
    return top_per_key(hits, "query_id", order, k).select(
        "query_id", "id", (1.0 - F.col("distance")).alias("score"), "distance", "rank"
    )


def scored_against(
    vector: list[float] | np.ndarray, candidates: DataFrame, label: str = "id"
) -> DataFrame:
    """Similarity (0.0 for all-zero vectors) and distance of every candidate to one vector."""
    probe = F.array(*[F.lit(float(x)) for x in vector])
    return candidates.select(
        F.col(label),
        V.cosine_similarity(F.col("embedding"), probe).alias("score"),
        V.cosine_distance(F.col("embedding"), probe).alias("distance"),
    )


def rank_by_similarity(vector: list[float] | np.ndarray, candidates: DataFrame, label: str = "id") -> DataFrame:
    """All candidates ranked by similarity to one query vector, best first, ties by label."""
    scored = scored_against(vector, candidates, label).select(label, F.round("score", DECIMALS).alias("score"))
    return dense_index(scored, [F.col("score").desc(), F.col(label).asc()])


def distance_listing(vector: list[float] | np.ndarray, candidates: DataFrame, label: str = "id") -> DataFrame:
    """Distance next to similarity and its 4-digit rounding for every candidate, nearest first."""
    scored = scored_against(vector, candidates, label)
    return scored.select(
        F.col(label),
        "distance",
        (1.0 - F.col("distance")).alias("similarity"),
        F.round(1.0 - F.col("distance"), 4).alias("similarity_4"),
    ).orderBy("distance", label)


def similarity_matrix(columns: DataFrame, rows: DataFrame, dim: int, block_bytes: int = QUERY_BYTES) -> DataFrame:
    """``id, query_id, similarity`` for every corpus vector and every query vector in ``columns``.

    The result has rows times columns rows, as a matrix has; name in ``columns`` the offers that are wanted. Columns
    above ``block_bytes`` are taken block by block, each with its own pass over the rows.
    """
    columns = valid_vectors(columns.select("query_id", "embedding"), dim)
    blocks = max(1, -(-columns.count() * dim * 8 // block_bytes))
    rows = valid_vectors(rows.select("id", "embedding"), dim)
    parts = []
    for block in range(blocks):
        head = columns.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).toPandas()
        if len(head):
            parts.append(_filled(head, columns.schema["query_id"].dataType, rows, dim))
    schema = T.StructType([T.StructField("id", T.LongType()), columns.schema["query_id"], T.StructField("similarity", T.DoubleType())])
    return union_all(parts) if parts else rows.sparkSession.createDataFrame([], schema)


def _filled(head: pd.DataFrame, key_type: T.DataType, rows: DataFrame, dim: int) -> DataFrame:
    names = pa.array(head["query_id"])
    matrix = np.nan_to_num(unit_rows(np.stack(head["embedding"].to_numpy())))
    shared = rows.sparkSession.sparkContext.broadcast(matrix)
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("query_id", key_type), T.StructField("similarity", T.DoubleType())]
    )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, TILE):
                part = batch.slice(first, TILE)
                sims = np.nan_to_num(unit_rows(arrow_matrix(part.column("embedding"), dim))) @ shared.value.T
                each = pa.array(np.repeat(np.arange(part.num_rows), len(names)))
                tiled = pa.array(np.tile(np.arange(len(names)), part.num_rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(each), names.take(tiled), pa.array(sims.ravel())], names=["id", "query_id", "similarity"]
                )

    return rows.mapInArrow(fill, schema)


def embedding_max_diff(first: DataFrame, second: DataFrame) -> DataFrame:
    """Largest absolute difference between two embedding runs over the same ids."""
    pairs = first.select("id", F.col("embedding").alias("_a")).join(
        second.select("id", F.col("embedding").alias("_b")), "id"
    )
    return pairs.agg(
        F.count(F.lit(1)).alias("n"), F.max(V.max_abs_diff(F.col("_a"), F.col("_b"))).alias("max_diff")
    )
