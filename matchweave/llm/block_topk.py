"""Exact top-k search by inner product with block-at-a-time pruning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchweave.llm.integers import matrix, products, width_of
from matchweave.operators.scale import top_per_key
from matchweave.session import durable

#: Components are turned into floor(SCALE * x).
SCALE = 256
#: Vectors of a block, whose term maxima bound it.
BLOCK = 256
#: Vectors of a group of blocks and queries of a group; one task scores one pair of groups.
GROUP, QUERIES = 16_384, 1_024
#: Hits of a query.
TOP = 5
LOWEST, NOBODY = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def quantised(column: str = "embedding", scale: int = SCALE) -> F.Column:
    """Integer components, or null where the vector or a component is null or not finite."""
    values = F.transform(column, lambda x: x.cast("double"))
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(values, lambda x: F.floor(x * scale).cast("bigint")))


def prune_and_score(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, block: int = BLOCK
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The ``k`` best vectors of each query: query numbers, ids and scores, and how many blocks were scored.

    A block of consecutive ids is bounded by its term maxima: the sum over terms of the query's weight times the
    largest (for negative weights the smallest) component in the block. Each query takes blocks in order of their
    bounds and stops when the next bound is below its kth score; an equal bound may hide a smaller id. Blocks that
    several queries take in the same turn are scored for them together from the block's forward index.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    begins = np.arange(0, len(ids), block)
    largest, smallest = np.maximum.reduceat(vectors, begins), np.minimum.reduceat(vectors, begins)
    # bounds may be rounded, so they give way by more than that
    positive, negative = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    bounds = positive @ largest.T + negative @ smallest.T
    bounds += 1e-9 * (positive @ np.abs(largest).T.astype(np.float64) - negative @ np.abs(smallest).T.astype(np.float64))
    turns = np.argsort(-bounds, axis=1, kind="stable")
    best_scores = np.full((len(queries), k), LOWEST)
    best_ids = np.full((len(queries), k), NOBODY)
    live, scored = np.arange(len(queries)), 0
    for turn in range(len(begins)):
        chosen = turns[live, turn]
        going = bounds[live, chosen] >= best_scores[live, -1]
        live, chosen = live[going], chosen[going]
        if not len(live):
            break
        for number in np.unique(chosen).tolist():
            rows = live[chosen == number]
            part = slice(begins[number], begins[number] + block)
            scores = products(queries[rows], vectors[part])
            own = ids[part][None, :] == query_ids[rows][:, None]
            scored += len(rows)
            # a stable order puts smaller ids first among equals; the smallest integer has no opposite
            pick = np.lexsort((np.broadcast_to(ids[part], scores.shape), ~scores, own), axis=1)[:, :k]
            out = np.take_along_axis(own, pick, 1)
            scores, found = np.where(out, LOWEST, np.take_along_axis(scores, pick, 1)), np.where(out, NOBODY, ids[part][pick])
            all_scores = np.concatenate([best_scores[rows], scores], axis=1)
            all_ids = np.concatenate([best_ids[rows], found], axis=1)
            keep = np.lexsort((all_ids, ~all_scores), axis=1)[:, :k]
            best_scores[rows] = np.take_along_axis(all_scores, keep, 1)
            best_ids[rows] = np.take_along_axis(all_ids, keep, 1)
    row, column = np.nonzero(best_ids < NOBODY)
    return row, best_ids[row, column], best_scores[row, column], scored


HITS = "query_id bigint, vec_id bigint, score bigint"


def _search(k: int, block: int):
    def search(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        kinds = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not queries.num_rows or not vectors.num_rows:
            return kinds.empty_table()
        width = width_of(queries.column("_v"), vectors.column("_v"))
        query_ids = queries.column("_id").to_numpy()
        row, ids, scores, _ = prune_and_score(
            query_ids, matrix(queries.column("_v"), width), vectors.column("_id").to_numpy(), matrix(vectors.column("_v"), width), k, block
        )
        return pa.Table.from_arrays([pa.array(query_ids[row]), pa.array(ids), pa.array(scores)], schema=kinds)

    return search


def top_k(
    vectors: DataFrame,
    is_query: F.Column,
    k: int = TOP,
    group: int = GROUP,
    queries_per_group: int = QUERIES,
    block: int = BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` vectors with the highest integer inner product for each query.

    Components are ``floor(256 * x)``. Queries are the rows for which ``is_query`` holds (a condition on ``vec_id``);
    candidates are all rows but those with the query's id. Ties go to the smaller ``vec_id``.

    Vectors are cut into groups of about ``group`` rows and queries into groups of about ``queries_per_group``; each
    pair of groups is one task, which prunes block by block, and only its ``k`` best hits per query leave it.

    Null vectors, vectors with null or non-finite components and rows without an id take no part; shorter vectors
    count as ending in zeros. Scores are exact integers; beyond 64 bits they are held at the end of that range. Rows that
    repeat an id are candidates each, and as queries they are answered once, by the row with the smallest vector. An empty table gives no rows; other columns are not read.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), quantised().alias("_v")).filter("vec_id is not null and _v is not null")
    rows = durable(rows.select(F.col("vec_id").alias("_id"), "_v", is_query.alias("_query")))
    asked = rows.filter("_query").groupBy("_id").agg(F.min("_v").alias("_v"))
    n, m = rows.count(), rows.filter("_query").count()
    parts, sides = max(1, -(-n // group)), max(1, -(-m // queries_per_group))

    def dealt(df: DataFrame, own: str, own_parts: int, other: str, other_parts: int) -> DataFrame:
        """Each row in its part, once for every part of the other side."""
        salt = F.xxhash64("_id", "_v") if own == "_part" else F.xxhash64("_id")
        marked = df.select("_id", "_v", F.pmod(salt, F.lit(own_parts)).cast("int").alias(own))
        return marked.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_parts - 1))))

    left = dealt(asked, "_side", sides, "_part", parts)
    right = dealt(rows, "_part", parts, "_side", sides)
    hits = left.groupBy("_side", "_part").cogroup(right.groupBy("_side", "_part")).applyInArrow(_search(k, block), HITS)
    best = top_per_key(hits, "query_id", [F.desc("score"), F.asc("vec_id")], k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
