"""Search over cluster cells: build, store, probe, exact re-rank.

Vectors are normalised and grouped into k-means cells. ``ann_search`` visits only the ``nprobe`` nearest cells of a query;
``cell_search`` visits as many as its exact result needs: each cell has a radius, and one whose nearest possible vector
is beyond the ``k``-th hit is left out. Exact search stays the default elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchweave.operators.vector_search import (
    DECIMALS,
    arrow_matrix,
    blocked_topk,
    kth_distances,
    ranked_hits,
    unit_rows,
    valid_vectors,
    vector_search,
)
from matchweave.session import durable

#: Cells that are probed before a query's bound is known.
FIRST_CELLS = 2
#: Queries whose exact hits tell how many cells have to be probed, if there are more than that.
PROBE_QUERIES = 500


@dataclass(frozen=True)
class CellIndex:
    """Fitted centres, the corpus with its cell number, and the largest angle between a centre and its vectors."""

    centers: np.ndarray
    cells: DataFrame
    radii: np.ndarray

    @property
    def n_cells(self) -> int:
        return len(self.centers)


def fit_centers(corpus: DataFrame, n_cells: int | None, dim: int, seed: int = 7, fraction: float = 1.0) -> np.ndarray:
    """Cell centres, fitted on all vectors or on the ``fraction`` the caller asks for; every vector is indexed.

    Without ``n_cells`` there are as many cells as vectors in a cell, about.
    """
    vectors = valid_vectors(corpus.select("id", "embedding"), dim)
    if n_cells is None:
        n_cells = max(1, round(vectors.count() ** 0.5))
    if fraction < 1.0:
        vectors = vectors.sample(fraction=fraction, seed=seed)
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    features = vectors.withColumn("_len", length).filter("_len > 0").select(
        array_to_vector(F.transform("embedding", lambda x: x.cast("double") / F.col("_len"))).alias("features")
    )
    model = KMeans(k=n_cells, seed=seed, maxIter=15).fit(features)
    return unit_rows(np.array(model.clusterCenters()))


def _nearest(closeness: np.ndarray, n: int) -> np.ndarray:
    """Columns of the ``n`` largest values of each row, the largest first."""
    if n < closeness.shape[1]:
        some = np.argpartition(-closeness, n - 1, axis=1)[:, :n]
    else:
        some = np.broadcast_to(np.arange(n), closeness.shape)
    order = np.lexsort((some, -np.take_along_axis(closeness, some, 1)), axis=1)
    return np.take_along_axis(some, order, 1)


def assign_cells(df: DataFrame, key: str, centers: np.ndarray, dim: int, nprobe: int = 1) -> DataFrame:
    """``key, embedding, cell`` with one row for each of the ``nprobe`` nearest cells."""
    shared = df.sparkSession.sparkContext.broadcast(centers)
    nprobe = min(nprobe, len(centers))
    rows = valid_vectors(df.select(key, "embedding"), dim)
    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            closeness = np.nan_to_num(unit_rows(arrow_matrix(batch.column("embedding"), dim)) @ shared.value.T)
            cells = _nearest(closeness, nprobe)
            take = pa.array(np.repeat(np.arange(batch.num_rows), nprobe))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(take),
                    batch.column("embedding").take(take),
                    pa.array(cells.ravel(), pa.int32()),
                ],
                names=[key, "embedding", "cell"],
            )

    return rows.mapInArrow(nearest, schema)


def _angles(closeness: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(closeness, -1.0, 1.0))


def cell_radii(cells: DataFrame, centers: np.ndarray, dim: int) -> np.ndarray:
    """The largest angle between each centre and a vector of its cell; all-zero vectors have none, empty cells a negative one."""
    shared = cells.sparkSession.sparkContext.broadcast(centers)

    def widest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.full(len(shared.value), -1.0)
        for batch in batches:
            cell = batch.column("cell").to_numpy(zero_copy_only=False)
            unit = unit_rows(arrow_matrix(batch.column("embedding"), dim)) if batch.num_rows else np.empty((0, dim))
            np.fmax.at(most, cell, _angles(np.einsum("ij,ij->i", unit, shared.value[cell])))
        yield pa.RecordBatch.from_pydict({"cell": pa.array(range(len(most)), pa.int32()), "radius": most})

    found = cells.select("embedding", "cell").mapInArrow(widest, "cell int, radius double").groupBy("cell").agg(F.max("radius").alias("radius"))
    radii = np.full(len(centers), -1.0)
    for row in found.collect():
        radii[row.cell] = row.radius
    return radii


def build_index(corpus: DataFrame, n_cells: int | None, dim: int, seed: int = 7, fraction: float = 1.0) -> CellIndex:
    centers = fit_centers(corpus, n_cells, dim, seed, fraction)
    cells = durable(assign_cells(corpus, "id", centers, dim))
    return CellIndex(centers, cells, cell_radii(cells, centers, dim))


def write_index(index: CellIndex, path: str) -> None:
    """Store vectors by cell, so that a probe reads only the folders it needs."""
    index.cells.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/cells")
    spark = index.cells.sparkSession
    centers = pd.DataFrame({"cell": range(index.n_cells), "center": [c.tolist() for c in index.centers], "radius": index.radii})
    spark.createDataFrame(centers, "cell int, center array<double>, radius double").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/centers"
    )


def read_index(spark: SparkSession, path: str) -> CellIndex:
    centers = spark.read.parquet(f"{path}/centers").toPandas().sort_values("cell")
    return CellIndex(np.stack(centers["center"].to_numpy()), spark.read.parquet(f"{path}/cells"), centers["radius"].to_numpy())


def _only_probed(index: CellIndex, probes: DataFrame) -> DataFrame:
    # The list of cells is no longer than the list of centres, hence the broadcast; on a stored
    # index this becomes dynamic partition pruning.
    return index.cells.join(F.broadcast(probes.select("cell").distinct()), "cell", "left_semi")


def ann_search(
    queries: DataFrame,
    index: CellIndex,
    k: int,
    dim: int,
    nprobe: int,
    corpus_block: int | None = None,
    query_block: int | None = None,
) -> DataFrame:
    """As ``vector_search``, over the ``nprobe`` nearest cells of each query only."""
    probes = assign_cells(queries, "query_id", index.centers, dim, nprobe)
    return ranked_hits(blocked_topk(probes, _only_probed(index, probes), k, dim, "cell", corpus_block, query_block), k)


def cells_within(queries: DataFrame, index: CellIndex, dim: int, first: int = FIRST_CELLS) -> DataFrame:
    """``query_id, embedding, limit, cell``: the cells that may hold a vector within each query's ``limit``.

    No vector of a cell is nearer to the query than the angle to its centre less its radius. The ``first`` nearest cells are not
    returned; a query without a limit gets all others.
    """
    shared = queries.sparkSession.sparkContext.broadcast((index.centers, index.radii))
    schema = T.StructType([queries.schema["query_id"], queries.schema["embedding"], T.StructField("limit", T.DoubleType()), T.StructField("cell", T.IntegerType())])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers, radii = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            closeness = np.nan_to_num(unit_rows(arrow_matrix(batch.column("embedding"), dim)) @ centers.T)
            limit = batch.column("limit").to_numpy(zero_copy_only=False)
            nearest = 1.0 - np.cos(np.maximum(_angles(closeness) - radii[None, :], 0.0))
            # distances are rounded, and angles are less exact than they are
            wanted = (nearest <= limit[:, None] + 1e-6 + 10.0**-DECIMALS) & ((radii >= 0)[None, :] | np.isinf(limit)[:, None])
            np.put_along_axis(wanted, _nearest(closeness, min(first, len(centers))), False, 1)
            row, cell = np.nonzero(wanted)
            out = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(cell, pa.int32())], names=[*batch.schema.names, "cell"])

    return queries.select("query_id", "embedding", "limit").mapInArrow(within, schema)


@dataclass(frozen=True)
class CellHits:
    """Ranked hits, and ``query_id, cell`` of every cell that was read for them."""

    hits: DataFrame
    read: DataFrame


def cell_search(
    queries: DataFrame,
    index: CellIndex,
    k: int,
    dim: int,
    first: int = FIRST_CELLS,
    corpus_block: int | None = None,
    query_block: int | None = None,
) -> CellHits:
    """The hits of ``vector_search``, from the cells that can hold one of them.

    The ``first`` nearest cells of each query give its ``k``-th distance so far; then all cells are read whose
    bound, from centre and radius, is not beyond that. With fewer than ``k`` hits in the first cells, all are read.
    """
    probes = durable(assign_cells(queries, "query_id", index.centers, dim, first))
    near = durable(blocked_topk(probes, _only_probed(index, probes), k, dim, "cell", corpus_block, query_block))
    limits = kth_distances(near, k, "_of")
    asked = valid_vectors(queries.select("query_id", "embedding"), dim)
    asked = asked.join(limits, F.col("query_id").eqNullSafe(F.col("_of")), "left")
    asked = asked.select("query_id", "embedding", F.coalesce("limit", F.lit(float("inf"))).alias("limit"))
    further = durable(cells_within(asked, index, dim, first))
    rest = blocked_topk(further, _only_probed(index, further), k, dim, "cell", corpus_block, query_block)
    read = probes.select("query_id", "cell").unionByName(further.select("query_id", "cell"))
    return CellHits(ranked_hits(near.unionByName(rest), k), read)


def probes_needed(
    index: CellIndex, queries: DataFrame, k: int, dim: int, least: float, sample: int = PROBE_QUERIES, exact: DataFrame | None = None
) -> int:
    """The smallest ``nprobe`` that finds a mean share ``least`` of the exact hits of ``queries``.

    Measured by brute force: an exact hit is found as soon as its cell is probed. Of more than ``sample`` queries that
    many are measured (those with the smallest hashes), and ``least`` has to be passed by three standard errors.
    ``exact`` may give exact lists of all queries that are there already.
    """
    rows = valid_vectors(queries.select("query_id", "embedding"), dim)
    head = rows.orderBy(F.xxhash64("query_id"), "query_id").limit(sample + 1).toPandas()
    sampled, head = len(head) > sample, head.head(sample)
    if not len(head):
        return index.n_cells
    chosen = queries.sparkSession.createDataFrame(
        [(q,) for q in head["query_id"].tolist()], T.StructType([rows.schema["query_id"]])
    )
    if exact is None:
        exact = vector_search(rows.join(F.broadcast(chosen), "query_id", "left_semi"), index.cells, k, dim)
    hits = exact.join(F.broadcast(chosen), "query_id", "left_semi").select("query_id", "id")
    hits = index.cells.select("id", "cell").join(F.broadcast(hits), "id").select("query_id", "cell").toPandas()
    closeness = np.nan_to_num(unit_rows(np.stack(head["embedding"].to_numpy())) @ index.centers.T)
    order = _nearest(closeness, index.n_cells)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(index.n_cells)[None, :], 1)
    row = pd.Index(head["query_id"]).get_indexer(hits["query_id"])
    # share of the hits of each query by number of probed cells
    found = np.zeros((len(head), index.n_cells))
    np.add.at(found, (row, place[row, hits["cell"].to_numpy()]), 1)
    found = found[found.sum(axis=1) > 0].cumsum(axis=1)
    if not len(found):
        return index.n_cells
    shares = found / found[:, -1:]
    margin = 3 * shares.std(axis=0) / len(shares) ** 0.5 if sampled else 0.0
    enough = shares.mean(axis=0) - margin >= min(least + 1e-9, 1.0)
    return int(np.argmax(enough)) + 1 if enough.any() else index.n_cells


def recall(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """Share of the exact hits of each query that the approximate list holds."""
    found = approximate.select("query_id", "id", F.lit(1).alias("_hit"))
    return (
        exact.select("query_id", "id")
        .join(found, ["query_id", "id"], "left")
        .groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("n"), (F.count("_hit") / F.count(F.lit(1))).alias("recall"))
    )
