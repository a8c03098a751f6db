import math

import pytest
import numpy as np
from pyspark.sql import functions as F

from matchweave.functions import vectors as V
from matchweave.operators import ann
from matchweave.operators import vector_search as VS

VEC = "id long, embedding array<float>"


def frame(spark, rows, key="id"):
    return spark.createDataFrame(rows, f"{key} long, embedding array<float>")


def brute(queries, corpus, k):
    out = set()
    for q, a in queries:
        scored = sorted(
            (round(1 - np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b), 12), i) for i, b in corpus
        )
        out |= {(q, i, rank) for rank, (_, i) in enumerate(scored[:k], 1)}
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    corpus = [(i, rng.normal(size=6).astype("float32").tolist()) for i in range(120)]
    corpus += [(200 + i, corpus[3][1]) for i in range(30)]  # many copies of one vector
    queries = [(i, corpus[i * 3][1]) for i in range(11)]
    return queries, corpus


def test_similarity_and_distance(spark):
    df = spark.createDataFrame([([3.0, 4.0], [6.0, 8.0]), ([1.0, 0.0], [-1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    sim = [r[0] for r in df.select(V.cosine_similarity(F.col("a"), F.col("b"))).collect()]
    dist = [r[0] for r in df.select(V.cosine_distance(F.col("a"), F.col("b"))).collect()]
    assert sim == [1.0, -1.0, 0.0]
    assert dist[:2] == [0.0, 2.0] and math.isnan(dist[2])


def test_tiny_listing(spark):
    df = frame(spark, [(1, [1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, [0.0, 0.0, 1.0])])
    got = VS.distance_listing([1.0, 0.0, 0.0], df).collect()
    assert [(r.id, r.distance, r.similarity_4) for r in got] == [(1, 0.0, 1.0), (2, 1.0, 0.0), (3, 1.0, 0.0)]


def test_search_forms_equal_brute_force(spark, data):
    queries, corpus = data
    q, c = frame(spark, queries, "query_id"), frame(spark, corpus)
    want = brute(queries, corpus, 5)
    for options in ({}, {"query_bytes": 0, "corpus_block": 17, "query_block": 3}):
        hits = VS.vector_search(q, c.repartition(5), 5, 6, **options).collect()
        assert {(r.query_id, r.id, r["rank"]) for r in hits} == want


def test_rows_leaving_the_tasks_do_not_grow_with_them(spark):
    rng = np.random.default_rng(4)
    corpus = frame(spark, [(i, v) for i, v in enumerate(rng.normal(size=(4_000, 3)).tolist())])
    queries = frame(spark, [(i, v) for i, v in enumerate(rng.normal(size=(100_000, 3)).tolist())], "query_id")
    few, many = (VS.search_hits(queries, corpus.repartition(n), 2, 3).count() for n in (50, 200))
    assert many < 1.2 * few and many < 1.1 * 100_000 * 2 * VS.TASKS  # unbounded, 200 tasks send 400 rows a query
    assert VS.bounding_shares(16) == [] and VS.bounding_shares(17) == [16] and VS.bounding_shares(5_000) == [4096, 256, 16]


def test_bounded_search_equals_brute_force(spark, data):
    queries, corpus = data
    corpus = corpus + [(900, [0.0] * 6), (901, None)]
    q, c = frame(spark, [*queries, (50, [0.0] * 6)], "query_id"), frame(spark, corpus)
    for options in ({}, {"query_bytes": 0, "corpus_block": 7, "query_block": 3}):
        hits = VS.vector_search(q, c.repartition(40), 5, 6, **options).collect()
        got = {(r.query_id, r.id, r["rank"]) for r in hits if r.query_id != 50}
        assert got == brute(queries, corpus[:-2], 5)
        # a vector without length is at no distance from any: ties by id
        assert sorted((r.id, r["rank"]) for r in hits if r.query_id == 50) == [(i, i + 1) for i in range(5)]


def test_search_skips_invalid_and_sorts_zero_vectors_last(spark):
    corpus = frame(spark, [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [1.0]), (5, [-1.0, 0.0])])
    hits = VS.vector_search(frame(spark, [(7, [2.0, 0.0])], "query_id"), corpus, 9, 2).orderBy("rank").collect()
    assert [r.id for r in hits] == [2, 5, 1] and math.isnan(hits[2].score)
    assert {r.id: r.found_dim for r in VS.invalid_vectors(corpus, 2).collect()}[4] == 1


def test_empty_sides(spark):
    some, none = frame(spark, [(1, [1.0, 0.0])]), frame(spark, [])
    assert VS.vector_search(none.withColumnRenamed("id", "query_id"), some, 3, 2).count() == 0
    assert VS.vector_search(some.withColumnRenamed("id", "query_id"), none, 3, 2).count() == 0


def test_cells(spark, data, tmp_path):
    queries, corpus = data
    q, c = frame(spark, queries, "query_id"), frame(spark, corpus)
    index = ann.build_index(c, 5, 6)
    ann.write_index(index, str(tmp_path))
    index = ann.read_index(spark, str(tmp_path))
    exact = VS.vector_search(q, c, 5, 6)
    every = ann.ann_search(q, index, 5, 6, nprobe=5, corpus_block=13, query_block=4)
    assert every.exceptAll(exact).count() == 0 and exact.exceptAll(every).count() == 0
    for r in ann.recall(exact, ann.ann_search(q, index, 5, 6, nprobe=2)).collect():
        assert r.n == 5 and 0.2 <= r.recall <= 1.0


def test_cells_are_left_out_only_where_no_hit_can_be(spark, data, tmp_path):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(20, 6))
    corpus = [(i, (centres[i % 20] + rng.normal(size=6) * 0.05).astype("float32").tolist()) for i in range(600)]
    odd = [(700, [0.0] * 6), (701, None), (702, [1.0])]
    queries = [(i, corpus[i * 7][1]) for i in range(40)] + [(90, [0.0] * 6), (91, None)]
    q, c = frame(spark, queries, "query_id"), frame(spark, corpus + odd)
    for index in (ann.build_index(c, 20, 6), ann.build_index(frame(spark, data[1]), None, 6)):
        ann.write_index(index, str(tmp_path / str(index.n_cells)))
        index = ann.read_index(spark, str(tmp_path / str(index.n_cells)))
        for k in (3, 50):
            exact = VS.vector_search(q, index.cells.select("id", "embedding"), k, 6)
            found = ann.cell_search(q, index, k, 6)
            assert found.hits.exceptAll(exact).count() == 0 and exact.exceptAll(found.hits).count() == 0
            if k == 3 and index.n_cells == 20:
                read = found.read.filter("query_id < 90").groupBy("query_id").count().collect()
                assert len(read) == 40 and np.mean([r["count"] for r in read]) < 10
            assert found.read.distinct().count() == found.read.count()


def test_matrix_rank_and_diff(spark):
    docs = frame(spark, [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0])])
    offers = frame(spark, [(8, [0.0, 1.0]), (9, [1.0, 0.0])], "query_id")
    wanted = {(1, 8): 0.0, (1, 9): 1.0, (2, 8): 0.707107, (2, 9): 0.707107, (3, 8): 0.0, (3, 9): 0.0}
    for options in ({}, {"block_bytes": 8}):
        found = VS.similarity_matrix(offers, docs, 2, **options).collect()
        assert {(r.id, r.query_id): round(r.similarity, 6) for r in found} == wanted
    ranked = VS.rank_by_similarity([0.0, 1.0], docs).orderBy("rank").collect()
    assert [(r.id, r["rank"]) for r in ranked] == [(2, 1), (1, 2), (3, 3)]
    other = frame(spark, [(1, [1.0, 0.5]), (2, [1.0, 1.0]), (3, [0.0, 0.0])])
    assert VS.embedding_max_diff(docs, other).first().max_diff == 0.5
