import math
import random

import numpy as np
from pyspark.sql import functions as F

from matchweave.llm.block_topk import prune_and_score, top_k
from tests.llm.data import frame


def plain(rows, k, every):
    usable = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    first = {}
    for i, v in usable:
        if i % every == 0:
            first[i] = min(first.get(i, v), v)
    out = []
    for q, v in first.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def sample(n, dim):
    random.seed(5)
    rows = [(i, [random.choice([0.0, 0.5, -0.25, random.uniform(-1, 1)]) for _ in range(dim)]) for i in range(n)]
    rows += [(n, None), (n + 1, []), (n + 2, [1.0, float("nan")]), (n + 3, [None, 1.0]), (n + 4, [float("inf")]), (None, [1.0])]
    rows += [(n + 5, [1.0]), (10, [0.5, 0.5])] + rows[3:9] + [(i, [1.0, 1.0]) for i in range(600, 620)]
    return rows


def test_equals_all_scores(spark):
    rows = sample(120, 4)
    for options in ({}, {"group": 30, "queries_per_group": 5, "block": 4}):
        vectors = frame(spark, rows, "vec_id bigint, embedding array<float>", extra=True)
        got = top_k(vectors, F.col("vec_id") % 10 == 0, 5, **options).collect()
        assert sorted(map(tuple, got)) == plain(rows, 5, 10)


def test_few_rows(spark):
    vectors = frame(spark, [(0, [1.0]), (50, [2.0])], "vec_id bigint, embedding array<float>")
    got = top_k(vectors, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 50, 131072), (50, 1, 0, 131072)]
    assert top_k(frame(spark, [], "vec_id bigint, embedding array<float>"), F.col("vec_id") % 50 == 0).count() == 0


def test_blocks_below_the_kth_score_are_left_out():
    vectors = np.repeat(np.eye(4, dtype=np.int64), 10, axis=0) * 100
    row, ids, scores, scored = prune_and_score(np.array([-1]), np.array([[3, 0, 0, 0]]), np.arange(40), vectors, 5, block=10)
    assert ids.tolist() == [0, 1, 2, 3, 4] and scored == 1


def test_scores_beyond_floats_are_exact(spark):
    rows = [(0, [2.0**30, 1.0]), (1, [2.0**30, 0.0]), (4, [1e30, 1.0]), (5, [-1e30, 0.0]), (7, [0.0, 1.0])]
    got = top_k(frame(spark, rows, "vec_id bigint, embedding array<float>"), F.col("vec_id") % 50 == 0, 5).collect()
    # beyond 64 bits the ends of the range
    assert sorted((r.rank, r.vec_id, r.score) for r in got) == [(1, 1, 2**63 - 1), (2, 4, 2**63 - 1), (3, 7, 2**16), (4, 5, -(2**63))]
    rows = [(0, [2.0**20, 1.0]), (1, [2.0**20, 0.0]), (2, [2.0**20, 0.00390625]), (3, [2.0**20, 0.0078125])]
    got = top_k(frame(spark, rows, "vec_id bigint, embedding array<float>"), F.col("vec_id") % 50 == 0, 5).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in got) == [(1, 3, 2**56 + 512), (2, 2, 2**56 + 256), (3, 1, 2**56)]
