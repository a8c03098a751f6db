import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchweave.llm.hard_negatives import _HIGH, _LOW, Searches, build, hard_negatives, lengths
from matchweave.llm.integers import products
from tests.llm.data import frame


def usable(rows):
    for i, v, label in rows:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            yield i, label, [math.floor(256 * float(np.float32(x))) for x in v]


def plain(rows, every, positives=5, negatives=10):
    rows, out, anchors = list(usable(rows)), [], {}
    for i, label, v in rows:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    for a, (label, v) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in rows if i != a)
        for minus, p, _ in [s for s in scored if s[2] == label][:positives]:
            fitting = [s for s in scored if s[2] != label and -30 * minus <= -100 * s[0] <= -90 * minus][:negatives]
            out += [(a, p, n + 1, i, -minus, -s) for n, (s, i, _) in enumerate(fitting)]
    return sorted(out)


SCHEMA = "vec_id bigint, embedding array<float>, label int"


def sample(n, dim, seed=5):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(n):
        centre = centres[i % 6]
        rows.append((i, [c + rng.gauss(0, 0.3) for c in centre], rng.randrange(3)))
    return rows


ODD = [
    (900, None, 1), (901, [1.0, float("nan")], 1), (902, [None, 1.0], 1), (903, [float("inf")], 1), (904, [], 1), (905, [1.0], None),
    (None, [1.0], 1), (906, [0.5], 2), (10, [0.25, 0.25], 0), (10, [0.25, 0.25], 0),
]


@pytest.mark.parametrize("options", [{}, {"piece": 40, "sample": 400, "searches": 7}])
def test_equals_all_scores(spark, options):
    rows = sample(300, 4) + ODD + [(i, [1.0, 1.0, 0.5, -1.0], i % 3) for i in range(600, 660)]
    vectors = frame(spark, rows, SCHEMA, extra=True)
    got = hard_negatives(vectors, F.col("vec_id") % 10 == 0, F.col("label"), **options).collect()
    assert sorted(map(tuple, got)) == plain(rows, 10)


def test_few_rows(spark):
    empty = hard_negatives(frame(spark, [], SCHEMA), F.col("vec_id") % 100 == 0, F.col("label"))
    assert empty.count() == 0
    rows = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (3, [0.95], 2), (4, [0.3], 2)]
    got = hard_negatives(frame(spark, rows, SCHEMA), F.col("vec_id") % 100 == 0, F.col("label")).collect()
    assert sorted(map(tuple, got)) == plain(rows, 100) and len(got) == 1


def test_tree_leaves_out_what_cannot_hold_a_row():
    rows = list(usable(sample(3_000, 4)))
    ids, labels, vectors = (np.array(c) for c in zip(*rows))
    longest = float(lengths(vectors).max())
    tree = build(vectors, np.arange(len(ids)), longest, 32)
    asked = np.arange(0, 3_000, 100)

    def search(low, high):
        n = len(asked)
        return Searches(vectors[asked], ids[asked], labels[asked], np.ones(n, bool), np.full(n, low), np.full(n, high), np.full(n, 5))

    searches = search(_LOW, _HIGH)
    assert searches.run(tree, vectors, ids, labels, longest) < 0.3 * len(asked) * len(ids)
    scores = vectors[asked] @ vectors.T
    for row, a in enumerate(asked):
        best = sorted((-scores[row, i], ids[i]) for i in range(len(ids)) if i != a and labels[i] == labels[a])[:5]
        assert [(-s, i) for s, i in best] == list(zip(searches.found[row].tolist(), searches.ids[row].tolist()))
    # a ring away from the anchor leaves out what is too near as well
    middle = int(np.median(scores))
    ring = search(middle, middle + 50)
    ring.run(tree, vectors, ids, labels, longest)
    for row, a in enumerate(asked):
        best = sorted((-scores[row, i], ids[i]) for i in range(len(ids)) if i != a and labels[i] == labels[a] and middle <= scores[row, i] <= middle + 50)
        assert [i for _, i in best[:5]] == ring.ids[row][ring.ids[row] < _HIGH].tolist()


def test_products_are_exact():
    big = np.array([[2**38, 3], [2**38, 4], [2**20, 5]])
    assert products(big, big[2:]).tolist() == [[2**58 + 15], [2**58 + 20], [2**40 + 25]]
    assert products(big, big).tolist()[0][0] == _HIGH
    assert products(np.array([[_LOW]]), np.array([[1], [-1]])).tolist() == [[_LOW, _HIGH]]
