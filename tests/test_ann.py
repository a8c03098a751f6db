import numpy as np
import pytest

from matchweave.operators import ann
from matchweave.operators import vector_search as VS
from matchweave.plans import queries

FOLDER = "/root/testdata/sf0.01"


def test_topk_finds_nine_tenths_of_the_exact_hits(spark):
    exact = {(r.query_id, r.id) for r in queries.REGISTRY["vector_topk"](spark, FOLDER).collect()}
    found = {(r.query_id, r.id) for r in queries.REGISTRY["ann_topk"](spark, FOLDER).collect()}
    assert len(exact & found) >= 0.9 * len(exact) > 0


def test_stated_recall(spark):
    assert queries.ANN_RECALL >= 0.9
    got = queries.REGISTRY["ann_recall"](spark, FOLDER).collect()
    assert len(got) == 1 and got[0].n_queries == 40 and got[0].enough


@pytest.mark.parametrize("sample", [500, 15])
def test_probes_needed(spark, sample):
    rng = np.random.default_rng(3)
    corpus = [(i, rng.normal(size=8).astype("float32").tolist()) for i in range(400)]
    c = spark.createDataFrame(corpus, "id long, embedding array<float>")
    q = spark.createDataFrame([*corpus[::13], (999, None)], "query_id long, embedding array<float>")
    index = ann.build_index(c, None, 8)
    exact = VS.vector_search(q, c, 5, 8)
    nprobe = ann.probes_needed(index, q, 5, 8, 0.9, sample)
    mean = lambda n: np.mean([r.recall for r in ann.recall(exact, ann.ann_search(q, index, 5, 8, n)).collect()])
    assert mean(nprobe) >= 0.9
    if sample == 500:
        assert nprobe == 1 or mean(nprobe - 1) < 0.9
    assert ann.probes_needed(index, q, 5, 8, 1.0, sample) <= index.n_cells
    assert ann.probes_needed(index, q.limit(0), 5, 8, 0.9, sample) == index.n_cells
