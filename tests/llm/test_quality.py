import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from matchweave.llm import quality
from tests.llm.data import frame

FOLDER = "/root/testdata/sf0.01"


def test_accuracy_on_the_held_out_fold(spark):
    from matchweave.llm.queries import op3_quality_attention

    rows = op3_quality_attention(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert len(unseen) > 50 and np.mean([r.predicted == r.quality for r in unseen]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_passages_cover_the_whole_text():
    texts = [None, "", "a b", "w " * 130]
    features, begins = quality.passage_features(pa.array(texts, pa.string()), size=64)
    assert np.diff(begins).tolist() == [1, 1, 1, 3]
    assert not features[:2].any() and np.isfinite(features).all()
    together, _ = quality.passage_features(pa.array(["x Y!", "w " * 130]))
    assert np.allclose(together[1:], features[3:])


def test_gradients():
    rng = np.random.default_rng(1)
    documents = [rng.normal(size=(n, quality.FEATURES)) for n in (1, 3, 2)]
    labels, begins = np.array([1.0, 0.0, 1.0]), np.array([0, 1, 4, 6])
    model = quality.fit(documents, labels)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    stacked = np.concatenate(documents)

    def loss():
        y = model.score(stacked, begins)
        return -np.mean(labels * np.log(y) + (1 - labels) * np.log(1 - y))

    grads = model.gradients(stacked, begins, labels)
    for name, weight in model.weights.items():
        at = tuple(0 for _ in weight.shape)
        old = weight[at].copy()
        weight[at] = old + 1e-5
        up = loss()
        weight[at] = old - 1e-5
        down = loss()
        weight[at] = old
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-5


def test_odd_rows(spark):
    docs = frame(spark, [(1, None), (2, ""), (2, "x"), (None, "y")], "doc_id bigint, text string", extra=True)
    none = frame(spark, [(1, None), (None, 1)], "doc_id bigint, quality int")
    model = quality.train(docs, none)
    got = quality.score_quality(docs, model).collect()
    assert len(got) == 4 and all(r.score == 1.0 for r in got)
    assert quality.score_quality(docs.limit(0), model).count() == 0
    assert not docs.filter(quality.held_out(F.lit(None))).count()
