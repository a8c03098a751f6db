"""Document quality by multiple-instance learning with gated attention over passages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchweave.llm.words import by_bytes, column_bytes, split_words

#: Words of a passage.
PASSAGE = 64
#: Labelled documents that the model is fitted on, at most (those with the smallest hash of their id).
SAMPLE = 3_000
#: Score from which a document is predicted good.
ACCEPT = 0.7
#: Every fourth document by CRC-32 of its id is held out.
FOLDS, HELD_OUT = 4, 2

ENCODED, GATE, EPOCHS, BATCH, RATE, DECAY, SEED = 24, 16, 30, 64, 0.01, 1e-4, 7

#: Byte kinds: white space, lower, upper, digit, sentence marks, quotes and brackets, other signs, above ASCII.
_KIND = np.full(256, 6, dtype=np.int64)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[97:123] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[ord(c) for c in ".,;:!?"]] = 4
_KIND[[ord(c) for c in "\"'()[]{}-"]] = 5
_KIND[128:] = 7
KINDS = 8
FEATURES = KINDS * KINDS + 8


def passage_features(column: pa.Array, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of ``size`` words, and where each text's passages begin (one entry more).

    A text without words has one passage of zeros. Features are the frequencies of neighbouring byte kinds, and per
    passage the word length, the share of different words, of words equal to the one before, of words in capitals,
    of words that end in a sign, of words of signs alone, of line ends, and the share of words new to the document.
    """
    data, offsets = column_bytes(column)
    words = split_words(column)
    total = np.diff(words.first)
    passages = np.maximum(-(-total // size), 1)
    begins = np.concatenate([[0], np.cumsum(passages)])
    out = np.zeros((int(begins[-1]), FEATURES), dtype=np.float32)
    if not len(words.starts):
        return out, begins

    text = words.text
    within = np.arange(len(text)) - words.first[:-1][text]
    passage = begins[:-1][text] + within // size
    counts = np.bincount(passage, minlength=len(out)).astype(np.float32)
    some = np.maximum(counts, 1)

    # each byte counts for the passage of the last word that began before it
    kinds = _KIND[data]
    marks = np.zeros(len(data), dtype=np.int64)
    marks[words.starts] = 1
    of_word = np.cumsum(marks) - 1
    pair = kinds[:-1] * KINDS + kinds[1:]
    inside = of_word[:-1] >= 0
    inside[offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))] - 1] = False
    cell = passage[of_word[:-1][inside]] * (KINDS * KINDS) + pair[inside]
    pairs = np.bincount(cell, minlength=len(out) * KINDS * KINDS).reshape(len(out), -1)
    out[:, : KINDS * KINDS] = pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(passage, weights=flags, minlength=len(out)) / some

    base = KINDS * KINDS
    length = words.ends - words.starts
    out[:, base] = np.log1p(share(length))
    order = np.lexsort((words.hashes, passage))
    first_here = np.ones(len(order))
    first_here[1:] = (words.hashes[order][1:] != words.hashes[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    out[:, base + 1] = np.bincount(passage[order], weights=first_here, minlength=len(out)) / some
    same = np.zeros(len(text))
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (text[1:] == text[:-1])
    out[:, base + 2] = share(same)
    letters = np.concatenate([[0], np.cumsum((kinds == 1) | (kinds == 7))])
    capitals = np.concatenate([[0], np.cumsum(kinds == 2)])
    signs = np.concatenate([[0], np.cumsum(kinds == 6)])
    low = letters[words.ends] - letters[words.starts]
    out[:, base + 3] = share((low == 0) & (capitals[words.ends] > capitals[words.starts]))
    out[:, base + 4] = share(kinds[words.ends - 1] == 6)
    out[:, base + 5] = share(signs[words.ends] - signs[words.starts] == length)
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    after = np.concatenate([words.starts[1:], [len(data)]])
    out[:, base + 6] = share(lines[after] - lines[words.ends])
    order = np.lexsort((np.arange(len(text)), words.hashes, text))
    fresh = np.ones(len(order))
    fresh[1:] = (words.hashes[order][1:] != words.hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
    out[:, base + 7] = np.bincount(passage[order], weights=fresh, minlength=len(out)) / some
    return out, begins


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class AttentionModel:
    """Encoder, gated attention and output weights; ``constant`` answers where there was nothing to learn from."""

    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    constant: float | None = None

    def _forward(self, features: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        x = np.clip((features - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ w["encode"] + w["encode_b"])
        t, g = np.tanh(h @ w["tanh"]), _sigmoid(h @ w["gate"])
        e = (t * g) @ w["attend"]
        owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        top = np.maximum.reduceat(e, begins[:-1])
        p = np.exp(e - top[owner])
        a = p / np.add.reduceat(p, begins[:-1])[owner]
        z = np.add.reduceat(a[:, None] * h, begins[:-1])
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "owner": owner, "y": _sigmoid(z @ w["out"] + w["out_b"])}

    def score(self, features: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The chance that a document is good; ``begins`` cuts the passages into documents."""
        if self.constant is not None:
            return np.full(len(begins) - 1, self.constant)
        return self._forward(features, begins)["y"].astype(np.float64)

    def gradients(self, features: np.ndarray, begins: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss."""
        w, f = self.weights, self._forward(features, begins)
        dy = (f["y"] - labels) / len(labels)
        dz = dy[:, None] * w["out"][None, :]
        spread = dz[f["owner"]]
        da = (spread * f["h"]).sum(axis=1)
        mean = np.add.reduceat(f["a"] * da, begins[:-1])[f["owner"]]
        de = f["a"] * (da - mean)
        both = de[:, None] * w["attend"][None, :]
        dt = both * f["g"] * (1 - f["t"] ** 2)
        dg = both * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * spread + dt @ w["tanh"].T + dg @ w["gate"].T
        dx = dh * (1 - f["h"] ** 2)
        return {
            "out": f["z"].T @ dy,
            "out_b": dy.sum(),
            "attend": (f["t"] * f["g"]).T @ de,
            "tanh": f["h"].T @ dt,
            "gate": f["h"].T @ dg,
            "encode": f["x"].T @ dx,
            "encode_b": dx.sum(axis=0),
        }


def fit(documents: list[np.ndarray], labels: np.ndarray) -> AttentionModel:
    """Fit on the passages of each document by Adam; the same input gives the same model."""
    if not len(labels) or labels.min() == labels.max():
        return AttentionModel(constant=float((labels.sum() + 1) / (len(labels) + 1)))
    rng = np.random.default_rng(SEED)
    everything = np.concatenate(documents)
    model = AttentionModel(everything.mean(axis=0), everything.std(axis=0) + 1e-3)
    model.weights = {
        "encode": rng.normal(0, FEATURES**-0.5, (FEATURES, ENCODED)),
        "encode_b": np.zeros(ENCODED),
        "tanh": rng.normal(0, ENCODED**-0.5, (ENCODED, GATE)),
        "gate": rng.normal(0, ENCODED**-0.5, (ENCODED, GATE)),
        "attend": rng.normal(0, GATE**-0.5, GATE),
        "out": rng.normal(0, ENCODED**-0.5, ENCODED),
        "out_b": np.zeros(()),
    }
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.weights.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(documents))
        rate = RATE * (1 - epoch / EPOCHS) + RATE / 20
        for i in range(0, len(order), BATCH):
            chosen = order[i : i + BATCH]
            begins = np.concatenate([[0], np.cumsum([len(documents[j]) for j in chosen])])
            found = model.gradients(np.concatenate([documents[j] for j in chosen]), begins, labels[chosen])
            step += 1
            for name, gradient in found.items():
                weight = model.weights[name]
                gradient = gradient + DECAY * weight
                first, second = moments[name]
                first = 0.9 * first + 0.1 * gradient
                second = 0.999 * second + 0.001 * gradient**2
                moments[name] = (first, second)
                model.weights[name] = weight - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    model.mean, model.scale = model.mean.astype(np.float32), model.scale.astype(np.float32)
    model.weights = {k: np.asarray(v, dtype=np.float32) for k, v in model.weights.items()}
    return model


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "_text"):
        features, begins = passage_features(batch.column("_text"))
        packed = [features[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_label"), pa.array(packed, pa.binary())], names=["_id", "_label", "_features"]
        )


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AttentionModel:
    """Fit on at most ``sample`` labelled documents outside the held-out fold.

    The sample is that of the smallest id hashes, so it is the same at any partitioning. Rows without an id or a label
    do not count; of contradicting labels the lower one counts. Only the features of the sample reach the driver.
    """
    ident = F.col("doc_id").cast("bigint")
    known = labels.select(ident.alias("_id"), F.col("quality").cast("int").alias("_label")).filter(
        "_id is not null and _label is not null"
    )
    known = known.filter(~held_out(F.col("_id"))).groupBy("_id").agg(F.min("_label").alias("_label"))
    texts = docs.select(ident.alias("_id"), F.coalesce("text", F.lit("")).alias("_text"))
    wanted = known.join(texts.select("_id").distinct(), "_id", "left_semi").orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = texts.join(F.broadcast(wanted), "_id").mapInArrow(_packed, "_id bigint, _label int, _features binary")
    # of rows that repeat an id the smallest counts
    rows = rows.groupBy("_id").agg(F.min(F.struct("_label", "_features")).alias("_row")).select("_id", "_row.*")
    found = sorted(rows.collect(), key=lambda r: r._id)
    features = [np.frombuffer(r._features, dtype=np.float32).reshape(-1, FEATURES) for r in found]
    return fit(features, np.array([1.0 if r._label > 0 else 0.0 for r in found]))


def _score(model: AttentionModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            scores = model.score(*passage_features(batch.column("_text")))
            kept = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in kept] + [pa.array(np.clip(scores, 0, 1), pa.float64())], names=[*kept, "_score"]
            )

    return score


def _accept(model: AttentionModel):
    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            scores = model.score(*passage_features(batch.column(batch.schema.get_field_index("text"))))
            yield batch.filter(pa.array(scores >= ACCEPT))

    return accept


def accepted(docs: DataFrame, model: AttentionModel) -> DataFrame:
    """The rows of ``docs``, all columns, that ``score_quality`` predicts to be good."""
    return docs.mapInArrow(_accept(model), docs.schema)


def score_quality(docs: DataFrame, model: AttentionModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``score, predicted`` of every row of ``docs``.

    Every passage of the whole text is encoded, gated attention weighs the passages, and the weighted passage gives
    the score. Texts that are null, empty or without words are scored as one passage of zeros. Ids, labels, language
    and source are never read for a score. Every row is answered by itself; an empty table gives no rows.
    """
    names = [f"_keep{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.coalesce("text", F.lit("")).alias("_text"))
    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    scored = rows.mapInArrow(_score(model), f"{schema}, _score double")
    return scored.select(
        *[F.col(n).alias(c) for c, n in zip(keep, names)],
        F.col("_score").alias("score"),
        F.when(F.col("_score") >= ACCEPT, 1).otherwise(0).alias("predicted"),
    )
