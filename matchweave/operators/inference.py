"""Batched calls of pluggable models, with deterministic stand-ins that need no network.

``embed`` and ``complete`` are the only stages that leave the JVM; everything before and after is
expressions. The stand-ins are no models: one hashes words into a vector, the other counts shared
words.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchweave.functions.text import task_text
from matchweave.schemas import DOCUMENT_TASK

EmbedFn = Callable[[list[str]], np.ndarray]
CompleteFn = Callable[[list[dict]], str]

#: Texts or message lists handed to a model in one call.
MODEL_BATCH = 256
#: Characters of a model error that are kept (fixed value).
ERROR_CHARS = 200

_WORD = re.compile(r"\w+")


def hashed_embedding(dim: int) -> EmbedFn:
    """Stand-in embedder: signed word counts hashed into ``dim`` slots, scaled to length one."""

    def embed_batch(texts: list[str]) -> np.ndarray:
        slots: dict[str, tuple[int, int]] = {}
        out = np.zeros((len(texts), dim))
        for row, text in enumerate(texts):
            for word in _WORD.findall(text.lower()):
                slot = slots.get(word)
                if slot is None:
                    digest = int(hashlib.md5(word.encode()).hexdigest()[:8], 16)
                    slot = slots[word] = (digest // 2 % dim, 1 - 2 * (digest % 2))
                out[row, slot[0]] += slot[1]
        lengths = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return np.divide(out, lengths, out=out, where=lengths > 0)

    return embed_batch


def embed(
    df: DataFrame,
    fn: EmbedFn,
    dim: int,
    text: str = "raw_text",
    task: str = DOCUMENT_TASK,
    out: str = "embedding",
    batch: int = MODEL_BATCH,
) -> DataFrame:
    """Add a vector of the task-prefixed text; ``batch`` texts go to the model per call.

    Null texts get a null vector. Other columns pass through untouched.
    """
    prepared = df.drop(out).withColumn("_task_text", task_text(F.col(text), task))
    kept = [f.name for f in df.schema.fields if f.name != out]
    schema = T.StructType(
        [df.schema[name] for name in kept] + [T.StructField(out, T.ArrayType(T.FloatType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, batch):
                part = whole.slice(first, batch)
                texts = part.column("_task_text").to_pylist()
                known = [i for i, t in enumerate(texts) if t is not None]
                vectors: list = [None] * len(texts)
                if known:
                    rows = np.asarray(fn([texts[i] for i in known]), dtype=np.float32)
                    if rows.shape != (len(known), dim):
                        raise ValueError(f"the model returned shape {rows.shape}, not {(len(known), dim)}")
                    for i, row in zip(known, rows):
                        vectors[i] = row
                columns = [part.column(name) for name in kept] + [pa.array(vectors, pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, out])

    return prepared.mapInArrow(run, schema)


def shared_word_scorer(chat: list[dict]) -> str:
    """Stand-in scorer: share of the offer's words that the document has, answered as JSON."""
    question = chat[-1]["content"]
    offer, rest = question.split("\n\n[CV]\n", 1)
    document = rest.rsplit("\n\n[TASK]", 1)[0]
    wanted = list(dict.fromkeys(_WORD.findall(offer.removeprefix("[JOB]\n").lower())))
    held = set(_WORD.findall(document.lower()))
    matches = [w for w in wanted if w in held]
    gaps = [w for w in wanted if w not in held]
    score = 100 * len(matches) // len(wanted) if wanted else 0
    label = "strong_match" if score >= 75 else "weak_match" if score >= 45 else "no_match"
    return json.dumps(
        {"score": score, "key_matches": matches[:3], "gaps": gaps[:3], "recommendation": label},
        ensure_ascii=False,
    )


def last_words_answer(chat: list[dict]) -> str:
    """Stand-in for a free-form answer: the size of the context and the last thing asked."""
    return f"{len(chat)} messages in context. You asked: {chat[-1]['content']}".strip()


def sized_summary(chat: list[dict]) -> str:
    """Stand-in for a summary: the size and a digest of what was to be summarised."""
    text = chat[-1]["content"].split("\n\n", 1)[1]
    return f"{len(text)} characters, {hashlib.md5(text.encode()).hexdigest()[:8]}"


def complete(
    df: DataFrame, fn: CompleteFn, keys: list[str], chat: str = "messages", batch: int = MODEL_BATCH
) -> DataFrame:
    """Call a chat model once per row: ``keys``, the stripped ``raw`` answer, or the ``error`` text.

    A row without messages is passed on without a call.

    Only keys and messages travel to Python. A failing call becomes data and ends nothing. Calls take
    far longer than moving their text, so rows are dealt out evenly first; otherwise a few small
    rows would be put into one task.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    source = df.select(*keys, chat).repartition(tasks)
    schema = T.StructType(
        [source.schema[k] for k in keys]
        + [T.StructField("raw", T.StringType()), T.StructField("error", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, batch):
                part = whole.slice(first, batch)
                answers, errors = [], []
                for row in part.column(chat).to_pylist():
                    try:
                        answers.append(fn(row).strip() if row is not None else None)
                        errors.append(None)
                    except Exception as problem:  # noqa: BLE001 - any model failure is recorded
                        answers.append(None)
                        errors.append(str(problem))
                columns = [part.column(k) for k in keys]
                columns += [pa.array(answers, pa.string()), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keys, "raw", "error"])

    return source.mapInArrow(run, schema)
