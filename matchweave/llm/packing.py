"""Packing of documents into training sequences by order-preserving dynamic programming."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchweave.llm.word_tokenizer import load
from matchweave.llm.words import by_bytes

#: Tokens of a sequence, and the id that ends each document.
LENGTH = 2048
END_ID = 1
#: Costs in padding tokens: a sequence; a cut at a sentence end; a cut inside a sentence.
SEQUENCE_COST, SENTENCE_COST, WORD_COST = 16, 4, 32
#: Sentences longer than this may be cut every so many tokens.
LONG_SENTENCE, LONG_STEP = 256, 64
#: Powers of two that may be a sequence without padding.
WHOLE = (256, 512, 1024)
#: Tokens gathered before the cuts among them are settled.
BUFFER = 256 * LENGTH

_SENTENCE = np.zeros(256, dtype=bool)
_SENTENCE[[ord(c) for c in ".!?"]] = True


def padding(length: int, size: int = LENGTH) -> int:
    """Padding of a sequence: up to ``size``, none at a power of two."""
    return 0 if length & (length - 1) == 0 else size - length


def _whole_places(places: list[int]) -> dict[int, list[int]]:
    """The places from which a sequence without padding ends at a place, where there are any."""
    at = np.array(places)
    found: dict[int, list[int]] = {}
    for whole in WHOLE:
        j = np.searchsorted(at, at - whole)
        ends = np.flatnonzero(at[j] == at - whole)
        for k, begin in zip(ends.tolist(), j[ends].tolist()):
            found.setdefault(k, []).append(begin)
    return found


def best_cuts(places: list[int], costs: list[int], size: int = LENGTH) -> tuple[list[float], list[int]]:
    """Least cost up to each place where a cut may be, and the place before it.

    ``places`` begin with 0 and rise by at most ``size``. A sequence from ``i`` to ``k`` costs its padding
    ``size - (place k - place i)``; so apart from powers of two the best ``i`` has the least ``cost + place`` among
    those in reach, which a queue of rising values gives in constant time.
    """
    whole = _whole_places(places)
    cost, before = [0.0] * len(places), [0] * len(places)
    queue: deque[tuple[float, int, int]] = deque()
    for k in range(1, len(places)):
        value = cost[k - 1] + places[k - 1]
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, k - 1, places[k - 1]))
        here = places[k]
        while here - queue[0][2] > size:
            queue.popleft()
        least, i = queue[0][0] + size - here, queue[0][1]
        if k in whole:
            for j in whole[k]:
                if cost[j] < least:
                    least, i = cost[j], j
        cost[k], before[k] = least + costs[k] + SEQUENCE_COST, i
    return cost, before


def tail_cuts(begin: int, end: int, size: int = LENGTH) -> list[int]:
    """Ends of the sequences for the last tokens: one padded one, or powers of two where that costs less."""
    length = end - begin
    parts = [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]
    if (len(parts) - 1) * (SEQUENCE_COST + WORD_COST) < padding(length, size):
        return [begin + int(p) for p in np.cumsum(parts)]
    return [end]


class _Packer:
    """Packs a stream of documents; holds at most the tokens of one buffer and one document."""

    def __init__(self, size: int, first_sequence: int):
        self.size, self.sequence = size, first_sequence
        self.docs: list[tuple] = []  # id, ids, its cut places, their costs
        self.skip = 0  # tokens of the first document that are packed
        self.total = 0
        self.out: list[tuple] = []

    def add(self, doc, ids: np.ndarray, places: np.ndarray, costs: np.ndarray) -> None:
        self.docs.append((doc, ids, places, costs))
        self.total += len(ids)

    def settle(self, last: bool) -> None:
        """Cut what is held; unless it is the ``last`` time, the end stays for the documents to come."""
        places, costs, offset = [np.zeros(1, dtype=np.int64)], [np.zeros(1, dtype=np.int64)], -self.skip
        for _, ids, own, own_costs in self.docs:
            chosen = own + offset > 0
            places.append(own[chosen] + offset)
            costs.append(own_costs[chosen])
            offset += len(ids)
        places, costs = np.concatenate(places).tolist(), np.concatenate(costs).tolist()
        if len(places) == 1:
            return
        cost, before = best_cuts(places, costs, self.size)
        k = len(places) - 1
        if not last:
            rate = cost[k] / places[k]
            k = min((i for i in range(1, len(places)) if places[i] > places[-1] - self.size), key=lambda i: cost[i] - rate * places[i])
        cuts = []
        while k:
            cuts.append(places[k])
            k = before[k]
        cuts.reverse()
        if last:
            final = cuts.pop()
            cuts += tail_cuts(cuts[-1] if cuts else 0, final, self.size)
        self._emit(cuts)

    def _emit(self, cuts: list[int]) -> None:
        begin = 0
        index, inside = 0, self.skip
        for cut in cuts:
            offset = 0
            while begin < cut:
                doc, ids, _, _ = self.docs[index]
                take = min(cut - begin, len(ids) - inside)
                piece = ids[inside : inside + take]
                self.out.append((doc, inside, take, zlib.crc32(piece), len(ids), self.sequence, offset))
                begin, inside, offset = begin + take, inside + take, offset + take
                if inside == len(ids):
                    index, inside = index + 1, 0
            self.sequence += 1
        self.total -= cuts[-1] if cuts else 0
        self.docs, self.skip = self.docs[index:], inside


PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _documents(batch: pa.RecordBatch, path: str):
    """Id, token ids, cut places and costs of every document of a batch."""
    ids, counts, words = load(path).encode(batch.column("_text"))
    stops = np.concatenate([[0], np.cumsum(counts)])
    data, n = words.data, batch.num_rows
    # all documents one after another, each with its end
    ends = stops[words.first[1:]]
    tokens = np.insert(ids, ends, END_ID).astype("<u4")
    begins, ends = stops[words.first[:-1]] + np.arange(n), ends + np.arange(n) + 1
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    after = np.concatenate([words.starts[1:], [len(data)]])
    ending = _SENTENCE[data[words.ends - 1]] | (lines[after] > lines[words.ends]) if len(counts) else np.empty(0, dtype=bool)
    text = words.text[ending]
    places = (stops[1:][ending] + text)[stops[1:][ending] + text > begins[text]]
    places = np.unique(places)
    # sentences that are too long may be cut every so many tokens
    edges = np.unique(np.concatenate([places, begins, ends]))
    gaps = np.diff(edges)
    long = gaps > LONG_SENTENCE
    inner = np.where(long, (gaps - 1) // LONG_STEP, 0)
    nth = np.arange(inner.sum()) - np.repeat(np.cumsum(inner) - inner, inner) + 1
    extra = np.repeat(edges[:-1], inner) + nth * LONG_STEP
    every = np.concatenate([places, extra, ends])
    cost = np.repeat([SENTENCE_COST, WORD_COST, 0], [len(places), len(extra), n])
    order = np.argsort(every, kind="stable")
    every, cost = every[order], cost[order]
    first = np.searchsorted(every, begins, side="right")
    last = np.searchsorted(every, ends, side="right")
    for doc, begin, end, a, b in zip(batch.column("_doc").to_pylist(), begins.tolist(), ends.tolist(), first.tolist(), last.tolist()):
        yield doc, tokens[begin:end], every[a:b] - begin, cost[a:b]


def _pack(path: str, size: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = _Packer(size, TaskContext.get().partitionId() << 40)

        def rows():
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*packer.out)], names=NAMES)
            packer.out = []
            return batch

        for batch in by_bytes(batches, "_text"):
            for document in _documents(batch, path):
                packer.add(*document)
                if packer.total >= BUFFER:
                    packer.settle(last=False)
            if packer.out:
                yield rows()
        packer.settle(last=True)
        if packer.out:
            yield rows()

    return pack


def pack_documents(docs: DataFrame, tokenizer: str, size: int = LENGTH) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece of every row of ``docs``.

    A document is its token ids by the vocabulary file ``tokenizer`` and then id 1. Documents keep the order in which
    a task reads them, and each task fills its own sequences, so nothing is shuffled. Cuts fall on ends of documents or sentences
    (line ends and words that end in ``.``, ``!`` or ``?``), and inside a sentence of more than 256 tokens; dynamic programming with a monotone queue
    takes those with the least padding and cut costs. A sequence that is no power of two long is padded to ``size``;
    a task's last sequence is cut into powers of two where that is cheaper.

    Null and empty texts are documents of one token. Repeated rows are packed each. An empty table gives no rows;
    other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_doc"), F.coalesce("text", F.lit("")).alias("_text"))
    return rows.mapInArrow(_pack(tokenizer, size), PIECES)
