"""Removal of passages that an earlier document already has, by FM-indexes over shards of shared text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchweave.llm.fm_index import FMIndex
from matchweave.llm.words import by_bytes, grams, mix, sequence_hashes, sliding_min, split_words, valid_runs
from matchweave.operators.scale import union_all
from matchweave.session import durable

#: Words of a window.
WINDOW = 50
#: Words of the anchors that deal windows to shards.
ANCHOR = 16
#: Different runs around one anchor up to which they stay together; beyond, they are cut into pieces.
HOT_TEXTS = 64
#: Windows of a piece, from one cut to the next.
GRAINS = (8, 2, 1)
#: Texts in the index of one shard.
SHARD_TEXTS = 4_000

LAST_ID = (1 << 63) - 1
_RADIX = 0xD6E8FEB86659FD93


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _runs(window: int, anchor: int):
    """Runs of neighbouring windows with the same anchor: the smallest hash of ``anchor`` words inside the window."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            words = split_words(batch.column("_text"))
            total = len(words.hashes)
            if total < window:
                continue
            least = sliding_min(grams(words.hashes, anchor), window - anchor + 1)
            at = np.flatnonzero(valid_runs(words.first, window, total))
            if not len(at):
                continue
            text = words.text
            least, owner = least[at], text[at]
            begin = np.flatnonzero(
                np.concatenate([[True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])])
            )
            count = np.diff(np.concatenate([begin, [len(at)]]))
            start = at[begin]
            of = owner[begin]
            whole = sequence_hashes(words.hashes, start, start + count + window - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").take(pa.array(of)),
                    batch.column("_key").take(pa.array(of)),
                    _signed(least[begin]),
                    _signed(whole),
                    pa.array((start - words.first[of]).astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                ],
                names=["_id", "_key", "_anchor", "_whole", "_first", "_count"],
            )

    return find


RUN = "_id bigint, _key bigint, _anchor bigint, _whole bigint, _first int, _count int"


def _split(window: int, anchor: int, grain: int):
    """Cut the listed runs into pieces of at most ``grain`` windows, in the same places wherever they occur.

    A window's piece is told by how far its anchor is from its begin, in steps of ``grain``; the windows of a piece
    have ``window - grain + 1`` words in common, whose hash is the key that equal windows share. With ``grain`` 1 a piece is a
    window.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            words = split_words(batch.column("_text"))
            anchors, common = grams(words.hashes, anchor), grams(words.hashes, window - grain + 1)
            rows, keys, starts, counts = [], [], [], []
            for i, runs in enumerate(batch.column("_runs").to_pylist()):
                source = (batch.column("_id")[i].as_py(), batch.column("_key")[i].as_py())
                for run in runs:
                    begin, n = int(words.first[i]) + run["_first"], run["_count"]
                    inside = anchors[begin : begin + n + window - anchor]
                    places = np.flatnonzero(inside == inside[: window - anchor + 1].min())
                    window_at = np.arange(n)
                    place = places[np.searchsorted(places, window_at)]
                    step = (place - window_at) // grain
                    cut = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (step[1:] != step[:-1])]))
                    shared = begin + place[cut] - grain * step[cut]
                    keys.append(mix(common[shared] + step[cut].astype(np.uint64) * np.uint64(_RADIX)))
                    starts.append(begin + cut)
                    counts.append(np.diff(np.concatenate([cut, [n]])))
                    rows += [(run["_anchor"], run["_whole"], int(c), *source, run["_first"] + int(c)) for c in cut]
            if rows:
                begins, sizes = np.concatenate(starts), np.concatenate(counts)
                whole = sequence_hashes(words.hashes, begins, begins + sizes + window - 1)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
                    + [pa.array(sizes.astype(np.int32)), _signed(np.concatenate(keys)), _signed(whole)],
                    names=["_in", "_of", "_offset", "_id", "_key", "_first", "_count", "_anchor", "_whole"],
                )

    return find


PIECE = (
    "_in bigint, _of bigint, _offset int, _id bigint, _key bigint, _first int, _count int, _anchor bigint, _whole bigint"
)


def _contents(window: int):
    """The words of the listed runs, joined by one space."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in by_bytes(batches, "_text"):
            rows = []
            for i, text in enumerate(batch.column("_text").to_pylist()):
                source = (batch.column("_id")[i].as_py(), batch.column("_key")[i].as_py())
                if source in done:  # a repeated row
                    continue
                done.add(source)
                words = text.encode().split()
                for run in batch.column("_runs")[i].as_py():
                    begin = run["_first"]
                    content = b" ".join(words[begin : begin + run["_count"] + window - 1])
                    rows.append((run["_level"], run["_anchor"], run["_whole"], source[0], content.decode()))
            if rows:
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["_level", "_anchor", "_whole", "_id", "_content"])

    return find


def _search(window: int):
    """Index the texts of a shard and report where windows of each have an earlier owner."""

    def find(shard: pa.Table) -> pa.Table:
        words = split_words(shard.column("_content"))
        owners = shard.column("_id").to_numpy()
        sequences = np.split(words.hashes, words.first[1:-1])
        spans = []
        for owner, first in zip(owners, FMIndex(sequences, owners, window).first_owners()):
            covered = np.concatenate([[False], first < owner, [False]])
            edges = np.flatnonzero(covered[1:] != covered[:-1])
            spans.append([{"_from": int(a), "_n": int(b - a)} for a, b in zip(edges[::2], edges[1::2])])
        kind = pa.list_(pa.struct([("_from", pa.int32()), ("_n", pa.int32())]))
        return pa.Table.from_arrays(
            [shard.column(n) for n in ("_level", "_anchor", "_whole", "_id")] + [pa.array(spans, kind)],
            names=["_level", "_anchor", "_whole", "_owner", "_spans"],
        )

    return find


FOUND = "_level int, _anchor bigint, _whole bigint, _owner bigint, _spans array<struct<_from int, _n int>>"


def _keep(window: int, with_text: bool):
    """Drop the words that the listed windows cover."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            words = split_words(batch.column("_text"))
            total = np.diff(words.first)
            removed = np.zeros(len(words.hashes) + 1, dtype=np.int64)
            for i, spans in enumerate(batch.column("_removed").to_pylist()):
                for span in spans or ():
                    begin = words.first[i] + span["_from"]
                    removed[begin] += 1
                    removed[begin + span["_n"] + window - 1] -= 1
            kept = np.cumsum(removed)[:-1] == 0
            # bytes of kept words, each followed by one space, straight from the buffer
            marks = np.zeros(len(words.data) + 1, dtype=np.int8)
            marks[words.starts[kept]] += 1
            marks[words.ends[kept]] -= 1
            sizes = np.where(kept, words.ends - words.starts + 1, 0)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            out = np.full(int(bounds[-1]), 32, dtype=np.uint8)
            letters = np.ones(len(out), dtype=bool)
            letters[bounds[1:][kept] - 1] = False
            out[letters] = words.data[np.cumsum(marks[:-1]) > 0]
            pieces = [out[bounds[a] : max(bounds[b] - 1, bounds[a])] for a, b in zip(words.first[:-1], words.first[1:])]
            kept_words = np.add.reduceat(np.append(kept, False).astype(np.int64), words.first[:-1]) * (total > 0)
            columns = [
                batch.column("_doc"),
                pa.array(total),
                pa.array(total - kept_words),
                pa.array([hashlib.sha256(p).hexdigest() for p in pieces], pa.string()),
            ]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns.append(pa.array([p.tobytes().decode() for p in pieces], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return clean


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    anchor: int = ANCHOR,
    hot_texts: int = HOT_TEXTS,
    shard_texts: int = SHARD_TEXTS,
    with_text: bool = False,
) -> DataFrame:
    r"""``doc_id, n_words, n_removed, kept_sha256`` (and ``kept_text``) of every row of ``docs``.

    Words are ``[^\x20\x09-\x0D]+`` of the whole text. A word goes if a window of ``window`` words that covers it also
    begins in a document with a smaller ``doc_id``; windows are judged on the input. The digest is that of the kept
    words, joined by one space.

    Windows are dealt to shards by content: a window belongs to its anchor, the smallest hash of ``anchor`` neighbouring
    words inside it, so equal windows meet. Neighbouring windows with the same anchor travel as one run. Anchors that
    only one document has are left out, equal runs travel once with their smallest ``doc_id``, and each shard builds
    one FM-index over its runs and streams them against it. An anchor inside more than ``hot_texts`` different runs (a
    passage that many documents quote, or many near copies) would fill a shard: its runs are cut into pieces of 8
    windows and, where need be, of two and of one, dealt by the words that all windows of a piece share; pieces whose
    key occurs once have no equal and end there. No run, document or window is dropped otherwise.

    Null text counts as empty; a document below ``window`` words keeps all. Rows that repeat a ``doc_id`` are answered
    each and never count as earlier than one another; a null ``doc_id`` counts as later than any other. An empty table
    gives no rows. Other columns are not read.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("_doc"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("_id"),
        F.coalesce("text", F.lit("")).alias("_text"),
    ).withColumn("_key", F.xxhash64("_text"))
    texts = rows.select("_id", "_key", "_text")

    all_runs = texts.mapInArrow(_runs(window, anchor), RUN)
    shared = all_runs.groupBy("_anchor").agg(F.min("_id").alias("_low"), F.max("_id").alias("_high"))
    shared = durable(shared.filter("_low < _high").select("_anchor"))
    runs = durable(all_runs.join(shared, "_anchor", "left_semi"))

    place = F.min(F.struct("_id", "_key", "_first", "_count")).alias("_at")

    def first_of(pieces: DataFrame) -> DataFrame:
        """Each different piece once, with the place of its smallest id."""
        return durable(pieces.groupBy("_anchor", "_whole").agg(place).select("_anchor", "_whole", "_at.*"))

    def listed(wanted: DataFrame) -> DataFrame:
        """Texts with the list of pieces that are wanted from them."""
        others = [c for c in wanted.columns if c not in ("_id", "_key")]
        by_text = wanted.groupBy("_id", "_key").agg(F.collect_list(F.struct(*others)).alias("_runs"))
        return texts.join(by_text, ["_id", "_key"])

    # level by level: pieces, the different ones, and which of those have keys in too many of them
    levels = [(None, first_of(runs), None)]
    for grain in (*GRAINS, None):
        _, firsts, _ = levels[-1]
        hot = firsts.groupBy("_anchor").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_texts).select("_anchor")
        levels[-1] = (*levels[-1][:2], hot)
        if grain is None or hot.isEmpty():
            break
        pieces = durable(listed(firsts.join(hot, "_anchor", "left_semi")).mapInArrow(_split(window, anchor, grain), PIECE))
        # keys that occur once have nothing to be equal to
        again = pieces.groupBy("_anchor").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_anchor")
        pieces = durable(pieces.join(again, "_anchor", "left_semi"))
        levels.append((pieces, first_of(pieces), None))

    last = len(levels) - 1
    searched = [
        (firsts if level == last else firsts.join(hot, "_anchor", "left_anti")).withColumn("_level", F.lit(level))
        for level, (_, firsts, hot) in enumerate(levels)
    ]
    searched = durable(union_all(searched))
    shards = max(1, -(-searched.count() // shard_texts))
    contents = listed(searched).mapInArrow(
        _contents(window), "_level int, _anchor bigint, _whole bigint, _id bigint, _content string"
    )
    found = durable(
        contents.withColumn("_shard", F.pmod(F.xxhash64("_anchor"), F.lit(shards)))
        .groupBy("_shard")
        .applyInArrow(_search(window), FOUND)
    )

    def spans_of(pieces: DataFrame, answers: DataFrame) -> DataFrame:
        """Spans of windows with an earlier owner, for each occurrence of a piece."""
        whole = F.array(F.struct(F.lit(0).alias("_from"), F.col("_count").alias("_n")))
        spans = F.when(F.col("_id") > F.col("_owner"), whole).otherwise(F.col("_spans"))
        joined = pieces.join(answers, ["_anchor", "_whole"]).withColumn("_spans", spans)
        return joined.filter(F.size("_spans") > 0)

    def moved(by: str) -> F.Column:
        return F.transform("_spans", lambda s: F.struct((s["_from"] + F.col(by)).alias("_from"), s["_n"].alias("_n")))

    answers = None
    for level in range(last, -1, -1):
        own = found.filter(F.col("_level") == level).drop("_level")
        if level < last:
            pieces, firsts = levels[level + 1][0], levels[level][1]
            inner = spans_of(pieces, answers).select("_in", "_of", moved("_offset").alias("_spans"))
            inner = inner.groupBy("_in", "_of").agg(F.flatten(F.collect_list("_spans")).alias("_spans"))
            inner = inner.withColumnsRenamed({"_in": "_anchor", "_of": "_whole"})
            owners = firsts.join(levels[level][2], "_anchor", "left_semi").select(
                "_anchor", "_whole", F.col("_id").alias("_owner")
            )
            own = own.unionByName(owners.join(inner, ["_anchor", "_whole"], "left"))
        answers = own

    removed = spans_of(runs, answers).select("_id", "_key", moved("_first").alias("_spans"))
    removed = removed.groupBy("_id", "_key").agg(F.flatten(F.collect_list("_spans")).alias("_removed"))
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * with_text
    return rows.join(removed, ["_id", "_key"], "left").select("_doc", "_text", "_removed").mapInArrow(
        _keep(window, with_text), schema
    )
