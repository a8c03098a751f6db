"""Text probabilities by a hierarchical Pitman-Yor model of words after words, over word classes and the words in them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchweave.llm.words import by_bytes, mix, split_words
from matchweave.session import durable

#: Classes: the end of a text, the most frequent words each by itself, and the other words by their last two bytes.
FREQUENT, ENDINGS = 24, 23
CLASSES = 1 + FREQUENT + ENDINGS
#: Strength of every restaurant, and the share of its new tables that serve words not seen before.
STRENGTH, UNSEEN = 1.0, 0.5
#: Sweeps before the first sample, samples that are averaged, and seatings that one is drawn from.
BURN_IN, SAMPLES, TRIES = 1, 3, 4
#: Customers of a dish up to which the chance of each number of tables is worked out.
EXACT = 6
#: Customers beyond this many groups come in at once that are so much smaller than those seated.
STEP = 8
#: A sum of log10 probabilities goes from task to task in such parts of 1.
UNIT = 1 << 30
#: Bytes of text whose words are numbered together.
BLOCK_BYTES = 16 << 20
#: Tokens that are sorted together before they are sent.
SORTED_TOKENS = 1 << 20
#: Tokens whose contexts are seated together, and the number of the end of a text among the words.
PART_TOKENS, END = 1_000_000, 0
#: Parts that one group of rows holds; they are seated one after another.
TOGETHER = 4
#: Every seventh document by CRC-32 of its id is held out.
FOLDS, HELD_OUT = 7, 2
SEED = 11


# --- seating


def _enter(customers: np.ndarray, opening: np.ndarray, discount: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Tables of each dish after its customers (most first) came in one after another, and the log weight of that seating."""
    tables, weight = np.minimum(customers, 1).astype(np.float64), np.zeros(len(customers))
    seated = 1
    while True:
        n = int(np.searchsorted(-customers, -seated, side="left"))  # dishes with more customers than that
        if not n:
            return tables, weight
        group = max(seated // STEP, 1)
        coming = np.minimum(customers[:n] - seated, group)
        taken = discount * tables[:n]
        # one more table takes the discount off every later choice, which this foresees
        later = ((seated + (coming + 1) / 2 - taken) / (customers[:n] - taken)) ** discount
        new = opening[:n] * later
        total = new + seated + (coming - 1) / 2 - taken
        opened = (rng.random(n) * total < new).astype(np.float64) if group == 1 else rng.binomial(coming, new / total)
        weight[:n] += coming * np.log(total) - opened * np.log(later)
        tables[:n] += opened
        seated += group


def seat(customers: np.ndarray, opening: np.ndarray, discount: float, rng: np.random.Generator, tries: int = TRIES) -> np.ndarray:
    """Sample the number of tables of each dish given all others.

    A customer opens a table with weight ``opening`` or joins one with its number of guests less the discount. Customers enter one
    after another, with weights that look ahead; the weight of a seating over its chance to come about so is kept, and out of
    ``tries`` seatings one is drawn by it. With more than ``2 * STEP`` customers, groups of one in ``STEP`` of those seated
    enter at once.
    """
    if not len(customers):
        return np.zeros(0)
    order = np.argsort(-customers, kind="stable")
    ordered, weights = customers[order], np.maximum(np.broadcast_to(opening, customers.shape)[order], 1e-300)
    best, chosen = np.full(len(order), -np.inf), np.zeros(len(order))
    for _ in range(tries):
        tables, weight = _enter(ordered, weights, discount, rng)
        # the largest of the log weights plus Gumbel noise is a draw by weight
        weight += rng.gumbel(size=len(order))
        chosen = np.where(weight > best, tables, chosen)
        best = np.maximum(weight, best)
    out = np.empty(len(order))
    out[order] = np.minimum(chosen, ordered)
    return out


def tables_of(customers: np.ndarray, opening: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """As ``seat``, where most dishes have few customers: up to ``EXACT`` the weights of all numbers of tables are added up."""
    tables, many = np.minimum(customers, 1).astype(np.float64), customers > EXACT
    for n in range(2, EXACT + 1):
        some = np.flatnonzero(customers == n)
        if not len(some):
            continue
        weights, new = [np.ones(len(some))], opening[some]
        for seated in range(1, n):
            stay = [w * (seated - discount * t) for t, w in enumerate(weights, 1)] + [0.0]
            weights = [a + b for a, b in zip(stay, [0.0, *(w * new for w in weights)], strict=True)]
        sums = np.cumsum(weights, axis=0)
        tables[some] = 1 + (sums[:-1] < rng.random(len(some)) * sums[-1]).sum(axis=0)
    tables[many] = seat(customers[many].astype(np.int64), opening[many], discount, rng)
    return tables


def discount_of(counts: np.ndarray) -> float:
    """From how many dishes have one and two customers."""
    return discount_from(float((counts == 1).sum()), float((counts == 2).sum()))


def discount_from(ones: float, twos: float) -> float:
    return float(np.clip(ones / (ones + 2 * twos), 0.05, 0.95)) if ones else 0.5


def class_probabilities(counts: np.ndarray, samples: int = SAMPLES, burn_in: int = BURN_IN, tries: int = TRIES) -> np.ndarray:
    """Averaged chance of each class (last axis) after each two classes, from how often the three came together.

    The restaurant of two classes has that of the second as its parent, which has the root as its own; a table is a customer of
    the parent. A sweep seats the customers of the longest contexts given the parents' predictive
    probabilities, then those of their parents, up to the root over a uniform choice, and takes the new probabilities down again.
    """
    rng = np.random.default_rng(SEED)
    kinds = counts.shape[-1]
    pairs, ones = counts.sum(axis=0), counts.sum(axis=(0, 1))
    root = (ones + 1.0) / (ones.sum() + kinds)
    second = (pairs + root) / (pairs.sum(axis=1, keepdims=True) + 1)
    open3, open2, open1 = (counts > 0).sum(axis=-1), (pairs > 0).sum(axis=-1), int((ones > 0).sum())
    d3, d2, d1 = discount_of(counts), discount_of(pairs), discount_of(ones)
    mean = np.zeros(counts.shape)

    def seated(customers, opening, discount):
        some = customers > 0
        tables = np.zeros(customers.shape)
        tables[some] = seat(customers[some].astype(np.int64), np.broadcast_to(opening, customers.shape)[some], discount, rng, tries)
        return tables

    def predicted(customers, tables, opened, discount, parent):
        total = STRENGTH + customers.sum(axis=-1, keepdims=True)
        return (customers - discount * tables + (STRENGTH + discount * opened) * parent) / total

    for sweep in range(burn_in + samples):
        tables3 = seated(counts, (STRENGTH + d3 * open3[..., None]) * second[None], d3)
        guests2 = tables3.sum(axis=0)
        tables2 = seated(guests2, (STRENGTH + d2 * open2[:, None]) * root[None], d2)
        guests1 = tables2.sum(axis=0)
        tables1 = seated(guests1, np.full(kinds, (STRENGTH + d1 * open1) / kinds), d1)
        open3, open2, open1 = tables3.sum(axis=-1), tables2.sum(axis=-1), tables1.sum()
        root = predicted(guests1, tables1, open1, d1, np.full(kinds, 1 / kinds))
        second = predicted(guests2, tables2, open2[:, None], d2, root[None])
        if sweep >= burn_in:
            mean += predicted(counts, tables3, open3[..., None], d3, second[None]) / samples
    return mean


# --- words after words


@dataclass
class Contexts:
    """Which words came after which two, each three once: first, middle and last word, and how often they were learnt."""

    one: np.ndarray
    two: np.ndarray
    word: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, one: np.ndarray, two: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[Contexts, np.ndarray]:
        """From three words in any order; also where each went."""
        order = _order(one, two, word)
        new = _changes(one[order], two[order], word[order])
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.cumsum(new) - 1
        first = order[new]
        return cls(one[first], two[first], word[first], np.bincount(place, weights=n, minlength=len(first))), place

    def __post_init__(self):
        self.context = np.cumsum(_changes(self.one, self.two)) - 1
        self.words, self.last = np.unique(self.word, return_inverse=True)
        self.found = None

    def pairs(self, split: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pair of the last two words in each three, and of each pair its first word's number and its last's."""
        if split:
            return self.last, np.zeros(len(self.words), dtype=np.int64), np.arange(len(self.words))
        if self.found is None:
            order = _order(self.one, self.last)
            new = _changes(self.one[order], self.last[order])
            pair = np.empty(len(order), dtype=np.int64)
            pair[order] = np.cumsum(new) - 1
            self.found = pair, np.cumsum(_changes(self.one[order][new])) - 1, self.last[order][new]
        return self.found

    def guess(self, split: bool) -> np.ndarray:
        """Chance of each of ``words`` in the parent of all, if every dish had one table."""
        pair, _, last = self.pairs(split)
        found = np.bincount(pair, weights=self.n > 0, minlength=len(last))
        kinds = np.bincount(last, weights=found if split else found > 0, minlength=len(self.words))
        return (kinds + 1) / (kinds.sum() + len(kinds))

    def sampled(self, parent: np.ndarray, split: bool, rng: np.random.Generator, samples: int, burn_in: int) -> tuple[np.ndarray, np.ndarray]:
        """Averaged chance of each last word after its two, and customers that each of ``words`` sends to the parent at last.

        The restaurant of two words has that of the nearer one as its parent, and this the restaurant without context,
        whose probabilities are ``parent``. With ``split``, all threes have the same nearer word, whose restaurant has
        further threes elsewhere: ``parent`` is that restaurant. Each sweep seats the customers of two words, then those
        their tables send to the restaurant of one.
        """
        pair, near, last = self.pairs(split)
        d3, customers3 = discount_of(self.n), np.bincount(self.context, weights=self.n)
        open3 = np.bincount(self.context, weights=self.n > 0)
        above, guests = parent[last], np.bincount(pair, weights=self.n > 0, minlength=len(last))
        second = above if split else (guests + above) / (np.bincount(near, weights=guests)[near] + 1)
        open2 = np.bincount(near, weights=guests > 0)
        mean, sent = np.zeros(len(self.n)), guests
        for sweep in range(burn_in + samples):
            tables3 = tables_of(self.n, (STRENGTH + d3 * open3[self.context]) * second[pair], d3, rng)
            open3 = np.bincount(self.context, weights=tables3)
            sent = guests = np.bincount(pair, weights=tables3, minlength=len(last))
            if not split:
                d2 = discount_of(guests)
                tables2 = tables_of(guests, (STRENGTH + d2 * open2[near]) * above, d2, rng)
                open2 = np.bincount(near, weights=tables2)
                second = (guests - d2 * tables2 + (STRENGTH + d2 * open2[near]) * above) / (STRENGTH + np.bincount(near, weights=guests)[near])
                sent = np.bincount(last, weights=tables2, minlength=len(self.words))
            if sweep >= burn_in:
                new = (STRENGTH + d3 * open3[self.context]) * second[pair]
                mean += (self.n - d3 * tables3 + new) / (STRENGTH + customers3[self.context]) / samples
        return mean, sent


def _order(*columns: np.ndarray) -> np.ndarray:
    """The order by all columns, the first one first; rows that are alike come in any order."""
    joint, size = np.zeros(len(columns[0]), dtype=np.int64), 1
    for column in columns:
        kinds, number = np.unique(column, return_inverse=True)
        size *= max(len(kinds), 1)
        if size >= 1 << 63:
            return np.lexsort(columns[::-1])
        joint = joint * len(kinds) + number
    return np.argsort(joint)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


# --- texts as word numbers


def _pack(values: np.ndarray) -> bytes:
    """Four-byte numbers, byte by byte of all, so that the mostly empty ones shrink."""
    return pa.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(np.int64)


def _pack_long(values: np.ndarray) -> bytes:
    """As ``_pack``, for eight-byte numbers."""
    return pa.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpack_long(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<i8")


def _varints(values: np.ndarray) -> np.ndarray:
    """Numbers from 0 on, each as bytes of 7 bits, the lowest first; all but its last byte are 128 or more."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 7))
    out, some = np.empty((len(values), width), dtype=np.uint8), np.ones((len(values), width), dtype=bool)
    for k in range(width):
        out[:, k] = values.astype(np.uint8) & 127
        values = values >> 7
        if k + 1 < width:
            some[:, k + 1] = values > 0
            out[:, k] |= some[:, k + 1].astype(np.uint8) << 7
    return out[some]


def _from_varints(data: np.ndarray) -> np.ndarray:
    stops = np.flatnonzero(data < 128)
    starts = np.append(0, stops + 1)[:-1]
    values, some, k = (data[starts] & 127).astype(np.int64), np.flatnonzero(stops > starts), 1
    while len(some):
        values[some] |= (data[starts[some] + k] & 127).astype(np.int64) << (7 * k)
        some = some[stops[some] > starts[some] + k]
        k += 1
    return values


def _pack_alike(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Fractions of which many are alike: how many different ones there are, these, and which one each is."""
    kinds, which = np.unique(values, return_inverse=True)
    return len(kinds), _pack_long(kinds.view(np.int64)), _pack(which)


def _unpack_alike(kinds: int, different: bytes, which: bytes, n: int) -> np.ndarray:
    return _unpack_long(different, kinds).view(np.float64)[_unpack(which, n)]


def _endings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of each word's ending: its last two bytes, A-Z as a-z."""
    lower = np.arange(256)
    lower[65:91] += 32
    last = lower[data[ends - 1]]
    before = np.where(ends - starts > 1, lower[data[np.maximum(ends - 2, 0)]], 0)
    return (last * 31 + before * 7 + last // 16) % ENDINGS


BLOCK = (
    "_block bigint, _docs array<bigint>, _held array<boolean>, _sizes array<int>, _tokens binary, "
    "_words array<bigint>, _ends array<int>, _counts array<int>"
)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts: which words they have, most frequent first, how often outside held-out texts, and every text as their numbers.

    Held-out texts are the last ones of a block.
    """
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for batch in by_bytes(batches, "_text", BLOCK_BYTES):
        batch = batch.take(pc.array_sort_indices(batch.column("_held")))  # stable
        words = split_words(batch.column("_text"), lower=True)
        held = np.asarray(batch.column("_held").to_pandas(), dtype=bool)
        sizes = np.diff(words.first)
        hashes, first, inverse, often = np.unique(words.hashes, return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        tokens = place[inverse]
        learnt = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(order))
        ends = _endings(words.data, words.starts[first[order]], words.ends[first[order]])

        def one(values, kind):
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))

        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("_doc")),
                one(held, pa.bool_()),
                one(sizes, pa.int32()),
                pa.array([_pack(tokens)], pa.binary()),
                one(hashes[order].view(np.int64), pa.int64()),
                one(ends, pa.int32()),
                one(learnt, pa.int32()),
            ],
            names=[c.split()[0] for c in BLOCK.split(", ")],
        )
        number += 1


WORDS = "_bucket bigint, _block bigint, _n int, _words binary, _places binary, _ends binary, _counts binary"
ANSWERS = "_block bigint, _n int, _places binary, _ids binary, _counts binary"
VOCABULARY = "word bigint, id bigint, _end int, n bigint"
NUMBERED = f"{ANSWERS}, {VOCABULARY}"


def _table(columns: list, schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = columns or [[]] * len(fields)
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _segments(keys: np.ndarray) -> list[np.ndarray]:
    """Where each key is, in order."""
    if not len(keys):
        return []
    order = np.argsort(keys, kind="stable")
    return np.split(order, np.flatnonzero(_changes(keys[order]))[1:])


def _ask(buckets: int):
    """The words of each block by their hash, so that all blocks' words of a bucket can be numbered together."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, ends, counts = (batch.column(n)[i].values.to_numpy() for n in ("_words", "_ends", "_counts"))
                bucket, rows = (mix(words.view(np.uint64)) % np.uint64(buckets)).astype(np.int64), []
                for at in _segments(bucket):
                    packed = _pack(np.diff(at, prepend=0)), _pack(ends[at]), _pack(counts[at])
                    rows.append((int(bucket[at[0]]), batch.column("_block")[i].as_py(), len(at), words[at].tobytes(), *packed))
                yield from _table(list(zip(*rows, strict=True)), WORDS).to_batches()

    return ask


def _numbers(asked: pa.Table, buckets: int) -> tuple[list[dict], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a bucket, its words, their numbers, endings and counts, and which word each row has where; frequent words have small numbers."""
    rows = sorted(asked.to_pylist(), key=lambda r: r["_block"])
    all_words = np.concatenate([np.frombuffer(r["_words"], np.int64) for r in rows])
    ends, counts = (np.concatenate([_unpack(r[c], r["_n"]) for r in rows]) for c in ("_ends", "_counts"))
    words, which = np.unique(all_words, return_inverse=True)
    n = np.bincount(which, weights=counts).astype(np.int64)
    end = np.full(len(words), ENDINGS)
    np.minimum.at(end, which, ends)
    rank = np.empty(len(words), dtype=np.int64)
    rank[np.argsort(-n, kind="stable")] = np.arange(len(words))
    return rows, words, END + 1 + rank * buckets + rows[0]["_bucket"], end, n, which


def _bucket_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    return np.maximum(ids - END - 1, 0) % buckets


def _number_words(buckets: int):
    """The words of a bucket, and for each block numbers and counts of those it has; a row is one or the other."""

    def number(asked: pa.Table) -> pa.Table:
        rows, words, ids, end, n, which = _numbers(asked, buckets)
        out, begin = [], 0
        for r in rows:
            own = which[begin : begin + r["_n"]]
            out.append((r["_block"], r["_n"], r["_places"], _pack_long(ids[own]), _pack_long(n[own])))
            begin += r["_n"]
        answers = _table(list(zip(*out, strict=True)), ANSWERS)
        return pa.concat_tables([answers, _table([words, ids, end, n], VOCABULARY)], promote_options="default")

    return number


# --- the model


@dataclass
class Totals:
    """What every task needs to know of the corpus."""

    frequent: np.ndarray
    tokens: int
    words: int
    documents: int
    base: np.ndarray | None = None

    def classes(self, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The class of each word, by its hash and ending."""
        out = 1 + FREQUENT + ends
        if len(self.frequent):
            order = np.argsort(self.frequent)
            at = np.minimum(np.searchsorted(self.frequent[order], words), len(order) - 1)
            known = self.frequent[order][at] == words
            out = np.where(known, 1 + order[at], out)
        return out


def _histories(classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Cell of each token in a cube of three classes, for texts one after another; the class before a text is the end's."""
    one, two = _before(classes, sizes, 0)
    return (two * CLASSES + one) * CLASSES + classes


def _before(tokens: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The token before each token and the one before that, for texts one after another; before a text is ``end``."""
    stops = np.cumsum(sizes)
    one, two = np.full_like(tokens, end), np.full_like(tokens, end)
    one[1:], two[2:] = tokens[:-1], tokens[:-2]
    begins = stops[:-1]
    one[begins], two[begins] = end, end
    second = begins[sizes[1:] > 1] + 1
    two[second] = end
    return one, two


def _row(blocks: pa.RecordBatch | pa.Table, i: int, names: tuple[str, ...]) -> dict:
    """One block: its arrays, and its packed tokens."""
    row = {n: blocks.column(n)[i] for n in names}
    return {n: v.values.to_numpy(zero_copy_only=False) for n, v in row.items()} | {"_tokens": blocks.column("_tokens")[i].as_py()}


def _texts(row: dict, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Of one block: word number of each token (``end``, the number of words, stands for the end), and tokens of each text."""
    sizes = np.asarray(row["_sizes"], dtype=np.int64)
    tokens = _unpack(row["_tokens"], int(sizes.sum()))
    return np.insert(tokens, np.cumsum(sizes), end), sizes + 1


def _count_classes(totals: Totals):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cube = np.zeros(CLASSES**3, dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                row = _row(batch, i, ("_held", "_sizes", "_words", "_ends"))
                words, ends = (np.asarray(row[n], dtype=np.int64) for n in ("_words", "_ends"))
                tokens, sizes = _texts(row, len(words))
                classes = np.append(totals.classes(words, ends), 0)[tokens]
                learnt = np.repeat(~row["_held"].astype(bool), sizes)
                cube += np.bincount(_histories(classes, sizes)[learnt], minlength=len(cube))
        cells = np.flatnonzero(cube)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(cube[cells])], names=["cell", "n"])

    return count


@dataclass
class Restaurants:
    """One restaurant of words for each ending: words, customers and, for each sample, tables of the sweep before."""

    words: np.ndarray
    customers: np.ndarray
    discount: float
    tables: list[np.ndarray]

    def opening(self, sweep: int) -> np.ndarray:
        """Weight of a new table with a given word."""
        share = np.where(self.words > 0, 1 - UNSEEN, 0) / np.maximum(self.words, 1)
        return (STRENGTH + self.discount * self.tables[sweep]) * share

    def seated(self, ends: np.ndarray, counts: np.ndarray, sweep: int) -> np.ndarray:
        """Tables of each word in one sweep."""
        rng = np.random.default_rng([SEED, sweep, int(counts.sum()), len(counts)])
        return tables_of(counts, self.opening(sweep)[ends], self.discount, rng)


def _sit(hall: Restaurants, sweep: int):
    def sit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ENDINGS)
        for batch in batches:
            ends, counts = (np.asarray(batch.column(n), dtype=np.int64) for n in ("_end", "n"))
            total += np.bincount(ends, weights=hall.seated(ends, counts, sweep), minlength=ENDINGS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(ENDINGS)), pa.array(total)], names=["_end", "tables"])

    return sit


def _word_logs(hall: Restaurants, samples: range, totals: Totals):
    """Averaged log10 probability of each word by its class alone; of one not learnt, that of any such word."""

    def logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, counts = (np.asarray(batch.column(n), dtype=np.int64) for n in ("_end", "n"))
            own = np.asarray(batch.column("_own").to_pandas(), dtype=bool)
            mean = np.zeros(len(ends))
            for sweep in samples:
                opening, tables = hall.opening(sweep), np.zeros(len(ends))
                some = (counts > 0) & ~own
                tables[some] = hall.seated(ends[some], counts[some], sweep)
                new = STRENGTH + hall.discount * hall.tables[sweep]
                unseen = new * np.where(hall.words > 0, UNSEEN, 1)
                mean += np.where(counts > 0, counts - hall.discount * tables + opening[ends], unseen[ends]) / (STRENGTH + hall.customers[ends])
            classes = totals.classes(np.asarray(batch.column("word"), dtype=np.int64), ends)
            value = np.where(own, 0.0, np.log10(np.where(own, 1.0, mean / len(samples)))) + np.log10(totals.base[classes])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), pa.array(value)], names=["id", "n", "value"])

    return logs


RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)


ENTRIES = "_group bigint, _part bigint, _at bigint, _n int, _first int, _learnt int, _size int, _data binary"
SENT = "_group bigint, _bucket bigint, _split bigint, _n int, _ids binary, _guests binary"
HALLS = "_split bigint, dishes double, ones double, twos double"
TOLD = "_split bigint, customers double, tables double"
PARENTS = "_group bigint, _bucket bigint, _n int, _ids binary, _kinds int, _chances binary, _which binary"
WORD_VALUES = "_bucket bigint, _n int, _ids binary, _often binary, _kinds int, _values binary, _which binary"
#: Entries that are read from their rows at once.
READ = 1 << 16


@dataclass
class Parts:
    """Where contexts are seated: by the word before, and by the two words before if the one before is very frequent."""

    n: int
    split: np.ndarray
    shares: np.ndarray
    buckets: int

    def of(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        out = (mix(one.astype(np.uint64)) % np.uint64(self.n)).astype(np.int64)
        if len(self.split):
            at = np.minimum(np.searchsorted(self.split, one), len(self.split) - 1)
            some = self.split[at] == one
            share = (mix(two[some].astype(np.uint64)) % self.shares[at[some]].astype(np.uint64)).astype(np.int64)
            out[some] = self.n + (np.cumsum(self.shares) - self.shares)[at[some]] + share
        return out

    def group(self, part: int) -> int:
        """Parts that are in one group; one of a frequent word is alone."""
        return part // TOGETHER if part < self.n else part

    def word(self, part: int) -> int:
        """The frequent word whose contexts are split over this part and others, or -1."""
        return -1 if part < self.n else int(self.split[np.searchsorted(np.cumsum(self.shares), part - self.n, side="right")])


def _send(totals: Totals, parts: Parts, step: int):
    """Of a block, which words follow which two in which text, by part; and, in a group below 0, what else is known of its texts."""

    def send(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        row = _row(blocks, 0, ("_held", "_sizes"))
        at, docs, held = blocks.column("_at")[0].as_py(), blocks.column("_docs")[0].values, row["_held"].astype(bool)
        answers = answers.to_pylist()
        words = sum(r["_n"] for r in answers)
        counts, ids = np.zeros(words + 1, dtype=np.int64), np.full(words + 1, END, dtype=np.int64)
        for r in answers:
            places = np.cumsum(_unpack(r["_places"], r["_n"]))
            counts[places], ids[places] = _unpack_long(r["_counts"], r["_n"]), _unpack_long(r["_ids"], r["_n"])
        counts[-1] = totals.documents
        tokens, sizes = _texts(row, words)
        begins = np.cumsum(sizes) - sizes
        known = np.add.reduceat((counts > 0)[tokens].astype(np.int64), begins)
        base = np.add.reduceat(np.log10((counts + 1) / (totals.tokens + totals.words + 1))[tokens], begins)
        marks, learnt = held + 2 * np.asarray(docs.is_null()), int((~held).sum())
        kept = np.concatenate([docs.fill_null(0).to_numpy(), marks, known, sizes, base.view(np.int64)])
        rows = [(-1 - at, -1, at, len(sizes), 0, learnt, 8 * len(kept), _pack_long(kept))]

        # words of the block by their numbers, so that sorted ones are near each other; the end is the first
        by = np.argsort(ids)
        ids, place = ids[by], np.empty(len(by), dtype=np.int64)
        place[by] = np.arange(len(by))
        tokens = place[tokens]
        for texts in _segments((np.cumsum(sizes) - 1) // step):
            lo, hi = texts[0], texts[-1] + 1
            own = tokens[begins[lo] : begins[lo] + sizes[lo:hi].sum()]
            one, two = _before(own, sizes[lo:hi], END)
            near, far = one << 32 | two, own << 32 | np.repeat(np.arange(hi - lo), sizes[lo:hi])
            order = np.lexsort((far, near))
            near, far = near[order], far[order]
            first = np.flatnonzero(_changes(near, far))
            times = np.diff(first, append=len(near))
            near, far = near[first], far[first]
            one, two, word, doc = ids[near >> 32], ids[near & 0xFFFFFFFF], ids[far >> 32], far & 0xFFFFFFFF
            part = parts.of(one, two)
            order = np.argsort(part, kind="stable")
            part = part[order]
            new = _changes(part)
            starts, columns, stops = np.flatnonzero(new), [], []
            for column in chain(_differences((v[order] for v in (one, two, word, doc)), new), [times[order] - 1]):
                columns.append(_varints(column))
                stops.append(np.append(0, np.flatnonzero(columns[-1] < 128) + 1)[np.append(starts, len(part))])
            for i, (own_part, n) in enumerate(zip(part[starts].tolist(), np.diff(starts, append=len(part)).tolist(), strict=True)):
                data = np.concatenate([c[s[i] : s[i + 1]] for c, s in zip(columns, stops, strict=True)]).tobytes()
                rows.append((parts.group(own_part), own_part, at, n, int(lo), max(learnt - int(lo), 0), len(data), _squeeze(data)))
        return _table(list(zip(*rows, strict=True)), ENTRIES)

    return send


def _squeeze(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def _differences(columns: Iterable[np.ndarray], new: np.ndarray) -> Iterator[np.ndarray]:
    """Of sorted rows, what each column has more than the row before, if the columns before it are alike; else the value itself."""
    for column in columns:
        more = np.where(new, column, np.diff(column, prepend=0))
        new = new | (more != 0)
        yield more


def _sums(columns: Iterable[np.ndarray], new: np.ndarray) -> list[np.ndarray]:
    """The columns that have these ``_differences``."""
    out = []
    for column in columns:
        total, starts = np.cumsum(column), np.flatnonzero(new)
        out.append(total - np.repeat(total[starts] - column[starts], np.diff(starts, append=len(total))))
        new = new | (column != 0)
    return out


def _by_part(entries: pa.Table) -> list[tuple[int, list[dict]]]:
    """Rows of each part of a group."""
    rows = sorted(entries.to_pylist(), key=lambda r: (r["_part"], r["_at"], r["_first"]))
    return [(part, list(own)) for part, own in groupby(rows, key=lambda r: r["_part"])]


def _received(rows: list[dict]) -> tuple[Contexts, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Contexts of a part; of each entry its place there, text and times; block and entries of each row."""
    n = np.array([r["_n"] for r in rows])
    stops = np.cumsum(n)
    three, (doc, times) = np.empty((3, stops[-1]), dtype=np.int64), np.empty((2, stops[-1]), dtype=np.int32)
    learnt = np.empty(stops[-1], dtype=bool)
    for some in _segments((stops - n) // READ):
        own = rows[some[0] : some[-1] + 1]
        values = _from_varints(np.frombuffer(b"".join(pa.decompress(r["_data"], r["_size"], codec="zstd", asbytes=True) for r in own), np.uint8))
        columns = np.concatenate([v.reshape(5, -1) for v in np.split(values, np.cumsum(5 * n[some])[:-1])], axis=1)
        new = np.zeros(columns.shape[1], dtype=bool)
        new[np.cumsum(n[some]) - n[some]] = True
        at = slice(stops[some[0]] - n[some[0]], stops[some[-1]])
        *three[:, at], text = _sums(columns[:4], new)
        learnt[at] = text < np.repeat([r["_learnt"] for r in own], n[some])
        doc[at], times[at] = text + np.repeat([r["_first"] for r in own], n[some]), columns[4] + 1
    contexts, place = Contexts.of(*three, times * learnt)
    return contexts, place, doc, times, [(r["_at"], r["_n"]) for r in rows]


def _first_seating(parts: Parts):
    """Customers that the contexts of a group send to the restaurant without context, or to that of their frequent word."""

    def seated(entries: pa.Table) -> pa.Table:
        group = entries.column("_group")[0].as_py()
        if group < 0:
            return _table([], SENT)
        words, guests, split = np.zeros(0, dtype=np.int64), np.zeros(0), -1
        for part, own in _by_part(entries):
            contexts, split = _received(own)[0], parts.word(part)
            _, sent = contexts.sampled(contexts.guess(split >= 0), split >= 0, np.random.default_rng([SEED, 0, part]), 1, BURN_IN)
            words, which = np.unique(np.concatenate([words, contexts.words]), return_inverse=True)
            guests = np.bincount(which, weights=np.concatenate([guests, sent]))
        buckets, rows = _bucket_of(words, parts.buckets), []
        for at in _segments(buckets):
            packed = _pack_long(np.diff(words[at], prepend=0)), _pack(guests[at])
            rows.append((group, int(buckets[at[0]]), split, len(at), *packed))
        return _table(list(zip(*rows, strict=True)), SENT)

    return seated


def _gathered(sent: pa.Table) -> tuple[list[dict], np.ndarray, np.ndarray, np.ndarray]:
    """What parts sent for the words of a bucket: rows, and of each word in each row the frequent word (or -1), the word and the customers."""
    rows = sorted(sent.to_pylist(), key=lambda r: r["_group"])
    split = np.repeat([r["_split"] for r in rows], [r["_n"] for r in rows])
    ids = np.concatenate([np.cumsum(_unpack_long(r["_ids"], r["_n"])) for r in rows])
    return rows, split, ids, np.concatenate([_unpack(r["_guests"], r["_n"]) for r in rows])


def _grouped(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row of each group of alike rows, and the group of each row."""
    order = _order(*columns)
    new = _changes(*(c[order] for c in columns))
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    return order[new], group


def _pack_values(buckets: int):
    """Words, how often they were learnt and their values, by bucket."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, often, values = (batch.column(c).to_numpy() for c in ("id", "n", "value"))
            order = np.argsort(ids)
            ids, often, values, rows = ids[order], often[order], values[order], []
            bucket = _bucket_of(ids, buckets)
            for at in _segments(bucket):
                own = int(bucket[at[0]])
                ranks = (ids[at] - (END + 1 + own)) // buckets
                rows.append((own, len(at), _pack_long(np.diff(ranks, prepend=0)), _pack_long(often[at]), *_pack_alike(values[at])))
            yield from _table(list(zip(*rows, strict=True)), WORD_VALUES).to_batches()

    return pack


def _word_values(packed: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of a bucket, how often they were learnt and their values."""
    rows = packed.to_pylist()
    ids = [np.cumsum(_unpack_long(r["_ids"], r["_n"])) * buckets + (END + 1 + r["_bucket"]) for r in rows]
    often = [_unpack_long(r["_often"], r["_n"]) for r in rows]
    values = [_unpack_alike(r["_kinds"], r["_values"], r["_which"], r["_n"]) for r in rows]
    return tuple(np.concatenate(v) if v else np.zeros(0) for v in (ids, often, values))


def _halls(sent: pa.Table) -> pa.Table:
    """Of each frequent word's restaurant, how many dishes it has in a bucket, and how many of them with one and two customers."""
    _, split, ids, guests = _gathered(sent)
    some = split >= 0
    if not some.any():
        return _table([], HALLS)
    first, group = _grouped(split[some], ids[some])
    n, words = np.bincount(group, weights=guests[some]), split[some][first]
    kinds, which = np.unique(words, return_inverse=True)
    return _table([kinds, *(np.bincount(which, weights=found) for found in (n > 0, n == 1, n == 2))], HALLS)


def _without_context(totals: Totals, discount: float, buckets: int, told: bool):
    """Seat what all parts sent for some words: in the restaurants of frequent words, and theirs and all others in that without context.

    At first this gives the customers and tables of these restaurants, without context as word -1. Where these are told for all
    words, it gives the chances of the words in the restaurant that is the parent of all in a group.
    """

    def seated(sent: pa.Table, values: pa.Table) -> pa.Table:
        if not sent.num_rows:
            return _table([], PARENTS if told else TOLD)
        rows, split, word, guests = _gathered(sent)
        rng = np.random.default_rng([SEED, 1, rows[0]["_bucket"]])
        ids, n, logs = _word_values(values, buckets)
        ids, n, logs = np.append(ids, END), np.append(n, totals.documents), np.append(logs, np.log10(totals.base[0]))
        by = np.argsort(ids)
        first2, group2 = _grouped(split, word)
        first1, group1 = _grouped(word[first2])
        at = by[np.searchsorted(ids[by], word[first2][first1])]
        base, often = 10 ** logs[at], (n[at] + 1) / (totals.tokens + totals.words + 1)

        # a group seats its own restaurants, so that the customers it sends are tables; those of a frequent word are seated here
        guests2 = np.bincount(group2, weights=guests)
        tables2, halls = guests2.copy(), {r["_split"]: (r["discount2"], r["open2"]) for r in rows if r["_split"] >= 0}
        for hall, (d, opened) in sorted(halls.items()):
            own = split[first2] == hall
            tables2[own] = tables_of(guests2[own], (STRENGTH + d * opened) * often[group1[own]], d, rng)
        guests1 = np.bincount(group1, weights=tables2)
        tables1 = tables_of(guests1, (STRENGTH + discount * totals.words) * base, discount, rng)

        if not told:
            out = [(-1, guests1.sum(), tables1.sum())]
            for hall in sorted(halls):
                own = split[first2] == hall
                out.append((hall, guests2[own].sum(), tables2[own].sum()))
            return _table(list(zip(*out, strict=True)), TOLD)
        alone = (guests1 - discount * tables1 + (STRENGTH + discount * rows[0]["t1"]) * base) / (STRENGTH + rows[0]["c1"])
        out, begin = [], 0
        for r in rows:
            pair = group2[begin : begin + r["_n"]]
            begin += r["_n"]
            p = alone[group1[pair]]
            if r["_split"] >= 0:
                d = r["discount2"]
                p = ((guests2 - d * tables2)[pair] + (STRENGTH + d * r["t2"]) * p) / (STRENGTH + r["c2"])
            out.append((r["_group"], r["_bucket"], r["_n"], r["_ids"], *_pack_alike(p)))
        return _table(list(zip(*out, strict=True)), PARENTS)

    return seated


def _parents(sent: DataFrame, values: DataFrame, totals: Totals, parts: Parts, discount: float) -> DataFrame:
    """For each group the words it has, by bucket, with their chance in the restaurant that is the parent of all its own."""
    sent = sent.repartition("_bucket")
    if len(parts.split):
        found = sent.groupBy("_bucket").applyInArrow(_halls, HALLS).groupBy("_split").agg(*(F.sum(c).alias(c) for c in ("dishes", "ones", "twos")))
        share = F.greatest(F.lit(0.05), F.least(F.lit(0.95), F.col("ones") / (F.col("ones") + 2 * F.col("twos"))))
        found = found.select("_split", F.when(F.col("ones") > 0, share).otherwise(0.5).alias("discount2"), F.col("dishes").alias("open2"))
        sent = sent.join(F.broadcast(found), "_split", "left")
    else:
        sent = sent.withColumns({"discount2": F.lit(None).cast("double"), "open2": F.lit(None).cast("double")})
    words = values.mapInArrow(_pack_values(parts.buckets), WORD_VALUES).groupBy("_bucket")
    told = sent.groupBy("_bucket").cogroup(words).applyInArrow(_without_context(totals, discount, parts.buckets, False), TOLD)
    told = told.groupBy("_split").agg(F.sum("customers").alias("c"), F.sum("tables").alias("t"))
    root = told.groupBy().agg(*(F.max(F.when(F.col("_split") == -1, F.col(c))).alias(f"{c}1") for c in "ct"))
    sent = sent.crossJoin(F.broadcast(root)).join(F.broadcast(told.withColumnsRenamed({"c": "c2", "t": "t2"})), "_split", "left")
    return sent.groupBy("_bucket").cogroup(words).applyInArrow(_without_context(totals, discount, parts.buckets, True), PARENTS)


def _score(parts: Parts):
    """Log10 probabilities that a group has for the texts of each block."""

    def score(entries: pa.Table, parents: pa.Table) -> pa.Table:
        group = entries.column("_group")[0].as_py()
        if group < 0:
            return entries
        rows = parents.to_pylist()
        words = np.concatenate([np.cumsum(_unpack_long(r["_ids"], r["_n"])) for r in rows])
        chances = np.concatenate([_unpack_alike(r["_kinds"], r["_chances"], r["_which"], r["_n"]) for r in rows])
        order = np.argsort(words)
        words, chances, sums = words[order], chances[order], {}
        for part, own in _by_part(entries):
            contexts, place, doc, times, blocks = _received(own)
            parent = chances[np.searchsorted(words, contexts.words)]
            mean, _ = contexts.sampled(parent, parts.word(part) >= 0, np.random.default_rng([SEED, 2, part]), SAMPLES, BURN_IN)
            logs, begin = np.log10(mean)[place] * times, 0
            for at, n in blocks:
                found = np.bincount(doc[begin : begin + n], weights=logs[begin : begin + n])
                have = sums.get(at, np.zeros(0))
                if len(have) < len(found):
                    have, found = found, have
                have[: len(found)] += found
                sums[at] = have
                begin += n
        out = []
        for at, found in sums.items():
            texts = np.flatnonzero(found)
            data = _varints(np.concatenate([np.diff(texts, prepend=0), np.rint(-found[texts] * UNIT).astype(np.int64)])).tobytes()
            out.append((group, 0, at, len(texts), 0, 0, len(data), _squeeze(data)))
        return _table(list(zip(*out, strict=True)), ENTRIES)

    return score


def _add(totals: Totals):
    """Rows of the texts of one block, from what is known of them and from the sums of all parts."""

    def add(rows: pa.Table) -> pa.Table:
        known, *sums = sorted(rows.to_pylist(), key=lambda r: r["_part"])
        n = known["_n"]
        docs, marks, words, sizes, base = _unpack_long(known["_data"], 5 * n).reshape(5, n)
        scores = np.zeros(n)
        for r in sums:
            texts, found = _from_varints(np.frombuffer(pa.decompress(r["_data"], r["_size"], codec="zstd", asbytes=True), np.uint8)).reshape(2, -1)
            scores[np.cumsum(texts)] -= found
        held, ids = marks % 2 == 1, pa.array(docs, pa.int64(), mask=marks >= 2)
        return _table([ids, held, sizes, words, np.full(n, totals.tokens), base.view(np.float64), scores / UNIT], RESULT)

    return add


def score_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    Tokens are white-space separated words with A-Z lower-cased, and one end for each text. Rows whose CRC-32 of the id
    leaves 2 when divided by 7 are held out (a null id is not); the model learns from all others. ``base_score`` is add-one smoothing of single
    tokens. ``score`` is the log10 probability of the text: that of each token's class after the two classes before it,
    by restaurants for two classes, one and none, each the parent of the longer ones; and that of the word in its class, by one
    restaurant per class, in which half of what new tables serve is kept for words not learnt. Probabilities are
    averaged over samples of the seating.

    Null and empty texts are one end token. Rows that repeat an id are scored each and learnt from each. Without rows to learn
    from, classes are equally likely. An empty table gives no rows; other columns are not read.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_doc"), held.alias("_held"), F.coalesce("text", F.lit("")).alias("_text"))
    blocks = durable(rows.mapInArrow(_encode, BLOCK))
    buckets = max(1, blocks.count())
    asked = blocks.select("_block", "_words", "_ends", "_counts").mapInArrow(_ask(buckets), WORDS).groupBy("_bucket")
    numbered = durable(asked.applyInArrow(_number_words(buckets), NUMBERED))
    vocabulary = numbered.filter("_block is null").select("word", "id", "_end", "n")

    learnt = vocabulary.filter("n > 0")
    documents = blocks.select(F.explode("_held").alias("_held")).filter("not _held").count()
    top = learnt.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    size = learnt.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).first()
    totals = Totals(np.array([r.word for r in top], dtype=np.int64), (size.n or 0) + documents, size.words + (documents > 0), documents)

    counted = blocks.select("_held", "_sizes", "_tokens", "_words", "_ends").mapInArrow(_count_classes(totals), "cell bigint, n bigint")
    cube = np.zeros(CLASSES**3, dtype=np.int64)
    for r in counted.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # at most as many as the cube has
        cube[r.cell] = r.n
    cube = cube.reshape((CLASSES,) * 3)
    shares = cube.sum(axis=2) / cube.sum() if cube.any() else np.full((CLASSES, CLASSES), CLASSES**-2.0)
    totals.base = np.tensordot(shares, class_probabilities(cube), 2)

    own = F.col("word").isin([r.word for r in top])
    hall, samples = _seat_words(learnt.filter(~own))
    values = vocabulary.withColumn("_own", own).mapInArrow(_word_logs(hall, samples, totals), "id bigint, n bigint, value double")
    values = durable(values)
    parts = _parts_for(values, totals, buckets)
    answers = numbered.filter("_block is not null").select("_block", "_n", "_places", "_ids", "_counts")
    texts = blocks.select(F.col("_block").alias("_at"), "_docs", "_held", "_sizes", "_tokens")
    entries = texts.groupBy("_at").cogroup(answers.groupBy("_block")).applyInArrow(_send(totals, parts, SORTED_TOKENS), ENTRIES)
    sent = entries.groupBy("_group").applyInArrow(_first_seating(parts), SENT)
    ones = learnt.agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).first()
    parents = _parents(sent, values, totals, parts, discount_from(ones.ones, ones.twos))
    scored = entries.groupBy("_group").cogroup(parents.groupBy("_group")).applyInArrow(_score(parts), ENTRIES)
    return scored.groupBy("_at").applyInArrow(_add(totals), RESULT)


def _parts_for(values: DataFrame, totals: Totals, buckets: int) -> Parts:
    """Parts of about ``PART_TOKENS`` tokens; words before so many tokens that they fill a quarter of one get parts of their own."""
    frequent = values.filter(F.col("n") > PART_TOKENS // 4).select("id", "n").orderBy("id").collect()
    split, n = (np.array([r[c] for r in frequent], dtype=np.int64) for c in ("id", "n"))
    return Parts(max(1, -(-totals.tokens // PART_TOKENS)), split, n // PART_TOKENS + 1, buckets)


def _seat_words(learnt: DataFrame) -> tuple[Restaurants, range]:
    """Seat the words of all classes in sweeps; a sweep needs nothing of the last one but how many tables each restaurant has."""
    found = learnt.groupBy("_end").agg(
        F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")
    )
    words, customers, ones, twos = np.zeros(ENDINGS), np.zeros(ENDINGS), 0, 0
    for r in found.collect():
        words[r._end], customers[r._end], ones, twos = r.words, r.n, ones + r.ones, twos + r.twos
    hall = Restaurants(words, customers, discount_from(ones, twos), [words])
    for sweep in range(BURN_IN + SAMPLES - 1):
        tables = np.zeros(ENDINGS)
        seated = learnt.select("_end", "n").mapInArrow(_sit(hall, sweep), "_end bigint, tables double")
        for r in seated.groupBy("_end").agg(F.sum("tables").alias("tables")).collect():
            tables[r._end] = r.tables
        hall.tables.append(tables)
    return hall, range(BURN_IN, BURN_IN + SAMPLES)
