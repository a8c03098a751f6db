"""Near-duplicate documents by a parity-sketch join on word shingles."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchweave.llm.components import components
from matchweave.llm.words import by_bytes, grams, mix, split_words
from matchweave.operators.scale import within
from matchweave.session import durable

#: Words of a shingle and the least similarity, as numerator and denominator.
SHINGLE = 5
THRESHOLD = (80, 100)
#: Bits of one block of a sketch, as a power of two: so many that different shingles hardly ever flip the same one. With 4,096 of
#: them blocks of one shingle agreed by chance, in a number of pairs that grew with the square of the texts.
BLOCK_BITS = 32
#: Chance that a document has more empty blocks than its band allows for.
EMPTY_TAIL = 1e-6
#: Sets in one block from which it is hot, and hot blocks that a sketch may have without being in a family.
HOT_SETS, HOT_BLOCKS = 64, 3
#: Sets of a family that are compared with each other in one task, at most twice as many.
FAMILY_PART = 512
#: Shingles of a family's part, about.
FAMILY_SHINGLES = 1 << 20
#: Nodes of which a list is broadcast to pick their texts; a longer one is joined by shuffle.
BROADCAST_NODES = 500_000
#: Low bits of a block's key that tell its band.
BAND_BITS = 10

#: Sets the numbers of bits apart from other mixed numbers.
_BIT = np.uint64(0x7B1FA5D3C96E2481)


@dataclass(frozen=True)
class Band:
    """Set sizes ``low..high`` and the sketch that links them to this band and the next one.

    Two linked sets, the smaller in this band, differ in at most ``differ`` shingles. A sketch has
    ``differ + 1 + empty + hot`` blocks, so at least ``empty + hot + 1`` blocks of the two agree: one at least that is
    neither empty nor hot, if one of the two has at most ``empty`` empty and ``hot`` hot blocks.
    """

    low: int
    high: int
    differ: int
    blocks: int
    empty: int
    hot: int


def hot_blocks(differ: int) -> int:
    """Hot blocks that are left out where a sketch has no more; short texts have too few blocks to spare."""
    return min(HOT_BLOCKS, differ // 4)


def _band(low: int, high: int, num: int, den: int) -> Band:
    differ = (high + high * den // num) * (den - num) // (den + num)
    empty, hot = 0, hot_blocks(differ)
    while True:
        blocks = differ + 1 + empty + hot
        needed = min(_tail_count(blocks * math.exp(-low / blocks)), differ + 1)
        if needed <= empty:
            return Band(low, high, differ, blocks, empty, hot)
        empty = needed


def _tail_count(mean: float) -> int:
    """The smallest count that a Poisson number exceeds with a chance below ``EMPTY_TAIL``."""
    if mean > 50:
        return math.ceil(mean + 6 * math.sqrt(mean))
    count, term, tail = 0, math.exp(-mean), 1 - math.exp(-mean)
    while tail >= EMPTY_TAIL:
        count += 1
        term *= mean / count
        tail -= term
    return count


class Bands:
    """Bands of set sizes; the larger of two linked sets is in the band of the smaller or the next one."""

    def __init__(self, threshold: tuple[int, int]):
        self.num, self.den = threshold
        self.list: list[Band] = []

    def of(self, size: int) -> int:
        """Number of the band that ``size`` is in."""
        while not self.list or self.list[-1].high < size:
            last = self.list[-1].high if self.list else 0
            self.list.append(_band(last + 1, max(last + 1, last * self.den // self.num), self.num, self.den))
        low, high = 0, len(self.list) - 1
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if self.list[middle].high < size else (low, middle)
        return low


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a text of fewer than ``n`` words is one shingle, or none."""
    words = split_words(column, lower=True)
    every = grams(words.hashes, n)
    sets = []
    for begin, end in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        count = end - begin
        if count >= n:
            sets.append(np.unique(every[begin : end - n + 1]))
        else:
            sets.append(grams(words.hashes[begin:end], count) if count else np.empty(0, dtype=np.uint64))
    return sets


def set_hash(items: np.ndarray) -> int:
    """A 64-bit hash of a set, as a signed number; equal sets have equal ones."""
    total = mix(items + np.uint64(len(items)))
    pair = np.array([np.add.reduce(total), np.bitwise_xor.reduce(items)], dtype=np.uint64)
    return int(mix(pair[:1] + mix(pair[1:])).view(np.int64)[0])


def parity_bits(items: np.ndarray) -> bytes:
    """The parity sketch of a set: each shingle flips one of at least twice as many bits."""
    size = 1 << max(6, (2 * len(items) - 1).bit_length())
    flips = np.bincount(((items >> np.uint64(12)) & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((flips & 1).astype(np.uint8)).tobytes()


def bits_apart(a: bytes, b: bytes) -> int:
    """Hamming distance of two sketches, the longer folded to the shorter; never above the symmetric difference."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def sketch_keys(items: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys of the sketch blocks under which a set is filed.

    Each shingle flips one bit of the block that the head of its hash names. A block's key is a linear hash of
    its bits together with band and block number. Blocks without a bit are filed only by sets that have more of them
    than their band allows for: if all agreeing blocks of two linked sets are empty, both have that many.
    """
    found = []
    own = bands.of(len(items))
    flipped = mix((items & np.uint64((1 << BLOCK_BITS) - 1)) + _BIT)
    for number in (own, own - 1):
        if number < 0:
            continue
        band = bands.list[number]
        if not band.differ:  # only equal sets are linked
            continue
        block = ((items >> np.uint64(32)) * np.uint64(band.blocks)) >> np.uint64(32)
        begins = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        parity = np.bitwise_xor.reduceat(flipped, begins)
        named = block[begins][parity != 0]
        parity = parity[parity != 0]
        if band.blocks - len(named) > band.empty:
            missing = np.setdiff1d(np.arange(band.blocks, dtype=np.uint64), named)
            named = np.concatenate([named, missing])
            parity = np.concatenate([parity, np.zeros(len(missing), dtype=np.uint64)])
        keys = mix(mix(named + np.uint64(number << 32)) + parity) << np.uint64(BAND_BITS)
        found.append(keys | np.uint64(number & ((1 << BAND_BITS) - 1)))
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def _profile(n: int):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            sets = shingle_sets(batch.column("_text"), n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_doc"),
                    batch.column("_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([parity_bits(s) if len(s) else None for s in sets], pa.binary()),
                ],
                names=["_doc", "_key", "_size", "_set", "_bits"],
            )

    return profile


def _file(n: int, threshold: tuple[int, int]):
    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, done = Bands(threshold), set()
        for batch in by_bytes(batches, "_text"):
            keys, names, counts = [], [], []
            for items in shingle_sets(batch.column("_text"), n):
                if len(items):
                    name = set_hash(items)
                    if name not in done:  # copies in one task are filed once
                        done.add(name)
                        keys.append(sketch_keys(items, bands))
                        names.append(name)
                        counts.append(len(keys[-1]))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys).view(np.int64)),
                        pa.array(np.repeat(np.array(names, dtype=np.int64), counts)),
                    ],
                    names=["_block", "_set"],
                )

    return file


def _first_of_block(hot_sets: int):
    """Of rows in order of block and set, the further sets of each block next to its first one, and whether the block is hot.

    Of hot blocks, those with more than ``hot_sets`` sets, the first one comes too. No more rows are held back than tell that.
    """

    def out(blocks: np.ndarray, leads: np.ndarray, sets: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (blocks, leads, sets, hot)], names=["_block", "_lead", "_set", "_hot"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((2, 0), dtype=np.int64)  # the last block's sets, while they are too few to tell
        known = None  # block, first and last set of the last block, if it is known to be hot
        for batch in chain(batches, [None]):
            rows = held if batch is None else np.concatenate([held, [batch.column(c).to_numpy() for c in ("_block", "_set")]], axis=1)
            if known is not None and rows.shape[1]:
                more = int(np.searchsorted(rows[0] != known[0], True))
                sets = rows[1, :more]
                sets = sets[np.concatenate([[known[2]], sets[:-1]]) != sets] if more else sets
                if len(sets):
                    yield out(np.full(len(sets), known[0]), np.full(len(sets), known[1]), sets, np.full(len(sets), True))
                known = (known[0], known[1], rows[1, more - 1]) if more == rows.shape[1] else None
                rows = rows[:, more:]
            if not rows.shape[1]:
                held = rows
                continue
            again = np.concatenate([[False], (rows[:, 1:] == rows[:, :-1]).all(axis=0)])
            blocks, sets = rows[:, ~again]
            begins = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]]))
            counts = np.diff(begins, append=len(blocks))
            hot, ready = np.repeat(counts > hot_sets, counts), len(blocks)
            held = rows[:, :0]
            if batch is not None and hot[-1]:
                known = (blocks[-1], sets[begins[-1]], sets[-1])
            elif batch is not None:
                ready = begins[-1]
                held = np.stack([blocks[ready:], sets[ready:]])
            leads, keep = np.repeat(sets[begins], counts), hot.copy()
            keep |= ~np.isin(np.arange(len(blocks)), begins)
            keep[ready:] = False
            if keep.any():
                yield out(blocks[keep], leads[keep], sets[keep], hot[keep])

    return first


def _family_edges(hot: DataFrame, spared: list[int]) -> DataFrame:
    """Edges ``u, v`` between the sets that share a hot block, for sets with more of them than a sketch of their band can spare.

    ``hot`` has the sets of each hot block next to its first one, that one included. Blocks with one first set are counted and not listed:
    a set is tied to the first sets of its blocks, of which a family has few. Only where a first set is in no family itself
    are the blocks gone through.
    """
    hot = hot.withColumn("_band", F.col("_block").bitwiseAND((1 << BAND_BITS) - 1))
    tied = durable(hot.groupBy("_lead", "_set", "_band").agg(F.count(F.lit(1)).alias("_n")))
    most = F.element_at(F.array(*[F.lit(n) for n in spared]), F.col("_band").cast("int") + 1)
    many = tied.groupBy("_set", "_band").agg(F.sum("_n").alias("_n")).filter(F.col("_n") > most).select("_set", "_band")
    many = durable(many.withColumn("_in", F.lit(True)))
    leads = many.select(F.col("_set").alias("_lead"), "_band", F.col("_in").alias("_led"))
    close = durable(tied.join(many, ["_set", "_band"], "left_semi").join(leads, ["_lead", "_band"], "left"))
    loose = close.filter("_led is null").select("_lead", "_band").distinct()
    rows = hot.join(loose, ["_lead", "_band"], "left_semi").join(many, ["_set", "_band"], "left_semi").select("_block", "_set")
    rows = durable(rows)
    least = rows.groupBy("_block").agg(F.min("_set").alias("v"))
    edges = rows.join(least, "_block").select(F.col("_set").alias("u"), "v")
    return edges.unionByName(close.filter("_led").select(F.col("_set").alias("u"), F.col("_lead").alias("v"))).distinct()


def _pairs_of_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of block, the pairs in each block that differ in component and in family."""
    block, held = None, []
    for batch in batches:
        out: tuple[list, list] = ([], [])
        for b, *row in zip(*(batch.column(x).to_pylist() for x in ("_block", "_set", "_part", "_family"))):
            if b != block:
                block, held = b, []
            for other, part, family in held:
                if part != row[1] and (family is None or family != row[2]):
                    out[0].append(other)
                    out[1].append(row[0])
            held.append(row)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["u", "v"])


def _compare(threshold: tuple[int, int]):
    """Links among the sets of two parts of a family, as one edge from each set to the smallest one it reaches."""
    num, den = threshold

    def compare(table: pa.Table) -> pa.Table:
        names = table.column("_set").to_numpy()
        lists = table.column("_items").combine_chunks()
        sizes = np.asarray(lists.value_lengths()).astype(np.int64)
        items = lists.flatten().to_numpy()
        rows = np.repeat(np.arange(len(names)), sizes)
        # shingles of one set only add nothing to an intersection
        _, column, count = np.unique(items, return_inverse=True, return_counts=True)
        shared = count[column] > 1
        number = np.cumsum(count > 1) - 1
        rows, column = rows[shared], number[column[shared]]
        both = np.zeros((len(names), len(names)), dtype=np.float32)
        order = np.argsort(column, kind="stable")
        rows, column = rows[order], column[order]
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            part = slice(*np.searchsorted(column, [first, first + COLUMNS]))
            matrix = np.zeros((len(names), COLUMNS), dtype=np.float32)
            matrix[rows[part], column[part] - first] = 1
            both += matrix @ matrix.T
        common = both.astype(np.int64)
        linked = den * common >= num * (sizes[:, None] + sizes[None, :] - common)
        label = np.arange(len(names))
        while True:
            least = np.where(linked, label[None, :], len(names)).min(axis=1)
            least = np.minimum(label, least)
            if (least == label).all():
                break
            label = least
        found = np.flatnonzero(label != np.arange(len(names)))
        return pa.table({"u": pa.array(names[found]), "v": pa.array(names[label[found]])})

    return compare


#: Shingles whose columns are multiplied at once.
COLUMNS = 2048


def _sets(n: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            if batch.num_rows:
                lists = [items.view(np.int64) for items in shingle_sets(batch.column("_text"), n)]
                sizes = np.array([len(x) for x in lists])
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                items = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists)))
                yield pa.RecordBatch.from_arrays([batch.column("_set"), pa.array(sizes, pa.int64()), items], names=["_set", "_size", "_items"])

    return sets


def _near(threshold: tuple[int, int]):
    """Keep the pairs whose sizes and sketches allow a link."""
    num, den = threshold

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(x).to_pylist() for x in ("_size", "_bits", "_size2", "_bits2"))
            kept = [
                num * max(n, m) <= den * min(n, m) and bits_apart(a, b) <= (n + m) * (den - num) // (den + num)
                for n, a, m, b in zip(*columns)
            ]
            yield batch.select(["u", "v", "_agree"]).filter(pa.array(kept, pa.bool_()))

    return near


def _verify(threshold: tuple[int, int]):
    num, den = threshold

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for i in range(batch.num_rows):
                a = batch.column("_items")[i].values.to_numpy()
                b = batch.column("_others")[i].values.to_numpy()
                both = len(a) + len(b) - len(np.union1d(a, b))
                linked.append(den * both >= num * (len(a) + len(b) - both))
            yield batch.select(["u", "v"]).filter(pa.array(linked, pa.bool_()))

    return verify


def near_duplicates(
    docs: DataFrame,
    n: int = SHINGLE,
    threshold: tuple[int, int] = THRESHOLD,
    keys: bool = False,
    hot_sets: int = HOT_SETS,
    family_part: int = FAMILY_PART,
    family_shingles: int = FAMILY_SHINGLES,
) -> DataFrame:
    r"""``doc_id, n_shingles, component_id`` of every row of ``docs``; with ``keys`` also ``text_key`` (a hash of the text)
    and ``group_key`` (the same for all rows of a component, null without shingles).

    A-Z are lower-cased; words are ``[^\x20\x09-\x0D]+`` of the whole text; a document's set holds its distinct
    shingles of ``n`` words, or its whole sequence if it has fewer words. Two documents are linked if
    ``den * intersection >= num * union``. ``component_id`` is the smallest ``doc_id`` reachable by links.

    Equal sets become one node, named by a 64-bit hash of the set. Each set is cut into blocks of a parity sketch, as
    many as two linked sets of its size band can differ plus one (and a few for empty and hot blocks), so linked sets
    agree in a block that both are filed under. Pairs from a block (every set with the first one of the block, then
    those that are still in different components) go on if their whole sketches differ in no more bits than linked
    sets can differ in shingles, and are then verified by their shingle sets.

    A block with more than ``hot_sets`` sets is hot. It brings together only sets with more hot blocks than a sketch
    can spare, which two linked sets either both have or need not meet there. Such sets form families (many near copies of one text); a
    family is compared whole, in parts of about ``family_part`` sets and ``family_shingles`` shingles at most, by multiplying
    the incidence of its shingles, so no pairs are written out. All links between different components are found either way.

    Null and empty texts and texts without words have no shingles and no link. Rows that repeat a ``doc_id`` are
    answered each. A null ``doc_id`` is linked as any other and is the smallest only where no other is there. An
    empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_doc"), F.coalesce("text", F.lit("")).alias("_text"))
    rows = rows.withColumn("_key", F.xxhash64("_text"))
    profiles = durable(rows.mapInArrow(_profile(n), "_doc bigint, _key bigint, _size bigint, _set bigint, _bits binary"))

    filed = rows.select("_text").mapInArrow(_file(n, threshold), "_block bigint, _set bigint")
    in_order = filed.repartition("_block").sortWithinPartitions("_block", "_set")
    members = durable(in_order.mapInArrow(_first_of_block(hot_sets), "_block bigint, _lead bigint, _set bigint, _hot boolean"))

    # hot blocks count only for sets that have more of them than their band can spare: families of near copies
    bands = Bands(threshold)
    bands.of(1 << 40)
    ties = _family_edges(members.filter("_hot").drop("_hot"), [band.hot for band in bands.list])
    members = members.filter("not _hot")
    pairs = durable(members.groupBy("_lead", "_set").agg(F.count(F.lit(1)).alias("_agree")))

    nodes = pairs.select(F.explode(F.array("_lead", "_set")).alias("_set")).distinct()
    sketches = durable(
        profiles.join(nodes, "_set", "left_semi").groupBy("_set").agg(F.min("_size").alias("_size"), F.min("_bits").alias("_bits"))
    )

    def sets_of(nodes: DataFrame) -> DataFrame:
        """Shingle sets of the nodes, one row each, from one text each: copies in many partitions are made one first."""
        texts = durable(profiles.join(nodes, "_set", "left_semi").groupBy("_set").agg(F.min("_key").alias("_key")))
        if within(texts, BROADCAST_NODES):
            texts = F.broadcast(texts)
        chosen = rows.select("_key", "_text").join(texts, "_key").select("_set", "_text").dropDuplicates(["_set"])
        return durable(chosen.mapInArrow(_sets(n), "_set bigint, _size bigint, _items array<bigint>"))

    # each family whole, part by part: links come out as one edge for each set
    families = durable(components(ties))
    families = families.select(F.col("node").alias("_set"), F.col("component").alias("_family"))
    sets = sets_of(families.select("_set"))
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(family_part), F.sum("_size") / F.lit(family_shingles))).cast("int")
    size = families.join(sets.select("_set", "_size"), "_set").groupBy("_family").agg(parts.alias("_parts"))
    placed = families.join(size, "_family").join(sets, "_set")
    own = F.pmod(F.xxhash64("_set"), F.col("_parts")).cast("int")
    placed = placed.select("_set", "_items", "_family", own.alias("_own"), F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_other"))
    met = placed.groupBy("_family", F.least("_own", "_other").alias("_a"), F.greatest("_own", "_other").alias("_b"))
    edges = durable(met.applyInArrow(_compare(threshold), "u bigint, v bigint"))
    labels = None

    def linked(wanted: DataFrame) -> DataFrame:
        wanted = durable(wanted)
        sets = sets_of(wanted.select(F.explode(F.array("u", "v")).alias("_set")).distinct())
        first = sets.select(F.col("_set").alias("u"), "_items")
        second = sets.select(F.col("_set").alias("v"), F.col("_items").alias("_others"))
        return durable(wanted.join(first, "u").join(second, "v").mapInArrow(_verify(threshold), "u bigint, v bigint"))

    def placed_in(wanted: DataFrame, name: str) -> DataFrame:
        """Add the component and the family of each named node."""
        family = families.select(F.col("_set").alias(name), F.col("_family").alias(f"{name}_family"))
        wanted = wanted.join(family, name, "left")
        if labels is None:
            return wanted.withColumn(f"{name}_part", F.col(name))
        part = labels.select(F.col("node").alias(name), F.col("component").alias(f"{name}_part"))
        return wanted.join(part, name, "left").withColumn(f"{name}_part", F.coalesce(f"{name}_part", name))

    def apart(wanted: DataFrame) -> DataFrame:
        """Pairs of different components that no family has compared."""
        known = placed_in(placed_in(wanted, "u"), "v")
        compared = F.coalesce(F.col("u_family") == F.col("v_family"), F.lit(False))
        return known.filter((F.col("u_part") != F.col("v_part")) & ~compared).select(wanted.columns)

    def near(wanted: DataFrame) -> DataFrame:
        """Pairs whose sketches differ in no more bits than two linked sets can differ in shingles."""
        first = sketches.select(F.col("_set").alias("u"), "_size", "_bits")
        second = sketches.select(F.col("_set").alias("v"), F.col("_size").alias("_size2"), F.col("_bits").alias("_bits2"))
        found = wanted.join(first, "u").join(second, "v")
        return durable(found.mapInArrow(_near(threshold), "u bigint, v bigint, _agree bigint"))

    # the other blocks hold few sets: compare with the first one, best agreement first, then whatever is still apart
    asked = near(apart(pairs.select(F.col("_lead").alias("u"), F.col("_set").alias("v"), "_agree")))
    best = asked.groupBy("v").agg(F.max(F.struct("_agree", "u")).alias("_best"))
    edges = edges.unionByName(linked(best.select(F.col("_best.u").alias("u"), "v")))
    labels = durable(components(edges))
    marked = placed_in(members.select("_block", "_set"), "_set").withColumnsRenamed({"_set_part": "_part", "_set_family": "_family"})
    mixed = marked.groupBy("_block").agg(F.min("_part").alias("_a"), F.max("_part").alias("_b")).filter("_a <> _b")
    marked = marked.join(mixed.select("_block"), "_block", "left_semi")
    rest = marked.repartition("_block").sortWithinPartitions("_block").mapInArrow(_pairs_of_block, "u bigint, v bigint")
    rest = rest.groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.count(F.lit(1)).alias("_agree"))
    others = apart(asked.select("u", "v")).unionByName(near(rest).select("u", "v"))
    edges = edges.unionByName(linked(others.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()))
    labels = durable(components(edges))

    classes = profiles.filter("_set is not null").groupBy("_set").agg(F.min("_doc").alias("_least"))
    classes = classes.join(labels.select(F.col("node").alias("_set"), "component"), "_set", "left")
    classes = classes.withColumn("_part", F.coalesce("component", "_set")).select("_set", "_part", "_least")
    smallest = classes.groupBy("_part").agg(F.min("_least").alias("component_id"))
    named = classes.join(smallest, "_part").select("_set", "_part", "component_id")
    return profiles.join(named, "_set", "left").select(
        F.col("_doc").alias("doc_id"),
        F.col("_size").alias("n_shingles"),
        F.coalesce("component_id", "_doc").alias("component_id"),
        *([F.col("_key").alias("text_key"), F.col("_part").alias("group_key")] if keys else []),
    )
