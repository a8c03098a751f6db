import random
import re

import numpy as np
import pytest

from matchweave.llm import shingle_join
from matchweave.llm.components import components
from matchweave.llm.shingle_join import bits_apart, near_duplicates, parity_bits
from tests.llm.data import frame


def plain(rows, n, num, den):
    sets = []
    for _, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        words = re.findall("[^\x20\x09-\x0d]+", low)
        sets.append({tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set()))
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                part[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), 1 << 63), d)
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def sample(seed):
    random.seed(seed)
    word = lambda: f"w{int(random.random() ** 2 * 300)}"
    rows = [(0, None), (1, ""), (2, "a b"), (3, "A B"), (None, "one two three four five six"), (5, " \n")]
    bases = [[word() for _ in range(length)] for length in (6, 9, 14, 20, 33, 60, 120, 300)]
    for i in range(6, 110):
        words = list(random.choice(bases))
        for _ in range(random.randrange(5) if len(words) > 15 else random.randrange(2)):
            words[random.randrange(len(words))] = word()
        if i % 7 == 0:
            words += [word() for _ in range(random.randrange(8))]
        text = " ".join(words)
        rows.append((i, text.upper() if i % 5 == 0 else text))
    return rows + rows[10:13]


@pytest.mark.parametrize("seed,n,threshold", [(1, 4, (85, 100)), (2, 5, (80, 100)), (3, 2, (50, 100))])
def test_equals_all_pairs(spark, seed, n, threshold):
    rows = sample(seed)
    docs = frame(spark, rows, "doc_id bigint, text string", extra=True)
    for options in ({}, {"hot_sets": 3, "family_part": 5}) if seed == 1 else ({"hot_sets": 4},):
        got = near_duplicates(docs, n, threshold, **options).collect()
        assert sorted(map(tuple, got), key=str) == plain(rows, n, *threshold)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [], "doc_id bigint, text string")).count() == 0


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (103, 101), (7, 7)]
    got = dict(map(tuple, components(frame(spark, edges, "u bigint, v bigint")).collect()))
    assert got == {i: 0 for i in range(51)} | {100: 100, 101: 100, 103: 100}


def test_sketch_distance_is_no_more_than_the_difference():
    rng = np.random.default_rng(4)
    for n, m, common in ((3, 4, 2), (100, 90, 80), (40, 300, 30), (500, 520, 0)):
        items = rng.integers(1, 1 << 63, n + m - common, dtype=np.uint64)
        a, b = items[:n], items[n - common :]
        assert bits_apart(parity_bits(a), parity_bits(b)) <= n + m - 2 * common


def test_copies_in_many_partitions_meet_once(spark, monkeypatch):
    compare, verify = shingle_join._compare, shingle_join._verify

    def compare_once(threshold):
        inner = compare(threshold)

        def once(table):
            names = table.column("_set").to_pylist()
            assert len(names) == len(set(names)), "a set came twice"
            return inner(table)

        return once

    def verify_once(threshold):
        inner = verify(threshold)

        def once(batches):
            seen = set()

            def checked():
                for batch in batches:
                    for pair in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                        assert pair not in seen, "a pair came twice"
                        seen.add(pair)
                    yield batch

            return inner(checked())

        return once

    monkeypatch.setattr(shingle_join, "_compare", compare_once)
    monkeypatch.setattr(shingle_join, "_verify", verify_once)
    rows = [(1000 * k + i, t) for k in range(6) for i, (_, t) in enumerate(sample(1)[6:])]
    docs = frame(spark, rows, "doc_id bigint, text string").repartition(9)
    for options in ({}, {"hot_sets": 3, "family_part": 5}, {"hot_sets": 3, "family_shingles": 300}):
        got = near_duplicates(docs, 4, (85, 100), **options).collect()
        assert sorted(map(tuple, got), key=str) == plain(rows, 4, 85, 100)


def test_blocks_of_unlike_sets_do_not_agree_by_chance():
    """With 4,096 bits in a block, 2,000 sets without a common shingle shared hundreds of blocks."""
    rng = np.random.default_rng(5)
    bands = shingle_join.Bands((80, 100))
    sets = [np.unique(rng.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2)) for _ in range(2000)]
    keys = np.concatenate([shingle_join.sketch_keys(s, bands) for s in sets])
    assert len(np.unique(keys)) == len(keys) > 2000


@pytest.mark.parametrize("step", [1, 2, 3, 7, 1000])
def test_sets_of_a_block_and_whether_it_is_hot(step):
    import pyarrow as pa

    random.seed(step)
    rows = sorted((b, random.randrange(12)) for b in range(60) for _ in range(random.choice([1, 1, 2, 5, 30])))
    got = []
    batches = [rows[i : i + step] for i in range(0, len(rows), step)]
    arrow = (pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*b)], names=["_block", "_set"]) for b in batches)
    for batch in shingle_join._first_of_block(4)(arrow):
        got += list(zip(*(c.to_pylist() for c in batch.columns)))
    want = []
    for b in range(60):
        sets = sorted({s for block, s in rows if block == b})
        want += [(b, sets[0], s, len(sets) > 4) for s in (sets if len(sets) > 4 else sets[1:])]
    assert sorted(got) == sorted(want)


def test_families_from_first_sets(spark):
    """Same families as by every block, from a few edges a set: the number of blocks does not multiply them."""
    random.seed(3)
    keys = shingle_join.BAND_BITS
    blocks = {(b << keys) | 1: sorted(random.sample(range(100), 40)) for b in range(50)}  # one family of near copies
    blocks |= {(b << keys) | 1: sorted(random.sample(range(100, 130), 3)) for b in range(50, 80)}
    blocks |= {(80 << keys) | 1: [-5, 3, 300, 301], (81 << keys) | 1: [-5, 110, 300], (82 << keys) | 2: [400, 401, 402]}
    hot = [(b, sets[0], s) for b, sets in blocks.items() for s in sets]
    spared = [0, 3, 0]
    edges = shingle_join._family_edges(spark.createDataFrame(hot, "_block bigint, _lead bigint, _set bigint"), spared)
    held = {}
    for b, _, s in hot:
        held[s, b & 1023] = held.get((s, b & 1023), 0) + 1
    part = {s: s for _, _, s in hot}
    for b, sets in blocks.items():
        close = [s for s in sets if held[s, b & 1023] > spared[b & 1023]]
        for s in close[1:]:
            old, new = part[s], part[close[0]]
            part = {k: new if v == old else v for k, v in part.items()}
    want = {frozenset(k for k, v in part.items() if v == p) for p in set(part.values())}
    found = {}
    for node, component in components(edges).collect():
        found.setdefault(component, set()).add(node)
    assert {frozenset(x) for x in found.values()} == {x for x in want if len(x) > 1}
    assert edges.count() < len(hot) / 2
