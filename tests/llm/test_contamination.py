import random
import re

import numpy as np

from matchweave.llm.contamination import edit_distances, edit_limit, find_benchmark
from tests.llm.data import frame


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(last + (x != y), row[j] + 1, row[j + 1] + 1)
    return row[-1]


def plain(docs, items):
    split = lambda t: re.findall("[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in t or ""))
    found = set()
    for d, t in docs:
        words = split(t)
        for i, it in items:
            item = split(it)
            n = len(item)
            for s in range(max(len(words) - n, 0) + 1):
                if n and words and distance(words[s : s + n], item) <= edit_limit(n):
                    found.add((d, i))
    return found


def test_edit_distances():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 3, (40, 9)), rng.integers(0, 3, (40, 9))
    assert edit_distances(a, b).tolist() == [distance(list(x), list(y)) for x, y in zip(a, b)]


def test_recall_and_precision(spark):
    random.seed(4)
    word = lambda: random.choice(["the", "of"] + [f"w{random.randrange(300)}" for _ in range(4)])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([4, 5, 9, 15, 15, 20, 37, 59])]
    items += [(50, None), (51, ""), (52, "...")]
    docs = [(0, None), (1, ""), (2, "the the the the the the the"), (3, items[3][1]), (3, items[3][1]), (None, items[4][1])]
    for i in range(4, 160):
        words = [word() for _ in range(random.randrange(80))]
        if i % 2:
            passage = items[random.randrange(8)][1].split()
            for _ in range(random.randrange(1 + edit_limit(len(passage)))):
                k = random.randrange(len(passage))
                random.choice([lambda: passage.insert(k, word()), lambda: passage.pop(k), lambda: passage.__setitem__(k, word())])()
            at = random.randrange(len(words) + 1)
            words[at:at] = passage
        text = " ".join(words)
        docs.append((i, text.upper().replace(" ", ", ") if i % 3 == 0 else text))
    wanted = plain(docs, items)
    for options in ({}, {"block_bytes": 400}):
        rows = find_benchmark(
            frame(spark, docs, "doc_id bigint, text string", extra=True), frame(spark, items, "item_id bigint, text string"), **options
        ).collect()
        got = {(r.doc_id, r.item_id) for r in rows}
        assert got <= wanted
        assert len(got) >= 0.97 * len(wanted)
        assert sum(r.doc_id == 3 and r.item_id == 3 for r in rows) == 2


def test_empty_tables(spark):
    docs = frame(spark, [(1, "a b c")], "doc_id bigint, text string")
    none = frame(spark, [], "item_id bigint, text string")
    assert find_benchmark(docs, none).count() == 0
    assert find_benchmark(frame(spark, [], "doc_id bigint, text string"), frame(spark, [(1, "a b c")], "item_id bigint, text string")).count() == 0


def test_items_with_repeated_runs(spark):
    random.seed(8)
    texts = ["yes no " * 10, "la " * 10, "1 2 3 4 " * 8, "ring a ring o roses " * 3, "a b " * 5 + "c d " * 6, "x " * 25]
    items = [(i, t) for i, t in enumerate(texts)]
    docs, copies = [], []
    for i in range(180):
        passage = texts[i % 6].split()
        if i < 12:
            copies.append((i, i % 6))
        else:
            for _ in range(random.randrange(1, 1 + edit_limit(len(passage)))):
                k = random.randrange(len(passage))
                random.choice([lambda: passage.insert(k, f"v{i}"), lambda: passage.pop(k), lambda: passage.__setitem__(k, f"u{i}")])()
        around = [f"w{random.randrange(300)}" for _ in range(random.randrange(40))] if i >= 6 else []
        at = random.randrange(len(around) + 1)
        docs.append((i, " ".join([*around[:at], *passage, *around[at:]])))
    wanted = plain(docs, items)
    assert wanted >= set(copies)
    rows = find_benchmark(frame(spark, docs, "doc_id bigint, text string"), frame(spark, items, "item_id bigint, text string")).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert {(r.doc_id, r.item_id) for r in rows if r.edits == 0} >= set(copies)
    assert got <= wanted
    assert len(got) >= 0.97 * len(wanted), (len(got), len(wanted))
