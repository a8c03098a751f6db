import hashlib
import random
import re

from matchweave.llm.fm_index import FMIndex
from matchweave.llm.substring_dedup import remove_repeats
from tests.llm.data import frame

import numpy as np


def plain(rows, window):
    """Every window of every document in a dictionary."""
    split = [(i, re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in rows]
    first = {}
    for i, words in split:
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            first[w] = min(first.get(w, 1 << 63), i if i is not None else (1 << 63) - 1)
    out = []
    for i, words in split:
        drop = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < (i if i is not None else (1 << 63) - 1):
                drop |= set(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in drop)
        out.append((i, len(words), len(drop), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def sample(seed):
    random.seed(seed)
    word = lambda: random.choice(["a", "bé", "c,", "dd", "e"] + [f"w{random.randrange(400)}" for _ in range(3)])
    passage = [word() for _ in range(14)]
    rows = [(0, None), (1, ""), (2, " \t\n "), (None, " ".join(passage)), (3, "x y z")]
    for i in range(4, 90):
        words = [word() for _ in range(random.randrange(60))]
        if i % 3 == 0:
            at = random.randrange(len(words) + 1)
            words[at:at] = passage
        if i % 11 == 0:
            words = re.findall(r"\S+", rows[-1][1] or "")
        rows.append((i, random.choice([" ", "\n", "  "]).join(words)))
    return rows + rows[20:23]


def test_equals_plain_windows(spark):
    for seed, options in ((1, {}), (2, {"hot_texts": 2, "shard_texts": 7})):
        rows = sample(seed)
        docs = frame(spark, rows, "doc_id bigint, text string", extra=True)
        got = remove_repeats(docs, window=8, anchor=3, **options).collect()
        assert sorted(map(tuple, got), key=str) == plain(rows, 8)


def test_empty_table_and_text(spark):
    assert remove_repeats(frame(spark, [], "doc_id bigint, text string")).count() == 0
    row = remove_repeats(frame(spark, [(1, " a  b ")], "doc_id bigint, text string"), with_text=True).first()
    assert (row.n_words, row.n_removed, row.kept_text) == (2, 0, "a b")


def test_index_finds_first_owner():
    rng = np.random.default_rng(3)
    sequences = [rng.integers(0, 3, n).astype(np.uint64) for n in (5, 30, 9, 17, 5)]
    owners = np.array([7, 3, 9, 1, 2])
    for window in (2, 3, 5):
        best = {}
        for s, o in zip(sequences, owners):
            for k in range(len(s) - window + 1):
                key = tuple(s[k : k + window])
                best[key] = min(best.get(key, 99), o)
        got = FMIndex(sequences, owners, window).first_owners()
        for s, g in zip(sequences, got):
            assert list(g) == [best[tuple(s[k : k + window])] for k in range(len(s) - window + 1)]
