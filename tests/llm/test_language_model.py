import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from matchweave.llm import language_model as lm
from tests.llm.data import frame


def tokens_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def ending(word):
    last = word.encode()[-2:]
    before = last[0] if len(last) > 1 else 0
    return (last[-1] * 31 + before * 7 + last[-1] // 16) % lm.ENDINGS


def exact_tables(customers, opening, discount):
    """Chance of each number of tables, by adding up the weights of all seatings."""
    ways, tables = np.zeros(customers + 1), np.arange(customers + 1)
    ways[1] = 1.0
    for n in range(1, customers):
        ways = ways * np.maximum(n - discount * tables, 0) + opening * np.concatenate([[0.0], ways[:-1]])
        ways /= ways.sum()
    return ways


@pytest.mark.parametrize(("customers", "opening", "discount"), [(2, 0.3, 0.5), (6, 0.8, 0.7), (15, 2.0, 0.4), (400, 1.5, 0.6)])
def test_seating_follows_its_weights(customers, opening, discount):
    n = 6_000
    drawn = lm.seat(np.full(n, customers), np.full(n, opening), discount, np.random.default_rng(1))
    got = np.bincount(drawn.astype(int), minlength=customers + 1) / n
    expected = exact_tables(customers, opening, discount)
    assert np.abs(got - expected).sum() < 0.1
    assert abs(drawn.mean() / (expected @ np.arange(customers + 1)) - 1) < 0.05


def test_class_probabilities_sum_to_one_and_follow_counts():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 3, (6, 6, 6)) * rng.integers(0, 2, (6, 6, 6))
    counts[1, 2, 3] = 500
    found = lm.class_probabilities(counts)
    assert np.allclose(found.sum(axis=-1), 1) and (found > 0).all()
    assert found[1, 2, 3] > 0.9
    nothing = lm.class_probabilities(np.zeros((4, 4, 4), dtype=np.int64))
    assert np.allclose(nothing, 0.25)


def plain(rows):
    """Rows of the model by plain loops, for a corpus whose words are frequent or come once."""
    counts, learnt, total = Counter(), [r for r in rows if not held(r[0])], 0
    for _, text in learnt:
        counts.update(tokens_of(text))
    total = sum(counts.values()) + len(learnt)
    size = len(counts) + bool(learnt)
    top = [w for w, n in counts.items() if n > 1]
    assert len(top) == lm.FREQUENT and set(counts.values()) - {1} and min(counts[w] for w in top) > 1
    return counts, total, size, learnt, top


def corpus():
    rng = random.Random(4)
    common = [f"Common{i}" for i in range(lm.FREQUENT)]
    rows = []
    for doc in range(60):
        words = [rng.choice(common) for _ in range(30)] + [f"rare{doc}x{j}é" for j in range(5)]
        rng.shuffle(words)
        rows.append((doc, " \n".join(words)))
    return rows + [(70, None), (71, ""), (72, " \t "), (3, rows[40][1].replace("rare", "again")), (None, "Common1 unique")]


def test_equals_plain_loops(spark):
    rows = corpus()
    counts, total, size, learnt, top = plain(rows)
    got = lm.score_texts(frame(spark, rows, "doc_id bigint, text string", extra=True).repartition(3)).collect()
    assert len(got) == len(rows)
    key = {}  # classes are numbered by frequency, ties by hash: name them by the word
    kinds = {w: w if w in top else ending(w) for _, t in rows for w in tokens_of(t)}
    cube = Counter()
    for _, text in learnt:
        before = ("end", "end")
        for kind in [kinds[w] for w in tokens_of(text)] + ["end"]:
            cube[(*before, kind)] += 1
            before = (before[1], kind)
    for r in got:
        key.setdefault((r.doc_id, r.n_tokens), []).append(r)
    words = Counter(kinds[w] for w in counts if w not in top)
    ones = sum(n == 1 for n in counts.values())
    discount = lm.discount_from(ones, 0)
    for doc, text in rows:
        tokens = tokens_of(text)
        known = sum(w in counts for w in tokens) + 1
        base = sum(math.log10((counts[w] + 1) / (total + size + 1)) for w in tokens) + math.log10((len(learnt) + 1) / (total + size + 1))
        row = next(r for r in key[doc, len(tokens) + 1] if math.isclose(r.base_score, base, rel_tol=1e-9))
        assert (row.held_out, row.n_known, row.train_tokens) == (held(doc), known, total)
        # the words of rare classes come once each, so that each has one table and its chance a closed form
        own = 0.0
        for w in tokens:
            if w not in top:
                n = words[kinds[w]]
                new = lm.STRENGTH + discount * n
                mass = 1 - discount + new * (1 - lm.UNSEEN) / n if w in counts else new * (lm.UNSEEN if n else 1)
                own += math.log10(mass / (lm.STRENGTH + n))
        assert row.score < own  # what is left is the chance of the classes
        assert row.score - own > -2.2 * len(tokens) - 2.2


def test_held_out_texts_are_likelier_than_by_single_tokens(spark):
    rng = random.Random(8)
    words = [f"w{i}{c}" for i in range(300) for c in "aeo"]
    rows = [(d, " ".join(w for _ in range(40) for w in ("the", words[min(int(rng.paretovariate(0.6)), 899)], "of"))) for d in range(300)]
    got = lm.score_texts(frame(spark, rows, "doc_id bigint, text string")).filter("held_out").toPandas()
    assert len(got) > 20 and got.score.sum() > 0.8 * got.base_score.sum()


def test_tables_without_rows_to_learn_from(spark):
    assert lm.score_texts(frame(spark, [], "doc_id bigint, text string")).count() == 0
    alone = next(d for d in range(100) if held(d))
    row = lm.score_texts(frame(spark, [(alone, "one two")], "doc_id bigint, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0) and math.isclose(row.score, -3 * math.log10(lm.CLASSES))


@pytest.mark.parametrize(("customers", "opening", "discount"), [(2, 0.3, 0.5), (5, 0.8, 0.7), (6, 2.0, 0.05), (9, 1.0, 0.6)])
def test_few_customers_are_seated_by_their_exact_chances(customers, opening, discount):
    drawn = lm.tables_of(np.full(20_000, customers), np.full(20_000, opening), discount, np.random.default_rng(3))
    got = np.bincount(drawn.astype(int), minlength=customers + 1) / 20_000
    assert np.abs(got - exact_tables(customers, opening, discount)).sum() < 0.06


@pytest.mark.parametrize("split", [False, True])
def test_chances_after_two_words_sum_to_one_and_pass_tables_up(split):
    rng = np.random.default_rng(5)
    every = np.array([(1 if split else a, b, c) for a in range(1 if split else 6) for b in range(7) for c in range(8)])
    n = rng.integers(0, 4, len(every)) * rng.integers(0, 2, len(every))
    n[3] = 90
    mixed = rng.permutation(len(every))
    contexts, place = lm.Contexts.of(*every[mixed].T, n[mixed])
    assert (contexts.n[place] == n[mixed]).all()
    mean, sent = contexts.sampled(np.full(8, 1 / 8), split, np.random.default_rng(6), 3, 1)
    assert np.allclose(mean.reshape(-1, 8).sum(axis=1), 1) and (mean > 0).all()
    row = np.flatnonzero((contexts.one == every[3][0]) & (contexts.two == 0) & (contexts.word == 3))
    assert mean[row] > 0.7
    # each dish sends at least one customer for each restaurant that serves it, and no more than it has
    some = contexts.n > 0
    keys = (contexts.two if split else contexts.one)[some]
    least = [len(set(keys[contexts.word[some] == w])) for w in range(8)]
    most = np.bincount(contexts.word, weights=contexts.n, minlength=8)
    assert (sent >= least).all() and (sent <= most).all()


def chains(seed, docs=240):
    """Texts of phrases whose words all have one ending and are about equally frequent, so that classes tell nothing of what follows."""
    phrases, rng = random.Random(0), random.Random(seed)
    phrases = [phrases.sample([f"w{i}zz" for i in range(300)], 3) for _ in range(100)]
    return [(doc, " ".join(w for _ in range(12) for w in rng.choice(phrases))) for doc in range(docs)]


def test_words_after_two_words_are_learnt(spark):
    got = lm.score_texts(frame(spark, chains(1), "doc_id bigint, text string")).filter("held_out").toPandas()
    assert len(got) > 20 and got.score.sum() > 0.6 * got.base_score.sum()


def test_parts_of_frequent_words_change_little(spark, monkeypatch):
    """Contexts over many parts, those of frequent words split, and blocks sorted in steps: the same chances but for the draws."""
    rows = chains(2) + [(1000, None), (None, "w1zz w2zz"), (1001, "alone " * 50)]
    docs = frame(spark, rows, "doc_id bigint, text string").repartition(4)
    whole = lm.score_texts(docs).toPandas()
    monkeypatch.setattr(lm, "PART_TOKENS", 300)
    monkeypatch.setattr(lm, "SORTED_TOKENS", 200)
    parted = lm.score_texts(docs).toPandas()
    key = ["doc_id", "n_tokens"]
    both = whole.merge(parted, on=key, suffixes=("", "_parted"))
    assert len(both) == len(rows) and (both.n_known == both.n_known_parted).all() and np.allclose(both.base_score, both.base_score_parted)
    held_out = both[both.held_out]
    assert abs(held_out.score.sum() / held_out.score_parted.sum() - 1) < 0.05
    assert abs(both.score.sum() / both.score_parted.sum() - 1) < 0.05


@pytest.mark.parametrize(("step", "most"), [(1 << 20, 3.1), (5_000, 3.7)])
def test_entries_are_whole_and_small(spark, step, most):
    """What leaves a block for the parts: every word after two words in every text, in few bytes a token."""
    rng = np.random.default_rng(9)
    names = [f"v{i}" for i in range(6_000)]
    rows = [(d, " ".join(names[i] for i in np.minimum(rng.zipf(1.2, 200) - 1, 5_999))) for d in range(500)] + [(None, None), (-7, "v0")]
    docs = frame(spark, rows, "doc_id bigint, text string").coalesce(1)
    docs = docs.selectExpr("doc_id _doc", "coalesce(crc32(cast(doc_id as string)) % 7 = 2, false) _held", "coalesce(text, '') _text")
    block = docs.mapInArrow(lm._encode, lm.BLOCK).toArrow()
    assert block.num_rows == 1
    own = np.array(block["_words"][0].values)
    ids = lm.END + 1 + 3 * np.random.default_rng(10).permutation(len(own))
    n = np.array(block["_counts"][0].values)
    half = len(own) // 2
    answers = [
        (0, len(at), lm._pack(np.diff(at, prepend=0)), lm._pack_long(ids[at]), lm._pack_long(n[at]))
        for at in (np.arange(half), np.arange(half, len(own)))
    ]
    totals = lm.Totals(np.zeros(0, np.int64), 1000, len(own), 10)
    frequent = int(ids[0])
    parts = lm.Parts(3, np.array([frequent]), np.array([2]), 1)
    at = ["_at" if c == "_block" else c for c in block.column_names]
    sent = lm._send(totals, parts, step)(block.rename_columns(at), lm._table(list(zip(*answers, strict=True)), lm.ANSWERS))
    entries = sent.filter(np.array(sent["_group"]) >= 0)

    id_of = dict(zip(own.tolist(), ids.tolist(), strict=True))
    hashes = lm.split_words(lm.pa.array(names), lower=True).hashes.view(np.int64).tolist()
    id_of = {name: id_of[h] for name, h in zip(names, hashes, strict=True) if h in id_of}
    numbers = {doc: i for i, doc in enumerate(block["_docs"][0].as_py())}
    learnt, texts = Counter(), Counter()
    for doc, text in rows:
        before = (lm.END, lm.END)
        for word in [id_of[w] for w in tokens_of(text)] + [lm.END]:
            learnt[before[1], before[0], word] += not held(doc)
            texts[numbers[doc], before[1], before[0], word] += 1
            before = (before[1], word)
    got, got_texts = Counter(), Counter()
    for part, own_rows in lm._by_part(entries):
        contexts, place, doc, times, blocks = lm._received(own_rows)
        assert (parts.of(contexts.one, contexts.two) == part).all() and sum(k for _, k in blocks) == len(place)
        three = list(zip(contexts.one.tolist(), contexts.two.tolist(), contexts.word.tolist(), strict=True))
        got.update(dict(zip(three, contexts.n.tolist(), strict=True)))
        for p, d, t in zip(place.tolist(), doc.tolist(), times.tolist(), strict=True):
            got_texts[(d, *three[p])] += t
    assert got == learnt and got_texts == texts
    size = sum(len(v or b"") for c in entries.column_names for v in entries[c].to_pylist() if isinstance(v, bytes))
    assert size < most * sum(texts.values())


def test_numbers_and_chances_are_packed_without_loss():
    rng = np.random.default_rng(12)
    numbers = np.concatenate([[0, 1, 127, 128, 16_383, 16_384, (1 << 62) + 5], rng.integers(0, 1 << 40, 1_000)])
    assert (lm._from_varints(lm._varints(numbers)) == numbers).all() and not len(lm._from_varints(lm._varints(numbers[:0])))
    chances = rng.random(40)[rng.integers(0, 40, 5_000)]
    packed = lm._pack_alike(chances)
    assert (lm._unpack_alike(*packed, len(chances)) == chances).all()
    assert len(packed[1]) + len(packed[2]) < len(chances) * 1.5 < len(lm._pack_long(chances.view(np.int64)))


def test_values_of_words_come_back_by_bucket():
    rng = np.random.default_rng(13)
    ids = lm.END + 1 + rng.permutation(900)
    often, values = rng.integers(0, 5, 900), -rng.integers(1, 9, 900) / 7
    batch = lm.pa.table({"id": ids, "n": often, "value": values}).to_batches()
    packed = lm.pa.Table.from_batches(lm._pack_values(4)([batch[0].slice(0, 500), batch[0].slice(500)]))
    found = {}
    for bucket in range(4):
        got = lm._word_values(packed.filter(np.array(packed["_bucket"]) == bucket), 4)
        assert (lm._bucket_of(got[0], 4) == bucket).all()
        found |= {i: (n, v) for i, n, v in zip(*(c.tolist() for c in got), strict=True)}
    assert found == {i: (n, v) for i, n, v in zip(ids.tolist(), often.tolist(), values.tolist(), strict=True)}
