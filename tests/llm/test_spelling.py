import random
import re
import zlib
from collections import Counter

import pytest

from matchweave.llm.spelling import near_pairs, roots, spelling_variants
from tests.llm.data import frame


def near(a, b):
    """One inserted, deleted or replaced code point, by trying all places."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, length=5, occurrences=3, ratio=2):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= length and c >= occurrences}
    others = {w: [o for o in n if near(w, o)] for w in n}
    form = {}
    for w in n:
        if others[w]:
            best = min(others[w], key=lambda o: (-n[o], o))
            if n[best] >= ratio * n[w]:
                form[w] = best

    def last(w):
        return last(form[w]) if w in form else w

    return sorted((w, n[w], len(others[w]), form.get(w), n.get(form.get(w)), last(w)) for w in n)


def varied(seed, words):
    rng = random.Random(seed)
    out = []
    for _ in range(words):
        word = list(rng.choice(["kathedrale", "straße", "aaaaa", "Ärgernis", "abcab", "bbbbbb", "x÷y×z", "Ångström"]))
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(word))
            word[i : i + rng.randrange(2)] = rng.choice(["", "a", "b", "é", "Z"])
        out.append("".join(word))
    return out


def test_equals_brute_force(spark):
    words = varied(1, 6_000)
    rows = [(i, " ".join(words[i * 60 : i * 60 + 60])) for i in range(100)]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (500, None), (501, ""), (502, "1234 ... āĂ"), (503, "a" * 30_000 + " " + "longword-" * 2_000)]
    got = spelling_variants(frame(spark, rows, "doc_id bigint, text string", extra=True))
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(rows), key=repr)


@pytest.mark.parametrize("pairs", [1, 8, 1_000_000])
def test_common_chunks_are_cut_finer(spark, pairs):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(5, 9))) for _ in range(150)} | {"prefix" + c for c in "abcdefgh"})
    found = near_pairs(frame(spark, [(w, 3) for w in words], "word string, n bigint"), pairs).collect()
    got = sorted(tuple(sorted((r.word, r.other))) for r in found)
    assert got == sorted((a, b) for i, a in enumerate(words) for b in words[i + 1 :] if near(a, b))


def test_roots_of_a_long_chain(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("side", "w5")]
    got = {r.word: r.root for r in roots(frame(spark, chain, "word string, form string")).collect()}
    assert got == {w: "w37" for w, _ in chain}


def test_empty_tables(spark):
    assert spelling_variants(frame(spark, [], "doc_id bigint, text string")).count() == 0
    assert spelling_variants(frame(spark, [(1, "alpha alpha alpha")], "doc_id bigint, text string")).count() == 1
