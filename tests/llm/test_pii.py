import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import pytest

from matchweave.llm import pii
from matchweave.llm.tagger import Tagger
from tests.llm.data import frame


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    """The patterns as they are written."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(1)
    made = ["".join(rng.choice(list("ab1209.@+- ()é\n"), 60)) for _ in range(3000)]
    made += ["a@b.c@d.e", "x@y.z" * 3, "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (578) 555-6437.", "٣@a.b", "256.1.1.1 001.2.3.004"]
    for text in made:
        assert pii.base_spans(text) == plain(text), text


def test_tagger_learns_and_adds(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("etaoinshr"), 5))
    number = lambda: f"({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}"
    rows = [(0, None), (1, ""), (2, "no data"), (3, "version 2.0")]
    for i in range(4, 700):
        middle = f"+1 {number()}" if i % 2 else rng.integers(10, 99)
        rows.append((i, f"{word()} {word()} {middle} {word()} a{i}@mail.example {word()}"))
    bare = {i: f"é {word()} {number()} {word()} {word()}" for i in range(700, 720)}
    rows += [*bare.items(), (5, rows[5][1]), (None, "x@y.zz")]
    docs = frame(spark, rows, "doc_id bigint, text string", extra=True)
    tagger = pii.train(docs)
    got = {r.doc_id: r for r in pii.find_pii(docs, tagger).collect()}
    for i, text in rows:
        base = plain(text or "")
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        assert got[i].base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert {s for s in pii.joined(base).split(",") if s} <= set(got[i].spans.split(","))
    assert sum(got[i].spans == "phone:8:22" for i in bare) >= 15
    assert not got[3].spans and not got[2].spans
    texts = {r.doc_id: r.text for r in pii.redact(docs, tagger).collect()}
    assert texts[0] is None and "[EMAIL]" in texts[6] and "[PHONE]" in texts[7] and "555" not in texts[7]


class Runs:
    """Tags every run of ASCII as an address, also where a window cuts it."""

    def decode(self, windows, allowed):
        tags = np.zeros(windows.shape, dtype=np.int64)
        inside = windows < 128
        tags[inside] = 2
        begin = inside.copy()
        begin[:, 1:] &= ~inside[:, :-1]
        tags[begin] = 1
        tags[:, 0][inside[:, 0]] = 2  # begins or goes on: a window does not tell
        return tags


def test_long_spans_at_every_offset():
    for length in (20, 34, 40, 64, 65, 96, 100, 128, 150, 300):
        for offset in range(0, 140, 1 if length < 101 else 7):
            body = "a" * (length // 3) + "@" + "b" * (length - length // 3 - 1)
            text = "é" * offset + body + "é" * 150 + "x@y"
            (found,) = pii.tagged_spans([text], [[]], Runs())
            expected = [("email", offset, offset + length), ("email", len(text) - 3, len(text))]
            assert sorted(found) == expected, (length, offset)


def test_labels_are_counted_from_the_window():
    text = "word " * 40 + "mail me@home.example now " + "word " * 40 + "10.0.0.1"
    batch = pa.RecordBatch.from_arrays([pa.array([text])], names=["_text"])
    seen = 0
    for out in pii._windows(iter([batch])):
        for window, label in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
            for kind, a, b in (s.split(":") for s in label.split(",")):
                a, b = int(a), int(b)
                body = window[max(a, 0) : b]
                assert body in {"email": "me@home.example", "ip": "10.0.0.1"}[kind] and len(body) >= min(b, len(window)) - max(a, 0)
                seen += a >= 0 and b <= len(window)
    assert seen >= 3


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_tagger_alone_finds_most_base_spans(spark, folder):
    if not os.path.isdir(folder):
        pytest.skip("no tables")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = [r.text for r in docs.filter("text is not null").select("text").collect()]
    base = [pii.base_spans(t) for t in texts]
    alone = pii.tagged_spans(texts, [[] for _ in texts], pii.train(docs))
    found = sum(len(set(a) & set(b)) for a, b in zip(alone, base))
    assert found >= 0.9 * sum(map(len, base)) and sum(map(len, alone)) <= 1.1 * sum(map(len, base))


def test_gradients():
    rng = np.random.default_rng(3)
    tagger = Tagger(3)
    tagger.start()
    x, y = rng.integers(97, 100, (2, 6)), rng.integers(0, 3, (2, 6))
    _, grads = tagger.gradients(x, y)
    for name, weight in tagger.weights.items():
        at = (97, 1) if name == "embed" else tuple(0 for _ in weight.shape)
        old = weight[at]
        losses = []
        for step in (1e-5, -1e-5):
            weight[at] = old + step
            losses.append(tagger.gradients(x, y)[0])
        weight[at] = old
        assert abs((losses[0] - losses[1]) / 2e-5 - grads[name][at]) < 1e-6


def test_nothing_to_learn_from(spark):
    docs = frame(spark, [(1, "a b"), (2, "5 apples")], "doc_id bigint, text string")
    assert pii.train(docs) is None
    assert [r.spans for r in pii.find_pii(docs, None).collect()] == ["", ""]
    assert pii.find_pii(docs.limit(0), None).count() == 0
