import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from matchweave.llm.packing import SEQUENCE_COST, best_cuts, pack_documents, padding
from matchweave.llm.word_tokenizer import PieceTokenizer
from tests.llm.data import frame

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    None, "", " \n", "Hello, World! It's 12345.", "a<|endoftext|>b <|ENDOFTEXT|> C", "ΑΣ Σ ﬁ İ É,x y\u0085z​q", "x" * 3000,
    "word, word. WORD; 0 00 a0 0a", "'s 'll don’t «q» %%%, a%%%,",
]


def whole(texts):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_equal_whole_text_encoding():
    tokenizer = PieceTokenizer(PATH)
    random.seed(1)
    made = ["".join(random.choice("abEÉß .,!?0\n<|'’") for _ in range(200)) for _ in range(200)]
    for texts in (TEXTS, made, [t for t in made if "<|" not in t], TEXTS[:1], TEXTS[3:4] * 3):
        ids, counts, words = tokenizer.encode(pa.array(texts, pa.string()))
        stops = np.concatenate([[0], np.cumsum(counts)])[words.first]
        assert [ids[a:b].tolist() for a, b in zip(stops[:-1], stops[1:])] == whole(texts)


def test_cuts_are_the_cheapest():
    random.seed(2)
    for _ in range(30):
        places = [0]
        while len(places) < 9:
            places.append(places[-1] + random.choice([100, 156, 256, 400, 512, 700]))
        costs = [0] + [random.choice([0, 4, 32]) for _ in places[1:]]
        cost, before = best_cuts(places, costs)
        best = [0] + [None] * 8
        for k in range(1, 9):
            reach = [i for i in range(k) if places[k] - places[i] <= 2048]
            best[k] = min(best[i] + padding(places[k] - places[i]) for i in reach) + costs[k] + SEQUENCE_COST
        assert cost == best


def test_every_id_lies_in_one_piece(spark):
    random.seed(3)
    sentence = lambda: " ".join(random.choice(["one", "two,", "Three"]) for _ in range(random.randrange(1, 40))) + "."
    texts = TEXTS + [" ".join(sentence() for _ in range(random.randrange(60))) for _ in range(120)] + ["long " * 9000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "no id")]
    got = pack_documents(frame(spark, rows, "doc_id bigint, text string", extra=True).coalesce(2), PATH).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
    used = padded = 0
    for rows_ in sequences.values():
        at = 0
        for r in sorted(rows_, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= 2048
        used, padded = used + at, padded + padding(at)
    assert padded < 0.01 * used
    for (doc, text), ids in zip(rows[:-2], whole(t for _, t in rows[:-2])):
        ids = np.array(ids + [1], dtype="<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start)[:: 2 if doc == 3 else 1]:
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert len(pieces[None]) == 1


def test_empty_table(spark):
    assert pack_documents(frame(spark, [], "doc_id bigint, text string"), PATH).count() == 0
