import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from matchweave.llm import packing, pii, quality
from matchweave.llm.queries import tokenizer_path
from tests.llm.data import frame

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_one_document_of_each_group_stays(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(5, long), (3, long + " more"), (3, long + " more"), (9, "else"), (9, "other words"), (10, None), (11, ""), (None, long), (None, "alone")]
    docs = frame(spark, [(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(3, long + " more"), (9, "else"), (9, "other words"), (10, None), (11, ""), (None, "alone")], key=str)


def test_stages_over_a_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[2:4]):
        kept = stage(spark, docs, folder)
        assert kept.columns == names and 0 < kept.count() <= docs.count(), number
    assert corpus_pipeline.pack(spark, docs.limit(0), folder).count() == 0


def plain_kept(rows, good, items):
    """Documents that the first three stages keep, by brute force over all pairs and windows."""
    rows = [r for r in rows if good[r]]
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    first = {}
    for g, row, of in zip(group, rows, sets):
        if not of:
            first[row] = row
        elif g not in first or row < first[g]:
            first[g] = row
    return sorted(row for row in first.values() if not any(holds(row[1], item) for item in items))


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def holds(text, item):
    words, wanted = re.findall(r"[a-z0-9]+", (text or "").lower()), re.findall(r"[a-z0-9]+", item.lower())
    windows = [words[i : i + len(wanted)] for i in range(max(len(words) - len(wanted), 0) + 1)]
    return any(edits(w, wanted) <= len(wanted) // 5 for w in windows)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, above = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(above[j] + (x != y), above[j + 1] + 1, row[j] + 1))
    return row[-1]


def corpus():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghinorstu") for _ in range(rng.randrange(2, 9)))
    vocabulary = [word() for _ in range(400)]
    sentence = lambda: " ".join(rng.choice(vocabulary) for _ in range(12)).capitalize() + "."
    items = [" ".join(rng.choice(vocabulary) for _ in range(25)) for _ in range(4)]
    texts = []
    for i in range(140):
        texts.append(" ".join(sentence() for _ in range(rng.randrange(3, 9))))
        if i % 4 == 1:
            texts[i] = " ".join(rng.choice(["$$", "||", "%%%", "CLICK", "@@", "##"]) for _ in range(60))
        elif i % 9 == 0:
            texts[i] += f" Mail {word()}@mail.example or call +1 (578) 555-{rng.randrange(1000, 9999)}."
    texts[50], texts[52] = texts[10] + " more", texts[10].replace("a", "a", 1)
    texts[60] = texts[60] + " " + items[0] + " " + sentence()
    changed = items[1].split()
    changed[3:5] = ["other"]
    texts[62] = sentence() + " " + " ".join(changed) + " " + texts[62]
    return list(enumerate(texts)) + [(200, ""), (7, texts[6])], items


def test_run_equals_plain_stages(spark, tmp_path, monkeypatch):
    rows, items = corpus()
    fit, fitted = pii.train, {}

    def train(docs):
        """Fit once for the same documents."""
        key = tuple(sorted(r.text or "" for r in docs.select("text").collect()))
        if key not in fitted:
            fitted[key] = fit(docs)
        return fitted[key]

    monkeypatch.setattr(pii, "train", train)
    docs = frame(spark, [(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    docs = docs.withColumns({"_key": F.lit("k"), "score": F.lit("s"), "predicted": F.lit("p")})  # names that stages use inside
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i % 4 != 1), 0) for i, _ in rows[:120]]
    frame(spark, labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frame(spark, list(enumerate(items)), "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    model = quality.train(read, spark.read.parquet(str(tmp_path / "labels.parquet")))
    good = {row: model.score(*quality.passage_features(pa.array([row[1]])))[0] >= quality.ACCEPT for row in rows}
    assert 60 < sum(good.values()) < len(rows)
    kept = read
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == read.columns, name
    expected = plain_kept(rows, good, items)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == expected

    tagger = pii.train(kept)
    clean = corpus_pipeline.redact_personal_data(spark, kept, str(tmp_path))
    masked = {i: pii.redacted(t, pii.all_spans([t], tagger)[1][0]) for i, t in expected}
    assert sorted((r.doc_id, r.text, r.n_chars) for r in clean.collect()) == sorted((i, t, len(t)) for i, t in masked.items())
    assert any("[EMAIL]" in t for t in masked.values()) and not any("@mail" in t for t in masked.values())

    encoder = Tokenizer.from_file(tokenizer_path())
    pieces = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        assert r.offset + r.length <= packing.LENGTH
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    assert sorted(pieces) == sorted(masked) and len(fitted) == 1
    for doc, text in masked.items():
        ids = np.array([*encoder.encode(text, add_special_tokens=False).ids, packing.END_ID], dtype="<u4")
        at = 0
        for start, length, crc, total in sorted(pieces[doc]):
            assert (start, total, crc) == (at, len(ids), zlib.crc32(ids[start : start + length].tobytes()))
            at += length
        assert at == len(ids)
