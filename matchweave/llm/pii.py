"""Personal data by fixed patterns and a trained character tagger."""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchweave.llm.tagger import PADDING, Tagger, symbols
from matchweave.llm.words import by_bytes
from matchweave.operators.scale import top_per_key

KINDS = ("email", "ip", "card", "phone")
#: Code points of a window, and from one window to the next.
WINDOW, STRIDE = 128, 64
#: Windows that the tagger is fitted on, at most.
SAMPLE = 3_000
#: Windows decoded at once.
DECODED = 512

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
#: Shapes that a span of the tagger has to have.
_SHAPES = {
    "email": re.compile(r"[^\s@]+@[^\s@]+"),
    "ip": re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9][0-9 -]+[0-9]"),
    "phone": re.compile(r"[+(]?[0-9][0-9 ().-]+[0-9]"),
}


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the fixed patterns, by kind as listed, then by start."""
    if not _TRIGGER.search(text):
        return []
    spans = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            spans.append(("phone", m.start(), m.end()))
    return spans


def joined(spans: list[tuple[str, int, int]]) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in order)


# Tags: 0 outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
_ALLOWED = np.ones((TAGS, TAGS), dtype=bool)
for _k in range(len(KINDS)):
    _ALLOWED[:, 2 + 2 * _k] = False
    _ALLOWED[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = True


def window_starts(text: str) -> list[int]:
    """Starts of the overlapping windows that hold a digit or an at sign; spans of all four kinds hold one."""
    starts: set[int] = set()
    m = _TRIGGER.search(text)
    while m:
        first = m.start() // STRIDE * STRIDE
        starts.update(s for s in (first, first - STRIDE) if s >= 0)
        m = _TRIGGER.search(text, first + STRIDE)
    return sorted(starts)


def _cut(codes: np.ndarray, start: int) -> np.ndarray:
    window = np.full(WINDOW, PADDING, dtype=np.int64)
    part = codes[start : start + WINDOW]
    window[: len(part)] = part
    return window


def tags_of(spans: list[tuple[str, int, int]], start: int) -> np.ndarray:
    """Tags of the window at ``start``; a span that begins before it goes on inside."""
    tags = np.zeros(WINDOW, dtype=np.int64)
    for kind, a, b in spans:
        a, b, k = a - start, b - start, KINDS.index(kind)
        if b > 0 and a < WINDOW:
            tags[max(a, 0) : b] = 2 + 2 * k
            if a >= 0:
                tags[a] = 1 + 2 * k
    return tags


def _varied(text: str, spans: list[tuple[str, int, int]], rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """The same window with telephone numbers written in other ways."""
    out, made, at, moved = [], [], 0, 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        whole = kind == "phone" and a >= at and b <= len(text)
        body = text[a:b]
        if whole:
            body = rng.choice([body, body.lstrip("+"), re.sub(r"^\+[0-9]+ ?", "", body), body.replace("-", rng.choice([" ", "."]))])
            out += [text[at:a], body]
            at = b
        begin = a + moved
        moved += len(body) - (b - a) if whole else 0
        made.append((kind, begin, b + moved))
    out.append(text[at:])
    return "".join(out), made


def _doubtful(window: str) -> bool:
    """Does the window hold anything in the shape of a kind?"""
    numbers = (_digits(m[0]) for kind in ("card", "phone") for m in _SHAPES[kind].finditer(window))
    return any(9 <= len(d) <= 19 for d in numbers) or any(_SHAPES[k].search(window) for k in ("email", "ip"))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window with a trigger and the base spans in it, counted from its begin; spans may begin before it or end after it."""
    for batch in by_bytes(batches, "_text"):
        texts, labels = [], []
        for text in batch.column("_text").to_pylist():
            spans = base_spans(text)
            for start in window_starts(text):
                window = text[start : start + WINDOW]
                inside = [(kind, a - start, b - start) for kind, a, b in spans if b > start and a < start + WINDOW]
                if inside or not _doubtful(window):
                    texts.append(window)
                    labels.append(joined(inside))
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(labels, pa.string())], names=["_window", "_spans"])


def train(docs: DataFrame, sample: int = SAMPLE) -> Tagger | None:
    """Fit the tagger on at most ``sample`` labelled windows; none if no window has a span.

    The labelled spans are those of the fixed patterns in the documents. Half of the sample are windows with spans, half windows
    with digits or at signs, no span and nothing in the shape of one, each those with the smallest hash of their text, so
    the sample does not depend on the partitioning. Windows may cut spans. Windows with a telephone number come a second time with it written in another way.
    """
    texts = docs.select(F.col("text").alias("_text")).filter(F.col("_text").rlike("[0-9@]"))
    windows = texts.mapInArrow(_windows, "_window string, _spans string").groupBy("_window").agg(F.min("_spans").alias("_spans"))
    order = [F.xxhash64("_window"), F.col("_window")]
    found = top_per_key(windows.withColumn("_some", F.col("_spans") != ""), "_some", order, sample // 2).collect()
    if not any(row._some for row in found):
        return None
    found.sort(key=lambda row: (not row._some, row.rank))
    rng = random.Random(5)
    x, y = [], []
    for row in found:
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in row._spans.split(",") if s)]
        copies = [(row._window, spans)]
        if any(s[0] == "phone" for s in spans):
            copies.append(_varied(row._window, spans, rng))
        for text, marked in copies:
            x.append(_cut(symbols(text), 0))
            y.append(tags_of(marked, 0))
    tagger = Tagger(TAGS)
    tagger.fit(np.stack(x), np.stack(y))
    return tagger


def _spans_in(tags: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Kind number, begin and end of the tagged spans of one window; one that goes on at its begin counts from there."""
    place = 0
    while place < len(tags):
        if tags[place] and (tags[place] % 2 or not place):
            inside, end = tags[place] + tags[place] % 2, place + 1
            while end < len(tags) and tags[end] == inside:
                end += 1
            yield (int(inside) - 2) // 2, place, end
            place = end
        else:
            place += 1


def _joined_over(parts: list[tuple[int, int, int, bool, bool]]) -> Iterator[tuple[int, int, int]]:
    """Margin, begin and end of the spans that parts of one kind (margin, begin, end, cut on the left, cut on the right) make.

    A part that a window's border cuts is continued by any part of a neighbouring window that overlaps it.
    """
    for margin, a, b, left, right in parts:
        grown = True
        while grown and (left or right):
            grown = False
            for other, c, d, cut_left, cut_right in parts:
                if right and c < b < d:
                    b, right, margin, grown = d, cut_right, max(margin, other), True
                if left and c < a < d:
                    a, left, margin, grown = c, cut_left, max(margin, other), True
        yield margin, a, b


def _fits(kind: str, body: str) -> bool:
    """Has a tagged span the shape of its kind?"""
    digits = _digits(body)
    if not _SHAPES[kind].fullmatch(body):
        return False
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or all(int(p) <= 255 for p in body.split("."))


def _reconciled(found: list[tuple[int, str, int, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Of spans from overlapping windows, those furthest from a window's border first; none may overlap another."""
    taken = [(a, b) for _, a, b in base]
    kept = []
    for _, kind, a, b in sorted(set(found), key=lambda s: (-s[0], s[2], s[3], s[1])):
        if all(b <= c or a >= d for c, d in taken):
            taken.append((a, b))
            kept.append((kind, a, b))
    return kept


def _tagged(text: str, parts: list[list[tuple[int, int, int, bool, bool]]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    found = []
    for kind, own in zip(KINDS, parts):
        for margin, a, b in _joined_over(own):
            body = text[a:b]
            a, body = a + len(body) - len(body.lstrip()), body.strip()
            if _fits(kind, body):
                found.append((margin, kind, a, a + len(body)))
    return _reconciled(found, base)


def tagged_spans(texts: list[str], base: list[list[tuple[str, int, int]]], tagger: Tagger) -> list[list[tuple[str, int, int]]]:
    """Spans that the tagger adds to the ``base`` spans of each text."""
    places = [(i, start) for i, text in enumerate(texts) for start in window_starts(text)]
    parts: dict[int, list[list]] = {}
    done: set[tuple[int, int]] = set()
    while places:
        done.update(places)
        further = set()
        for i in range(0, len(places), DECODED):
            chunk = places[i : i + DECODED]
            codes = {k: symbols(texts[k]) for k in {k for k, _ in chunk}}
            decoded = tagger.decode(np.stack([_cut(codes[k], start) for k, start in chunk]), _ALLOWED)
            some = decoded.any(axis=1)
            for (k, start), tags in zip([p for p, hit in zip(chunk, some) if hit], decoded[some]):
                # at the text's own begin and end nothing is cut
                first, last = start == 0, start + WINDOW >= len(texts[k])
                for number, a, b in _spans_in(tags[: len(texts[k]) - start]):
                    margin = min(WINDOW if first else a, WINDOW if last else WINDOW - b)
                    left, right = a == 0 and not first, b == WINDOW and not last
                    parts.setdefault(k, [[] for _ in KINDS])[number].append((margin, start + a, start + b, left, right))
                    further |= {(k, start - STRIDE)} if left else set()
                    further |= {(k, start + STRIDE)} if right else set()
        # spans that go on where no trigger is
        places = sorted(further - done)
    return [_tagged(text, parts[k], b) if k in parts else [] for k, (text, b) in enumerate(zip(texts, base))]


def all_spans(texts: list[str], tagger: Tagger | None) -> tuple[list, list]:
    """Base spans of each text, and base spans with those that the tagger adds."""
    base = [base_spans(t) for t in texts]
    if tagger is None:
        return base, base
    return base, [b + a for b, a in zip(base, tagged_spans(texts, base, tagger))]


def _find(tagger: Tagger | None):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            base, spans = all_spans(batch.column("_text").to_pylist(), tagger)
            counts = [[sum(s[0] == kind for s in b) for b in base] for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_doc"),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()),
                    pa.array([joined(s) for s in spans], pa.string()),
                ],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    return find


def find_pii(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every row of ``docs``.

    The counts and the digest are those of the fixed patterns; ``spans`` holds these and what the tagger adds
    (telephone numbers without a plus sign, say). Places are code points, the end is exclusive. The tagger reads overlapping
    windows of the whole text wherever there is a digit or an at sign; parts of a span that a window's border cuts are joined with
    those of the next window, of spans that overlap the one furthest from a border counts, and an added span overlaps no other.

    Null and empty texts have no spans. Rows that repeat an id are answered each; an empty table gives no rows; other columns
    are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_doc"), F.coalesce("text", F.lit("")).alias("_text"))
    return rows.mapInArrow(
        _find(tagger),
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    )


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first counts."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
            at = b
        else:
            at = max(at, b)
    return "".join(out) + text[at:]


def _redact(tagger: Tagger | None, column: str):
    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, column):
            texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
            known = [i for i, t in enumerate(texts) if t is not None]
            _, spans = all_spans([texts[i] for i in known], tagger)
            for i, found in zip(known, spans):
                texts[i] = redacted(texts[i], found)
            yield batch.set_column(batch.schema.get_field_index(column), column, pa.array(texts, pa.string()))

    return redact


def redact(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``; null stays null."""
    return docs.mapInArrow(_redact(tagger, "text"), docs.schema)
