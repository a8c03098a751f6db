"""Text expressions: lines, names, titles, task prefixes, tokens, keywords."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode-aware stripping and line splitting treat as blank / line end.
BLANK = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_ENDS = r"\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
LINE_END = rf"\r\n|[{LINE_ENDS}]"
TOKEN = r"[\p{L}\p{N}_]+"
NAME_PATTERN = rf"^(.+?)[{BLANK}]*[—–-]"
TITLE_LABEL = "Stanowisko:"


def strip(text: Column) -> Column:
    """Drop blanks of every kind at both ends (``trim`` drops spaces only)."""
    return F.regexp_replace(text, rf"^[{BLANK}]+|[{BLANK}]+\z", "")


def first_line(text: Column) -> Column:
    """First line; null for empty text."""
    return F.when(text != "", F.split(text, LINE_END, 2).getItem(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _stripped_line(text: Column) -> Column:
    """First line of the stripped text, read from the front: a text is not stripped as a whole for the sake of its first line."""
    front = rf"\A[{BLANK}]*+([^{LINE_ENDS}]*+)"
    alone = text.rlike(rf"{front}[{BLANK}]*+\z")
    return let(
        F.regexp_extract(text, front, 1),
        lambda line: F.when(line != "", F.when(alone, F.regexp_replace(line, rf"[{BLANK}]+\z", "")).otherwise(line)),
    )


def _head(text: Column, pattern: str) -> Column:
    def of(line: Column) -> Column:
        return strip(F.when(line.rlike(pattern), F.regexp_extract(line, pattern, 1)).otherwise(line))

    return let(_stripped_line(text), of)


def extract_name(text: Column, pattern: str = NAME_PATTERN) -> Column:
    """Text before the first dash of the first line, else the whole line; null for blank text."""
    return _head(text, pattern)


def extract_title(text: Column, label: str = TITLE_LABEL) -> Column:
    """Text after ``label`` when the first line starts with it, else as :func:`extract_name`."""
    return let(
        _head(text, rf"^{label}[{BLANK}]*(.+)"),
        lambda labelled: F.coalesce(F.when(labelled != "", labelled), extract_name(text)),
    )


def task_text(text: Column, task: str) -> Column:
    return F.concat(F.lit(f"{task}: "), text)


def tokens(text: Column) -> Column:
    """Lower-cased word tokens in order; no stemming and no stop words."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def default_keywords(stem: Column) -> Column:
    return F.translate(stem, "_", " ")


def file_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.txt$", "")
