"""Expressions over chat messages: sizes, transcript lines, summaries, budget checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchweave.schemas import CHARS_PER_TOKEN, RESPONSE_BUDGET, SUMMARY_CAP, SUMMARY_TAIL

# Labels and sentences that results are compared on.
SUMMARY_LABEL = "[Summary of earlier conversation]: "
FALLBACK_OPEN, FALLBACK_CLOSE = "[Previous conversation truncated. Last topics: ", "]"
LATER = "\n\nLATER: "
ANSWER_ERROR_OPEN, ANSWER_ERROR_CLOSE = "[LLM error: ", "]"
SUMMARY_REQUEST = (
    "Summarize this conversation in 3 sentences. Keep all important facts, names, scores, and decisions.\n\n"
)
RESET = "/reset"

#: A transcript tail never reaches back further: the shortest line, ``": "`` and a line end, has 3 characters.
TAIL_LINES = SUMMARY_TAIL // 3 + 1


def tokens_of(chars: Column) -> Column:
    """Token estimate of a whole message list from its character total."""
    return F.floor(chars / F.lit(CHARS_PER_TOKEN)).cast("bigint")


def line(role: Column, content: Column) -> Column:
    return F.concat(F.upper(role), F.lit(": "), content)


def fallback_summary(transcript: Column) -> Column:
    """The end of a transcript in a fixed sentence."""
    return F.concat(F.lit(FALLBACK_OPEN), F.right(transcript, F.lit(SUMMARY_TAIL)), F.lit(FALLBACK_CLOSE))


def joined_summary(old: Column, new: Column) -> Column:
    """A first summary stays as it is; later ones are appended and the whole is capped."""
    return F.when(old == "", new).otherwise(F.left(F.concat(old, F.lit(LATER), new), F.lit(SUMMARY_CAP)))


def label_chars(summary: Column) -> Column:
    """Characters a summary takes in the message list."""
    return F.when(summary == "", F.lit(0)).otherwise(F.length(summary) + len(SUMMARY_LABEL))


def spare_chars(max_tokens: int) -> int:
    """Fewest characters with which a message list is over budget.

    ``floor(chars / 4) + reserve > max_tokens`` holds from ``4 * (max_tokens - reserve + 1)`` on.
    """
    return CHARS_PER_TOKEN * (max_tokens - RESPONSE_BUDGET + 1)


def usage(chars: Column, messages: Column, summary: Column, max_tokens: int) -> list[Column]:
    """``used, budget, remaining, turns, has_summary`` of a conversation state."""
    used = tokens_of(chars)
    return [
        used.alias("used"),
        F.lit(max_tokens).cast("bigint").alias("budget"),
        (F.lit(max_tokens - RESPONSE_BUDGET) - used).cast("bigint").alias("remaining"),
        F.floor(messages / 2).cast("bigint").alias("turns"),
        (summary != "").alias("has_summary"),
    ]
