"""Prompt text and message lists for scoring a document against an offer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prompt wording, excerpt length and the worked example shown to the model.
EXCERPT_CHARS = 600
PROMPT_TASK = (
    "[TASK] Score this candidate 0-100. Output only JSON:\n"
    '{"score": <0-100>, "key_matches": ["match1"], "gaps": ["gap1"], '
    '"recommendation": "strong_match|weak_match|no_match"}\n\n'
    "JSON output:"
)
SYSTEM_TEXT = "You are a JSON API. You output only valid JSON. No explanations."
EXAMPLE_QUESTION = (
    "[JOB]\nWe need graphic designer with Photoshop and brand identity skills.\n\n"
    "[CV]\nMaria: Illustrator 6yr, Figma, brand campaigns for L'Oreal.\n\n"
    "[TASK] Score 0-100. JSON output:"
)
EXAMPLE_ANSWER = (
    '{"score": 75, "key_matches": ["Illustrator similar to Photoshop", "brand identity experience"], '
    '"gaps": ["Photoshop not explicitly mentioned"], "recommendation": "weak_match"}'
)


def excerpt(text: Column, chars: int = EXCERPT_CHARS) -> Column:
    """Opening of the text with braces made round, so that it cannot look like the JSON asked for."""
    return F.translate(F.substring(text, 1, chars), "{}", "()")


def prompt(document: Column, offer: Column) -> Column:
    return F.concat(
        F.lit("[JOB]\n"), excerpt(offer), F.lit("\n\n[CV]\n"), excerpt(document), F.lit("\n\n" + PROMPT_TASK)
    )


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(prompt_text: Column) -> Column:
    """System text, worked example as a question and its answer, then the real question."""
    return F.array(
        message("system", F.lit(SYSTEM_TEXT)),
        message("user", F.lit(EXAMPLE_QUESTION)),
        message("assistant", F.lit(EXAMPLE_ANSWER)),
        message("user", prompt_text),
    )
