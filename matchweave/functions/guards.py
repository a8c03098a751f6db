"""Input screening and response repair as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchweave.functions.text import BLANK, strip
from matchweave.session import setting

# The screening patterns, limits, labels and texts results are compared on.
INJECTION_PATTERNS = [
    r"ignore (previous|all) instructions",
    r"forget (everything|your|the) (previous|system)",
    r"you are now",
    r"new instructions:",
    r"###\s*system",
]
MAX_CHARS = 3000
TRUNCATION_MARK = "\n[...text truncated...]"
RESPONSE_PREFIX = '{"score": '
FENCED_OBJECT = rf"(?s)```(?:json)?[{BLANK}]*(\{{.*?\}})[{BLANK}]*```"
PLAIN_OBJECT = r"(?s)\{.*?\}"
STRONG, WEAK, NONE = "strong_match", "weak_match", "no_match"
STRONG_FROM, WEAK_FROM = 75, 45
LIST_ITEMS = 3
RAW_KEPT = 300
GUARD_ERROR = "guardrail_failed"

_NUMBER = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$"


def injection_flags(text: Column) -> list[Column]:
    """One boolean per pattern, searched anywhere in the whole text, any case."""
    return [text.rlike("(?iU)" + p) for p in INJECTION_PATTERNS]


def has_injection(text: Column) -> Column:
    return text.rlike("(?iU)" + "|".join(f"(?:{p})" for p in INJECTION_PATTERNS))


def is_long(text: Column, max_chars: int = MAX_CHARS) -> Column:
    return F.length(text) > max_chars


def bounded(text: Column, max_chars: int = MAX_CHARS) -> Column:
    """The text as it goes on: cut at ``max_chars`` with a mark, if longer."""
    return F.when(
        is_long(text, max_chars), F.concat(F.substring(text, 1, max_chars), F.lit(TRUNCATION_MARK))
    ).otherwise(text)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a name inside ``body``.

    A value used several times is computed once, and the expression stays linear in size when a
    filter above is pushed through it.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def find_json(raw: Column, prefix: str = RESPONSE_PREFIX) -> Column:
    """Fenced object, else first plain object, else one completed by the prefix, else the raw text."""

    def first(text: Column, pattern: str, group: int) -> Column:
        return let(F.regexp_extract(text, pattern, group), lambda found: F.when(found != "", found))

    return F.coalesce(
        first(raw, FENCED_OBJECT, 1),
        first(raw, PLAIN_OBJECT, 0),
        first(F.concat(F.lit(prefix), raw), PLAIN_OBJECT, 0),
        raw,
    )


def implied_recommendation(score: Column) -> Column:
    return F.when(score >= STRONG_FROM, STRONG).when(score >= WEAK_FROM, WEAK).otherwise(NONE)


def coerced_score(data: Column) -> Column:
    """Number (or numeric text, or boolean) cut to an integer in 0..100; -1 if it is none.

    A missing key counts as 0.
    """

    def number(text: Column) -> Column:
        written = F.when(text.rlike(_NUMBER), F.regexp_replace(text, "_", "").try_cast("double"))
        return F.when(text == "true", F.lit(1.0)).when(text == "false", F.lit(0.0)).otherwise(written)

    def clamped(value: Column) -> Column:
        usable = value.isNotNull() & (F.abs(value) != float("inf"))
        return F.when(usable, F.greatest(F.lit(0.0), F.least(F.lit(100.0), value)).cast("int")).otherwise(F.lit(-1))

    text = strip(F.try_variant_get(data, "$.score", "string"))
    missing = F.try_variant_get(data, "$.score", "variant").isNull()
    return F.when(missing, F.lit(0)).otherwise(let(let(text, number), clamped))


def coerced_list(data: Column, key: str) -> Column:
    """First three items as text; an empty list for anything that is no list."""
    items = F.slice(F.try_variant_get(data, f"$.{key}", "array<variant>"), 1, LIST_ITEMS)

    def as_text(item: Column) -> Column:
        kind = F.schema_of_variant(item)
        text = F.try_variant_get(item, "$", "string")
        return (
            F.when(kind == "VOID", "None")
            .when(kind == "BOOLEAN", F.initcap(text))
            .when(kind.startswith("DECIMAL") & ~text.contains("."), F.concat(text, F.lit(".0")))
            .otherwise(F.coalesce(text, F.to_json(item)))
        )

    return F.coalesce(F.transform(items, as_text), F.array().cast("array<string>"))


def _checked(data: Column) -> Column:
    """The analysis in a parsed response, mended where possible."""
    said = F.regexp_replace(
        F.lower(strip(F.try_variant_get(data, "$.recommendation", "string"))), rf"[{BLANK}]+", "_"
    )
    judged = F.struct(coerced_score(data).alias("score"), said.alias("said"))

    def labelled(j: Column) -> Column:
        implied = implied_recommendation(j["score"])
        known = F.coalesce(j["said"].isin(STRONG, WEAK, NONE), F.lit(False))
        return F.struct(
            j["score"].alias("score"),
            implied.alias("implied"),
            known.alias("known"),
            F.when(known, j["said"]).otherwise(implied).alias("label"),
        )

    def warnings(k: Column) -> Column:
        score = k["score"].cast("string")
        wrong = (k["label"] != k["implied"]) & (k["score"] >= 0)
        given = F.array(
            F.when(k["score"] < 0, F.concat(F.lit("score out of range: "), score)),
            F.when(~k["known"], F.concat(F.lit("recommendation coerced from model output to: "), k["implied"])),
            F.when(
                wrong,
                F.concat(
                    F.lit("recommendation '"), k["label"], F.lit("' inconsistent with score="), score,
                    F.lit(", corrected to '"), k["implied"], F.lit("'"),
                ),
            ),
        )
        return let(F.filter(given, lambda w: w.isNotNull()), lambda w: F.when(F.size(w) > 0, w))

    def record(k: Column) -> Column:
        return F.struct(
            k["score"].alias("score"),
            coerced_list(data, "key_matches").alias("key_matches"),
            coerced_list(data, "gaps").alias("gaps"),
            F.when(k["score"] >= 0, k["implied"]).otherwise(k["label"]).alias("recommendation"),
            warnings(k).alias("warnings"),
            F.lit(None).cast("string").alias("error"),
            F.lit(None).cast("string").alias("raw"),
        )

    return let(let(judged, labelled), record)


def repair(responses: DataFrame, raw: str = "raw", out: str = "analysis") -> DataFrame:
    """Add the checked analysis of each model response.

    What can be mended is mended and noted as a warning; a response without a readable object gives
    the fallback record and keeps its first characters.
    """

    def analysed(text: Column) -> Column:
        body = F.regexp_replace(find_json(text), r'("score"\s*:\s*)-?(?:NaN|Infinity)\b', "$1null")
        parsed = let(F.try_parse_json(body), lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), v))
        fallback = failed(F.lit(GUARD_ERROR), F.substring(text, 1, RAW_KEPT))
        return let(parsed, lambda data: F.when(data.isNull(), fallback).otherwise(_checked(data)))

    # A repeated key keeps its last value; the setting is read when the expression is analysed.
    with setting(responses.sparkSession, "spark.sql.variant.allowDuplicateKeys", "true"):
        return responses.withColumn(out, let(F.col(raw), analysed))


def failed(error: Column, raw: Column | None = None) -> Column:
    """The record of a pair that could not be analysed."""
    empty = F.array().cast("array<string>")
    return F.struct(
        F.lit(-1).alias("score"),
        empty.alias("key_matches"),
        empty.alias("gaps"),
        F.lit(NONE).alias("recommendation"),
        F.lit(None).cast("array<string>").alias("warnings"),
        error.alias("error"),
        (F.lit(None).cast("string") if raw is None else raw).alias("raw"),
    )


def status(analysis: str = "analysis") -> Column:
    return (
        F.when(F.col(f"{analysis}.error").isNotNull(), "ERROR")
        .when(F.col(f"{analysis}.warnings").isNotNull(), "WARN")
        .otherwise("OK")
    )
