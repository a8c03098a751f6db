"""Scoring jobs over (offer, document) pairs: screening, prompt, model call, repair, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchweave.functions import guards as G
from matchweave.functions import prompts as P
from matchweave.operators.inference import ERROR_CHARS, CompleteFn, complete


@dataclass(frozen=True)
class Screened:
    """The two sides of an input check, and how often each pattern fired."""

    clean: DataFrame
    quarantine: DataFrame
    pattern_counts: DataFrame


def screen(df: DataFrame, text: str = "raw_text") -> Screened:
    """Split texts on the injection patterns; clean ones carry the bounded text and a flag."""
    flagged = df.withColumn("_injected", F.coalesce(G.has_injection(F.col(text)), F.lit(False)))
    clean = (
        flagged.filter(~F.col("_injected"))
        .drop("_injected")
        .withColumn("safe_text", G.bounded(F.col(text)))
        .withColumn("was_truncated", G.is_long(F.col(text)))
    )
    flags = G.injection_flags(F.col(text))
    counts = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(p).alias("pattern"), F.coalesce(flag, F.lit(False)).alias("hit"))
                    for p, flag in zip(G.INJECTION_PATTERNS, flags)
                ]
            )
        ).alias("_f")
    )
    pattern_counts = counts.groupBy(F.col("_f.pattern").alias("pattern")).agg(
        F.count_if(F.col("_f.hit")).alias("n_rows")
    )
    return Screened(clean, flagged.filter("_injected").drop("_injected"), pattern_counts)


def analysed_pairs(pairs: DataFrame, fn: CompleteFn) -> DataFrame:
    """Add ``analysis`` to pairs with ``document_text`` and ``offer_text``; other columns are kept.

    A pair with a screened-out text is not sent to the model; its record says which side it was.
    """
    refused = F.when(G.has_injection(F.col("document_text")), "document").when(
        G.has_injection(F.col("offer_text")), "offer"
    )
    text = P.prompt(G.bounded(F.col("document_text")), G.bounded(F.col("offer_text")))
    kept = [c for c in pairs.columns if c not in ("document_text", "offer_text")]
    asked = pairs.withColumn("_refused", refused).select(
        *kept, "_refused", F.when(F.col("_refused").isNull(), P.messages(text)).alias("messages")
    )
    analysed = analysed_responses(complete(asked, fn, [*kept, "_refused"]))
    barred = G.failed(F.concat(F.lit("prompt injection detected in "), F.col("_refused")))
    return analysed.withColumn(
        "analysis", F.when(F.col("_refused").isNotNull(), barred).otherwise(F.col("analysis"))
    ).drop("_refused")


def analysed_responses(responses: DataFrame) -> DataFrame:
    """Repair stored model answers (``raw``, ``error``) without calling the model again."""
    repaired = G.repair(responses)
    call_failed = G.failed(F.substring("error", 1, ERROR_CHARS))
    return repaired.withColumn(
        "analysis", F.when(F.col("error").isNotNull(), call_failed).otherwise(F.col("analysis"))
    ).drop("raw", "error")


def hit_pairs(hits: DataFrame, documents: DataFrame, offers: DataFrame, few: bool = False) -> DataFrame:
    """Hits with the texts of both sides; hits whose document is gone are dropped.

    ``few`` says that the number of hits was checked, so that the texts need not be shuffled.
    """
    hits = F.broadcast(hits) if few else hits
    return hits.join(documents.select("filename", F.col("raw_text").alias("document_text")), "filename").join(
        offers.select("query_id", F.col("raw_text").alias("offer_text")), "query_id"
    )


def missing_documents(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """Hits whose document is gone, for a warning."""
    return hits.join(documents.select("filename"), "filename", "left_anti")


def analysed_hits(
    hits: DataFrame, documents: DataFrame, offers: DataFrame, fn: CompleteFn, few: bool = False
) -> DataFrame:
    """The top candidates of each offer with their ``analysis``."""
    return analysed_pairs(hit_pairs(hits, documents, offers, few), fn)


def guard_report(analysed: DataFrame) -> DataFrame:
    """How many responses were fine, mended or lost."""
    return analysed.groupBy(G.status().alias("status")).agg(F.count(F.lit(1)).alias("n_rows"))


def warning_report(analysed: DataFrame) -> DataFrame:
    """How often each kind of warning was given."""
    kind = F.regexp_extract("warning", r"^(score|recommendation coerced|recommendation)", 1)
    return (
        analysed.select(F.explode("analysis.warnings").alias("warning"))
        .groupBy(kind.alias("kind"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def _quoted(value: F.Column) -> F.Column:
    """A list item as the report prints it: in single quotes, or in double ones if it holds a single."""
    single = F.concat(F.lit("'"), value, F.lit("'"))
    return F.when(value.contains("'"), F.concat(F.lit('"'), value, F.lit('"'))).otherwise(single)


def report_block() -> F.Column:
    """The report lines of one ranked, analysed hit."""
    a = "analysis"

    def listed(title: str, items: str, mark: str) -> F.Column:
        lines = F.transform(items, lambda x: F.concat(F.lit(f"       {mark} "), x))
        return F.when(
            F.size(items) > 0, F.concat(F.lit(f"     {title}:\n"), F.array_join(lines, "\n"))
        )

    return F.concat_ws(
        "\n",
        F.format_string("\n#%d  %s  (rrf=%.4f)", F.col("rank"), F.col("filename"), F.col("rrf_score")),
        F.format_string("     LLM score:       %d/100", F.col(f"{a}.score")),
        F.format_string("     Recommendation:  %s", F.col(f"{a}.recommendation")),
        listed("Key matches", f"{a}.key_matches", "+"),
        listed("Gaps", f"{a}.gaps", "-"),
        F.when(
            F.size(f"{a}.warnings") > 0,
            F.concat(
                F.lit("     [guardrail warnings: ["),
                F.array_join(F.transform(f"{a}.warnings", _quoted), ", "),
                F.lit("]]"),
            ),
        ),
        F.when(
            F.col(f"{a}.error").isNotNull(), F.concat(F.lit("     [ERROR: "), F.col(f"{a}.error"), F.lit("]"))
        ),
    )


def match_report(analysed: DataFrame) -> DataFrame:
    """One report text per query, its hits in rank order. A query has at most ``k`` hits."""
    blocks = analysed.select("query_id", F.struct("rank", report_block().alias("block")).alias("_b"))
    return blocks.groupBy("query_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("_b")), lambda b: b["block"]), "\n").alias("report")
    )
