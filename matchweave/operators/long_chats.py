"""Compaction of conversations of any length, without bringing one together in a task.

Which messages trigger a compaction depends on lengths alone, through running sums ``S``: with the
kept history starting after the sum ``base``, the next trigger is the first user message at least
four messages later whose ``S`` reaches ``base`` plus what the budget leaves. So

1. running sums are built block by block;
2. while a summary still grows, each round finds the next trigger of all conversations at once;
   summaries reach their cap and then never change again, after a dozen rounds at most;
3. from then on every trigger leads to the next by a fixed rule. Blocks of a conversation work out
   where a chain that enters them leaves them; only the few messages at which a block can be
   entered go up to the next level, until one group per conversation is left.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchweave.functions import chat as C
from matchweave.operators.inference import CompleteFn, complete
from matchweave.operators.scale import BLOCK_SPAN, running_sum, sliced_join, top_per_key, union_all
from matchweave.schemas import KEEP_LAST, SUMMARY_CAP, SUMMARY_TAIL
from matchweave.session import durable

_CHAIN = "conv_id long, idx long, s long, base long, at long, hops long, start_turn long, prev double, last long, need long"
#: Levels of blocks below the one group per conversation.
LEVELS = 2
#: Characters of the transcript that a model summarises at once.
PART_CHARS = 20_000


def _joined_lines(lines: str) -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(lines)), lambda x: x["line"]), "\n")


def _joined_lines_of(turn: str, line: str) -> Column:
    lines = F.sort_array(F.collect_list(F.struct(F.col(turn).alias("turn"), F.col(line).alias("line"))))
    return F.array_join(F.transform(lines, lambda x: x["line"]), "\n")


def transcript_tails(history: DataFrame, order: Column) -> DataFrame:
    """``conv_id, tail``: enough of the end of each transcript for a fallback summary."""
    lines = history.select(
        "conv_id", "turn", F.right(C.line(F.col("role"), F.col("content")), F.lit(SUMMARY_TAIL)).alias("line")
    )
    last = top_per_key(lines, "conv_id", [order], C.TAIL_LINES)
    last = last.select("conv_id", F.struct("turn", "line").alias("_line"))
    return last.groupBy("conv_id").agg(_joined_lines("_line").alias("tail"))


def _summaries(parts: DataFrame, summarizer: CompleteFn | None, part_chars: int) -> DataFrame:
    """``conv_id, fresh``: summary of the messages that leave each history."""
    if summarizer is not None:
        return _model_summaries(parts, summarizer, part_chars)
    tails = transcript_tails(parts, F.col("turn").desc())
    return tails.select("conv_id", C.fallback_summary(F.col("tail")).alias("fresh"))


def _model_summaries(parts: DataFrame, summarizer: CompleteFn, part_chars: int) -> DataFrame:
    """Summaries by a model, as a tree where a history is long.

    Transcript lines are cut into parts of about ``part_chars`` characters (a longer line is one by itself), each is summarised,
    and of a history with several parts the capped summaries are lines again, until one is left. A part whose call
    fails has the fallback sentence. So no row holds more than a part.
    """
    lines = parts.select("conv_id", F.col("turn").cast("bigint").alias("turn"), C.line(F.col("role"), F.col("content")).alias("line"))
    finished = []
    while True:
        size = F.length("line").cast("bigint") + 1
        placed = running_sum(lines, "conv_id", "turn", {"_end": size})
        part = F.floor((F.col("_end") - size) / part_chars).cast("bigint").alias("_part")
        texts = placed.groupBy("conv_id", part).agg(_joined_lines_of("turn", "line").alias("_text"))
        chat = F.array(F.struct(F.lit("user").alias("role"), F.concat(F.lit(C.SUMMARY_REQUEST), "_text").alias("content")))
        asked = texts.select("conv_id", "_part", C.fallback_summary(F.col("_text")).alias("_fallback"), chat.alias("messages"))
        said = complete(asked, summarizer, ["conv_id", "_part", "_fallback"])
        # each call is paid for once
        said = durable(said.select("conv_id", "_part", F.coalesce("raw", "_fallback").alias("fresh")))
        several = said.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("conv_id")
        finished.append(said.join(several, "conv_id", "left_anti").select("conv_id", "fresh"))
        if several.limit(1).isEmpty():
            return union_all(finished)
        rest = said.join(several, "conv_id", "left_semi")
        lines = rest.select("conv_id", F.col("_part").alias("turn"), F.left(F.col("fresh"), F.lit(SUMMARY_CAP)).alias("line"))


def _indexed(history: DataFrame, span: int) -> DataFrame:
    """``conv_id, turn, is_user, n, idx, s``: position and running size of every message."""
    light = history.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        (F.col("role") == "user").alias("is_user"),
        F.length("content").cast("bigint").alias("n"),
    )
    sums = {"idx": F.lit(1).cast("bigint"), "s": F.col("n")}
    return running_sum(light, "conv_id", "turn", sums, span)


def _triggers(indexed: DataFrame) -> DataFrame:
    """User messages with the history that would be kept if they triggered: its size before, its first turn."""
    first = indexed.select(
        "conv_id",
        (F.col("idx") + (KEEP_LAST - 1)).alias("idx"),
        (F.col("s") - F.col("n")).alias("base"),
        F.col("turn").alias("start_turn"),
    )
    users = indexed.filter("is_user").filter(F.col("idx") > KEEP_LAST).select("conv_id", "idx", "s")
    return users.join(first, ["conv_id", "idx"])


def _rounds(
    triggers: DataFrame,
    history: DataFrame,
    states: DataFrame,
    max_tokens: int,
    summarizer: CompleteFn | None,
    part_chars: int,
) -> DataFrame:
    """Compact round by round until nothing triggers, or until fallback summaries are full."""
    spare = C.spare_chars(max_tokens)
    done, active = None, durable(states)
    while True:
        need = F.col("_base") + spare - F.length("system") - C.label_chars(F.col("summary"))
        limits = active.select(
            "conv_id", F.col("at").alias("_at"), F.col("base").alias("_base"), need.alias("_need")
        )
        due = sliced_join(triggers, limits, "conv_id", "idx").filter(
            (F.col("idx") > F.col("_at")) & (F.col("s") >= F.col("_need"))
        )
        hit = F.min_by(F.struct("idx", "base", "start_turn"), "idx")
        found = due.groupBy("conv_id").agg(hit.alias("_hit"))
        moved = durable(active.join(found, "conv_id", "left"))
        fired = moved.filter(F.col("_hit").isNotNull())
        settled = moved.filter(F.col("_hit").isNull()).drop("_hit")
        if fired.limit(1).isEmpty():
            return settled if done is None else done.unionByName(settled)
        bounds = fired.select("conv_id", F.col("start_turn").alias("_from"), F.col("_hit.start_turn").alias("_to"))
        leaving = history.join(bounds, "conv_id").filter(
            (F.col("turn") < F.col("_to")) & (F.col("_from").isNull() | (F.col("turn") >= F.col("_from")))
        )
        fresh = _summaries(leaving.drop("_from", "_to"), summarizer, part_chars)
        updated = durable(
            fired.join(fresh, "conv_id").select(
                "conv_id",
                "system",
                C.joined_summary(F.col("summary"), F.col("fresh")).alias("summary"),
                (F.col("n_compactions") + 1).alias("n_compactions"),
                F.col("_hit.idx").alias("at"),
                F.col("_hit.base").alias("base"),
                F.col("_hit.start_turn").alias("start_turn"),
            )
        )
        # A model's summaries change in length until they are full as well, but then stay too.
        full = F.length("summary") >= SUMMARY_CAP
        several = F.col("n_compactions") > 1
        finished = settled.unionByName(updated.filter(full & several))
        done = finished if done is None else done.unionByName(finished)
        active = updated.filter(~(full & several))
        if active.limit(1).isEmpty():
            return done


def _chain_block(rows: pd.DataFrame) -> pd.DataFrame:
    """Where chains that enter this group leave it, for the messages at which it can be entered.

    Rows are possible triggers in order: entering at one leads, inside its own block, to the
    compaction ``at`` with ``base``, after ``hops`` compactions.
    """
    rows = rows.sort_values("idx", ignore_index=True)
    s, idx = rows["s"].to_numpy(), rows["idx"].to_numpy()
    base, at = rows["base"].to_numpy().copy(), rows["at"].to_numpy().copy()
    hops, start = rows["hops"].to_numpy().copy(), rows["start_turn"].to_numpy().copy()
    need = rows["need"].to_numpy()
    for r in range(len(rows) - 1, -1, -1):
        nxt = max(np.searchsorted(s, base[r] + need[r]), np.searchsorted(idx, at[r], side="right"))
        if nxt < len(rows):
            base[r], at[r], start[r] = base[nxt], at[nxt], start[nxt]
            hops[r] += hops[nxt]
    prev = rows["prev"].to_numpy().copy()
    unknown = np.isnan(prev)
    unknown[0] = False
    prev[unknown] = rows["last"].to_numpy()[np.flatnonzero(unknown) - 1]
    prev[0] = np.nan
    entry = np.isnan(prev) | ((prev < s[0] + np.maximum(need, 1)) & (s > prev))
    out = rows.assign(base=base, at=at, hops=hops, start_turn=start, prev=prev, last=rows["last"].to_numpy()[-1])
    return out[entry]


def _chained(triggers: DataFrame, states: DataFrame, max_tokens: int, span: int) -> DataFrame:
    """Follow the fixed rule from each full state to its last compaction."""
    need = C.spare_chars(max_tokens) - F.length("system") - C.label_chars(F.col("summary"))
    start = states.select("conv_id", F.col("at").alias("_at"), need.cast("bigint").alias("need"))
    rows = (
        sliced_join(triggers, start, "conv_id", "idx")
        .filter(F.col("idx") > F.col("_at"))
        .select(
            "conv_id", "idx", "s", "base",
            F.col("idx").alias("at"), F.lit(1).cast("bigint").alias("hops"), "start_turn",
            F.lit(None).cast("double").alias("prev"), F.col("s").alias("last"), "need",
        )
    )
    for level in range(1, LEVELS + 1):
        group = F.floor(F.col("idx") / F.lit(span**level)).cast("bigint").alias("_group")
        rows = rows.groupBy("conv_id", group).applyInPandas(lambda pdf: _chain_block(pdf[_CHAIN_NAMES]), _CHAIN)
    rows = durable(rows.groupBy("conv_id").applyInPandas(lambda pdf: _chain_block(pdf[_CHAIN_NAMES]), _CHAIN))
    entered = rows.join(
        states.select("conv_id", F.col("base").alias("_base")), "conv_id"
    ).filter(F.col("s") >= F.col("_base") + F.col("need"))
    final = entered.groupBy("conv_id").agg(F.min_by(F.struct("at", "base", "start_turn", "hops"), "idx").alias("_f"))
    moved = states.join(final, "conv_id", "left")
    return moved.select(
        "conv_id",
        "system",
        "summary",
        (F.col("n_compactions") + F.coalesce("_f.hops", F.lit(0))).alias("n_compactions"),
        F.coalesce("_f.at", "at").alias("at"),
        F.coalesce("_f.base", "base").alias("base"),
        F.coalesce("_f.start_turn", "start_turn").alias("start_turn"),
    )


_CHAIN_NAMES = [part.split()[0] for part in _CHAIN.split(", ")]


def compacted(
    messages: DataFrame,
    max_tokens: int,
    default_system: str = "",
    summarizer: CompleteFn | None = None,
    span: int = BLOCK_SPAN,
    once: bool = False,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """Compaction states, as ``compact_history`` gives them, for conversations of any length.

    With ``once`` the budget is tested a single time, after the last message.
    """
    is_system = F.col("role") == "system"
    history = messages.filter(F.col("role").isin("user", "assistant"))
    totals = durable(
        messages.groupBy("conv_id").agg(
            F.coalesce(
                F.min_by(F.when(is_system, F.col("content")), F.when(is_system, F.col("turn"))),
                F.lit(default_system),
            ).alias("system"),
            F.count_if(~is_system).alias("total"),
            F.coalesce(F.sum(F.when(~is_system, F.length("content"))), F.lit(0)).alias("all_chars"),
            F.min(F.when(~is_system, F.col("turn"))).cast("bigint").alias("start_turn"),
        )
    )
    if once:
        return _compacted_once(history, totals, max_tokens, summarizer, part_chars)

    triggers = durable(_triggers(durable(_indexed(history, span))))
    states = totals.select(
        "conv_id",
        "system",
        F.lit("").alias("summary"),
        F.lit(0).cast("bigint").alias("n_compactions"),
        F.lit(KEEP_LAST).cast("bigint").alias("at"),
        F.lit(0).cast("bigint").alias("base"),
        "start_turn",
    )
    states = durable(_rounds(triggers, history, states, max_tokens, summarizer, part_chars))
    full = (F.length("summary") >= SUMMARY_CAP) & (F.col("n_compactions") > 1)
    states = states.filter(~full).unionByName(_chained(triggers, states.filter(full), max_tokens, span))
    kept = F.when(F.col("n_compactions") > 0, F.col("total") - F.col("at") + KEEP_LAST).otherwise(F.col("total"))
    return states.join(totals.drop("system", "start_turn"), "conv_id").select(
        "conv_id",
        "system",
        "summary",
        "n_compactions",
        "start_turn",
        kept.cast("bigint").alias("n_messages"),
        (F.col("all_chars") - F.col("base")).cast("bigint").alias("chars"),
    )


def _compacted_once(
    history: DataFrame, totals: DataFrame, max_tokens: int, summarizer: CompleteFn | None, part_chars: int
) -> DataFrame:
    due = (F.length("system") + F.col("all_chars") >= C.spare_chars(max_tokens)) & (F.col("total") > KEEP_LAST)
    last = top_per_key(
        history.select("conv_id", "turn", F.length("content").alias("n")), "conv_id", [F.col("turn").desc()], KEEP_LAST
    )
    recent = last.groupBy("conv_id").agg(
        F.min("turn").cast("bigint").alias("_from"), F.sum("n").alias("_chars")
    )
    over = durable(totals.filter(due).join(recent, "conv_id"))
    leaving = history.join(over.select("conv_id", "_from"), "conv_id").filter(F.col("turn") < F.col("_from"))
    fresh = _summaries(leaving.drop("_from"), summarizer, part_chars)
    done = over.join(fresh, "conv_id").select(
        "conv_id",
        "system",
        F.col("fresh").alias("summary"),
        F.lit(1).cast("bigint").alias("n_compactions"),
        F.col("_from").alias("start_turn"),
        F.lit(KEEP_LAST).cast("bigint").alias("n_messages"),
        F.col("_chars").cast("bigint").alias("chars"),
    )
    same = totals.filter(~due).select(
        "conv_id",
        "system",
        F.lit("").alias("summary"),
        F.lit(0).cast("bigint").alias("n_compactions"),
        "start_turn",
        F.col("total").cast("bigint").alias("n_messages"),
        F.col("all_chars").cast("bigint").alias("chars"),
    )
    return same.unionByName(done)
