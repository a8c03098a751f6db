"""Conversation histories: sizes, transcripts, compaction under a token budget, answers.

Messages are rows ``conv_id, turn, role, content`` with ``turn`` unique within a conversation. The
role ``system`` gives the system prompt (the first one counts) and is no part of the history.

Ordinary conversations are folded in one row each. Conversations with more than ``FOLD_ROWS``
messages never come together in one task: see :mod:`matchweave.operators.long_chats`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchweave.functions import chat as C
from matchweave.functions.text import strip
from matchweave.operators import long_chats
from matchweave.operators.inference import CompleteFn, complete
from matchweave.operators.scale import BLOCK_SPAN, running_sum, top_per_key
from matchweave.schemas import KEEP_LAST, MAX_TOKENS
from matchweave.session import durable

#: Longest history that is folded inside one row.
FOLD_ROWS = 1_000

STATE_COLUMNS = [
    "conv_id", "system", "summary", "n_compactions", "start_turn", "n_messages", "chars",
]


def history_of(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("role").isin("user", "assistant"))


def token_usage(messages: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Budget figures of each conversation as stored, without compaction."""
    is_history = F.col("role") != "system"
    first_system = F.min_by(
        F.when(~is_history, F.length("content")), F.when(~is_history, F.col("turn"))
    )
    sizes = messages.groupBy("conv_id").agg(
        (F.coalesce(F.sum(F.when(is_history, F.length("content"))), F.lit(0)) + F.coalesce(first_system, F.lit(0))).alias("chars"),
        F.count_if(is_history).alias("n"),
    )
    return sizes.select("conv_id", *C.usage(F.col("chars"), F.col("n"), F.lit(""), max_tokens))


def running_tokens(messages: DataFrame, span: int = BLOCK_SPAN) -> DataFrame:
    """Size of each conversation after every turn, and what the turn added."""
    sized = messages.select("conv_id", "turn", F.length("content").cast("bigint").alias("n_chars"))
    running = running_sum(sized, "conv_id", "turn", {"running_chars": F.col("n_chars")}, span)
    before = C.tokens_of(F.col("running_chars") - F.col("n_chars"))
    used = C.tokens_of(F.col("running_chars"))
    return running.select("conv_id", "turn", "running_chars", used.alias("used"), (used - before).alias("added"))


def keep_last(messages: DataFrame, n: int = KEEP_LAST) -> DataFrame:
    """The last ``n`` history messages of each conversation."""
    return top_per_key(history_of(messages), "conv_id", [F.col("turn").desc()], n).drop("rank")


def transcript(messages: DataFrame, span: int = BLOCK_SPAN) -> DataFrame:
    """``conv_id, part, transcript``: the lines of each conversation in turn order.

    Parts cover ``span`` turns, so that any ordinary conversation is one part and a huge one comes
    as several, to be read in order with a line end between them.
    """
    lines = F.struct("turn", C.line(F.col("role"), F.col("content")).alias("line"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(lines)), lambda x: x["line"]), "\n")
    part = F.floor(F.col("turn") / span).cast("bigint").alias("part")
    return history_of(messages).groupBy("conv_id", part).agg(text.alias("transcript"))


def fallback_summaries(messages: DataFrame) -> DataFrame:
    """Summary sentence of each whole conversation; reads back only as many lines as it can show."""
    tails = long_chats.transcript_tails(history_of(messages), F.col("turn").desc())
    return tails.select("conv_id", C.fallback_summary(F.col("tail")).alias("summary"))


def _fold(messages: Column, system: Column, max_tokens: int) -> Column:
    """State after feeding messages in turn order, checking the budget at each user message."""
    item = "struct<turn:bigint,role:string,content:string>"
    start = F.struct(
        F.array().cast(f"array<{item}>").alias("history"),
        F.lit(0).cast("bigint").alias("chars"),
        F.lit("").alias("summary"),
        F.lit(0).alias("n"),
    )

    def appended(state: Column, m: Column) -> Column:
        return F.struct(
            F.concat(state["history"], F.array(m)).alias("history"),
            (state["chars"] + F.length(m["content"])).alias("chars"),
            state["summary"].alias("summary"),
            state["n"].alias("n"),
        )

    def compacted(state: Column) -> Column:
        history = state["history"]
        old = F.slice(history, F.lit(1), F.size(history) - KEEP_LAST)
        text = F.array_join(F.transform(old, lambda x: C.line(x["role"], x["content"])), "\n")
        recent = F.slice(history, F.size(history) - (KEEP_LAST - 1), F.lit(KEEP_LAST))
        return F.struct(
            recent.alias("history"),
            F.aggregate(recent, F.lit(0).cast("bigint"), lambda n, x: n + F.length(x["content"])).alias("chars"),
            C.joined_summary(state["summary"], C.fallback_summary(text)).alias("summary"),
            (state["n"] + 1).alias("n"),
        )

    def checked(state: Column, m: Column) -> Column:
        chars = F.length(system) + C.label_chars(state["summary"]) + state["chars"]
        due = (m["role"] == "user") & (F.size(state["history"]) > KEEP_LAST) & (chars >= C.spare_chars(max_tokens))
        return F.when(due, compacted(state)).otherwise(state)

    def step(state: Column, m: Column) -> Column:
        grown = F.element_at(F.transform(F.array(appended(state, m)), lambda s: checked(s, m)), 1)
        return F.when((m["role"] == "user") & is_reset(m["content"]), start).otherwise(grown)

    return F.aggregate(messages, start, step)


def _folded(messages: DataFrame, max_tokens: int, default_system: str) -> DataFrame:
    is_system = F.col("role") == "system"
    m = F.struct(F.col("turn").cast("bigint").alias("turn"), "role", "content")
    grouped = messages.groupBy("conv_id").agg(
        F.coalesce(
            F.min_by(F.when(is_system, F.col("content")), F.when(is_system, F.col("turn"))), F.lit(default_system)
        ).alias("system"),
        F.sort_array(F.collect_list(F.when(~is_system, m))).alias("messages"),
    )
    state = grouped.select(
        "conv_id", "system", _fold(F.col("messages"), F.col("system"), max_tokens).alias("s")
    )
    return state.select(
        "conv_id",
        "system",
        F.col("s.summary").alias("summary"),
        F.col("s.n").cast("bigint").alias("n_compactions"),
        F.when(F.size("s.history") > 0, F.element_at("s.history", 1)["turn"]).alias("start_turn"),
        F.size("s.history").cast("bigint").alias("n_messages"),
        F.col("s.chars").alias("chars"),
    )


def compact_history(
    messages: DataFrame,
    max_tokens: int = MAX_TOKENS,
    check: str = "each_user_turn",
    default_system: str = "",
    summarizer: CompleteFn | None = None,
    fold_rows: int = FOLD_ROWS,
    span: int = BLOCK_SPAN,
    part_chars: int = long_chats.PART_CHARS,
) -> DataFrame:
    """State of each conversation after compaction: the summary and where the kept history starts.

    ``check`` is ``each_user_turn`` (the budget is tested whenever a user message arrives, as in a
    running chat) or ``end`` (once, over the whole history). With a ``summarizer`` a model writes
    the summaries; without one, or when it fails, the fallback sentence is used. A model is sent about ``part_chars``
    characters at once; of longer histories it summarises parts, then their summaries.

    A user message ``/reset`` empties a conversation but for its system prompt, as in a stream; it is no message itself.
    """
    if check not in ("each_user_turn", "end"):
        raise ValueError(f"unknown check {check}")
    messages = messages.filter(F.col("role").isin("system", "user", "assistant"))
    if summarizer is not None or check == "end":
        once = check == "end"
        states = long_chats.compacted(after_reset(messages), max_tokens, default_system, summarizer, span, once, part_chars)
        return _with_emptied(states, messages.select("conv_id").distinct(), default_system)
    sizes = messages.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > fold_rows)
    long_ids = sizes.select("conv_id")
    if long_ids.limit(1).isEmpty():
        return _folded(messages, max_tokens, default_system).select(*STATE_COLUMNS)
    ordinary = messages.join(long_ids, "conv_id", "left_anti")
    lengthy = messages.join(long_ids, "conv_id", "left_semi")
    states = long_chats.compacted(after_reset(lengthy), max_tokens, default_system, None, span)
    return _folded(ordinary, max_tokens, default_system).select(*STATE_COLUMNS).unionByName(
        _with_emptied(states, long_ids, default_system)
    )


def _with_emptied(states: DataFrame, ids: DataFrame, default_system: str) -> DataFrame:
    """States of all ``ids``: of a conversation without anything after its last reset, an empty one."""
    empty = {"system": default_system, "summary": "", "n_compactions": 0, "n_messages": 0, "chars": 0}
    every = ids.join(states, "conv_id", "left")
    return every.select(*[F.coalesce(c, F.lit(empty[c])).alias(c) if c in empty else F.col(c) for c in STATE_COLUMNS])


def state_usage(states: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Budget figures of compacted conversations."""
    chars = F.length("system") + C.label_chars(F.col("summary")) + F.col("chars")
    return states.select(
        "conv_id", "n_compactions", *C.usage(chars, F.col("n_messages"), F.col("summary"), max_tokens)
    )


def build_messages(messages: DataFrame, states: DataFrame) -> DataFrame:
    """What would be sent to a model, as rows ordered by ``section, turn``.

    Section 0 is the system prompt, 1 the labelled summary if there is one, 2 the kept history. The states are read
    three times, so they should be a written table.
    """
    nothing = F.lit(None).cast("bigint")
    system = states.select(
        "conv_id", F.lit(0).alias("section"), nothing.alias("turn"), F.lit("system").alias("role"), F.col("system").alias("content")
    )
    summary = states.filter(F.col("summary") != "").select(
        "conv_id",
        F.lit(1).alias("section"),
        nothing.alias("turn"),
        F.lit("assistant").alias("role"),
        F.concat(F.lit(C.SUMMARY_LABEL), "summary").alias("content"),
    )
    kept = history_of(messages).join(states.select("conv_id", "start_turn"), "conv_id")
    recent = kept.filter(F.col("turn") >= F.col("start_turn")).select(
        "conv_id", F.lit(2).alias("section"), "turn", "role", "content"
    )
    return system.unionByName(summary).unionByName(recent)


def answers(
    messages: DataFrame, fn: CompleteFn, max_tokens: int = MAX_TOKENS, default_system: str = "", **options
) -> DataFrame:
    """An assistant message for each conversation that waits for one, as rows to append.

    A waiting conversation ends with a user message, so its history was just checked: it fits the
    budget or is no longer than four messages, and can be sent as one list. A failed call is
    answered with the error text, which becomes part of the history like any answer.
    """
    last = history_of(messages).groupBy("conv_id").agg(
        F.max("turn").alias("last_turn"), F.max_by("role", "turn").alias("last_role")
    )
    waiting = last.filter(F.col("last_role") == "user").select("conv_id", "last_turn")
    open_chats = messages.join(waiting.select("conv_id"), "conv_id", "left_semi")
    states = durable(compact_history(open_chats, max_tokens, default_system=default_system, **options))
    rows = build_messages(open_chats, states)
    ordered = F.sort_array(F.collect_list(F.struct("section", "turn", "role", "content")))
    chats = rows.groupBy("conv_id").agg(
        F.transform(ordered, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages")
    )
    replies = complete(chats.join(waiting, "conv_id"), fn, ["conv_id", "last_turn"])
    failed = F.concat(F.lit(C.ANSWER_ERROR_OPEN), "error", F.lit(C.ANSWER_ERROR_CLOSE))
    return replies.select(
        "conv_id",
        (F.col("last_turn") + 1).alias("turn"),
        F.lit("assistant").alias("role"),
        F.coalesce("raw", failed).alias("content"),
    )


def is_reset(content: Column) -> Column:
    return F.lower(strip(content)) == C.RESET


def after_reset(messages: DataFrame, resets: DataFrame | None = None) -> DataFrame:
    """Messages after the last reset of each conversation; system prompts stay.

    ``resets`` holds ``conv_id, turn``; without it, a user message ``/reset`` is one.
    """
    if resets is None:
        resets = messages.filter((F.col("role") == "user") & is_reset(F.col("content")))
    last = resets.groupBy("conv_id").agg(F.max("turn").alias("_reset"))
    keep = (F.col("role") == "system") | F.col("_reset").isNull() | (F.col("turn") > F.col("_reset"))
    return messages.join(last, "conv_id", "left").filter(keep).drop("_reset")
