"""Running compaction of chat histories, one state per conversation.

The state is what the model would be sent: system prompt, summary and kept history, which the
budget bounds. Messages that arrive before their predecessors wait in the state, for a limited time.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from matchweave.functions import chat as C
from matchweave.schemas import KEEP_LAST, MAX_TOKENS, SUMMARY_CAP, SUMMARY_TAIL

_STATE = (
    "system string, summary string, n long, next_turn long, history string, waiting string, since long, late long"
)
_OUTPUT = (
    "conv_id long, last_turn long, system string, summary string, n_compactions long, "
    "start_turn long, n_messages long, chars long, n_waiting long, n_late long"
)

Summarize = Callable[[str], str]


def fallback(transcript: str) -> str:
    return C.FALLBACK_OPEN + transcript[-SUMMARY_TAIL:] + C.FALLBACK_CLOSE


class Chat:
    """Mutable form of one conversation's state."""

    def __init__(self, state: tuple | None, system: str):
        fields = state or (None, "", 0, None, "[]", "[]", None, 0)
        self.system, self.summary, self.n, self.next_turn = fields[:4]
        self.system_known = self.system is not None
        self.system = self.system if self.system_known else system
        self.history, self.waiting = json.loads(fields[4]), json.loads(fields[5])
        self.since, self.late = fields[6:]

    def packed(self) -> tuple:
        texts = json.dumps(self.history), json.dumps(self.waiting)
        return (self.system if self.system_known else None, self.summary, self.n, self.next_turn, *texts, self.since, self.late)

    def over_budget(self, max_tokens: int) -> bool:
        label = len(C.SUMMARY_LABEL) + len(self.summary) if self.summary else 0
        size = len(self.system) + label + sum(len(text) for _, _, text in self.history)
        return size >= C.spare_chars(max_tokens) and len(self.history) > KEEP_LAST

    def add(self, turn: int, role: str, content: str, max_tokens: int, summarize: Summarize) -> None:
        if role == "system":
            if not self.system_known:
                self.system, self.system_known = content, True
        elif role == "user" and content.strip().lower() == C.RESET:
            self.history, self.summary, self.n = [], "", 0
        elif role in ("user", "assistant"):
            self.history.append((turn, role, content))
            if role == "user" and self.over_budget(max_tokens):
                self.compact(summarize)

    def compact(self, summarize: Summarize) -> None:
        leaving, self.history = self.history[:-KEEP_LAST], self.history[-KEEP_LAST:]
        fresh = summarize("\n".join(f"{role.upper()}: {text}" for _, role, text in leaving))
        self.summary = (self.summary + C.LATER + fresh)[:SUMMARY_CAP] if self.summary else fresh
        self.n += 1


def running_compaction(
    messages: DataFrame,
    max_tokens: int = MAX_TOKENS,
    default_system: str = "",
    first_turn: int | None = 0,
    gap_seconds: float | None = 600,
    summarize: Summarize = fallback,
    timers: bool = False,
) -> DataFrame:
    """State of every conversation touched in a batch, after its messages in turn order.

    A conversation begins at ``first_turn``, or at the lowest turn of its first batch if that is None. Messages behind
    a missing turn wait, at most ``gap_seconds`` (None: for ever; 0: not at all), and are then taken in turn
    order without it. ``n_waiting`` tells how many wait; ``n_late`` how many came after their turn had been passed
    and so are in no history. Without ``timers`` an overdue gap is released when the conversation gets its next
    message; with them a stream that runs on also releases it by itself (a stream that has to stop when its source is
    drained would wait for its timers for ever).
    """

    def advance(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        chat = Chat(state.get if state.exists else None, default_system)
        waiting = {turn: (role, text) for turn, role, text in chat.waiting}
        expected = first_turn if chat.next_turn is None else chat.next_turn
        overdue = timers and state.hasTimedOut
        if not overdue:
            for chunk in chunks:
                for turn, role, text in zip(chunk["turn"], chunk["role"], chunk["content"]):
                    if expected is None or turn >= expected:
                        waiting[int(turn)] = (role, text)
                    else:
                        chat.late += 1
        if expected is None:
            expected = min(waiting)

        def take(turn: int) -> int:
            role, text = waiting.pop(turn)
            chat.add(turn, role, text, max_tokens, summarize)
            return turn + 1

        while expected in waiting:
            expected = take(expected)
        now = int(time.time() * 1000)
        limit = None if gap_seconds is None else int(gap_seconds * 1000)
        chat.since = (chat.since or now) if waiting else None
        if waiting and limit is not None and (overdue or now - chat.since >= limit):
            for turn in sorted(waiting):
                expected = take(turn)
            chat.since = None
        chat.next_turn = expected
        chat.waiting = [(turn, *rest) for turn, rest in sorted(waiting.items())]
        state.update(chat.packed())
        if timers and waiting and limit is not None:
            state.setTimeoutDuration(max(1, chat.since + limit - now))
        yield pd.DataFrame(
            {
                "conv_id": [key[0]],
                "last_turn": [expected - 1],
                "system": [chat.system],
                "summary": [chat.summary],
                "n_compactions": [chat.n],
                "start_turn": pd.array([chat.history[0][0] if chat.history else None], dtype="Int64"),
                "n_messages": [len(chat.history)],
                "chars": [sum(len(text) for _, _, text in chat.history)],
                "n_waiting": [len(waiting)],
                "n_late": [chat.late],
            }
        )

    return messages.groupBy("conv_id").applyInPandasWithState(
        advance,
        _OUTPUT,
        _STATE,
        "update",
        GroupStateTimeout.ProcessingTimeTimeout if timers else GroupStateTimeout.NoTimeout,
    )


def write_states(states: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each batch's states below ``path`` and stop when the source is drained.

    A batch writes to its own folder, so running it again replaces what it wrote.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        states.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_states(written: DataFrame) -> DataFrame:
    """The newest state of each conversation."""
    fields = [c for c in written.columns if c not in ("conv_id", "batch")]
    newest = F.max_by(F.struct(*fields), F.struct("last_turn", "batch")).alias("_s")
    return written.groupBy("conv_id").agg(newest).select("conv_id", "_s.*")
