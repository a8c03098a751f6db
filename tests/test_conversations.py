import random

import pytest
from pyspark.sql import functions as F

from matchweave.operators import conversations as K
from matchweave.operators import inference as M
from matchweave.session import scratch_path
from matchweave.streaming import compaction as running

SCHEMA = "conv_id long, turn long, role string, content string"


def plain_states(rows, max_tokens, mode="each_user_turn", summarize=None):
    """A direct loop over each conversation."""
    out, chats = {}, {}
    for row in rows:
        chats.setdefault(row[0], []).append(row)
    for conv, messages in chats.items():
        messages.sort(key=lambda m: m[1])
        system = next((m[3] for m in messages if m[2] == "system"), "")
        kept, summary, n = [], "", 0

        def check():
            nonlocal kept, summary, n
            label = len("[Summary of earlier conversation]: ") + len(summary) if summary else 0
            used = (len(system) + label + sum(len(m[3]) for m in kept)) // 4
            if used + 400 > max_tokens and len(kept) > 4:
                text = "\n".join(f"{m[2].upper()}: {m[3]}" for m in kept[:-4])
                new = summarize(text) if summarize else f"[Previous conversation truncated. Last topics: {text[-300:]}]"
                summary = f"{summary}\n\nLATER: {new}"[:600] if summary else new
                kept, n = kept[-4:], n + 1

        for m in messages:
            if m[2] == "system":
                continue
            kept.append(m)
            if m[2] == "user" and mode == "each_user_turn":
                check()
        if mode == "end":
            check()
        out[conv] = (system, summary, n, kept[0][1] if kept else None, len(kept), sum(len(m[3]) for m in kept))
    return out


def states(df):
    return {r[0]: tuple(r)[1:] for r in df.select(*K.STATE_COLUMNS).collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(1, t, rng.choice(["user", "user", "assistant"]), "x" * rng.choice([0, 0, 1, 5, 30, 200])) for t in range(700)]
    out += [(2, t * 3, "user" if t % 2 == 0 else "assistant", "ąb" * rng.randint(0, 40)) for t in range(150)]
    out += [(3, t, "assistant", "y" * 50) for t in range(90)] + [(3, 90, "user", "z")]
    out += [(4, 0, "system", "s" * 900), (4, 1, "user", "hi"), (4, 2, "assistant", "ho")]
    out += [(5, 0, "system", "only")]
    return out


@pytest.mark.parametrize("budget,options", [(500, {}), (500, {"fold_rows": 4, "span": 7}), (300, {"fold_rows": 4, "span": 16})])
def test_compaction_equals_a_plain_loop(spark, rows, budget, options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert states(K.compact_history(df, budget, **options)) == plain_states(rows, budget)


def test_compaction_once_and_with_a_model(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert states(K.compact_history(df, 500, check="end")) == plain_states(rows, 500, "end")
    short = [r for r in rows if r[0] != 1]
    df = spark.createDataFrame(short, SCHEMA)

    def model(text):
        return f"{len(text)} characters"

    got = K.compact_history(df, 480, summarizer=lambda chat: model(chat[0]["content"].split("decisions.\n\n", 1)[1]), span=16)
    assert states(got) == plain_states(short, 480, summarize=model)

    def broken(_chat):
        raise RuntimeError("no model")

    assert states(K.compact_history(df, 480, summarizer=broken)) == plain_states(short, 480)


def test_long_history_goldens(spark):
    long = "This is a very long test message for compression testing. " * 20
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"number {t}: {long}") for t in range(8)]
    df = spark.createDataFrame(rows, SCHEMA)
    once = K.compact_history(df, 300, check="end")
    assert (once.first().n_messages, once.first().n_compactions) == (4, 1)
    use = K.state_usage(once, 300).first()
    assert use.has_summary and use.turns == 2
    each = K.compact_history(df, 300).first()
    assert (each.n_messages, each.n_compactions) == (5, 2)


def test_usage_and_running_size(spark):
    rows = [(1, 0, "system", "s" * 28), (1, 1, "user", "u" * 19), (1, 2, "assistant", "a" * 21)]
    df = spark.createDataFrame(rows, SCHEMA)
    use = K.token_usage(df, 1800).first()
    assert (use.used, use.budget, use.remaining, use.turns, use.has_summary) == (17, 1800, 1383, 1, False)
    got = [(r.turn, r.running_chars, r.used, r.added) for r in K.running_tokens(df, span=2).orderBy("turn").collect()]
    assert got == [(0, 28, 7, 7), (1, 47, 11, 4), (2, 68, 17, 6)]


def test_transcripts(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = "\n".join(f"{'USER' if t % 2 == 0 else 'ASSISTANT'}: m{t}" for t in range(6))
    assert K.transcript(df).first().transcript == whole
    parts = [r.transcript for r in K.transcript(df, span=4).orderBy("part").collect()]
    assert len(parts) == 2 and "\n".join(parts) == whole
    assert K.fallback_summaries(df).first().summary == f"[Previous conversation truncated. Last topics: {whole}]"
    assert sorted(r.turn for r in K.keep_last(df, 4).collect()) == [2, 3, 4, 5]


def test_messages_answers_and_reset(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "user", "q" * 900), (1, 2, "assistant", "a"), (1, 3, "user", "b"), (1, 4, "assistant", "c"), (1, 5, "user", "d"), (2, 0, "user", "x"), (2, 1, "assistant", "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    built = K.build_messages(df, K.compact_history(df, 500)).filter("conv_id = 1").orderBy("section", "turn").collect()
    assert [(r.section, r.role) for r in built][:2] == [(0, "system"), (1, "assistant")]
    assert built[1].content.startswith("[Summary of earlier conversation]: [Previous") and [r.turn for r in built[2:]] == [2, 3, 4, 5]
    assert [tuple(r) for r in K.answers(df, lambda chat: f" {len(chat)} {chat[-1]['content']} ", 500).collect()] == [(1, 6, "assistant", "6 d")]

    def broken(_chat):
        raise RuntimeError("down")

    assert K.answers(df, broken, 500).first().content == "[LLM error: down]"
    chat = spark.createDataFrame(rows[:2] + [(1, 3, "user", "/reset "), (1, 4, "user", "new")], SCHEMA)
    assert sorted(r.turn for r in K.after_reset(chat).collect()) == [0, 4]


def test_running_compaction(spark, rows):
    chats = [r for r in rows if r[0] in (1, 4, 5)]
    path = scratch_path(spark, "chats")
    rng = random.Random(2)
    shuffled = chats[:]
    rng.shuffle(shuffled)
    half = len(shuffled) // 2
    for part in (shuffled[:half], shuffled[half:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")
        running.write_states(running.running_compaction(stream, 500), f"{path}/out", f"{path}/progress").awaitTermination()
    got = running.latest_states(spark.read.parquet(f"{path}/out"))
    assert states(got) == plain_states(chats, 500)


def test_resets_inside_compaction(spark, rows):
    rng = random.Random(5)
    chats = [r for r in rows if r[0] != 3] + [(6, t, "user", "m") for t in range(3)] + [(7, 0, "system", "S"), (7, 1, "user", "/reset")]
    chats += [(8, t, "user" if t % 2 else "assistant", "w" * 90) for t in range(400)]
    chats = [(c, t, role, " /RESET\n" if role == "user" and c in (1, 2, 6, 8) and rng.random() < (1 if (c, t) == (6, 2) else 0.02) else text) for c, t, role, text in chats]
    expected = {}
    for conv in sorted({c[0] for c in chats}):
        chat = running.Chat(None, "")
        for _, turn, role, text in sorted(c for c in chats if c[0] == conv):
            chat.add(turn, role, text, 500, running.fallback)
        kept = chat.history
        expected[conv] = (chat.system, chat.summary, chat.n, kept[0][0] if kept else None, len(kept), sum(len(m[2]) for m in kept))
    assert expected[6][4] == 0 and any("RESET" in c[3] for c in chats if c[0] == 8)
    df = spark.createDataFrame(chats, SCHEMA)
    assert states(K.compact_history(df, 500)) == expected
    assert states(K.compact_history(df, 500, fold_rows=0, span=16)) == expected


def test_model_summaries_of_long_histories(spark):
    rng = random.Random(6)
    chats = [(1, t, "user" if t % 2 else "assistant", f"{t} " + "x" * rng.randrange(60)) for t in range(1_200)]
    chats += [(2, t, "user", "short") for t in range(6)] + [(2, 9, "user", "y" * 2_000)]

    def summarize(chat):
        text = chat[-1]["content"].split("\n\n", 1)[1]
        if len(text) > 1_000 + 80 or "7 " in text[:8]:
            raise RuntimeError("too long")
        return f"{len(text)} {text[:3]}"

    def tree(lines):
        parts, at = {}, 0
        for line in lines:
            parts.setdefault(at // 1_000, []).append(line)
            at += len(line) + 1
        said = []
        for _, part in sorted(parts.items()):
            text = "\n".join(part)
            try:
                said.append(summarize([{"content": "r\n\n" + text}]).strip())
            except RuntimeError:
                said.append(f"[Previous conversation truncated. Last topics: {text[-300:]}]")
        return said[0] if len(said) == 1 else tree([s[:600] for s in said])

    df = spark.createDataFrame(chats, SCHEMA)
    got = states(K.compact_history(df, 500, check="end", summarizer=summarize, part_chars=1_000))
    assert got == plain_states(chats, 500, "end", lambda text: tree(text.split("\n")))


def test_reset_in_a_stream():
    chat = running.Chat(None, "S")
    for turn, (role, text) in enumerate([("user", "a"), ("assistant", "b"), ("user", " /RESET "), ("user", "c")]):
        chat.add(turn, role, text, 500, running.fallback)
    assert [m[2] for m in chat.history] == ["c"] and chat.summary == ""


def test_gaps_in_a_stream(spark):
    chats = [(1, t, "user" if t % 2 else "assistant", f"m{t}") for t in (1, 2, 4, 7)] + [(2, 5, "user", "x")]

    def run(rows, path, **options):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")
        states = running.running_compaction(stream, 500, **options)
        running.write_states(states, f"{path}/out", f"{path}/progress").awaitTermination()
        found = running.latest_states(spark.read.parquet(f"{path}/out")).collect()
        return {r.conv_id: (r.n_messages, r.n_waiting, r.n_late) for r in found}

    path = scratch_path(spark, "gaps")
    assert run(chats, path, first_turn=None, gap_seconds=0) == {1: (4, 0, 0), 2: (1, 0, 0)}
    assert run([(1, 3, "user", "late")], path, first_turn=None, gap_seconds=0)[1] == (4, 0, 1)
    path = scratch_path(spark, "gaps")
    assert run(chats, path, first_turn=None, gap_seconds=None) == {1: (2, 2, 0), 2: (1, 0, 0)}
    assert run([(1, 3, "user", "in time")], path, first_turn=None, gap_seconds=None)[1] == (4, 1, 0)
