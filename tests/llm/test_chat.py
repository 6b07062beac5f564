"""Chat formatting against a plain decoder, on whole-text blocks."""
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamfold.llm import chat

BLOCKS = "conv_id long, turn long, text string"


def table(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def turns(spark):
    return chat.raw_turns(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))


@pytest.fixture(scope="module")
def model(turns):
    return chat.fit(turns)


def formatted(spark, rows, model, **more):
    return sorted(table(chat.format_chat(spark.createDataFrame(rows, BLOCKS), model, **more)),
                  key=lambda r: (r["conv_id"] is None, r["conv_id"], r["pos"] is not None, r["pos"], r["tie"], r["line"]))


# ------------------------------------------------------------ plain decoder
WORDS = {w: i for i, r in enumerate(chat.ROLES) for w in chat.MARKERS[r]}


def plain_marker(line):
    """(style, role, characters) of a marker, form by form."""
    w = "(" + "|".join(sorted(WORDS, key=len, reverse=True)) + ")"
    for style, form in ((1, rf"#{{1,6}}[ \t]*{w}[ \t]*(?::|\Z)"), (3, rf"<\|?{w}\|?>:?"), (3, rf"\[{w}\]:?"),
                        (0, rf"\*\*{w}:\*\*"), (0, rf"\*\*{w}\*\*[ \t]*:?"), (0, rf"{w}[ \t]*:")):
        m = re.match(rf"[ \t]*{form}[ \t]?", line, re.IGNORECASE | re.ASCII)
        if m:
            word = m[1].lower()
            return (2 if style == 0 and len(word) == 1 else style), WORDS[word], m.end()
    return None


def plain_codes(text):
    out, blank = [], None
    for line in text.split("\n"):
        m = plain_marker(line)
        size = len(line.rstrip(" \t\r\x0b\x0c")) - (m[2] if m else 0)
        size = sum(size > b for b in chat.LENGTHS)
        mark = 1 + m[0] * 3 + m[1] if m else 0
        place = 0 if blank is None else 1 if blank else 2
        out.append(((mark * 6 + size) * 2 + line.rstrip(" \t\r\x0b\x0c").endswith("?")) * 3 + place)
        blank = not m and size == 0
    return out


def plain_states(codes, m):
    best = None
    for emit in m.emit:
        score, back = m.start + emit[:, codes[0]], []
        for e in codes[1:]:
            through = score[:, None] + m.step
            back.append(through.argmax(axis=0))
            score = through.max(axis=0) + emit[:, e]
        if best is None or score.max() > best[0] + 1e-9:
            at, path = int(score.argmax()), []
            for b in reversed(back):
                path.append(at)
                at = int(b[at])
            best = (score.max(), [at, *reversed(path)])
    return best[1]


POOL = ["User: what now?", "Assistant: this", "### Human:", "### Assistant", "Q: why", "A: so", "<|user|> go", "[bot] yes",
        "**System:** be", "", "", "plain words that go on for more than twenty characters", "short", "is it?", "  indented",
        "x" * 130, "Context: of it", "a: b", "Userland: no", "#user", "é" * 70, "\tQ :", "**user** hi", "tail \t"]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_rows_equal_a_plain_decoder(spark, model, parts):
    """Conversations over many partitions, blocks of one line to many."""
    rng = np.random.default_rng(5)
    rows = [(c, 3 * t - 5, "\n".join(rng.choice(POOL, int(rng.integers(1, 9)))) + f"\n{c} {t}")
            for c, n in ((1, 90), (2, 6), (3, 1), (4, 25)) for t in range(n)]
    got = defaultdict(list)
    for r in formatted(spark, rows, model, parts=parts):
        got[r["conv_id"]].append(r)
    for c in got:
        blocks = [(p, t) for cc, p, t in sorted(rows) if cc == c]
        states = plain_states([e for _, t in blocks for e in plain_codes(t)], model)
        want, at = [], 0
        for p, text in blocks:
            lines = text.split("\n")
            for i, line in enumerate(lines):
                s = states[at + i]
                if i == 0 or s % 2 == 0:
                    m = plain_marker(line)
                    own = s % 2 == 0 and m and m[1] == s // 2
                    want.append([p, i, chat.ROLES[s // 2], s % 2 == 0, [line[m[2]:] if own else line], own])
                else:
                    want[-1][4].append(line)
            at += len(lines)
        for w in want:
            if w[5] and not w[4][0].strip() and len(w[4]) > 1:
                w[4].pop(0)
            while len(w[4]) > 1 and not w[4][-1].strip():
                w[4].pop()
        assert [(r["pos"], r["line"], r["role"], r["opens"], r["text"]) for r in got[c]] \
            == [(p, i, role, opens, "\n".join(ls)) for p, i, role, opens, ls, _ in want]
    assert set(got) == {1, 2, 3, 4}


def test_turns_of_held_out_conversations_are_found(spark, turns, model):
    """Roles and bounds of turns inside blocks of one to eight turns, some
    without a marker, some with a line that looks like one."""
    blocks = defaultdict(list)
    for r in turns.collect():
        blocks[r.conv_id, r.block].append((r.turn, r.role, r.text))
    truth = {}
    for (c, b), ts in blocks.items():
        line = 0
        for _, role, text in sorted(ts):
            truth[c, b, line] = role
            line += text.count("\n") + 1
    held = {r.conv_id for r in turns.filter(chat.held_out()).select("conv_id").distinct().collect()}
    assert max(map(len, blocks.values())) > 4
    rows = table(chat.format_chat(chat.transcripts(turns), model))
    got = {(r["conv_id"], r["pos"], r["line"]): r["role"] for r in rows if r["opens"] and r["conv_id"] in held}
    want = {k: v for k, v in truth.items() if k[0] in held}
    assert len(want) > 150
    right = sum(got.get(k) == v for k, v in want.items())
    assert right >= 0.95 * len(want) and right >= 0.95 * len(got)


def test_ordinary_transcripts(spark, model):
    rows = formatted(spark, [(1, 0, "User: hi there\nAssistant: hello, how can I help?\nUser: what is 2+2?\nAssistant: 4"),
                             (2, 0, "### System:\nBe brief.\n### Human:\nWhat is it?\nTell me.\n\n### Assistant:\nA thing."),
                             (3, 0, "hi"), (3, 1, "hello there"), (3, 2, "what is it"), (3, 3, "four")], model)
    by = defaultdict(list)
    for r in rows:
        by[r["conv_id"]].append((r["role"], r["text"]))
    assert by[1] == [("user", "hi there"), ("assistant", "hello, how can I help?"), ("user", "what is 2+2?"),
                     ("assistant", "4")]
    assert by[2] == [("system", "Be brief."), ("user", "What is it?\nTell me."), ("assistant", "A thing.")]
    assert [r for r, _ in by[3]] == ["user", "assistant", "user", "assistant"]
    assert "".join(r["rendered"] for r in rows if r["conv_id"] == 2) == (
        "<|turn|>system\nBe brief.<|turn|>user\nWhat is it?\nTell me.<|turn|>assistant\nA thing.")


def test_null_ids_are_apart_and_repeats_count_once(spark, model):
    rows = formatted(spark, [(None, 0, "User: hi\nAssistant: A"), (None, 0, "User: hi\nAssistant: B"),
                             (None, None, "User: hi\nAssistant: B"), (None, 1, None),
                             (7, 0, "User: x"), (7, 0, "User: x"), (7, 0, "Assistant: y"), (7, 1, None)], model)
    none = sorted((r["line"], r["role"], r["text"]) for r in rows if r["conv_id"] is None)
    assert none == [(0, "user", "")] + [(0, "user", "hi")] * 3 + [(1, "assistant", "A")] + [(1, "assistant", "B")] * 2
    assert sorted((r["pos"], r["text"]) for r in rows if r["conv_id"] == 7) == [(0, "x"), (0, "y"), (1, "")]


def test_positions_far_apart_and_long_blocks(spark, model):
    long = "\n".join(f"line {i}" for i in range(4000))
    df = spark.createDataFrame([(1, 0, long), (1, 17 * 10 ** 17, "User: x"), (1, -2 ** 63, "Q: first"), (1, 2 ** 63 - 1, "z"),
                                (1, None, "A: null")], BLOCKS) \
        .withColumns({c: F.lit(1) for c in ("conv", "pos", "tie", "text2", "f", "e", "skip", "pid", "of", "ends", "line")})
    rows = table(chat.format_chat(df, model))
    body = sorted((r for r in rows if r["pos"] == 0), key=lambda r: r["line"])
    assert "\n".join(r["text"] for r in body) == long
    assert {r["pos"] for r in rows} == {None, -2 ** 63, 0, 17 * 10 ** 17, 2 ** 63 - 1}
    assert chat.format_chat(df.limit(0), model).count() == 0


def test_fit_takes_turns_by_order(spark, turns):
    a = chat.fit(turns)
    b = chat.fit(turns.withColumn("turn", F.col("turn") * 10))
    assert np.allclose(a.step, b.step) and np.allclose(a.start, b.start) and np.allclose(a.emit, b.emit)
    nothing = chat.fit(turns.limit(0))
    assert chat.format_chat(chat.transcripts(turns.limit(5)), nothing).count() >= 5


def test_texts_are_exchanged_once(spark, turns, model):
    """The matrices and the decisions read the same exchange, and the rows of a
    hot conversation lie in many partitions."""
    df = chat.decode(*chat._transcripts(turns), model)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1
    hot = spark.range(6000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                   F.concat(F.lit("User: "), F.col("id").cast("string")).alias("text"))
    dealt = chat.format_chat(hot, model, parts=16)
    assert dealt.count() == 6000
    assert dealt.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0] < 1500


def test_copies_of_a_block_do_not_meet_in_one_task(spark, model):
    copies = spark.range(5000).select(F.lit(1).alias("conv_id"), F.lit(0).alias("turn"), F.lit("User: x").alias("text"))
    df = copies.unionByName(copies.withColumn("turn", F.lit(1)).limit(3))
    rows, _ = chat._ready(df.select(F.col("conv_id").alias("conv"), F.col("turn").alias("pos"), "text"))
    assert rows.groupBy("pos").count().orderBy("pos").collect() == [(0, 1), (1, 3)]
    assert chat.format_chat(df, model).count() == 2
