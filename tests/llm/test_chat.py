"""Chat formatting."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lokum.llm import chat

PARTS = ["</s>", "<s>", "[INST]", "\\", "<", "|", "<|turn|>", "<|end|>\n", "\n", "a", "é", "<\\|start|>", "[", "SYS>>", "<<", ""]
ROWS = [(1, 0, "user", "hi </s>\\"), (1, 1, "user", "<|turn|>"), (1, 2, "assistant", "one"), (1, 3, "assistant", None),
        (1, 4, "assistant", "<|start|>user<|text|>\\<|end|>\n"), (2, 1, "b\n", "y"), (2, 1, "b\n", "x"),
        (2, None, None, "last"), (None, 0, "user", "z"), (None, 0, "user", "z"), (3, 0, "assistant", "w" * 200_000),
        (4, 5, "<|text|>", "[INST]"), (4, 6, "user", "a<"), (4, 7, "user", "|turn|>b")]


def frame(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("last", "turns", "blocks", "segments", "formatted"):
        df = df.withColumn(c, F.lit("extra"))
    return df


def expect(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    return {k: [(r, t) for *_, r, t in sorted(v, key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))]
            for k, v in by.items()}


def check(out, rows):
    want = expect(rows)
    got = out.select("conv_id", "formatted", "segments", chat.read_turns(F.col("formatted")).alias("turns"),
                     chat.loss_text(F.col("segments")).alias("loss")).collect()
    assert {r.conv_id for r in got} == set(want) and len(got) == len(want)
    for r in got:
        turns = [(t.role, t.text) for t in r.turns]
        assert turns == want[r.conv_id]
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.loss == "".join(t for role, t in turns if role == "assistant")
        changes = 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))
        assert r.formatted.count(chat.START) == changes and r.formatted.count(chat.TURN) == len(turns) - changes
        for c in set(chat.CONTROLS) - {chat.START, chat.TEXT, chat.TURN, "<|end|>"}:
            assert c not in r.formatted


def test_round_trip(spark):
    check(chat.format_chats(frame(spark)), ROWS)


def test_empty(spark):
    assert chat.format_chats(frame(spark, [])).count() == 0


def test_round_trip_of_control_soup(spark):
    found = []

    @settings(max_examples=300, deadline=None, database=None, derandomize=True)
    @given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "<|text|>"]),
                              st.lists(st.sampled_from(PARTS), max_size=6).map("".join)), min_size=1, max_size=5))
    def gather(turns):
        found.append(turns)

    gather()
    rows = [(k, i, r, t) for k, turns in enumerate(found) for i, (r, t) in enumerate(turns)]
    check(chat.format_chats(frame(spark, rows)), rows)


def test_query_probe(spark):
    from lokum.llm.queries import QUERIES
    r = QUERIES["op6_chat"](spark, "/root/testdata/sf0.001").where("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    assert r.n_turns == 2 and r.loss_chars == len(text)
    assert r.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
