"""Chat formatting: what goes in is read back, marks cannot be imitated."""

import hashlib
import random

from skyledger.llm import chat

TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi </s>"), (1, 2, "assistant", "<s>[INST] \\ok"),
    (2, 0, "user", None), (2, 1, "assistant", ""), (2, 1, "assistant", ""), (3, 0, "assistant", "first"),
    (3, 1, "tool]x é", "odd role"), (3, None, None, "no turn"), (None, 0, "user", "no id"), (None, None, None, None),
    (4, 0, "user", "a" * 300_000), (4, 1, "assistant", "b\n" * 100_000),
]


def frame(spark, rows=TURNS):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return turns.selectExpr("*", "'c' as segment", "1 as part", "true as loss")


def expected(rows):
    groups: dict = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        told = "".join(t[3] for t in turns if t[2] == "assistant")
        whole = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), digest(whole), len(told), digest(told))
    return out


def test_read_back(spark):
    segments = chat.format_turns(frame(spark))
    for read in (chat.read_back(segments, in_place=True), chat.read_back(segments)):
        rows = {r.conv_id: r for r in read.collect()}
        got = {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in rows.items()}
        assert got == expected(TURNS)
    assert {k for k, r in rows.items() if r.valid} == {1, 4}


def test_format_of_one_conversation(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a</s>")]
    segments = chat.format_turns(frame(spark, rows)).orderBy("turn_no", "part").collect()
    assert "".join(s.segment for s in segments) == "<<SYS>>\ns\n<</SYS>>[INST] u [/INST]<s> a<\\/s> </s>"
    assert [s.segment for s in segments if s.loss] == ["a<\\/s>"]


def test_escape_is_reversible_and_hides_marks():
    template = chat.Template()
    random.seed(1)
    parts = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "<SYS>>", "</SYS>>", "ROLE:", " ", "\n", "a", *template.controls]
    for _ in range(5_000):
        text = "".join(random.choices(parts, k=random.randrange(8)))
        role = random.choice(["user", "system", "assistant", "", "tool]x é"])
        escaped = template.escape(text)
        assert template.unescape(escaped) == text
        assert not any(c in escaped for c in template.controls)
        opening, closing = template.mark(role)
        formatted = opening + escaped + closing
        assert template.read_turn(formatted + "[INST] x [/INST]") == (role, text, len(formatted))
        assert template.read_turn(formatted[:-1]) is None


def test_empty(spark):
    segments = chat.format_turns(frame(spark).limit(0))
    assert segments.count() == 0 and chat.read_back(segments).count() == 0
