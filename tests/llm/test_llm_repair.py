"""Conversation repair against trying all edits, and giant conversations in small blocks."""

import functools
import hashlib
import random
import re
import zlib
from array import array

import pandas as pd
import pytest
from oracle import connect, differences

from skyledger.llm import repair
from skyledger.llm.repair import BLANKS

SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    """(turn, role, text, fault) of one conversation's rows in their order."""
    ordered = sorted(((t is not None, t or 0, r or " " if r is None else r, x if x is not None else " ") for t, r, x in rows))
    seen, out = set(), []
    for has, turn, role, text in ordered:
        said = text.strip(BLANKS)
        if not said:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = None if said[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((turn if has else None, role, text, fault))
    return out


def all_repairs(turns):
    """Every way to edit a few turns, as (cost, audit, repaired rows); inserts go anywhere."""
    best = (3 * len(turns), "D" * len(turns), [])

    def go(i, inserts, cost, audit, rows):
        nonlocal best
        shape = "".join(r[:1] or "-" for r, _ in rows)
        if cost > best[0] or not re.fullmatch("(s|s?(ua)*u?)", shape):
            return
        if i == len(turns) and re.fullmatch("(s?(ua)+)?", shape):
            best = min(best, (cost, audit, rows))
        if inserts < 2:
            for who in ("user", "assistant"):
                go(i, inserts + 1, cost + 2, audit + "I", [*rows, (who, "")])
        if i < len(turns):
            _, role, text, fault = turns[i]
            go(i + 1, 0, cost + 3, audit + "D", rows)
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                go(i + 1, 0, cost + more, audit + "K", [*rows, (role, text)])
                for who in ("user", "assistant"):
                    go(i + 1, 0, cost + 2 + more, audit + "R", [*rows, (who, text)])

    go(0, 0, 0, "", [])
    return best


def expected(rows):
    turns = faults(rows)
    cost, audit, kept = all_repairs(turns)
    times = {t for t, *_ in turns if t is not None}
    firsts = [r[:1] for _, r, _, _ in turns]
    kinds = [f for *_, f in turns]
    return (
        max(times) - min(times) + 1 - len(times) if times else 0,
        kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False)),
        cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest(),
    )


def told(rows, block=repair.BLOCK):
    found = repair.counts(rows).join(repair.digest(repair.repair(rows, block)), repair.NAME).collect()
    return {
        r.conv_name: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in found
    }


def conversations(number):
    random.seed(11)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "usher"]
    texts = ["Hi.", "Yes!", "cut off", "", " \x0b", None, "Why?", "Why? ", "so. it"]
    for conv in range(number):
        yield conv, [
            (random.choice([None, 0, 1, 2, 5, 9]), random.choice(roles), random.choice(texts)) for _ in range(random.randrange(1, 7))
        ]


def test_against_all_repairs(spark):
    wanted = {f"={conv}": expected(rows) for conv, rows in conversations(250)}
    frame = spark.createDataFrame([(c, *r) for c, rows in conversations(250) for r in rows], SCHEMA)
    found = repair.faulty(frame.selectExpr("*", "'c' as place", "'c' as fault", "'c' as edits").repartition(7))
    assert told(found) == wanted
    assert told(found, block=2) == wanted


@functools.cache
def long_rows():
    random.seed(3)
    return [(t, random.choice(["user", "assistant", "system"]), random.choice(["a.", "b!", "c", ""]) + str(t % 7)) for t in range(5000)]


def test_giant_conversation_in_blocks(spark):
    """Blocks of any size give the same edits, and they lead from the turns to a legal order."""
    rows = [(1, t, r, x + ".") for t, r, x in long_rows()] + [(None, 0, "user", "alone.")]
    found = repair.faulty(spark.createDataFrame(rows, SCHEMA)).cache()
    whole = told(found)
    assert told(found, block=64) == whole and told(found, block=5000) == whole
    done = repair.repair(found, block=64).where(f"{repair.NAME} = '=1'").orderBy("step").collect()
    assert re.fullmatch("s?(ua)+", "".join(r.role[0] for r in done if r.edit != "D"))
    assert [r.step for r in done] == list(range(len(done))) and sum(r.edit != "I" for r in done) == 5000
    assert whole[""][5:7] == (2, "KI")


def test_state_of_the_program_is_small():
    """So is its table, whatever the length of a conversation, and a pointer is four bytes."""
    states, open_states = {repair.START}, [repair.START]
    kinds = [(i, f) for i in ("s", "u", "a", "") for f in ("", "blank", "truncated")]
    while open_states:
        program = open_states.pop()
        for kind in kinds:
            after, pointers = repair.step(program, *kind)
            assert 0 <= pointers < 1 << 24
            if after not in states:
                states.add(after)
                open_states.append(after)
    assert len(states) < 1000 and array("I").itemsize == 4


def test_state_goes_across_batches():
    rows = [("=1", "u", ""), ("=1", "a", ""), ("=1", "a", ""), ("=2", "a", ""), ("=2", "u", "truncated")]
    split = lambda size: [
        pd.DataFrame(rows[i : i + size], columns=[repair.NAME, "initial", "fault"]) for i in range(0, len(rows), size)
    ]
    one = pd.concat(repair._forward(iter(split(1)), 100)).reset_index(drop=True)
    pd.testing.assert_frame_equal(one, pd.concat(repair._forward(iter(split(9)), 100)).reset_index(drop=True))
    assert list(one["edits"]) == ["KKIK", "IKD"]


def test_damage(spark):
    rows = [(c, t, r, x) for c in (None, 1, 22) for t in (None, *range(40)) for r, x in (("assistant", "a.b!"), (None, None))]
    got = sorted(map(repr, map(tuple, repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect())))
    want = []
    for c, t, r, x in rows:
        what = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if what == 1 else re.sub("[.!?]", "", x) if what == 2 else x
        want += [(c, t, "user" if what == 4 else r, x)] * {0: 0, 3: 2}.get(what, 1)
    assert got == sorted(map(repr, want))


@pytest.mark.parametrize("extra", [[], [(7, 0, "user", None), (7, 0, "user", None), (None, None, None, None), (8, None, "", "x" * 200_000)]])
def test_query_and_twin(spark, tmp_path, extra):
    rows = [(c, *r) for c, turns in conversations(60) for r in turns] if extra else []
    frame = spark.createDataFrame(rows + extra, SCHEMA)
    frame.coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    result = repair.query(spark, str(tmp_path))
    if not extra:
        assert result.count() == 0
        return
    connection = connect("/root/testdata/sf0.001")
    connection.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert differences(result, connection, repair.SQL) == []
