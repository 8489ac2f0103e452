"""Conversation structure repair: the cheapest edits that give each conversation a legal order.

A legal conversation has the role initials `(s?(ua)+)?`. Turns are repartitioned by
conversation and sorted by turn, and one pass carries the state of a dynamic program over
them from one Arrow batch to the next: for each of the four states of that grammar the least
cost, and the rank of its edits among the states' own by letters. Costs are kept as
differences, so there are few distinct states of the program, and a step is looked up.

A conversation that ends within a block is traced back at once. The back-pointers of a longer
one, four bytes a turn, are emitted block by block; Spark stores them in the shared folder, and a
second pass reads them from the last block to the first. No pass holds more than a block, and
no text is held at all: edits meet the turns again in a third pass, in the order of both.
"""

from __future__ import annotations

import functools
import hashlib
from array import array

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import stored

# Blanks, sentence ends, costs, the grammar, and who an edit adds in each state.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ADDED = ("user", "user", "assistant", "user")
CLOSING = ("", "II", "I", "")
# What may be done about one turn: edits before it, then its own.
EDITS = ("D", "K", "R", "IK", "IR", "IIK", "IIR")
LEGAL_PAIRS = ("su", "ua", "au")
BLOCK = 1 << 16


# ---------------------------------------------------------------- the program


@functools.cache
def moves(initial: str, fault: str) -> tuple:
    """(state before, state after, cost, edits) of a turn; the best for each pair of states."""
    found = {}
    for before in range(4):
        found[before, before] = (DELETE, "D")
        state, letters, cost = before, "", TRUNCATED if fault == "truncated" else 0
        for _ in range(3 if fault not in ("blank", "duplicate") else 0):
            kept = AFTER[state].get(initial)
            put = AFTER[state][ADDED[state][0]]
            for after, price, edit in ((kept, 0, "K"), (put, REROLE, "R")):
                if after is not None:
                    offer = (cost + price, letters + edit)
                    found[before, after] = min(found.get((before, after), offer), offer)
            state, letters, cost = put, letters + "I", cost + INSERT
    return tuple((*pair, *best) for pair, best in found.items())


# At most so much dearer, from the first state, is whatever may still be done from the second:
# by inserts and, where only the second may take a system turn, by deleting that.
STAND_INS = {
    (3, 2): INSERT, (2, 3): INSERT, (0, 2): INSERT, (0, 3): 2 * INSERT,
    (0, 1): 0, (3, 1): 0, (2, 1): INSERT, (3, 0): DELETE, (2, 0): INSERT + DELETE,
}

# A state of the program: for each state of the grammar (cost over the least, rank), or None.
START = ((0, 0), None, None, None)


@functools.cache
def step(program: tuple, initial: str, fault: str) -> tuple[tuple, int]:
    """The program after one more turn, and the back-pointers of its states.

    Edits of different states never are the beginning of one another, as each holds one edit
    per turn and ends with a turn's own. So the order of the longer ones follows from the
    ranks of the shorter and, where those are equal, from the letters added.
    """
    best: list = [None] * 4
    for before, after, cost, edits in moves(initial, fault):
        if program[before] is not None:
            total, rank = program[before]
            offer = (total + cost, rank, edits, before)
            best[after] = offer if best[after] is None else min(best[after], offer)
    # A state that another stands in for at less cost is in no cheapest repair. Without it,
    # costs differ by little, and the states of the program are few.
    for (other, state), price in STAND_INS.items():
        if best[other] and best[state] and best[state][0] > best[other][0] + price:
            best[state] = None
    least = min(b[0] for b in best if b)
    ranks = {b[1:3]: i for i, b in enumerate(sorted((b for b in best if b), key=lambda b: b[1:3]))}
    pointers = sum((EDITS.index(b[2]) * 4 + b[3]) << (6 * q) for q, b in enumerate(best) if b)
    return tuple(b and (b[0] - least, ranks[b[1:3]]) for b in best), pointers


def last_state(program: tuple) -> int:
    """The state the cheapest edits end in; they go on with that state's closing edits."""
    ends = [(p[0] + INSERT * len(CLOSING[q]), p[1], q) for q, p in enumerate(program) if p]
    return min(ends)[2]


def trace(pointers, state: int, closing: str) -> tuple[str, int]:
    """The edits of a block that ends in `state`, and the state before it."""
    parts = [closing]
    for packed in reversed(pointers):
        code = packed >> (6 * state) & 63
        parts.append(EDITS[code >> 2])
        state = code & 3
    return "".join(reversed(parts)), state


# ---------------------------------------------------------------- faults


def faulty(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, place, role, text, fault, illegal, new_turn: every turn in its order.

    The order is that of `turn`, nulls first, then role and text. Null roles and texts are one
    space. Rows with a null key are one conversation. A turn's fault is the first of blank,
    duplicate (role and text as in an earlier turn), truncated (no sentence end).
    """
    rows = turns.select(
        F.col(f"`{key}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
    )
    same = Window.partitionBy("conv_id", "role", "d1", "d2").orderBy(F.col("turn").asc_nulls_first())
    digests = {"d1": F.xxhash64("text"), "d2": F.xxhash64(F.lit(1), F.col("text"))}
    rows = rows.withColumns(digests).withColumn("seen", F.row_number().over(same)).drop("d1", "d2")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "seen")
    said = F.btrim("text", F.lit(BLANKS))
    fault = (
        F.when(said == "", "blank").when(F.col("seen") > 1, "duplicate").when(~F.right(said, F.lit(1)).isin(*ENDS), "truncated")
    )
    initial = lambda c: F.substring(c, 1, 1)
    pair = F.concat(initial(F.lag("role").over(order)), initial(F.col("role")))
    before = F.lag("turn").over(order)
    return rows.select(
        "conv_id",
        "turn",
        F.row_number().over(order).cast("long").alias("place"),
        "role",
        "text",
        fault.alias("fault"),
        F.coalesce(~pair.isin(*LEGAL_PAIRS), F.lit(False)).alias("illegal"),
        (F.col("turn").isNotNull() & (before.isNull() | (before != F.col("turn")))).alias("new_turn"),
    )


# ---------------------------------------------------------------- edits

# Conversations go through Python by a name that is never null, as pandas would turn whole
# numbers into fractions beside a null.
NAME = "conv_name"


def name_of(key: str) -> Column:
    """`=` and the key as text; empty for a null key."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumn(NAME, name_of("conv_id")).drop("conv_id")


def _dealt(rows: DataFrame, *order: Column | str) -> DataFrame:
    return rows.repartition(NAME).sortWithinPartitions(NAME, *order)


def edits(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_name, place, edits: the cheapest edits of `faulty` turns, block by block.

    `place` is that of the block's first turn. Of edits of one cost the least by letters wins.
    """
    initial = F.substring("role", 1, 1)
    narrow = rows.select(
        "conv_id",
        "place",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("").alias("initial"),
        F.coalesce("fault", F.lit("")).alias("fault"),
    )
    forward = stored(
        _dealt(_named(narrow), "place").mapInPandas(
            functools.partial(_forward, block=block),
            f"{NAME} string, place long, edits string, pointers binary, last int",
        ),
        "repair-edits",
    )
    long_ones = _dealt(forward.where("edits IS NULL"), F.desc("place")).select(NAME, "place", "pointers", "last")
    traced = long_ones.mapInPandas(_backward, f"{NAME} string, place long, edits string")
    return forward.where("edits IS NOT NULL").select(NAME, "place", "edits").unionByName(traced)


class _Forward:
    """One conversation on its way through the program."""

    def __init__(self, name, block):
        self.name, self.block, self.program = name, block, START
        self.pointers, self.place, self.done = array("I"), 1, 0

    def feed(self, initial, fault):
        """Take a turn; gives a block of back-pointers when one is full."""
        full = None
        if len(self.pointers) >= self.block:
            full = (self.name, self.place, None, self.pointers.tobytes(), None)
            self.place += len(self.pointers)
            self.pointers = array("I")
        self.program, packed = step(self.program, initial, fault)
        self.pointers.append(packed)
        return full

    def end(self):
        last = last_state(self.program)
        if self.place == 1:
            return (self.name, 1, trace(self.pointers, last, CLOSING[last])[0], None, None)
        return (self.name, self.place, None, self.pointers.tobytes(), last)


def _forward(batches, block):
    columns = [NAME, "place", "edits", "pointers", "last"]
    current = None
    for batch in batches:
        out = []
        for name, initial, fault in zip(*[batch[c] for c in (NAME, "initial", "fault")], strict=True):
            if current is None or name != current.name:
                if current is not None:
                    out.append(current.end())
                current = _Forward(name, block)
            full = current.feed(initial, fault)
            if full:
                out.append(full)
        yield _frame(out, columns)
    if current is not None:
        yield _frame([current.end()], columns)


def _frame(rows, columns):
    frame = pd.DataFrame(rows, columns=columns, dtype=object)
    for column in ("place", "last"):
        if column in frame:
            frame[column] = frame[column].astype("Int64")
    return frame


def _backward(batches):
    state = 0
    for batch in batches:
        out = []
        for name, place, packed, last in zip(*[batch[c] for c in (NAME, "place", "pointers", "last")], strict=True):
            closing = ""
            if not pd.isna(last):
                state = int(last)
                closing = CLOSING[state]
            letters, state = trace(array("I", packed), state, closing)
            out.append((name, place, letters))
        yield _frame(out, [NAME, "place", "edits"])


# ---------------------------------------------------------------- repaired turns


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_name, step, edit, role, text, cost: what becomes of `faulty` turns, in order.

    One row per edit, from step 0: K keeps a turn, R gives it the role that fits, D deletes it
    (role and text are null), I inserts an empty one. Rows of a conversation follow one
    another in their partition. A conversation without turns has none.
    """
    turns = _named(rows.select("conv_id", "place", "role", "text", (F.col("fault") == "truncated").alias("cut")))
    marks = edits(rows, block).select(NAME, "place", "edits")
    both = turns.withColumn("edits", F.lit(None).cast("string")).unionByName(marks, allowMissingColumns=True)
    ordered = _dealt(both, "place", F.col("edits").isNull()).select(NAME, "edits", "role", "text", "cut")
    return ordered.mapInPandas(_apply, f"{NAME} string, step long, edit string, role string, text string, cost long")


class _Applied:
    """One conversation whose edits meet its turns."""

    def __init__(self, name):
        self.name, self.state, self.number, self.rows = name, 0, 0, []

    def take(self):
        rows, self.rows = self.rows, []
        return rows

    def begin(self, letters):
        self.letters, self.at, self.own_end = letters, 0, len(letters.rstrip("I"))

    def add(self, edit, role, text, cost):
        self.rows.append((self.name, self.number, edit, role, text, cost))
        self.number += 1
        if role is not None:
            self.state = AFTER[self.state][role[0]]

    def insert(self, upto):
        while self.at < upto and self.letters[self.at] == "I":
            self.add("I", ADDED[self.state], "", INSERT)
            self.at += 1

    def turn(self, role, text, cut):
        self.insert(self.own_end)
        edit, self.at = self.letters[self.at], self.at + 1
        if edit == "D":
            self.add(edit, None, None, DELETE)
        else:
            cost = (REROLE if edit == "R" else 0) + (TRUNCATED if cut else 0)
            self.add(edit, role if edit == "K" else ADDED[self.state], text, cost)
        if self.at == self.own_end:
            self.insert(len(self.letters))


def _apply(batches):
    columns = [NAME, "step", "edit", "role", "text", "cost"]
    current = None
    for batch in batches:
        out = []
        for name, marks, role, text, cut in zip(*[batch[c] for c in (NAME, "edits", "role", "text", "cut")], strict=True):
            if current is None or name != current.name:
                current = _Applied(name)
            if isinstance(marks, str):
                current.begin(marks)
            else:
                current.turn(role, text, cut)
                out += current.take()
        yield pd.DataFrame(out, columns=columns).astype({"step": "int64", "cost": "int64"})


def digest(repaired: DataFrame) -> DataFrame:
    """conv_name, cost, audit, repaired_sha256 of the rows of `repair`, read as they lie."""
    return repaired.mapInPandas(_digest, f"{NAME} string, cost long, audit string, repaired_sha256 string")


class _Digest:
    def __init__(self, name):
        self.name, self.cost, self.letters, self.hash, self.first = name, 0, [], hashlib.sha256(), True

    def feed(self, edit, role, text, cost):
        self.cost += cost
        self.letters.append(edit)
        if edit != "D":
            self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
            self.first = False

    def row(self):
        return (self.name, self.cost, "".join(self.letters), self.hash.hexdigest())


def _digest(batches):
    columns = [NAME, "cost", "audit", "repaired_sha256"]
    current = None
    for batch in batches:
        out = []
        for name, *turn in zip(*[batch[c] for c in (NAME, "edit", "role", "text", "cost")], strict=True):
            if current is None or name != current.name:
                if current is not None:
                    out.append(current.row())
                current = _Digest(name)
            current.feed(*turn)
        yield pd.DataFrame(out, columns=columns).astype({"cost": "int64"})
    if current is not None:
        yield pd.DataFrame([current.row()], columns=columns)


# ---------------------------------------------------------------- the query


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage to conv_id, turn, role, text, dealt by a checksum of key and turn."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    rows = turns.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), what.alias("what"))
    return (
        rows.where("what <> 0")
        .withColumns(
            {
                "role": F.when(F.col("what") == 4, "user").otherwise(F.col("role")),
                "text": F.when(F.col("what") == 1, "")
                .when(F.col("what") == 2, F.regexp_replace("text", "[.!?]", ""))
                .otherwise(F.col("text")),
                "copy": F.explode(F.sequence(F.lit(1), F.when(F.col("what") == 3, 2).otherwise(1))),
            }
        )
        .select("conv_id", "turn", "role", "text")
    )


def counts(rows: DataFrame) -> DataFrame:
    """conv_name, gaps, blank, duplicate, truncated, illegal of `faulty` turns."""
    number = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    span = F.max("turn").cast("long") - F.min("turn").cast("long") + 1
    kinds = {k: number(F.col("fault") == k) for k in ("blank", "duplicate", "truncated")}
    return _named(rows).groupBy(NAME).agg(
        F.coalesce(span - number(F.col("new_turn")), F.lit(0)).alias("gaps"),
        *[total.alias(kind) for kind, total in kinds.items()],
        number(F.col("illegal")).alias("illegal"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op11: every conversation damaged, its faults counted, and repaired by the cheapest edits."""
    from skyledger.llm.common import table

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = stored(faulty(damaged(turns)), "repair-turns")
    known = turns.select("conv_id").distinct().withColumn(NAME, name_of("conv_id"))
    found = counts(rows).join(digest(repair(rows)), NAME)
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return known.join(found, NAME, "left").select(
        "conv_id",
        *[value.alias(name) for name, value in zero.items()],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


# ---------------------------------------------------------------- SQL twin

_BLANK_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_CRC_SQL = """xor(list_reduce(
    [4294967295::BIGINT] || [ascii(c)::BIGINT FOR c IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')],
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))
  ), 4294967295)"""


def _next_state_sql(target: int) -> str:
    """The best way into a state of the grammar: least cost, then edits, with the text so far."""
    offers = []
    for before in range(4):
        if before == target:
            offers.append(f"CASE WHEN q{before} IS NOT NULL THEN {{'c': q{before}.c + 3, 'e': q{before}.e || 'D', 't': q{before}.t}} END")
        state, letters, added = before, "", ""
        for n in range(3):
            put = AFTER[state][ADDED[state][0]]
            for edit, cost, role, fits in (
                ("K", 0, "role", f"CASE initial {' '.join(f"WHEN '{i}' THEN {q}" for i, q in AFTER[state].items())} END = {target}"),
                ("R", 2, f"'{ADDED[state]}'", f"{put} = {target}"),
            ):
                offers.append(
                    f"CASE WHEN q{before} IS NOT NULL AND NOT must_go AND {fits} THEN {{'c': q{before}.c + {2 * n + cost} + cut,"
                    f" 'e': q{before}.e || '{letters}{edit}', 't': q{before}.t || {added}chr(10) || {role} || ':' || text}} END"
                )
            state, letters, added = put, letters + "I", f"{added}chr(10) || '{ADDED[state]}:' || "
    return f"list_min(list_filter([{', '.join(offers)}], lambda o: o IS NOT NULL))"


SQL = f"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC_SQL} % 20 AS what FROM conversations
), d AS (
  SELECT conv_id, turn, CASE what WHEN 4 THEN 'user' ELSE role END AS role,
         CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE what WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM t WHERE what <> 0
), s AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         trim(text, {_BLANK_SQL}) AS said, substr(role, 1, 1) AS initial
  FROM d
), f AS (
  SELECT *, row_number() OVER o AS place, lag(initial) OVER o AS before,
         CASE WHEN said = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
              WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM s WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen)
), g AS (
  SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS must_go, coalesce((fault = 'truncated')::INT, 0) AS cut FROM f
), p AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS place, {{'c': 0, 'e': '', 't': ''}} AS q0, NULL::STRUCT(c INT, e VARCHAR, t VARCHAR) AS q1,
         NULL::STRUCT(c INT, e VARCHAR, t VARCHAR) AS q2, NULL::STRUCT(c INT, e VARCHAR, t VARCHAR) AS q3
  FROM conversations
  UNION ALL
  SELECT p.conv_id, g.place, {", ".join(f"{_next_state_sql(q)} AS q{q}" for q in range(4))}
  FROM p JOIN g ON g.conv_id IS NOT DISTINCT FROM p.conv_id AND g.place = p.place + 1
), e AS (
  SELECT conv_id, list_min(list_filter([q0, q3,
      CASE WHEN q1 IS NOT NULL THEN {{'c': q1.c + 4, 'e': q1.e || 'II', 't': q1.t || chr(10) || 'user:' || chr(10) || 'assistant:'}} END,
      CASE WHEN q2 IS NOT NULL THEN {{'c': q2.c + 2, 'e': q2.e || 'I', 't': q2.t || chr(10) || 'assistant:'}} END
    ], lambda o: o IS NOT NULL)) AS best
  FROM p QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY place DESC) = 1
), c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c::BIGINT AS cost, best.e AS audit,
       sha256(substr(best.t, 2)) AS repaired_sha256
FROM e LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
