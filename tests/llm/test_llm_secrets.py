"""Secrets: pattern spans against Python's patterns, learned spans, redaction."""

import random
import re

from pyspark.sql import functions as F

from skyledger.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KINDS = (("assign", ASSIGN, 2, 8), ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile(r"[0-9a-f]+"), 0, 32))


def plain(text):
    found = []
    for rank, (kind, pattern, group, least) in enumerate(KINDS):
        found += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return sorted(found)


def random_texts(count):
    random.seed(1)
    parts = [
        "password", "PassWD", "secret", "token", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "ABCD1234", "é", "\n",
        "0123456789abcdef", "deadbeef", "x.y", "longvalue", "-", "AKIAAKIAABCDEFGH12", "K", "ſ", "漢", "😀",
    ]
    return [(i, "".join(random.choices(parts, k=random.randrange(25)))) for i in range(count)]


def test_pattern_spans(spark):
    rows = [*random_texts(1500), (None, None), (-2, ""), (-3, "password=abcdefgh " * 3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    got = secrets.scan(frame).collect()
    assert len(got) == len(rows)
    for row in got:
        spans = [(s["start"], s["rank"], s["kind"], s["end"]) for s in row["spans"] if s["kind"] != secrets.LEARNED]
        assert spans == plain(texts[row.doc_id])


def test_learned_spans_and_redaction(spark):
    random.seed(2)
    syllables = ["tion", "ing", "er", "the", "and", "re", "men", "ta", "lo", "vis"]
    words = lambda n: " ".join("".join(random.choices(syllables, k=random.randrange(1, 7))) for _ in range(n))
    rows = [(i, words(200)) for i in range(150)]
    rows += [(1000 + i, f"{words(5)} token = \"{random.getrandbits(160):040x}\" {words(5)}") for i in range(20)]
    hidden = ["xK9dQ2mTz7LpW4vRb8NcY1hG", "Zm9vYmFyYmF6cXV4MTIzNDU2Nzg5MA=="]
    rows += [(2000 + i, f"{words(9)} {value} {words(9)}") for i, value in enumerate(hidden)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "length(text) as n_chars", "'c' as cuts")
    texts = dict(rows)
    learned = {
        (r.doc_id, texts[r.doc_id][s["start"] : s["end"]])
        for r in secrets.scan(frame).collect()
        for s in r["spans"]
        if s["kind"] == secrets.LEARNED
    }
    assert learned == {(2000, hidden[0]), (2001, hidden[1])}
    clean = secrets.redact(frame)
    assert clean.columns == frame.columns
    for row in clean.collect():
        assert row.n_chars == len(row.text)
        assert (secrets.REDACTED in row.text) == (row.doc_id >= 1000)
        assert row.doc_id >= 1000 or row.text == texts[row.doc_id]
        assert not any(h in row.text for h in hidden) and not plain(row.text)


def test_overlapping_spans_are_one_cut(spark):
    value = "0123456789abcdef" * 3
    rows = [(1, f"a token={value}, b AKIA{'X' * 16} c"), (1, f"a token={value}, b AKIA{'X' * 16} c"), (2, None)]
    clean = secrets.redact(spark.createDataFrame(rows, "doc_id long, text string"), chars=None).collect()
    assert [r.text for r in clean if r.doc_id == 1] == ["a [SECRET], b [SECRET] c"] * 2
    assert [r.text for r in clean if r.doc_id == 2] == [None]


def test_messy_and_empty(messy, empty):
    assert secrets.scan(messy).count() == messy.count()
    assert sorted(map(str, secrets.redact(messy).select("doc_id", "text").collect())) == sorted(
        map(str, messy.select("doc_id", "text").collect())
    )
    assert secrets.scan(empty).count() == 0 and secrets.redact(empty).count() == 0


def test_no_python_in_the_plan(messy):
    plan = secrets.scan(messy)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_judged_alike_in_small_and_large_tables(spark):
    """The labelled samples do not shrink with the table, so the same strings are found."""
    random.seed(6)
    alphabet = secrets.TOKEN_CHARS[:62]
    hidden = ["".join(random.choices(alphabet, k=32)) for _ in range(30)]
    plain_ones = ["monotonically_increasing_id", "InternationalizationService", "4111111111111111", "MAX_CONNECTION_TIMEOUT"]
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    tokens = spark.createDataFrame([(t,) for t in hidden + plain_ones], "token string")
    for rows in (docs.limit(30), docs.where("doc_id < 2000")):
        table = secrets.train(secrets.matches(rows, "doc_id", "text"))
        found = {r.token for r in tokens.where(secrets.ratio(F.col("token"), table) >= secrets.LEAST_RATIO).collect()}
        assert len(found & set(hidden)) >= 27 and not found & set(plain_ones)
