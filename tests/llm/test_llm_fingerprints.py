"""Fingerprints: the tree against plain Python, the next document, likeness."""

import hashlib
import re

from pyspark.sql import functions as F

from skyledger.llm import fingerprints

PIECE = re.compile(r"[^\n]{1,100}[^ \t\n\x0b\f\r]*[ \t\x0b\f\r]*|\n")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_root(text):
    lines, current = [], []
    for piece in PIECE.findall(text):
        if piece == "\n":
            lines.append(current)
            current = []
        else:
            current.append(sha("piece:" + piece))
    lines.append(current)
    sections, run = [], ""
    for line in lines:
        digest = sha("paragraph:" + "".join(line))
        ends = not line or digest[0] in fingerprints.SECTION_ENDS
        run += digest + ("" if ends else ",")
        if ends:
            sections.append(run)
            run = ""
    if run:
        sections.append(run)
    return sha("root:" + ",".join(sha("section:" + s) for s in sections))


def plain_leaves(text):
    return {p for p in PIECE.findall(text) if p != "\n"}


def plain_likeness(a, b):
    if a == b:
        return 1.0
    x, y = plain_leaves(a), plain_leaves(b)
    return 2.0 * len(x & y) / max(len(x) + len(y), 1)


def expected(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5((r[1] or "").encode()).hexdigest()))
    out = []
    for i, (doc_id, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out.append(
            (doc_id, len(text), sha(edited), plain_root(text), plain_root(edited), plain_likeness(text, edited), plain_likeness(text, following))
        )
    return sorted(out, key=str)


def test_against_plain_python(spark, messy):
    got = [tuple(r) for r in fingerprints.compare_edited(messy).collect()]
    assert sorted(got, key=str) == expected([(r.doc_id, r.text) for r in messy.collect()])


def test_many_ranges(spark):
    lines = ["some words of a line, here. ", "others\n", "a\n\nb", "漢字 and more " * 20, ""]
    rows = [(i * i % 1009, "".join(lines[(i * j) % 5] for j in range(i % 9))) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in fingerprints.compare_edited(frame).collect()]
    assert sorted(got, key=str) == expected(rows)


def test_one_document_and_none(spark, empty):
    one = spark.createDataFrame([(None, "abcd")], "doc_id long, text string")
    assert [tuple(r) for r in fingerprints.compare_edited(one).collect()] == expected([(None, "abcd")])
    assert fingerprints.compare_edited(empty).count() == 0


def test_changed_branches_locate_an_edit(spark):
    lines = [f"line {i} of the text" for i in range(20)]
    other = [*lines[:7], "an edited line", *lines[8:]]
    frame = spark.createDataFrame([("\n".join(lines), "\n".join(other))], "a string, b string")
    row = frame.select(
        fingerprints.changed(fingerprints.paragraphs(F.col("a")), fingerprints.paragraphs(F.col("b"))).alias("lines"),
        fingerprints.sections(fingerprints.paragraphs(F.col("a"))).alias("x"),
        fingerprints.sections(fingerprints.paragraphs(F.col("b"))).alias("y"),
    ).first()
    assert row.lines == [7]
    assert 0 < len(set(row.x) - set(row.y)) < len(row.x)
