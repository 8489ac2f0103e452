"""Mixing: targets, places and training order against plain Python."""

import hashlib
import re

import pytest

from skyledger.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes: dict, weights=(5, 2, 1), share=1.5, cap=2.0) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left, whole = total - sum(capped.values()), sum(weight[s] for s in free)
        found = {s: left * weight[s] / whole for s in free}
        over = {s: cap * sizes[s] for s in free if found[s] > cap * sizes[s]}
        if not over or not free:
            return capped | found
        capped |= over


def test_targets_and_taken(spark, messy):
    rows = mixing.mix_table(messy).collect()
    texts = [(r.doc_id, r.source, len(WORDS.findall(r.text or ""))) for r in messy.collect()]
    sizes: dict = {}
    for _, source, size in texts:
        sizes[source] = sizes.get(source, 0) + size
    targets = plain_targets(sizes)
    assert sorted((str(r.doc_id), r.size) for r in rows) == sorted((str(i), n) for i, _, n in texts)
    for row in rows:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(targets[row.source])
        assert 0 <= row.copies <= 2 and len(row.moments) == row.copies
        assert all(0 <= m <= 1 for m in row.moments)
    for source, size in sizes.items():
        taken = sum(r.size * r.copies for r in rows if r.source == source)
        assert abs(taken - targets[source]) <= max([n for _, s, n in texts if s == source] + [1]) / 2 + 1e-6


def test_places_against_a_sorted_list(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), f"s{i % 3}") for i in range(400)], "doc_id long, text string, source string")
    rows = {r.doc_id: r for r in mixing.mix_table(docs).collect()}
    for s in range(3):
        mine = sorted((i for i in range(400) if i % 3 == s), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
        place = 0
        for i in mine:
            size = 1 + i % 7
            row = rows[i]
            expected = sum(p * row.source_size + place + size / 2 < row.target for p in range(2))
            assert row.copies == expected
            place += size


def test_demand_curve_is_inverted(spark):
    from pyspark.sql import functions as F

    knots = [1.5, 1.0, 0.0, 2.0]

    def integral(t):
        area, step = 0.0, 1 / (len(knots) - 1)
        for i in range(len(knots) - 1):
            part = min(max(t - i * step, 0), step)
            end = knots[i] + (knots[i + 1] - knots[i]) * part / step
            area += (knots[i] + end) / 2 * part
        return area

    frame = spark.range(0, 101).select(
        (F.col("id") * 10.0).alias("supply"),
        mixing.due(F.col("id") * 10.0, F.lit(1000.0), F.array(*map(F.lit, knots))).alias("moment"),
    )
    for supply, moment in frame.collect():
        assert integral(moment) / integral(1.0) == pytest.approx(supply / 1000, abs=1e-9)


def test_order_and_copies_of_the_mixed_documents(spark, messy):
    mixed = mixing.mixed(messy)
    assert mixed.columns == messy.columns
    table = mixing.mix_table(messy).collect()
    assert mixed.count() == sum(r.copies for r in table)
    docs = spark.createDataFrame([(i, "w " * 5, "s") for i in range(200)], "doc_id long, text string, source string")
    moments = {r.doc_id: r.moments for r in mixing.mix_table(docs).collect()}
    got = [r.doc_id for r in mixing.mixed(docs).collect()]
    assert got == [i for _, i in sorted((m, i) for i, ms in moments.items() for m in ms)]


def test_empty(empty):
    assert mixing.mix_table(empty).count() == 0
    assert mixing.mixed(empty).count() == 0
