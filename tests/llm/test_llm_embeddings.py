"""Embedding near-duplicates against all pairs in numpy."""

import numpy as np
import pytest

from skyledger.llm import embeddings
from skyledger.llm.components import components

ODD = [
    (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 0.0]), (5, None), (6, [0.0, 0.0]),
    (7, [float("nan"), 1.0]), (8, [None, 1.0]), (9, []), (10, [1.0, 0.0, 0.0]), (11, [1e300, 1e300]),
    (12, [1e-300, 1e-300]), (None, [0.0, -1.0]), (13, [float("inf"), 1.0]),
]


def brute(ids, values, least):
    unit = values / np.linalg.norm(values, axis=1, keepdims=True)
    near = unit @ unit.T >= least
    np.fill_diagonal(near, False)
    label = list(ids)
    changed = True
    while changed:
        changed = False
        for i, j in zip(*np.nonzero(near), strict=True):
            if label[j] < label[i]:
                label[i], changed = label[j], True
    return {i: (int(n), c) for i, n, c in zip(ids, near.sum(1), label, strict=True)}


@pytest.mark.parametrize("block", [1024, 16])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", block)
    random = np.random.default_rng(3)
    centres = random.standard_normal((12, 16))
    rows = [centres[i % 12] + random.standard_normal(16) * random.choice([0.05, 0.2, 0.6]) for i in range(300)]
    rows += [random.standard_normal(16) for _ in range(100)] + rows[:40]
    values = np.array(rows, dtype=np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(frame, recall=0.9999).collect()}
    expected = brute(list(range(len(values))), values.astype(float), 0.9)
    found, true = sum(v[0] for v in got.values()), sum(v[0] for v in expected.values())
    assert all(got[i][0] <= expected[i][0] for i in expected)
    assert found >= 0.99 * true
    assert np.mean([got[i][1] == expected[i][1] for i in expected]) > 0.99


def test_odd_vectors(spark):
    frame = spark.createDataFrame(ODD, "vec_id long, embedding array<double>").selectExpr("*", "1 as node", "2 as payload")
    rows = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(frame).collect()]
    assert sorted(rows, key=str) == sorted(
        [
            (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (None, 3, 1, False), (None, 0, None, True),
            (11, 1, 11, True), (12, 1, 11, False), *[(i, 0, i, True) for i in (5, 6, 7, 8, 9, 10, 13)],
        ],
        key=str,
    )


def test_empty(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_duplicates(frame).count() == 0


def test_shape_follows_the_size():
    assert embeddings.shape(1_000)[0] == embeddings.LEAST_BITS
    bits, tables = embeddings.shape(100_000_000)
    assert bits == 19 and 1 - (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** tables >= embeddings.RECALL


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(39, 500), (7, 7), (200, 201), (201, 200)]
    frame = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.component for r in components(frame).collect()}
    expected = {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 40)} | {500: 1, 200: 200, 201: 200}
    assert got == expected
    assert components(frame.limit(0)).count() == 0
