"""Vector codes against a plain scan of all entries, in Python's whole numbers."""

import math

import numpy as np
import pytest
from oracle import connect, differences
from pyspark.errors import PySparkException

from skyledger.llm import vectorcodes
from skyledger.llm.vectorcodes import Assigner, codebook_digest, compress, net_moves, squares

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label) of each usable row, and the last codebooks."""
    usable = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max((-(-len(r[1]) // parts) for r in usable), default=0)
    whole = [[math.floor(x * 256) for x in map(float, np.float32(r[1]))] + [0] * (width * parts - len(r[1])) for r in usable]
    cut = lambda w, m: tuple(w[m * width : (m + 1) * width])
    order = sorted(range(len(usable)), key=lambda i: (usable[i][0] is None, usable[i][0] or 0, whole[i]))[:entries]
    books = [[cut(whole[i], m) for i in order] for m in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    best = lambda w, m: min((away(cut(w, m), c), j) for j, c in enumerate(books[m]))
    for _ in range(rounds):
        held = [[best(w, m)[1] for m in range(parts)] for w in whole]
        for m in range(parts):
            for j in range(len(books[m])):
                mine = [cut(w, m) for w, codes in zip(whole, held, strict=True) if codes[m] == j]
                if mine:
                    books[m][j] = tuple(sum(column) // len(mine) for column in zip(*mine, strict=True))
    out = []
    for row, w in zip(usable, whole, strict=True):
        found = [best(w, m) for m in range(parts)]
        out.append((row[0], "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found), row[2]))
    return out, books


def corpus(number, dims, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    rows = [(i, (centres[i % 12] + 0.3 * rng.normal(size=dims)).astype("f4").tolist(), i % 5 or None) for i in range(number)]
    return rows + [(number + i, rows[3][1], 7) for i in range(60)]


MESSY = [
    (None, [0.5] * 32, None), (None, None, 1), (5, [], 2), (6, [1.0, None] * 16, 2), (7, [float("nan")] * 32, 2),
    (8, [float("inf")] * 32, 2), (9, [-0.001] * 5, None), (9, [-0.001] * 5, None), (9, [2.0] * 31, 3), (10, [0.0] * 32, 3),
]


def told(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("rows", [corpus(300, 32), MESSY, MESSY + corpus(90, 32, 2), corpus(200, 16, 3)[::-1]])
def test_against_plain_scan(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'c' as whole", "'c' as codes", "1 as _key").repartition(5)
    found = compress(frame, keep=("label",))
    want, books = plain(rows)
    assert told((r.vec_id, r.code, r.error, r.label) for r in found.rows.collect()) == told(want)
    assert codebook_digest(found.history[-1]) == codebook_digest(np.array(books, dtype=np.int64))
    assert len(found.measured) == 3 and found.measured[0] == 16 * len(want)


def test_bounds_spare_measurements(spark):
    """Later rounds measure a part again only where the net moves of entries reach its bound."""
    found = compress(spark.createDataFrame(corpus(900, 64), SCHEMA), rounds=6)
    assert found.measured[0] == 16 * 960 and found.measured[-1] < found.measured[0] / 2
    want, _ = plain(corpus(900, 64), rounds=6)
    assert told((r.vec_id, r.code, r.error) for r in found.rows.collect()) == told(w[:3] for w in want)


def test_net_move_is_tighter_than_summed_drifts():
    """An entry that comes back has no net move, and a bound of the first round serves again."""
    rng = np.random.default_rng(4)
    first = rng.integers(-500, 500, (3, 20, 4))
    there = first + rng.integers(-90, 90, first.shape)
    vectors = rng.integers(-500, 500, (200, 12))
    held = Assigner([first]).fresh(200)
    exact, measured = Assigner([first]).assign(vectors, *held)
    assert measured == 600
    back, again = Assigner([first, there, first]).assign(vectors, *held)
    ties = (np.sort([squares(vectors[:, 4 * m : 4 * m + 4], first[m]) for m in range(3)], axis=2)[:, :, :2] ** 0.5).round(3)
    assert again <= (np.diff(ties, axis=2) < 1e-2).sum() and (back == exact).all()
    drift = net_moves(there[0], first[0]) + net_moves(first[0], there[0])
    assert (net_moves(first[0], first[0]) == 0).all() and (drift > 0).all()


def test_assigner_is_exact_over_rounds():
    """Codes by bounds equal codes by scan, ties to the lower entry, whatever the moves."""
    rng = np.random.default_rng(5)
    history = [rng.integers(-20, 20, (2, 9, 2))]
    vectors = rng.integers(-20, 20, (400, 4))
    held = Assigner(history).fresh(400)
    for _ in range(12):
        assigner = Assigner(history)
        exact, _ = assigner.assign(vectors, *held)
        for m in range(2):
            distances = squares(vectors[:, 2 * m : 2 * m + 2], history[-1][m])
            assert (held[0][:, m] == distances.argmin(axis=1)).all() and (exact[:, m] == distances.min(axis=1)).all()
        history.append(history[-1] + rng.integers(-2, 3, history[-1].shape))


def test_edges(spark):
    frame = spark.createDataFrame(corpus(5, 16), SCHEMA)
    assert compress(frame.limit(0)).rows.count() == 0
    assert {(r.code, r.error) for r in compress(spark.createDataFrame([(1, [], 1), (2, [], 1)], SCHEMA)).rows.collect()} == {("00" * 16, 0)}
    with pytest.raises(PySparkException, match="component"):
        compress(spark.createDataFrame([(1, [1e30] * 16, 1)], SCHEMA)).rows.count()
    with pytest.raises(ValueError, match="entries"):
        compress(frame, entries=300)


def test_query_and_twin(spark, tmp_path):
    rows = corpus(260, 32, 9) + [(900, None, 1), (901, [float("nan")] * 32, 1), (902, [-0.7] * 32, None)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    connection = connect("/root/testdata/sf0.001")
    connection.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert differences(vectorcodes.query(spark, str(tmp_path)), connection, vectorcodes.SQL) == []
