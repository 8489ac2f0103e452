"""Quality: the model against numpy on the same rows, held-out accuracy, odd tables."""

import zlib

import numpy as np
import pytest

from skyledger.llm import quality

SF_DIR = "/root/testdata/sf0.01"


def test_model_equals_numpy(spark):
    random = np.random.default_rng(1)
    d = len(quality.FEATURES)
    labels = np.arange(400) % 2
    values = random.standard_normal((400, d)) * (1 + labels[:, None]) + labels[:, None]
    rows = [(int(c), v.tolist()) for c, v in zip(labels, values, strict=True)] + [(None, [0.0] * d), (3, [9.0] * d)]
    model = quality.fit(spark.createDataFrame(rows, "label int, statistics array<double>"), "label", shrinkage=0.1)
    scaled = (values - values.mean(0)) / values.std(0)
    logs = []
    for c in (0, 1):
        mine = scaled[labels == c]
        raw = np.cov(mine.T, bias=True)
        shrunk = 0.9 * raw + 0.1 * raw.trace() / d * np.eye(d)
        away = scaled - mine.mean(0)
        distance = np.einsum("ij,jk,ik->i", away, np.linalg.inv(shrunk), away)
        logs.append(np.log(0.5) - 0.5 * np.linalg.slogdet(shrunk)[1] - 0.5 * distance)
    assert model.margins(values) == pytest.approx(logs[1] - logs[0], abs=1e-6)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in quality.score_documents(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    told = [(r.quality, rows[r.doc_id]) for r in labels.collect() if rows[r.doc_id].held_out]
    good = [r.score for q, r in told if q == 1]
    bad = [r.score for q, r in told if q == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.98
    assert np.mean([q == r.predicted for q, r in told]) > 0.95
    kept = {r.doc_id for r in quality.keep_good(docs, labels).select("doc_id").collect()}
    assert kept == {i for i, r in rows.items() if r.predicted}


def test_labels_held_out_do_not_teach(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 50 + 1)) for i in range(200)], "doc_id long, text string")
    held = [(i, i % 2) for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    labels = spark.createDataFrame(held, "doc_id long, quality int")
    assert {r.score for r in quality.score_documents(docs, labels).collect()} == {0.5}


def test_messy_and_empty(spark, messy, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 0), (6, 1), (6, 0), (None, 1), (3, None)], "doc_id long, quality int")
    rows = quality.score_documents(messy, labels).collect()
    assert len(rows) == messy.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.keep_good(messy, labels).columns == messy.columns
    assert quality.score_documents(empty, labels).count() == 0
    assert quality.keep_good(empty, labels.limit(0)).count() == 0


def test_statistics_of_long_texts_go_in_slices(monkeypatch):
    text = "Abc dé 12 ###! 漢\n" * 100
    whole = quality.statistics(text)
    monkeypatch.setattr(quality, "_SLICE", 7)
    assert quality.statistics(text) == whole
    assert len(whole) == len(quality.FEATURES) and np.isfinite(quality.statistics(None)).all()
