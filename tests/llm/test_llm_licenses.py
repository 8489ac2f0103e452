"""Licences: the cosine against plain Python, the pattern's rule, inheritance."""

import math
import random

import pytest

from skyledger.llm import licenses

FILES = [
    (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.py", "hello"), (3, "a/b/c/y", None),
    (4, "q/y", None), (5, None, "SPDX-License-Identifier: BSD-3-Clause"),
    (6, "a/b/c/d/z", "Licensed under CC BY 4.0.\nReleased under the ISC License.\n" + "other words " * 30),
    (7, "a/b/c/COPYING", "Licensed under the Apache License, Version 2.0.\n" + "notes " * 60), (8, "ab/x", ""), (2, "a/b/x.py", "hello"),
    (None, "a/b/c/d/w", "licensed words that are no licence at all"), (9, "long", "word " * 50_000),
]


def test_inheritance_and_messy_rows(spark):
    frame = spark.createDataFrame(FILES, "doc_id long, path string, text string").selectExpr("*", "'c' as text_key", "1 as score", "2 as own")
    rows = sorted(((r.doc_id, r.own, r.licence, r.inherited_from, r.is_file) for r in licenses.scan(frame).collect()), key=str)
    assert rows == sorted(
        [
            (1, "MIT", "MIT", None, True), (2, None, "MIT", "a", False), (2, None, "MIT", "a", False),
            (3, None, "Apache-2.0", "a/b/c", False), (4, None, "BSD-3-Clause", "", False),
            (5, "BSD-3-Clause", "BSD-3-Clause", None, True), (6, "CC-BY-4.0 AND ISC", "CC-BY-4.0 AND ISC", None, False),
            (7, "Apache-2.0", "Apache-2.0", None, True), (8, None, "BSD-3-Clause", "", False),
            (None, None, "Apache-2.0", "a/b/c", False), (9, None, "BSD-3-Clause", "", False),
        ],
        key=str,
    )


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, path string, text string")
    assert licenses.scan(frame).count() == 0


def test_cosine_against_plain_python(spark):
    random.seed(4)
    pool = sorted({w for _, s in licenses.templates() for w in licenses._python_words(s)}) + ["alpha", "beta", "gamma"]
    known = [s for _, s in licenses.templates()]
    texts = []
    for i in range(120):
        words = licenses._python_words(random.choice(known))
        for _ in range(random.randrange(4)):
            words.insert(random.randrange(len(words) + 1), random.choice(pool))
        texts.append((i, "p", " ".join(words) + ".\nplain prose of no kind"))
    frame = spark.createDataFrame(texts, "doc_id long, path string, text string")
    vocabulary = sorted({w for _, s in licenses.templates() for w in licenses._python_words(s)})
    counts = {w: sum(w in set(licenses._python_words(t)) for _, _, t in texts) for w in vocabulary}
    vectors, idf, rare = licenses.weigh(licenses.templates(), len(texts), counts)
    assert licenses.document_counts(frame, "text", vocabulary) == (len(texts), {w: n for w, n in counts.items() if n})
    expected = {}
    for i, _, text in texts:
        words = licenses._python_words(text.split("\n")[0])
        mine = {w: words.count(w) * idf.get(w, rare) for w in words}
        length = math.sqrt(sum(v * v for v in mine.values()))
        scores = [(-round(sum(v * vector.get(w, 0.0) for w, v in mine.items()) / length, 6), name) for name, vector in vectors]
        best = min(scores)
        if -best[0] >= licenses.LEAST_COSINE:
            expected[i] = (best[1], -best[0])
    got = {r.doc_id: (r.own, r.score) for r in licenses.scan(frame).collect() if r.own}
    assert set(got) == set(expected) and len(got) > 60
    for i, (name, score) in got.items():
        assert name == expected[i][0] and score == pytest.approx(expected[i][1], abs=2e-6)


def test_sentences_without_heavy_words_cannot_reach_the_cosine():
    vectors, _, _ = licenses.weigh(licenses.templates(), 1000, {"the": 900, "of": 800, "under": 20})
    heavy = licenses.heavy_words(vectors, 0.75)
    for _, vector in vectors:
        left = sum(w * w for word, w in vector.items() if word not in heavy)
        assert math.sqrt(left) < 0.75
