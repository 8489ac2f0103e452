"""Near-duplicates against all pairs, and the parts: alignment, sketches, classes."""

import random

import numpy as np
import pytest

from skyledger.llm import alignment, minhash


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_alignment_against_the_full_table():
    random.seed(3)
    for _ in range(800):
        a = [random.randrange(random.choice([3, 1000])) for _ in range(random.randrange(1, 40))]
        b = list(a)
        for _ in range(random.randrange(6)):
            i, what = random.randrange(len(b) + 1), random.random()
            if what < 0.4:
                b.insert(i, random.randrange(50))
            elif i < len(b):
                b[i] = random.randrange(50)
        length = lcs(a, b)
        true = length / (len(a) + len(b) - length)
        x, y = np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)
        for least in (0.8, 0.5):
            got = alignment.similarity(x, y, least)
            assert got == pytest.approx(true) if true >= least else got < least


def edited(words, share):
    words = list(words)
    for _ in range(int(len(words) * share)):
        i = random.randrange(len(words))
        words[i : i + 1] = random.choice([[], [f"n{random.randrange(10**6)}"], [words[i], f"n{random.randrange(10**6)}"]])
    return words


def corpus():
    random.seed(7)
    passage = [f"p{i}" for i in range(60)]
    docs = []
    for _ in range(40):
        base = [f"w{random.randrange(5000)}" for _ in range(random.randrange(20, 300))]
        if random.random() < 0.5:
            base = passage + base
        docs += [edited(base, random.choice([0, 0.01, 0.02, 0.05])) for _ in range(random.randrange(1, 9))]
    docs += [edited([f"h{i}" for i in range(200)], 0.02) for _ in range(60)]
    docs += [["few", "words"], ["few", "words"], ["Few", "Words"], ["few", "other"], []]
    random.shuffle(docs)
    return [(i, " ".join(words)) for i, words in enumerate(docs)]


def brute(docs, least):
    label = {i: i for i, _ in docs}
    values = [(i, text, alignment.shingles(text)) for i, text in docs]
    changed = [(i, j) for i, s, x in values for j, t, y in values if i < j and (s == t or (len(x) and alignment.similarity(x, y, least) >= least))]

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in changed:
        a, b = sorted((root(i), root(j)))
        label[b] = a
    return {i: root(i) for i in label}


def test_classes_against_all_pairs(spark):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = minhash.near_duplicate_classes(frame).collect()
    got, expected = {r.doc_id: r.class_id for r in rows}, brute(docs, 0.8)
    assert len(rows) == len(docs)
    assert sum(got[i] != expected[i] for i in expected) <= 0.01 * len(docs)
    # Nothing is tied that all pairs do not tie.
    assert all(expected[i] == expected[c] for i, c in got.items())
    assert sorted(r.doc_id for r in rows if r.kept) == sorted(set(got.values()))
    sizes = {c: list(got.values()).count(c) for c in got.values()}
    assert all(r.class_size == sizes[r.class_id] for r in rows)
    assert {r.doc_id for r in minhash.keep_one(frame).collect()} == set(got.values())


def chained():
    """One group of hundreds: several centres, and chains of copies of copies around each."""
    random.seed(11)
    docs = [[f"c{i}" for i in range(240)]]
    for _ in range(299):
        docs.append(edited(random.choice(docs[-40:]), 0.02))
    return [(i, " ".join(words)) for i, words in enumerate(docs)]


def test_chained_group_against_all_pairs(spark):
    docs = chained()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicate_classes(frame).collect()}
    assert got == brute(docs, 0.8)


def one_bucket(count):
    """A chain of texts, each alike to the one before and after only, that share their only code."""
    for salt in range(10_000):
        segments = [[f"x{salt}s{k}w{i}" for i in range(15)] for k in range(14)]
        docs = []
        for i in range(count):
            docs.append([word for segment in segments for word in segment])
            segments[1 + i % 13] = [f"x{salt}i{i}w{j}" for j in range(15)]
        codes = (minhash.sketch(alignment.shingles(" ".join(words)), 1, 1)[0] for words in docs)
        first = next(codes)
        if all(code == first for code in codes):
            return [(i, " ".join(words)) for i, words in enumerate(docs)]


def test_links_of_texts_tied_to_different_leaders(spark):
    docs = one_bucket(6)
    frame = spark.createDataFrame([docs[i] for i in (1, 4, 0, 5, 2, 3)], "doc_id long, text string").coalesce(1)
    assert set(brute(docs, 0.8).values()) == {0} and len(set(brute(docs[::2], 0.8).values())) == 3
    assert {r.class_id for r in minhash.near_duplicate_classes(frame, sketches=1, sample=1).collect()} == {0}


def test_rare_groups_hold_every_link():
    """Each pair that links shares a group; unlike texts of one bucket share few."""
    texts = [t for _, t in corpus()] + [t for _, t in chained()[:120]]
    for least in (0.8, 0.6):
        values = [alignment.shingles(t) for t in texts]
        held = {(min(i, j), max(i, j)) for g in minhash.rare_groups(values, least) for i in g for j in g if i != j}
        for i, x in enumerate(values):
            for j in range(i + 1, len(values)):
                if len(x) and alignment.similarity(x, values[j], least) >= least:
                    assert (i, j) in held
    passage = [f"p{i}" for i in range(30)]
    unlike = [alignment.shingles(" ".join(passage + [f"u{i}w{k}" for k in range(300)])) for i in range(50)]
    assert minhash.rare_groups(unlike, 0.8) == []


def test_buckets_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 64)
    docs = one_bucket(150)
    shuffled = random.Random(5).sample(docs, len(docs))
    assert len(docs) > 2 * minhash.BLOCK and set(brute(docs, 0.8).values()) == {0}
    frame = spark.createDataFrame(shuffled, "doc_id long, text string").coalesce(1)
    assert {r.class_id for r in minhash.near_duplicate_classes(frame, sketches=1, sample=1).collect()} == {0}


def test_messy_rows(spark, messy):
    rows = minhash.near_duplicate_classes(messy).collect()
    assert len(rows) == messy.count()
    kept = minhash.keep_one(messy)
    assert kept.columns == messy.columns
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    assert sum(i == 1 for i, _ in texts) == 1
    assert [i for i, t in texts if t and len(t) > 10_000] == [4]
    assert [i for i, t in texts if not t] == [2]
    assert len(texts) == 8


def test_empty(empty):
    assert minhash.near_duplicate_classes(empty).count() == 0
    assert minhash.keep_one(empty).count() == 0


def test_sketch_chunks_change_nothing(monkeypatch):
    values = alignment.shingles(" ".join(f"w{i % 37}" for i in range(500)))
    whole = minhash.sketch(values)
    monkeypatch.setattr(minhash, "CHUNK", 11)
    assert (minhash.sketch(values) == whole).all()
    assert (minhash.sketch(values[:2]) != whole).any() and len(minhash.sketch(values[:1])) == minhash.SKETCHES


def test_order_matters_to_a_sketch():
    words = [f"w{i}" for i in range(400)]
    moved = words[200:] + words[:200]
    a, b = (minhash.sketch(alignment.shingles(" ".join(w))) for w in (words, moved))
    assert (a == b).sum() < len(a) // 2
