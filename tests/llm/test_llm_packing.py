"""Packing: a round trip of every token, and the tokenizer's own ids."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from skyledger.llm import packing

PATH = packing.default_tokenizer()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.asarray(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4").tobytes()


def check(rows, expected):
    """Every document's ids lie in its pieces once, and every sequence is gapless."""
    found: dict = {}
    for row in sorted(rows, key=lambda r: (str(r.doc_id), r.start)):
        found.setdefault((row.doc_id, row.doc_tokens), []).append(row)
    whole = sorted(b"".join(r.ids for r in pieces) for pieces in found.values())
    assert sorted(expected) == whole
    for (_, tokens), pieces in found.items():
        assert sum(r.length for r in pieces) == tokens
        assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces])[:-1])
    sequences: dict = {}
    for row in sorted(rows, key=lambda r: r.offset):
        assert row.offset == sequences.get(row.sequence_id, 0)
        sequences[row.sequence_id] = row.offset + row.length
        assert len(row.ids) == 4 * row.length <= 4096
    return sequences


def test_round_trip(spark, tokenizer):
    random.seed(5)
    docs = [(i, " ".join(random.choice(["one", "two", "three,", "\n", "Über"]) for _ in range(random.randrange(1500)))) for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = packing.pack(frame, PATH).collect()
    sequences = check(rows, [ids_of(tokenizer, text) for _, text in docs])
    window = {r.sequence_id: r.window for r in rows}
    assert sum(length != window[s] for s, length in sequences.items()) <= 3
    steps: dict = {}
    for sequence, step in {(r.sequence_id, r.step) for r in rows}:
        steps.setdefault(step, []).append(window[sequence])
    assert all(len(set(windows)) == 1 and sum(windows) <= packing.STEP_TOKENS for windows in steps.values())


def test_messy_rows(messy, tokenizer):
    texts = [r.text for r in messy.collect()]
    rows = packing.pack(messy.coalesce(1), PATH).collect()
    joined = b"".join(sorted(ids_of(tokenizer, t) for t in texts))
    assert sum(r.length for r in rows) * 4 == len(joined)
    assert sum(r.doc_tokens == 1 for r in rows) == 3


def test_empty(empty):
    assert packing.pack(empty, PATH).count() == 0


def test_encoder_equals_the_tokenizer(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_CHARS", 30)
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    encoder = packing.Encoder(PATH)
    random.seed(2)
    alphabet = [chr(i) for i in range(256)] + ["'s", "'re", "  ", "\n\n", " a", "漢", "12", "<|endoftext|>"] * 6
    for _ in range(1500):
        text = "".join(random.choices(alphabet, k=random.randrange(100)))
        assert encoder.encode(text) + np.zeros(1, "<u4").tobytes() == ids_of(tokenizer, text)


def test_a_piece_is_cut_when_nothing_fits():
    packer = packing.Packer()
    for i in range(10):
        packer.add(i, np.full(700, i, dtype="<u4"))
    packer.finish()
    lengths: dict = {}
    for row in packer.rows:
        lengths[row[5]] = lengths.get(row[5], 0) + row[2]
    assert sum(lengths.values()) == 7000
    assert sum(n not in packing.TIERS for n in lengths.values()) <= 1
