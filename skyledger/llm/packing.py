"""Hierarchical packing of tokenised documents into windows of several context sizes.

A document is its token ids and one end id. Whole windows of the longest tier are cut off
first; what remains is routed to the shortest tier that holds it. Each tier is packed from
the longest down: the gap of a window is filled with pieces of shorter tiers, the last of
which is cut to fit. So every window ends full, but for one at the end of each partition.
Windows are dealt to step groups of equal size and equal token count.

Rows stay in the partition they are read in: nothing is shuffled, and a task holds one
buffer of pieces whatever the size of its partition. A task that is run again packs its
partition again as a whole.
"""

from __future__ import annotations

import functools
import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIERS = (128, 256, 512, 1024)
END_ID = 0
STEP_TOKENS = 16_384
BUFFER_PIECES = 4_096
CHUNK_CHARS = 1 << 20
CACHE_WORDS = 1_000_000
BATCH_BYTES = 4 << 20
VOCABULARY = "byte_bpe_50k.json"

# How byte-level BPE splits a text before merging, for characters up to U+00FF.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \u0085 "
SPLIT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
# Fixed rule: how byte-level BPE writes a byte as a character. Printable ones stand for
# themselves, the others for the characters from U+0100 on, in order.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {byte: 0x100 + i for i, byte in enumerate(b for b in range(0x100) if b not in PRINTABLE)}
CUT = re.compile(r"\S (?=\S)")


class Encoder:
    """Token ids of a text as little-endian 32-bit words, with a cache of split words.

    Merges never cross the words a text is split into, so the ids of a text are those of its
    words. Texts with characters beyond U+00FF, or with a special token's string, go to the
    tokenizer as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.normalized = self.tokenizer.model, self.tokenizer.normalizer is not None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Put the ids of new words in the cache, by the merges alone: a word is split already."""
        tokenize = self.model.tokenize
        for word in words:
            tokens = tokenize(word.encode().decode("latin-1").translate(BYTE_CHARS))
            self.cache[word] = b"".join([token.id.to_bytes(4, "little") for token in tokens])

    def _chunk(self, text: str) -> bytes:
        beyond = not text.isascii() and max(text) > "ÿ"
        if beyond or self.normalized or any(s in text for s in self.special):
            return self._whole(text)
        words, cache = SPLIT.findall(text), self.cache
        try:
            return b"".join([cache[word] for word in words])
        except KeyError:
            pass
        distinct = dict.fromkeys(words)
        if len(cache) + len(distinct) > CACHE_WORDS:
            cache.clear()
        self._learn([word for word in distinct if word not in cache])
        return b"".join([cache[word] for word in words])

    def encode(self, text: str) -> bytes:
        """Long texts go in chunks, cut before a lone space, where the split never looks back."""
        if len(text) <= CHUNK_CHARS or any(s in text for s in self.special):
            return self._chunk(text)
        parts, start = [], 0
        while len(text) - start > CHUNK_CHARS:
            cut = CUT.search(text, start + CHUNK_CHARS)
            if not cut:
                break
            parts.append(self._chunk(text[start : cut.start() + 1]))
            start = cut.start() + 1
        return b"".join([*parts, self._chunk(text[start:])])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker, so that the cache lasts from task to task."""
    return Encoder(path)


class Packer:
    """Packs the pieces of one partition. A piece: key, start, ids, tokens of its document."""

    def __init__(self, tiers=TIERS, step_tokens: int = STEP_TOKENS, first_id: int = 0):
        self.tiers, self.step_tokens = tuple(sorted(tiers)), step_tokens
        self.longest = self.tiers[-1]
        self.shelves = {tier: deque() for tier in self.tiers}
        self.waiting = 0
        self.next_sequence = self.next_step = first_id
        self.open_steps: dict[int, list[int]] = {}
        self.rows: list[tuple] = []
        self.bytes = 0

    def _route(self, piece: tuple) -> None:
        length = len(piece[2])
        self.shelves[next(tier for tier in self.tiers if tier >= length)].append(piece)
        self.waiting += 1

    def _take(self, tier: int) -> tuple:
        self.waiting -= 1
        return self.shelves[tier].popleft()

    def _emit(self, pieces: list[tuple], window: int) -> None:
        """One window. A step group holds windows of one tier, `step_tokens` in all."""
        step = self.open_steps.get(window)
        if step is None or step[1] + window > max(self.step_tokens, window):
            step = self.open_steps[window] = [self.next_step, 0]
            self.next_step += 1
        step[1] += window
        offset = 0
        for key, start, ids, tokens in pieces:
            self.rows.append(
                (key, start, len(ids), ids.tobytes(), tokens, self.next_sequence, offset, window, step[0])
            )
            offset += len(ids)
            self.bytes += 4 * len(ids) + 64
        self.next_sequence += 1

    def add(self, key, ids: np.ndarray) -> None:
        tokens, whole = len(ids), len(ids) // self.longest * self.longest
        for start in range(0, whole, self.longest):
            self._emit([(key, start, ids[start : start + self.longest], tokens)], self.longest)
        if whole < tokens:
            self._route((key, whole, ids[whole:], tokens))
        if self.waiting >= BUFFER_PIECES:
            self.pack()

    def _fill(self, gap: int, tier: int) -> tuple | None:
        """A piece of a shorter tier that fits the gap; else one, of this tier if need be, cut to it."""
        for shorter in reversed(self.tiers):
            if shorter <= gap and self.shelves[shorter]:
                return self._take(shorter)
        for other in self.tiers:
            if other <= tier and self.shelves[other]:
                key, start, ids, tokens = self._take(other)
                if len(ids) > gap:
                    self._route((key, start + gap, ids[gap:], tokens))
                return key, start, ids[:gap], tokens
        return None

    def pack(self) -> None:
        """All windows that can be filled; at most one window's worth of pieces stays."""
        for tier in reversed(self.tiers):
            while self.shelves[tier]:
                window, gap = [self._take(tier)], tier
                gap -= len(window[0][2])
                while gap and (piece := self._fill(gap, tier)):
                    window.append(piece)
                    gap -= len(piece[2])
                if gap:
                    for piece in window:
                        self._route(piece)
                    break
                self._emit(window, tier)
            if self.shelves[tier]:
                break

    def finish(self) -> None:
        """The rest of the partition: one short sequence, padded to the longest window."""
        self.pack()
        rest = [piece for shelf in self.shelves.values() for piece in shelf]
        while rest:
            window, gap = [], self.longest
            while rest and gap:
                key, start, ids, tokens = rest.pop()
                if len(ids) > gap:
                    rest.append((key, start + gap, ids[gap:], tokens))
                window.append((key, start, ids[:gap], tokens))
                gap -= len(window[-1][2])
            self._emit(window, self.longest)
        self.shelves = {tier: deque() for tier in self.tiers}
        self.waiting = 0


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    tiers=TIERS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset, window, step.

    `ids` are little-endian unsigned 32-bit words. A null text is empty and gives its end
    id alone; a null key stays null. Repeated rows are packed each by itself. An empty table
    gives no rows. Other columns play no part. `tokenizer` is a file all tasks can read.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    longs = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset", "window", "step"]
    schema = T.StructType(
        [rows.schema["doc_id"]]
        + [T.StructField(n, T.BinaryType() if n == "ids" else T.LongType()) for n in longs]
    )
    end = np.asarray([END_ID], dtype="<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        encode = encoder(tokenizer).encode
        packer = Packer(tiers, step_tokens, TaskContext.get().partitionId() << 33)

        def out(target):
            columns = list(zip(*packer.rows, strict=True))
            packer.rows, packer.bytes = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, target, strict=True)], schema=target
            )

        target = None
        for batch in batches:
            if target is None:
                kinds = [pa.binary() if n == "ids" else pa.int64() for n in longs]
                target = pa.schema([("doc_id", batch.schema.field(0).type), *zip(longs, kinds, strict=True)])
            for doc_id, value in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.frombuffer(encode(value.as_py() or "") + end, dtype="<u4")
                packer.add(doc_id.as_py(), ids)
                if packer.bytes > BATCH_BYTES:
                    yield out(target)
        packer.finish()
        if packer.rows:
            yield out(target)

    return rows.mapInArrow(run, schema)


def default_tokenizer(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def packed_rows(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Pieces with a digest in place of their ids."""
    pieces = pack(docs, tokenizer or default_tokenizer())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def query(spark, sf_dir: str) -> DataFrame:
    """op5: every document packed into sequences of at most 1024 tokens."""
    from skyledger.llm.common import table

    return packed_rows(table(spark, sf_dir, "documents"))
