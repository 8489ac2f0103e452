"""A quality classifier: regularised quadratic discriminant over document statistics.

Each document gives a short vector of transformed statistics. Per class the mean and the
covariance come from sums over all labelled rows, added up by Spark; covariances are shrunk
towards a multiple of the unit matrix. A score is the logistic of the difference of the two
log densities, from Mahalanobis distances through Cholesky factors that are computed once
and sent with the model, some hundred numbers at any table size.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.common import stored

SHRINKAGE = 0.05
# Divides the difference of log densities: statistics depend on each other and have longer
# tails than a normal density, most of all in texts of a few words. Chosen on the learning folds.
TEMPERATURE = 28.0
THRESHOLD = 0.3
FOLDS = 5
FEATURES = (
    "chars", "upper", "digits", "symbols", "stops", "spaces", "word_length", "word_spread", "repeats", "distinct",
    "top_word", "line_length", "line_repeats", "other_letters",
)
# Kinds of characters: letter below U+0080, upper case, digit, space, sentence mark, symbol, other letter.
SENTENCE_MARKS = ".,;:!?'\"()-"
_KINDS = 7
_SLICE = 1 << 20
_LINE = re.compile(r"\n+")


def _kinds() -> np.ndarray:
    table = np.full(256, 5, dtype=np.uint8)
    for code in range(256):
        c = chr(code)
        if c.isalpha():
            table[code] = 1 if c.isupper() else 0 if code < 128 else 6
        elif c.isdigit():
            table[code] = 2
        elif c.isspace():
            table[code] = 3
        elif c in SENTENCE_MARKS:
            table[code] = 4
    return table


KIND_OF = _kinds()


def _kind_counts(text: str) -> np.ndarray:
    """Characters of each kind; those beyond U+00FF count as letters of another alphabet."""
    counts = np.zeros(_KINDS, dtype=np.int64)
    for start in range(0, len(text), _SLICE):
        codes = np.frombuffer(text[start : start + _SLICE].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kinds = np.where(codes < 256, KIND_OF[np.minimum(codes, 255)], 6)
        counts += np.bincount(kinds, minlength=_KINDS)
    return counts


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text; a null text is an empty one.

    Shares go through log(share + 0.01), counts through log(1 + n). A text without words has
    shares of 0 and lengths of 0.
    """
    text = text or ""
    _, upper, digits, spaces, marks, symbols, other = kinds = _kind_counts(text).tolist()
    letters = kinds[0] + upper + other
    words = text.split()
    lines = [line for line in _LINE.split(text) if line]
    share = lambda part, whole: float(np.log(part / max(whole, 1) + 0.01))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1)
    counts = Counter(words)
    return [
        float(np.log1p(len(text))),
        share(upper, letters),
        share(digits, len(text)),
        share(symbols, len(text)),
        share(marks, len(text)),
        share(spaces, len(text)),
        float(np.log1p(lengths.mean())),
        float(np.log1p(lengths.std())),
        share(sum(a == b for a, b in zip(words, words[1:], strict=False)), len(words)),
        float(np.log1p(len(counts)) - 0.8 * np.log1p(len(words))),
        share(max(counts.values(), default=0), len(words) + 5),
        float(np.log1p(len(text) / max(len(lines), 1))),
        share(len(lines) - len(set(lines)), len(lines)),
        share(other, letters),
    ]


def with_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, statistics: one narrow row per document."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("statistics", T.ArrayType(T.DoubleType()))])
    names = schema.names

    def run(batches):
        for batch in batches:
            found = [statistics(value.as_py()) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, type=pa.list_(pa.float64()))], names=names)

    return rows.mapInArrow(run, schema)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log constants of the two classes, on scaled statistics."""

    shift: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def margins(self, values: np.ndarray) -> np.ndarray:
        """log density of class 1 with its prior, less that of class 0."""
        scaled = (values - self.shift) / self.scale
        logs = [
            self.constants[c] - 0.5 * (((scaled - self.means[c]) @ self.factors[c].T) ** 2).sum(axis=1) for c in (0, 1)
        ]
        return logs[1] - logs[0]

    def scores(self, values: np.ndarray, temperature: float = TEMPERATURE) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(values) / temperature, -500, 500)))


def fit(labelled: DataFrame, label: str, shrinkage: float = SHRINKAGE) -> Discriminant | None:
    """A model from rows of statistics and a label, 0 or 1; None without rows of both.

    Sums per class, not rows, reach the driver. Rows with another label or null play no part.
    """
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    x = [F.element_at("statistics", i + 1) for i in range(d)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in pairs]
    rows = {
        row["label"]: row
        for row in labelled.select(F.col(label).cast("int").alias("label"), "statistics")
        .where(F.col("label").isin(0, 1))
        .groupBy("label")
        .agg(F.count("*").alias("n"), *sums, *products)
        .collect()
    }
    if set(rows) != {0, 1}:
        return None
    n = np.array([rows[c]["n"] for c in (0, 1)], dtype=float)
    total = np.array([[rows[c][f"s{i}"] for i in range(d)] for c in (0, 1)])
    square = np.zeros((2, d, d))
    for c in (0, 1):
        for i, j in pairs:
            square[c, i, j] = square[c, j, i] = rows[c][f"p{i}_{j}"]
    shift = total.sum(axis=0) / n.sum()
    spread = np.sqrt(np.maximum(square.sum(axis=0).diagonal() / n.sum() - shift**2, 1e-12))
    means = (total / n[:, None] - shift) / spread
    factors, constants = [], []
    for c in (0, 1):
        raw = square[c] / n[c] - np.outer(total[c], total[c]) / n[c] ** 2
        raw = raw / np.outer(spread, spread)
        shrunk = (1 - shrinkage) * raw + shrinkage * max(raw.trace() / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(factor))
        constants.append(np.log(n[c] / n.sum()) - np.log(factor.diagonal()).sum())
    return Discriminant(shift, spread, means, np.array(factors), np.array(constants))


def _score(model: Discriminant | None, values: np.ndarray) -> np.ndarray:
    return np.full(len(values), 0.5) if model is None else model.scores(values)


def held_out(key: Column, folds: int = FOLDS) -> Column:
    """The documents never learned from; a null key is learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == 0, F.lit(False))


def learn(statistics_rows: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Discriminant | None:
    """A model from the labels of documents that are not held out."""
    known = labels.select(F.col(key).alias("doc_id"), F.col(label).alias("label"))
    return fit(statistics_rows.where(~held_out(F.col("doc_id"))).join(known, "doc_id"), "label")


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`.

    A null text is empty. Repeated rows each have a row, and each counts with its labels when
    learning; labels without a document, and null labels, play no part. Without labels of
    both classes every score is 0.5. An empty table gives no rows. Other columns play no part.
    """
    rows = stored(with_statistics(docs, key, text), "statistics")
    model = learn(rows, labels)
    schema = T.StructType(
        [rows.schema["doc_id"], T.StructField("score", T.DoubleType())]
    )
    names = schema.names

    def run(batches):
        for batch in batches:
            values = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_score(model, values))], names=names)

    return rows.mapInArrow(run, schema).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents the classifier does not reject; same columns, in place, without a shuffle of texts."""
    model = learn(stored(with_statistics(docs, key, text), "statistics"), labels)

    def score(texts):
        return pd.Series(_score(model, np.array([statistics(t) for t in texts]).reshape(len(texts), -1)))

    return docs.where(F.pandas_udf(score, T.DoubleType())(F.col(text)) >= THRESHOLD)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: a score for every document."""
    from skyledger.llm.common import table

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
