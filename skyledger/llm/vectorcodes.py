"""Vector code compression: product codes whose entries move, with exact assignments by bounds.

A vector of whole numbers is cut into parts, and each part is coded by the nearest entry of
its position's codebook. In each round all parts are assigned and every entry moves to the
mean of its parts. Beside its code a part keeps a lower bound on the distance to every other
entry, and the stamp of the round it was measured in. The codebooks of all rounds are kept, so
a bound is lowered by the norm of the entries' net move since its stamp (the norm of the sum
of their moves), not by the sum of the norms, which only grows. While the bound stays above
the exact distance to the part's own entry, that entry is still the nearest; else the part is
measured against all entries again and stamped anew. Distances are exact in whole numbers.

Vectors never move between tasks. A task emits its new states and, as one last row, the sums
of its parts by entry, whose size depends on the codebooks alone. Each round is a stored table.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Components are below this, so that squared distances over 4096 of them fit a long.
LIMIT = 1 << 24
# What rounding may add to a distance, many times over.
SLACK = 1e-9

STATE = "codes binary, lower binary, stamps binary, sums array<long>"


@dataclass
class Compressed:
    """Coded rows (row columns, codes, error), the codebooks of all rounds, and how many parts
    each assignment measured against all entries."""

    rows: DataFrame
    history: list[np.ndarray]
    measured: list[int]


# ---------------------------------------------------------------- whole numbers


def whole(rows: DataFrame, vector: str, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """`rows` without unusable vectors, and `whole`: the components as floor(scale * x).

    A vector that is null or holds a null or a component that is not finite is left out. One
    shorter than the longest, or not a multiple of `parts` long, is filled up with zeros. A
    component of LIMIT or more, scaled, is an error, as its distances would not fit a long.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = rows.where(F.col(vector).isNotNull() & ~F.exists(vector, bad))
    width = usable.agg(F.max(F.size(vector))).first()[0] or 0
    width = -(-width // parts) * parts
    scaled = lambda x: F.floor(x.cast("double") * scale)
    fits = lambda x: F.when(F.abs(scaled(x)) < LIMIT, scaled(x).cast("int")).otherwise(
        F.raise_error(F.lit(f"a component, scaled, reaches {LIMIT}"))
    )
    filled = F.concat(F.transform(vector, fits), F.array_repeat(F.lit(0), F.lit(width) - F.size(vector)))
    return usable.withColumn("whole", filled)


# ---------------------------------------------------------------- assignment


def squares(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of each part to each entry."""
    return ((parts[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)


def net_moves(now: np.ndarray, then: np.ndarray) -> np.ndarray:
    """For each entry how far the farthest-moved of the *others* is from where it was then."""
    moves = np.sqrt(((now - then) ** 2).sum(axis=1).astype(np.float64)) * (1 + SLACK)
    if len(moves) < 2:
        return np.zeros(len(moves))
    order = np.argsort(moves)
    farthest = np.full(len(moves), moves[order[-1]])
    farthest[order[-1]] = moves[order[-2]]
    return farthest


class Assigner:
    """Codes, bounds and stamps of blocks of vectors under the newest of some codebooks.

    A codebook is an array (position, entry, component).
    """

    def __init__(self, history: list[np.ndarray]):
        self.history, self.now = history, len(history) - 1
        # How much a bound of each stamp is lowered, by position, stamp and own entry.
        self.lowered = np.array([[net_moves(history[-1][m], h[m]) for h in history] for m in range(len(history[0]))])

    def fresh(self, vectors: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The states of vectors that were never assigned: bounds that hold nothing."""
        shape = (vectors, len(self.history[0]))
        return np.zeros(shape, np.uint8), np.full(shape, -np.inf, np.float32), np.full(shape, self.now, np.uint8)

    def assign(self, vectors: np.ndarray, codes, lower, stamps) -> tuple[np.ndarray, int]:
        """Bring codes, bounds and stamps up to date in place; gives the exact squared
        distances by part, and how many parts were measured against all entries."""
        positions, entries, width = self.history[0].shape
        parts = vectors.reshape(len(vectors), positions, width)
        exact, measured = np.zeros(codes.shape, np.int64), 0
        for m in range(positions):
            book, own = self.history[-1][m], codes[:, m]
            exact[:, m] = ((parts[:, m] - book[own]) ** 2).sum(axis=1)
            bound = lower[:, m] - self.lowered[m][stamps[:, m], own]
            again = np.flatnonzero(~(bound > np.sqrt(exact[:, m].astype(np.float64)) * (1 + SLACK) + SLACK))
            measured += len(again)
            if len(again):
                distances = squares(parts[again, m], book)
                nearest = distances.argmin(axis=1)
                rows = np.arange(len(again))
                exact[again, m] = distances[rows, nearest]
                others = np.sqrt(distances.astype(np.float64))
                others[rows, nearest] = np.inf
                codes[again, m], stamps[again, m] = nearest, self.now
                # Rounded down on its way to fewer digits.
                lower[again, m] = np.nextafter(others.min(axis=1).astype(np.float32), np.float32(-np.inf))
        return exact, measured


def moved(book: np.ndarray, sums: list[int], counts: list[int]) -> np.ndarray:
    """The codebook with every used entry at the floor of its parts' mean."""
    positions, entries, width = book.shape
    after = book.copy()
    for m in range(positions):
        for j in range(entries):
            count = counts[m * entries + j]
            if count:
                at = (m * entries + j) * width
                after[m, j] = [total // count for total in sums[at : at + width]]
    return after


# ---------------------------------------------------------------- passes over the vectors


def _vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("whole").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width).astype(np.int64)


def _held(batch: pa.RecordBatch, column: str, kind, shape) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(column).to_pylist()), dtype=kind).reshape(shape).copy()


def _binary(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in values], type=pa.binary())


def _states(assigner: Assigner, batch: pa.RecordBatch) -> tuple:
    """The vectors of a batch and their held states, fresh ones before the first round."""
    positions, _, width = assigner.history[0].shape
    vectors = _vectors(batch, positions * width)
    if "codes" not in batch.schema.names:
        return vectors, *assigner.fresh(len(vectors))
    shape = (len(vectors), positions)
    kinds = {"codes": np.uint8, "lower": np.float32, "stamps": np.uint8}
    return vectors, *[_held(batch, column, kind, shape) for column, kind in kinds.items()]


def _round(batches, history, kept):
    """New states of all vectors, then one row with the sums and counts by entry, and how many
    parts were measured."""
    assigner, fields = Assigner(history), None
    positions, entries, width = history[0].shape
    sums, counts, measured = np.zeros((positions, entries, width), np.int64), np.zeros((positions, entries), np.int64), 0
    state = [pa.field(n, pa.binary()) for n in ("codes", "lower", "stamps")] + [pa.field("sums", pa.list_(pa.int64()))]
    for batch in batches:
        fields = [batch.schema.field(n) for n in kept]
        if not batch.num_rows:
            continue
        vectors, codes, lower, stamps = _states(assigner, batch)
        measured += assigner.assign(vectors, codes, lower, stamps)[1]
        parts = vectors.reshape(len(vectors), positions, width)
        for m in range(positions):
            np.add.at(sums[m], codes[:, m], parts[:, m])
            counts[m] += np.bincount(codes[:, m], minlength=entries)
        arrays = [batch.column(n) for n in kept] + [_binary(v) for v in (codes, lower, stamps)]
        arrays.append(pa.nulls(len(vectors), state[-1].type))
        yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields + state))
    if fields is not None:
        totals = [*sums.ravel().tolist(), *counts.ravel().tolist(), measured]
        arrays = [pa.nulls(1, f.type) for f in fields + state[:-1]] + [pa.array([totals], type=state[-1].type)]
        yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields + state))


def _last(batches, history, kept):
    """Codes and exact errors under the final codebooks."""
    assigner = Assigner(history)
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors, codes, lower, stamps = _states(assigner, batch)
        exact, measured = assigner.assign(vectors, codes, lower, stamps)
        again = np.zeros(len(vectors), np.int64)
        again[0] = measured
        extra = [pa.array([row.tobytes().hex() for row in codes]), pa.array(exact.sum(axis=1)), pa.array(again)]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + extra, names=[*kept, "code", "error", "measured"])


def first_codebook(rows: DataFrame, key: str, parts: int, entries: int) -> np.ndarray:
    """The parts of the vectors of the least keys, null ones last, ties by their components."""
    found = rows.orderBy(F.col(key).asc_nulls_last(), "whole").limit(entries).select("whole").collect()
    width = len(found[0]["whole"]) // parts if found else 0
    vectors = np.array([r["whole"] for r in found], dtype=np.int64).reshape(len(found), parts, width)
    return vectors.transpose(1, 0, 2).copy()


def compress(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    keep: tuple[str, ...] = (),
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Compressed:
    """The key, the columns to `keep`, `code` (two hex digits a part) and `error` of every usable
    row. Rows alike are coded each; other columns play no part; no usable row gives no rows."""
    if not 1 <= entries <= 256 or rounds < 0 or rounds > 255 or parts < 1:
        raise ValueError("1 to 256 entries, at most 255 rounds, one part or more")
    names = ["_key", *[f"_keep{i}" for i in range(len(keep))], "whole"]
    source = rows.select(
        F.col(f"`{key}`").alias("_key"),
        *[F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)],
        F.col(f"`{vector}`").alias("_vector"),
    )
    states = whole(source, "_vector", parts).drop("_vector")
    history = [first_codebook(states, "_key", parts, entries)]
    measured = []
    if history[0].shape[1]:
        for _ in range(rounds):
            run = functools.partial(_round, history=list(history), kept=names)
            shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in states.schema if f.name in names)
            told = stored(states.mapInArrow(run, f"{shape}, {STATE}"), "vector-codes")
            totals = told.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "total"))
            summed = totals.groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
            summed = [int(r["total"]) for r in sorted(summed, key=lambda r: r["at"])]
            components = history[-1].size
            history.append(moved(history[-1], summed[:components], summed[components:-1]))
            measured.append(summed[-1])
            states = told.where("sums IS NULL").drop("sums")
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in states.schema if f.name in names[:-1])
    run = functools.partial(_last, history=list(history), kept=names[:-1])
    coded = stored(states.mapInArrow(run, f"{shape}, code string, error long, measured long"), "vector-codes")
    measured.append(coded.agg(F.sum("measured")).first()[0] or 0)
    back = [F.col("_key").alias(key), *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], "code", "error"]
    return Compressed(coded.select(*back), history, measured)


def codebook_digest(book: np.ndarray) -> str:
    """SHA-256 of the components by position, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def query(spark, sf_dir: str) -> DataFrame:
    """op13: every usable vector's code and error, and its label's errors summed."""
    from skyledger.llm.common import table

    found = compress(table(spark, sf_dir, "embeddings"), keep=("label",))
    sums = found.rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return found.rows.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebook_digest(found.history[-1])).alias("codebooks_sha256")
    )


# ---------------------------------------------------------------- SQL twin


def _assigned_sql(round_: int) -> str:
    """The nearest entry of each part, and its squared distance."""
    return f"""a{round_} AS MATERIALIZED (
  SELECT r, m, min({{'d': list_sum([(x[i] - c[i]) * (x[i] - c[i]) FOR i IN range(1, len(x) + 1)])::BIGINT, 'j': j}}) AS best
  FROM p JOIN c{round_} USING (m) GROUP BY r, m
)"""


def _moved_sql(round_: int) -> str:
    return f"""s{round_} AS (
  SELECT m, best.j AS j, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS mean
  FROM (SELECT m, best, x, unnest(range(1, len(x) + 1)) AS i FROM a{round_} JOIN p USING (r, m)) GROUP BY ALL
), c{round_ + 1} AS MATERIALIZED (
  SELECT m, j, coalesce(n.c, c{round_}.c) AS c FROM c{round_}
  LEFT JOIN (SELECT m, j, list(mean ORDER BY i) AS c FROM s{round_} GROUP BY m, j) AS n USING (m, j)
)"""


SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), p AS MATERIALIZED (
  SELECT r, m, w[m * (len(w) // {PARTS}) + 1 : (m + 1) * (len(w) // {PARTS})] AS x
  FROM (SELECT r, w, unnest(range({PARTS})) AS m FROM v)
), c0 AS MATERIALIZED (
  SELECT m, n - 1 AS j, x AS c FROM p JOIN (SELECT r, row_number() OVER (ORDER BY vec_id, w) AS n FROM v) USING (r) WHERE n <= {ENTRIES}
), {", ".join(f"{_assigned_sql(i)}, {_moved_sql(i)}" for i in range(ROUNDS))}, {_assigned_sql(ROUNDS)}, e AS (
  SELECT r, string_agg(printf('%02x', best.j), '' ORDER BY m) AS code, sum(best.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY r
), h AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY m, j)) AS codebooks_sha256 FROM c{ROUNDS}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM e JOIN v USING (r) CROSS JOIN h
"""
