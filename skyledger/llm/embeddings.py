"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, then exact cosine.

A table's code is the side of each of its hyperplanes a vector lies on; vectors of one code
meet in a bucket, and a pair is told by its exact cosine in double precision. Equal vectors
are one node with a weight, so copies are counted and never paired. A bucket is compared in
blocks of bounded size, as matrix products; a block gives sums of links and the root of each
vector's local group, not pairs. A pair that met in an earlier table counts only there.

The planes per table follow from the number of vectors, so that buckets stay small; the
tables follow from the chance that a pair at the threshold meets in one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.common import stored
from skyledger.llm.components import components

COSINE = 0.9
RECALL = 0.995
BUCKET_ROWS = 256
LEAST_BITS = 8
BLOCK_ROWS = 1_024
SEED = 20_240_101


def shape(vectors: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Planes per table and tables, so that a pair at the threshold meets with chance `recall`."""
    bits = max(LEAST_BITS, math.ceil(math.log2(max(vectors, 1) / BUCKET_ROWS)))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _codes(values: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Sign codes, one column per table. Planes depend on the seed and the dimension alone."""
    planes = np.random.default_rng([SEED, values.shape[1]]).standard_normal((values.shape[1], tables * bits))
    sides = (values @ planes > 0).reshape(len(values), tables, bits)
    return (sides << np.arange(bits)).sum(axis=2).astype("<i8")


def _unit(payloads: list[bytes], kind: str) -> np.ndarray:
    values = np.frombuffer(b"".join(payloads), dtype=kind).reshape(len(payloads), -1).astype(np.float64)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _payloads(rows: DataFrame, kind: str) -> DataFrame:
    """row, id, vector -> row, id, payload: the bytes of the components, null for unusable vectors."""
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("payload", T.BinaryType())])

    names = schema.names

    def run(batches):
        for batch in batches:
            payload = []
            for value in batch.column(2):
                numbers = value.values if value.is_valid else None
                usable = numbers is not None and len(numbers) and not numbers.null_count
                array = numbers.to_numpy(zero_copy_only=False).astype(kind) if usable else None
                usable = usable and np.isfinite(array).all() and array.any()
                payload.append((array + 0).tobytes() if usable else None)
            columns = [batch.column(0), batch.column(1), pa.array(payload, type=pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)


def _coded(classes: DataFrame, kind: str, bits: int, tables: int) -> DataFrame:
    """node, weight, payload -> with codes."""
    schema = T.StructType([*classes.schema.fields, T.StructField("codes", T.ArrayType(T.LongType()))])

    names = schema.names

    def run(batches):
        for batch in batches:
            payloads = batch.column(2).to_pylist()
            codes = [None] * len(payloads)
            lengths = np.array([len(p) for p in payloads], dtype=np.int64)
            for length in np.unique(lengths):
                chosen = np.nonzero(lengths == length)[0]
                found = _codes(_unit([payloads[i] for i in chosen], kind), bits, tables)
                for i, row in zip(chosen, found, strict=True):
                    codes[i] = row
            columns = [*batch.columns, pa.array(codes, type=pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return classes.mapInArrow(run, schema)


def _local_roots(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of `size` places the smallest place it is tied to."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[left], label[right])
        after = label.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def _compare(kind: str, cosine: float):
    fields = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(key, block):
        table, first, second = key[0].as_py(), key[3].as_py(), key[4].as_py()
        block = block.sort_by("node")
        node = block.column("node").to_numpy()
        weight = block.column("weight").to_numpy()
        part = block.column("part").to_numpy()
        values = _unit(block.column("payload").to_pylist(), kind)
        codes = np.frombuffer(b"".join(np.asarray(c, "<i8").tobytes() for c in block.column("codes").to_pylist()), "<i8")
        codes = codes.reshape(len(node), -1)[:, :table]
        if first == second:
            left, right = np.nonzero(np.triu(values @ values.T >= cosine, 1))
        else:
            a, b = np.nonzero(part == first)[0], np.nonzero(part == second)[0]
            i, j = np.nonzero(values[a] @ values[b].T >= cosine)
            left, right = a[i], b[j]
        links = np.zeros(len(node), dtype=np.int64)
        for start in range(0, len(left), 65_536):
            i, j = left[start : start + 65_536], right[start : start + 65_536]
            fresh = ~(codes[i] == codes[j]).any(axis=1)
            np.add.at(links, i[fresh], weight[j[fresh]])
            np.add.at(links, j[fresh], weight[i[fresh]])
        roots = node[_local_roots(len(node), left, right)]
        told = (links > 0) | (roots != node)
        return pa.Table.from_arrays([pa.array(x[told]) for x in (node, links, roots)], schema=fields)

    return run


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, recall: float = RECALL
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, and so do vectors of different lengths. Equal vectors link with each other.
    Rows with one key are vectors of their own; a null key is never a component's id unless
    it is alone there, and then the id is null. An empty table gives no rows. Other columns
    play no part.
    """
    inner = vectors.schema[vector].dataType.elementType
    kind = "<f4" if isinstance(inner, T.FloatType) else "<f8"
    picked = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("vec_id"), F.col(vector).alias("vector")
    )
    rows = stored(_payloads(picked, kind), "vectors")
    classes = (
        rows.where("payload IS NOT NULL")
        .groupBy("payload")
        .agg(F.min("row").alias("node"), F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    )
    classes = stored(classes, "vector-classes")
    bits, tables = shape(classes.count(), cosine, recall)
    coded = stored(_coded(classes.select("node", "weight", "payload"), kind, bits, tables), "vector-codes")

    spots = coded.select(
        "node", F.length("payload").alias("size"), F.posexplode("codes").alias("table", "bucket")
    )
    blocks = (
        spots.groupBy("table", "bucket", "size")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("table", "bucket", "size", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    )
    part = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    meeting = (
        spots.join(blocks, ["table", "bucket", "size"])
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("first", F.least("part", "other"))
        .withColumn("second", F.greatest("part", "other"))
        .select("node", "table", "bucket", "size", "first", "second", "part")
    )
    found = stored(
        meeting.join(coded, "node")
        .groupBy("table", "bucket", "size", "first", "second")
        .applyInArrow(_compare(kind, cosine), "node long, links long, root long"),
        "vector-links",
    )
    groups = components(found.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        classes.join(groups, "node", "left")
        .join(links, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    per_class = named.join(least, "component").select(
        "payload", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    component_id = F.when(F.col("payload").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (
        rows.join(per_class, "payload", "left")
        .withColumn("component_id", component_id)
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            "component_id",
            F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op6: links and components of all vectors at a cosine of 0.9."""
    from skyledger.llm.common import table

    return near_duplicates(table(spark, sf_dir, "embeddings"))
