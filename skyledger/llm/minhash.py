"""Near-duplicate documents: order MinHash candidates, verified by banded alignment.

A sketch samples, under each of several hash functions, the smallest few of a text's
occurrence-labelled five-word shingles and keeps them in text order. Texts of one sample meet
in a bucket; sampling several in order makes a chance meeting over one shared passage rare.

Equal texts are one node from the start. In a bucket the texts are first aligned with the one
text that shares most codes with others. Buckets that then hold several components are cut
into blocks of bounded length, and every two blocks make a bounded task. It aligns the pairs of
different components that share one of their rarest shingles, as every link must. So of any two
texts of a bucket, whatever its size, each pair is ruled out, aligned or in one component
already. Links become classes by distributed connected components. What can be missed: a link
of two texts that share no bucket.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.alignment import SHINGLE_WORDS, mix, shingles, similarity
from skyledger.llm.common import stored
from skyledger.llm.components import components

SIMILARITY = 0.8
SKETCHES = 16
SAMPLE = 4
SEED = 0x5EED
CHUNK = 1 << 16
# Nodes and shingles of a block of a bucket, on average. A cell is two blocks.
BLOCK = 1_024
BLOCK_SHINGLES = 400_000
# Rows of cells handed back from Python at once, and their columns.
CELL_ROWS = 10_000
CELL = pa.schema(
    [
        ("code", pa.int64()),
        ("low", pa.int32()),
        ("high", pa.int32()),
        ("side", pa.int32()),
        ("node", pa.int64()),
        ("component", pa.int64()),
        ("codes", pa.list_(pa.int64())),
    ]
)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _labels(values: np.ndarray) -> np.ndarray:
    """Each shingle hash mixed with how often it came before, so that repeats differ."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    start = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    place = np.arange(len(values))
    times = np.empty(len(values), dtype=np.uint64)
    times[order] = place - np.maximum.accumulate(np.where(start, place, 0))
    return mix(values + times * _STEP)


def sketch(values: np.ndarray, sketches: int = SKETCHES, sample: int = SAMPLE) -> np.ndarray:
    """One code per hash function: its `sample` smallest labelled shingles in text order.

    Long texts go in chunks, which keep the smallest so far. A text of fewer shingles than
    the sample gives them all.
    """
    labels = _labels(values)
    seeds = mix(np.arange(1, sketches + 1, dtype=np.uint64) * _STEP + np.uint64(SEED))
    low = np.empty((sketches, 0), dtype=np.uint64)
    where = np.empty((sketches, 0), dtype=np.int64)
    for start in range(0, len(labels), CHUNK):
        part = mix(labels[None, start : start + CHUNK] ^ seeds[:, None])
        places = np.broadcast_to(np.arange(start, start + part.shape[1]), part.shape)
        low, where = np.concatenate([low, part], axis=1), np.concatenate([where, places], axis=1)
        if low.shape[1] > sample:
            best = np.argpartition(low, sample - 1, axis=1)[:, :sample]
            low, where = np.take_along_axis(low, best, 1), np.take_along_axis(where, best, 1)
    chosen = labels[np.sort(where, axis=1)]
    code = seeds
    for i in range(chosen.shape[1]):
        code = mix(code * _STEP + chosen[:, i])
    return code.view(np.int64)


def _key(text):
    return F.md5(F.coalesce(text, F.lit("")))


def _id(column: str):
    """An id as a join key in which null meets null."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias("id")


def sketched(docs: DataFrame, key: str, text: str, sketches: int, sample: int) -> DataFrame:
    """row, doc_id, key, codes, size: a narrow row per document, `size` in shingles. Texts
    without words have no codes."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("doc_id"),
        _key(F.col(text)).alias("key"),
        F.col(text).alias("text"),
    )
    schema = T.StructType([*rows.schema.fields[:3], T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("size", T.LongType())])
    names = schema.names

    def run(batches):
        for batch in batches:
            codes, sizes = [], []
            for value in batch.column(3):
                values = shingles(value.as_py())
                codes.append(sketch(values, sketches, sample) if len(values) else [])
                sizes.append(len(values))
            told = [pa.array(codes, type=pa.list_(pa.int64())), pa.array(sizes, type=pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *told], names=names)

    return rows.mapInArrow(run, schema)


def _aligned(pairs: DataFrame, least: float) -> DataFrame:
    """a, b, text_a, text_b -> the pairs of that similarity or more."""

    def run(batches):
        for batch in batches:
            seen: dict = {}
            told = []
            for a, one, other in zip(batch.column(0), batch.column(2), batch.column(3), strict=True):
                leader = a.as_py()
                if leader not in seen:
                    seen = {leader: shingles(one.as_py())}
                told.append(similarity(seen[leader], shingles(other.as_py()), least) >= least)
            mask = pa.array(told, type=pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs of nodes that are alike. Aligning costs more than its bytes tell, so pairs are
    dealt out by number."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    needed = texts.join(wanted, "node")
    both = (
        pairs.join(needed.withColumnRenamed("node", "b").withColumnRenamed("text", "text_b"), "b")
        .join(needed.withColumnRenamed("node", "a").withColumnRenamed("text", "text_a"), "a")
        .select("a", "b", "text_a", "text_b")
    )
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _aligned(both.repartition(parts, "a", "b"), least)


def _named(rows: DataFrame, tied: DataFrame | None, node: str, name: str) -> DataFrame:
    """With the component of a node, itself where nothing is tied to it."""
    if tied is None:
        return rows.withColumn(name, F.col(node))
    of = tied.select(F.col("node").alias(node), F.col("component").alias(name))
    return rows.join(of, node, "left").withColumn(name, F.coalesce(name, node))


def _leaders(spots: DataFrame) -> DataFrame:
    """code, a: the node of a bucket that shares most codes with others.

    Such a text lies in the middle of its group: among copies that were each changed in their
    own places, it is the one least changed.
    """
    sizes = spots.groupBy("code").agg(F.count("*").alias("n"))
    fame = spots.join(sizes, "code").groupBy("node").agg(F.sum("n").alias("fame"))
    first = F.min_by("node", F.struct(-F.col("fame"), F.col("node")))
    return spots.join(fame, "node").groupBy("code").agg(first.alias("a"))


def _led(spots: DataFrame, texts: DataFrame, least: float) -> DataFrame | None:
    """node, component of the nodes that the leaders of their buckets tie, or None.

    Most copies are tied here, by one alignment each, which leaves few cells to walk.
    """
    met = spots.join(_leaders(spots), "code").where("a <> node")
    pairs = stored(met.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct(), "near-pairs")
    found = stored(_verified(pairs, texts, least), "near-links")
    if found.isEmpty():
        return None
    return stored(components(found.select(F.col("a").alias("u"), F.col("b").alias("v"))), "near-tied")


def _shared(spots: DataFrame) -> DataFrame:
    """Spots of codes that more than one node has."""
    shared = spots.groupBy("code").agg(F.count("*").alias("n")).where("n > 1").select("code")
    return spots.join(shared, "code", "left_semi")


def _cells(spots: DataFrame, tied: DataFrame | None) -> DataFrame:
    """code, low, high, side, node, component, codes: the buckets that hold several components,
    as cells of two blocks each, so that any two nodes of a bucket meet in one cell of it.

    `side` is the node's block. `codes` are all such buckets of a node, ascending.
    """
    named = _named(spots, tied, "node", "component")
    several = (
        named.groupBy("code")
        .agg(
            F.count("*").alias("n"),
            F.sum("size").alias("length"),
            F.min("component").alias("first"),
            F.max("component").alias("last"),
        )
        .where("first < last")
        .select("code", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("length") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    )
    parts = named.join(several, "code")
    codes = parts.groupBy("node").agg(F.sort_array(F.collect_list("code")).alias("codes"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return (
        parts.join(codes, "node")
        .withColumn("side", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("code", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "node", "component", "codes")
    )


def _dealt(cells: DataFrame) -> DataFrame:
    """Rows of a cell one after the other."""
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells.repartition(parts, "code", "low", "high").sortWithinPartitions("code", "low", "high", "node")


def _by_cell(batches):
    """The rows of each cell, as lists, from batches sorted by cell."""
    held, last = [], None
    for batch in batches:
        for row in batch.to_pylist():
            cell = (row["code"], row["low"], row["high"])
            if cell != last and held:
                yield held
                held = []
            last = cell
            held.append(row)
    if held:
        yield held


def _own(rows: list[dict]):
    """Whether a cell has to answer for a pair of its places: of different blocks, if it has
    two, of different components, and of no common bucket with a lower code."""
    code, across = rows[0]["code"], rows[0]["low"] < rows[0]["high"]
    lower = [frozenset(c for c in row["codes"] if c < code) for row in rows]
    parts = [(row["component"], row["side"] if across else None) for row in rows]

    def own(i: int, j: int) -> bool:
        apart = parts[i][0] != parts[j][0] and (not across or parts[i][1] != parts[j][1])
        return apart and lower[i].isdisjoint(lower[j])

    return own


def _needed(cells: DataFrame) -> DataFrame:
    """The rows of cells that are in a pair of their cell."""
    names = cells.columns

    def run(batches):
        told: list[dict] = []
        for rows in _by_cell(batches):
            own, kept = _own(rows), set()
            for i in range(len(rows)):
                if i not in kept:
                    met = next((j for j in range(len(rows)) if j != i and own(i, j)), None)
                    kept |= {i, met} if met is not None else set()
            told += [rows[i] for i in sorted(kept)]
            if len(told) >= CELL_ROWS:
                yield pa.RecordBatch.from_pylist(told, schema=CELL)
                told = []
        if told:
            yield pa.RecordBatch.from_pylist(told, schema=CELL)

    return _dealt(cells).mapInArrow(run, cells.schema).select(*names)


def rare_groups(values: list[np.ndarray], least: float):
    """Groups of places of texts that share one of their rarest shingles.

    Two texts of n and m shingles that link have at least `least` times n in common. So if all
    order their shingles alike, rarest first, they share one of the first n - ceil(least n) + 1.
    Every pair that links is in a group.
    """
    labelled = [_labels(v) if len(v) else v for v in values]
    every, place = np.unique(np.concatenate(labelled), return_inverse=True)
    often = np.bincount(place, minlength=len(every))
    owners, firsts, start = [], [], 0
    for i, labels in enumerate(labelled):
        own = place[start : start + len(labels)]
        start += len(labels)
        count = len(own) - math.ceil(least * len(own) - 1e-9) + 1
        firsts.append(own[np.lexsort((own, often[own]))[:count]])
        owners.append(np.full(len(firsts[-1]), i))
    owners, firsts = np.concatenate(owners), np.concatenate(firsts)
    order = np.argsort(firsts, kind="stable")
    cuts = np.flatnonzero(np.diff(firsts[order])) + 1
    return [group for group in np.split(owners[order], cuts) if len(group) > 1]


def _linked(cells: DataFrame, least: float) -> DataFrame:
    """Rows of cells with their texts -> a, b: links that join all components that links join.

    A pair that links of its cell have joined already is not aligned.
    """

    def run(batches):
        for rows in _by_cell(batches):
            values = [shingles(row["text"]) for row in rows]
            above = {row["component"]: row["component"] for row in rows}

            def root(c, above=above):
                while above[c] != c:
                    above[c] = c = above[above[c]]
                return c

            own, tried, found = _own(rows), set(), []
            for group in rare_groups(values, least):
                roots = [root(rows[i]["component"]) for i in group]
                if len(set(roots)) == 1:
                    continue
                for x, i in enumerate(group):
                    for j in group[x + 1 :]:
                        one, other = root(rows[i]["component"]), root(rows[j]["component"])
                        if one == other or (i, j) in tried:
                            continue
                        tried.add((i, j))
                        if own(i, j) and similarity(values[i], values[j], least) >= least:
                            above[one] = other
                            found.append((rows[i]["node"], rows[j]["node"]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*found, strict=True)], names=["u", "v"])

    return _dealt(cells).mapInArrow(run, "u long, v long")


def _united(spots: DataFrame, texts: DataFrame, tied: DataFrame | None, least: float) -> DataFrame | None:
    """`tied` with every link between two components that a bucket holds.

    Afterwards any two nodes of a bucket are of one component or have been aligned. A pair is
    aligned in one cell however many buckets it meets in, and no table has a row per pair.
    """
    needed = stored(_needed(_cells(spots, tied)), "near-cells")
    if needed.isEmpty():
        return tied
    links = stored(_linked(needed.join(texts, "node"), least), "near-united")
    if links.isEmpty():
        return tied
    return stored(components(links if tied is None else links.union(tied.select("node", "component"))), "near-tied")


def near_duplicate_classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: float = SIMILARITY,
    sketches: int = SKETCHES,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept, and text_key, the md5 of its text.

    class_id is the smallest id of a class; `kept` marks its one row that stays, the first of
    that id. Texts are alike whatever the case of letters and the white space. A null text is
    empty, and texts without words are alike if they are equal. Null ids come last: a class
    of null ids alone has a null class_id. Repeated rows are of one class. An empty table
    gives no rows. Other columns play no part.
    """
    rows = stored(sketched(docs, key, text, sketches, sample), "near-sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row")))
    nodes = stored(
        rows.groupBy("key")
        .agg(first.alias("first"), F.count("*").alias("rows"))
        .select(F.col("first.row").alias("node"), "key", F.col("first.doc_id").alias("least"), "rows"),
        "near-nodes",
    )
    codes = rows.join(nodes.select(F.col("node").alias("row")), "row").select(
        F.col("row").alias("node"), F.explode("codes").alias("code"), "size"
    )
    spots = stored(_shared(codes), "near-spots")
    # Texts move once, and only those that meet another go on. A node's text comes from the
    # rows that are its key and its first document; rows repeated with both have one text.
    whole = docs.select(_key(F.col(text)).alias("key"), F.col(key).alias("doc_id"), F.col(text).alias("text"))
    meeting = spots.select("node").distinct().join(nodes, "node").select("node", "key", _id("least"))
    texts = whole.select("key", _id("doc_id"), "text").join(meeting, ["key", "id"]).select("node", "text")
    texts = stored(texts.dropDuplicates(["node"]), "near-texts")
    tied = _united(spots, texts, _led(spots, texts, least), least)
    if tied is None:
        named = nodes.withColumn("component", F.col("node"))
    else:
        named = nodes.join(tied, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = named.groupBy("component").agg(
        F.min(F.struct(F.col("least").isNull().alias("none"), F.col("least"), F.col("node"))).alias("head"),
        F.sum("rows").alias("class_size"),
    )
    classes = named.join(heads, "component").select(
        "key", "class_size", F.col("head.least").alias("class_id"), F.col("head.node").alias("head")
    )
    return rows.join(classes, "key").select(
        "doc_id", "class_id", "class_size", (F.col("row") == F.col("head")).alias("kept"), F.col("key").alias("text_key")
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **rules) -> DataFrame:
    """One document of each class; same columns. Of rows alike in id and text any one stays."""
    kept = stored(near_duplicate_classes(docs, key, text, **rules), "near-classes").where("kept")
    kept = kept.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text_key")
    row = docs.select(
        F.struct("*").alias("row"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), _key(F.col(text)).alias("text_key")
    )
    chosen = row.join(kept, ["id", "text_key"], "left_semi")
    repeated = (
        docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), _key(F.col(text)).alias("text_key"))
        .groupBy("id", "text_key")
        .count()
        .where("count > 1")
    )
    if not repeated.isEmpty():
        chosen = chosen.dropDuplicates(["id", "text_key"])
    return chosen.select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op10: the near-duplicate class of every document."""
    from skyledger.llm.common import table

    return near_duplicate_classes(table(spark, sf_dir, "documents")).drop("text_key")
