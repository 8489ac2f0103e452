"""Mixing sources to target weights with a curriculum that changes over training.

Each source has a target of words and a weight schedule over training time. The schedule
is integrated to the cumulative demand of the source; a document's place in its source's
random order is a cumulative supply, and the inverse of the demand curve at that supply is
the moment the document is due. Sorting by that moment gives the training order.

Places in a source are prefix sums in two levels (cells of a hashed order, then rows of a
cell), so the largest source is spread over as many tasks as it has cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
ROWS_PER_CELL = 2_500
# Weight over training time at evenly spaced knots, by rank of the source, repeating. Only
# the shape counts: each is scaled so that its integral is the source's target.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
NO_SOURCE = "~"


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ticket(key: Column) -> Column:
    """The random but fixed order of the rows of a source."""
    return F.md5(F.coalesce(key.cast("string"), F.lit("")))


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(NO_SOURCE))


def cell_of(order: Column, cells: int) -> Column:
    """The cell of a ticket: cells are equal ranges of its first 32 bits."""
    head = F.conv(F.substring(order, 1, 8), 16, 10).cast("long")
    return F.floor(head * F.lit(cells) / F.lit(float(1 << 32))).cast("int")


def _cycled(values: tuple, rank: Column) -> Column:
    items = [F.lit(v) if isinstance(v, float) else F.array(*[F.lit(x) for x in v]) for v in values]
    return F.element_at(F.array(*items), (F.pmod(rank - 1, F.lit(len(values))) + 1).cast("int"))


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, schedules=SCHEDULES
) -> DataFrame:
    """skey, source, source_size -> with target and schedule; one row per source.

    Sources by code point, null last, take the weights in turn. They share `share` times
    all sizes by weight; none gets more than `cap` times its own size, and the rest goes to
    the others. Filling by rising cap per weight, the common level is the largest of the
    levels at which all sources before a source are at their cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight", _cycled(tuple(weights), F.col("rank"))
    )
    whole = Window.partitionBy()
    by_cap = Window.orderBy(F.col("limit") / F.col("weight"), F.col("rank"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    return (
        ranked.withColumn("limit", F.col("source_size") * F.lit(cap))
        .withColumn("level", level)
        .withColumn("target", F.least("limit", F.col("weight") * F.max("level").over(whole)))
        .select(
            "skey", "source", "source_size", "target", _cycled(tuple(schedules), F.col("rank")).alias("schedule")
        )
    )


def demand_cells(measured: DataFrame, cells: int, **rules) -> DataFrame:
    """skey, cell -> where the cell starts in its source, with the source's target.

    `measured` has source, size and order (a ticket). One row per cell and source.
    """
    per_cell = (
        measured.select(source_key(F.col("source")).alias("skey"), "source", "size", cell_of(F.col("order"), cells).alias("cell"))
        .groupBy("skey", "cell")
        .agg(F.sum("size").alias("cell_size"), F.first("source").alias("source"))
    )
    sizes = per_cell.groupBy("skey").agg(
        F.sum("cell_size").alias("source_size"), F.first("source").alias("source")
    )
    earlier = Window.partitionBy("skey").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_cell.select(
        "skey", "cell", F.coalesce(F.sum("cell_size").over(earlier), F.lit(0)).alias("cell_start")
    )
    targets = source_targets(sizes, **rules).drop("source")
    return starts.join(targets, "skey")


def due(supply: Column, target: Column, schedule: Column) -> Column:
    """The training time, 0 to 1, at which a source's demand reaches a supply.

    The schedule is linear between its knots, so demand is a quadratic per segment: find the
    segment by the integrals at its knots, then solve it. A schedule of no weight at all
    spreads its source evenly.
    """
    steps = F.size(schedule) - 1
    area = lambda i: (F.element_at(schedule, i) + F.element_at(schedule, i + 1)) / 2
    whole = F.aggregate(F.sequence(F.lit(1), steps), F.lit(0.0), lambda s, i: s + area(i))
    sought = supply / target * whole
    walked = F.aggregate(
        F.sequence(F.lit(1), steps),
        F.struct(F.lit(0.0).alias("left"), F.lit(0.0).alias("time"), F.lit(False).alias("done")),
        lambda s, i: F.when(s["done"], s)
        .when(
            s["left"] + area(i) < sought,
            F.struct((s["left"] + area(i)).alias("left"), (s["time"] + 1.0).alias("time"), F.lit(False).alias("done")),
        )
        .otherwise(
            F.struct(
                s["left"].alias("left"),
                (s["time"] + _solve(F.element_at(schedule, i), F.element_at(schedule, i + 1), sought - s["left"])).alias("time"),
                F.lit(True).alias("done"),
            )
        ),
    )
    moment = F.when(whole > 0, walked["time"] / steps).otherwise(supply / target)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), moment))


def _solve(a: Column, b: Column, area: Column) -> Column:
    """x in 0..1 with a x + (b - a) x^2 / 2 = area, in the form that is stable for a = b."""
    root = F.sqrt(F.greatest(F.lit(0.0), a * a + 2 * (b - a) * area))
    return F.when(a + root > 0, 2 * area / (a + root)).otherwise(F.lit(0.0))


def place(rows: DataFrame, cells: DataFrame, count: int, ties: list[str]) -> DataFrame:
    """rows with source, size, order -> with source_size, target, copies and moments.

    A row is due once for each pass over its source whose demand reaches the row's middle,
    so a source takes its target to within half a document. `moments` has one training time
    per copy. Equal tickets go by `ties`; rows equal in those too are alike, and each has a
    place of its own.
    """
    keyed = rows.withColumn("skey", source_key(F.col("source"))).withColumn("cell", cell_of(F.col("order"), count))
    before = (
        Window.partitionBy("skey", "cell").orderBy("order", *ties).rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = keyed.join(cells, ["skey", "cell"]).withColumn(
        "middle", F.col("cell_start") + F.coalesce(F.sum("size").over(before), F.lit(0)) + F.col("size") / 2
    )
    passes = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("target") / F.greatest("source_size", F.lit(1)))).cast("int"))
    supplies = F.filter(
        F.transform(passes, lambda p: p * F.col("source_size") + F.col("middle")), lambda s: s < F.col("target")
    )
    return (
        placed.withColumn("moments", F.transform(supplies, lambda s: due(s, F.col("target"), F.col("schedule"))))
        .withColumn("copies", F.size("moments"))
        .drop("skey", "cell", "cell_start", "middle", "schedule")
    )


def cell_count(rows: int, rows_per_cell: int = ROWS_PER_CELL) -> int:
    return max(1, -(-rows // rows_per_cell))


def mix_table(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **rules) -> DataFrame:
    """One row per document: key, source, size, source_size, target, copies, moments.

    Null or empty texts have size 0. Null keys share one ticket. A null source is a source
    of its own and comes last. Repeated rows each count. An empty table gives no rows. Other
    columns of `docs` play no part.
    """
    measured = stored(
        docs.select(
            F.col(key).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            ticket(F.col(key)).alias("order"),
        ),
        "mix-sizes",
    )
    count = cell_count(measured.count())
    return place(measured, demand_cells(measured, count, **rules), count, ["doc_id", "size"])


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **rules) -> DataFrame:
    """The documents in training order, each as often as it is due; same columns.

    Sizes are summed from narrow columns first. The texts then move twice: to their cell,
    and to their range of training time.
    """
    narrow = docs.select(
        F.col(source).alias("source"), word_count(F.col(text)).alias("size"), ticket(F.col(key)).alias("order")
    )
    count = cell_count(docs.count())
    cells = stored(demand_cells(narrow, count, **rules), "mix-cells")
    whole = docs.select(
        F.struct("*").alias("row"),
        F.col(key).alias("tie"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        ticket(F.col(key)).alias("order"),
    )
    due_rows = place(whole, cells, count, ["tie", "size"]).select("row", F.explode("moments").alias("moment"))
    return due_rows.repartitionByRange("moment").sortWithinPartitions("moment").select("row.*")


# Query and its SQL twin -------------------------------------------------------------------


def query(spark, sf_dir: str) -> DataFrame:
    """op1: size, target and words taken of every document."""
    from skyledger.llm.common import table

    return mix_table(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS ord,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank,
         source_size * 2.0::DOUBLE AS cap
  FROM sources
), levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
            / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted
), targets AS (
  SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target FROM levels
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY ord, doc_id, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + s.size / 2 AS middle
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, CAST((middle < target)::INTEGER + (middle + source_size < target)::INTEGER AS INTEGER) AS copies FROM placed
)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, copies FROM taken
"""
