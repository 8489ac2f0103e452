"""Line deduplication: levelled sorted runs of line hashes, merged with each new batch.

A run is a bucketed table, sorted within its buckets: one row per line key, hashed to 128
bits, with the number of documents of one batch or of several that hold it. A new batch
counts its own keys, merge-anti-joins every run for the keys that already have documents
enough, and adds what is left as a run of level 0. When a level holds `fanout` runs, they are
compacted into one of the next level, so a key is rewritten once per level, and runs stay few.
The buckets of runs and batch agree, so runs are never shuffled when a batch comes.

A manifest that is written last names the runs that count. A crash before it leaves a folder
nobody reads; a store is opened again from its manifests.

All of it is DataFrame expressions. Where a text is cut up only its line hashes move; equal
texts are worked on once, and a document's text moves once, when its lines are dropped.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import scratch_folder

# The blanks stripped from a line, and the letters made small.
BLANKS = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_DOCUMENTS = 10
BUCKETS = 16
FANOUT = 3
KEY = ("h1", "h2")
RUN = "h1 long, h2 long, n long"
MANIFEST = "version long, runs array<struct<level: int, folder: string>>"


def line_key(line: Column) -> Column:
    """What two lines must share to count as the same."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), CAPITALS, CAPITALS.lower())


def lines(text: Column) -> Column:
    """The lines of a text; a null or empty one is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed(value: Column) -> list[Column]:
    """Two hashes of unlike seeds: 128 bits, so that equal hashes mean equal values."""
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(1), value).alias("h2")]


def line_counts(docs: DataFrame, text: str = "text", least_chars: int = 1) -> DataFrame:
    """h1, h2, n: the rows of `docs` that hold each line key of at least `least_chars` characters.

    A key repeated within a row counts once there. Counts are summed before they are shuffled.
    """
    keys = F.array_distinct(F.transform(lines(F.col(f"`{text}`")), line_key))
    held = F.filter(keys, lambda k: F.length(k) >= least_chars)
    return (
        docs.select(F.explode(held).alias("line")).select(*hashed(F.col("line"))).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    )


@dataclass(frozen=True)
class Run:
    level: int
    folder: str


class LineRuns:
    """A store of levelled runs in a folder all executors can reach.

    A key is settled once `least_documents` rows held it; it is then never counted again. With
    `least_documents` 1 each run holds the lines no earlier batch had.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        least_documents: int = LEAST_DOCUMENTS,
        buckets: int = BUCKETS,
        fanout: int = FANOUT,
        least_chars: int = 1,
    ):
        if least_documents < 1 or fanout < 2 or buckets < 1 or least_chars < 1:
            raise ValueError("at least one document, bucket and character, and runs merged by two or more")
        self.spark, self.root = spark, root or scratch_folder(spark, "line-runs")
        self.least_documents, self.buckets, self.fanout, self.least_chars = least_documents, buckets, fanout, least_chars
        self.version, self.runs = self._latest()

    def add(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Count the lines of a batch of rows and add them as a run; gives the run back.

        Null and empty texts hold no key; equal rows count one each; other columns play no part.
        """
        counts = line_counts(docs, text, self.least_chars).repartition(self.buckets, *KEY)
        for run in self.runs:
            counts = counts.join(self._settled(run), [*KEY], "left_anti")
        added = self._write(counts, 0)
        self._publish([*self.runs, added])
        self.compact()
        return self._read(added)

    def compact(self) -> None:
        """Merge the runs of each full level into one of the next."""
        level = 0
        while level <= max((run.level for run in self.runs), default=-1):
            full = [run for run in self.runs if run.level == level]
            if len(full) >= self.fanout:
                merged = self._write(self._merged(full).repartition(self.buckets, *KEY), level + 1)
                self._publish([run for run in self.runs if run not in full] + [merged])
            level += 1

    def frequent(self) -> DataFrame:
        """h1, h2 of the keys that `least_documents` rows or more held."""
        if not self.runs:
            return self.spark.createDataFrame([], RUN).select(*KEY)
        return self._merged(self.runs).where(F.col("n") >= self.least_documents).select(*KEY)

    def _settled(self, run: Run) -> DataFrame:
        return self._read(run).where(F.col("n") >= self.least_documents).select(*KEY)

    def _merged(self, runs: list[Run]) -> DataFrame:
        """The counts of several runs, summed. They are read as plain files: Spark takes a union
        of bucketed tables for one dealt by key, but puts its columnar batches side by side."""
        rows = self.spark.read.schema(RUN).parquet(*[f"{self.root}/{run.folder}" for run in runs])
        return rows.groupBy(*KEY).agg(F.sum("n").alias("n"))

    # ------------------------------------------------------------ files

    def _write(self, rows: DataFrame, level: int) -> Run:
        run = Run(level, f"level={level}/{uuid.uuid4().hex}")
        (
            rows.select(*KEY, "n")
            .write.bucketBy(self.buckets, *KEY)
            .sortBy(*KEY)
            .option("path", f"{self.root}/{run.folder}")
            .format("parquet")
            .saveAsTable(_table_name(run))
        )
        return run

    def _read(self, run: Run) -> DataFrame:
        """The run as a bucketed table, made known to this session where another wrote it."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_table_name(run)} ({RUN}) USING parquet"
            f" CLUSTERED BY ({', '.join(KEY)}) SORTED BY ({', '.join(KEY)}) INTO {self.buckets} BUCKETS"
            f" LOCATION '{self.root}/{run.folder}'"
        )
        return self.spark.read.table(_table_name(run))

    def _latest(self) -> tuple[int, list[Run]]:
        try:
            newest = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifests").orderBy(F.desc("version")).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            newest = None
        return (newest.version, [Run(*run) for run in newest.runs]) if newest else (0, [])

    def _publish(self, runs: list[Run]) -> None:
        """Name the runs that count from now on: at most `fanout` a level, so a short list."""
        self.version += 1
        line = [(self.version, [(run.level, run.folder) for run in runs])]
        self.spark.createDataFrame(line, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifests")
        self.runs = runs


def _table_name(run: Run) -> str:
    return f"skyledger_line_run_{run.folder.split('/')[1]}"


def drop_lines(docs: DataFrame, keys: DataFrame, text: str = "text") -> DataFrame:
    """All columns of `docs`, and `n_lines`, `n_dropped`, `kept`: the text without the lines of
    the keys given. They stand in one column named `lines`, which takes the place of one of
    that name.

    Lines meet the keys by hash. The places of the lines to drop come back to the texts by the
    text's own hash, so that copies of a text share one list; the join that brings them is the
    only one that moves a text. Spark splits a group of copies over tasks.
    """
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    own = [h.alias(f"t{i}") for i, h in enumerate(hashed(F.coalesce("text", F.lit(""))))]
    places = (
        source.select(*own, F.posexplode(F.transform(lines(F.col("text")), line_key)).alias("at", "line"))
        .where(F.length("line") > 0)
        .select("t0", "t1", "at", *hashed(F.col("line")))
        .join(keys.select(*KEY).distinct(), [*KEY], "left_semi")
        .groupBy("t0", "t1")
        .agg(F.array_sort(F.collect_set("at")).alias("dropped"))
    )
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    told = source.select(*own, "row", "text").join(places, ["t0", "t1"], "left")
    cut = told.select("row", lines(F.col("text")).alias("all"), dropped.alias("dropped"))
    # Runs of kept lines lie between one dropped line and the next.
    kept = F.flatten(
        F.zip_with(
            F.concat(F.array(F.lit(-1)), "dropped"),
            F.concat("dropped", F.array(F.size("all"))),
            lambda start, end: F.slice("all", start + 2, end - start - 1),
        )
    )
    result = F.struct(
        F.size("all").cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept"),
    )
    return cut.select(*[F.col(f"row.`{c}`") for c in docs.columns if c != "lines"], result.alias("lines"))


# The query adds the documents in so many batches.
BATCHES = 4


def query(spark, sf_dir: str) -> DataFrame:
    """op12: every document without the lines that ten documents or more hold."""
    from skyledger.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    runs = LineRuns(spark)
    for batch in range(BATCHES):
        runs.add(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(BATCHES)) == batch))
    kept = drop_lines(docs, runs.frequent())
    return kept.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.kept", 256).alias("kept_sha256"))


_KEY_SQL = (
    "translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),"
    f" '{CAPITALS}', '{CAPITALS.lower()}')"
)
SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT r, doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS place FROM d
), k AS (
  SELECT *, {_KEY_SQL} AS k FROM l
), f AS (
  SELECT k FROM k WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= {LEAST_DOCUMENTS}
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY place) FILTER (f.k IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.k = f.k GROUP BY r
"""
