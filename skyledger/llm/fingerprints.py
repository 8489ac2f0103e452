"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

Paragraphs are lines. A paragraph's leaves are pieces of some hundred characters, cut behind
a word, so that long paragraphs are told apart inside. A section is a run of paragraphs that
ends at an empty one, or at one whose digest says so; an edit so moves the borders of its own
section at most. The root tells equality; unlike branches lead to the edits; the share of
common leaves is the likeness of two trees. All of it is column expressions, linear in the
length of a text.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import range_bounds, range_index

# A piece: a hundred characters and on to the end of the word and of the blanks behind it.
PIECE = r"[^\n]{1,100}\S*[^\S\n]*|\n"
# First hex digits of a paragraph's digest that end a section: one paragraph in four.
SECTION_ENDS = "0123"
MAX_RANGES = 1_000


def _sha(kind: str, value: Column) -> Column:
    return F.sha2(F.concat(F.lit(kind), value), 256)


def pieces(text: Column) -> Column:
    """The leaves' texts and the line ends between paragraphs; together they are the text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0))


def leaves(text: Column) -> Column:
    """The distinct leaves of a text, as 64-bit hashes."""
    return F.array_distinct(F.transform(F.filter(pieces(text), lambda p: p != "\n"), lambda p: F.xxhash64(p)))


def paragraphs(text: Column) -> Column:
    """The digests of the paragraphs, in order."""
    line = F.array_join(F.transform(pieces(text), lambda p: F.when(p == "\n", p).otherwise(_sha("piece:", p))), "")
    return F.transform(F.split(line, "\n", -1), lambda p: _sha("paragraph:", p))


def sections(paragraph_digests: Column) -> Column:
    """The digests of the sections, in order; none is empty."""
    blank = F.sha2(F.lit("paragraph:"), 256)
    ends = lambda p: (p == blank) | F.substring(p, 1, 1).isin(*SECTION_ENDS)
    line = F.array_join(F.transform(paragraph_digests, lambda p: F.concat(p, F.when(ends(p), ";").otherwise(","))), "")
    return F.transform(F.filter(F.split(line, ";", -1), lambda s: s != ""), lambda s: _sha("section:", s))


def root(text: Column) -> Column:
    """The fingerprint; equal texts, and only those, have equal ones. A null text is empty."""
    return _sha("root:", F.array_join(sections(paragraphs(text)), ","))


def likeness(mine: Column, other: Column, equal: Column) -> Column:
    """Twice the common leaves over all leaves of both; 1 for equal texts, empty ones too."""
    both = F.size(mine) + F.size(other)
    share = F.size(F.array_intersect(mine, other)) * 2.0 / F.greatest(both, F.lit(1))
    return F.when(equal, F.lit(1.0)).otherwise(share)


def changed(mine: Column, other: Column) -> Column:
    """Places, from 0, of the digests (paragraphs or sections) that the other tree lacks."""
    lacking = F.array_except(mine, other)
    return F.filter(
        F.transform(mine, lambda d, i: F.when(F.array_contains(lacking, d), i)), lambda i: i.isNotNull()
    )


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint, sections, paragraphs, leaves of every row."""
    return docs.select(
        F.col(key).alias("doc_id"),
        root(F.col(text)).alias("fingerprint"),
        sections(paragraphs(F.col(text))).alias("sections"),
        paragraphs(F.col(text)).alias("paragraphs"),
        leaves(F.col(text)).alias("leaves"),
    )


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, leaves, next: text and leaves of the next document by descending id.

    Null texts are empty. Null ids come last; equal ids go by the digest of their texts. The
    last document's next is the first. Documents are cut into ranges of ids, each of which
    also gets the first document of the range below, so a text moves once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = min(MAX_RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = range_bounds(rows.select("doc_id"), "doc_id", ranges)
    rows = rows.withColumn("range", range_index(F.col("doc_id"), bounds))
    # At most one row per range; the heads' ids are as bounded as the bounds.
    tops = rows.groupBy("range").agg(F.max("doc_id").alias("top")).orderBy(F.desc("range")).collect()
    ids = [row["top"] for row in tops if row["top"] is not None]
    nulls = [row["range"] for row in tops if row["top"] is None]
    held = [row["range"] for row in tops]
    above = {below: held[i - 1] for i, below in enumerate(held)}
    is_head = F.col("doc_id").isin(ids) | (F.col("doc_id").isNull() & F.col("range").isin(nulls))
    heads = rows.where(is_head).groupBy("range").agg(F.min(F.struct(F.md5("text").alias("tie"), "text")).alias("head"))
    goes_to = F.element_at(F.from_json(F.lit(json.dumps(above)), "map<string,int>"), F.col("range").cast("string"))
    guests = heads.select(
        goes_to.alias("range"),
        F.lit(True).alias("guest"),
        F.lit(None).cast(rows.schema["doc_id"].dataType).alias("doc_id"),
        F.col("head.text").alias("text"),
    )
    all_rows = rows.withColumn("guest", F.lit(False)).unionByName(guests).withColumn("leaves", leaves(F.col("text")))
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.md5("text"))
    return (
        all_rows.withColumn("next", F.lead(F.struct("text", "leaves")).over(order)).where("NOT guest").drop("range", "guest")
    )


def compare_edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document against its edited text and against the next document.

    The edited text has the latter half replaced by as many characters of the next document's
    start, or all of it. One row per row of `docs`; an empty table gives none; other columns
    play no part.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), (F.length("text") - half).cast("int")), F.substr(F.col("next.text"), F.lit(1), half)
    )
    rows = with_next(docs, key, text).withColumn("edited", edited)
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        root(F.col("text")).alias("fingerprint"),
        root(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("leaves"), leaves(F.col("edited")), F.col("text") == F.col("edited")).alias("near_edited"),
        likeness(F.col("leaves"), F.col("next.leaves"), F.col("text") == F.col("next.text")).alias("near_next"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op2: every document's fingerprint, its edited text's, and how alike they are."""
    from skyledger.llm.common import table

    return compare_edited(table(spark, sf_dir, "documents"))


def _root_sql(column: str) -> str:
    """The root of a text column in DuckDB."""
    parts = rf"regexp_extract_all({column}, '[^\n]{{1,100}}\S*[^\S\n]*|\n')"
    line = f"array_to_string([CASE WHEN p = chr(10) THEN p ELSE sha256('piece:' || p) END FOR p IN {parts}], '')"
    digests = f"[sha256('paragraph:' || p) FOR p IN string_split({line}, chr(10))]"
    ended = f"[p || CASE WHEN p = sha256('paragraph:') OR left(p, 1) IN ('0', '1', '2', '3') THEN ';' ELSE ',' END FOR p IN {digests}]"
    joined = f"[sha256('section:' || s) FOR s IN string_split(array_to_string({ended}, ''), ';') IF s <> '']"
    return f"sha256('root:' || array_to_string({joined}, ','))"


def _leaves_sql(column: str) -> str:
    return rf"list_distinct([p FOR p IN regexp_extract_all({column}, '[^\n]{{1,100}}\S*[^\S\n]*|\n') IF p <> chr(10)])"


def _likeness_sql(other: str) -> str:
    mine, theirs = _leaves_sql("text"), _leaves_sql(other)
    return (
        f"CASE WHEN text = {other} THEN 1.0::DOUBLE ELSE len(list_intersect({mine}, {theirs})) * 2.0::DOUBLE"
        f" / greatest(len({mine}) + len({theirs}), 1) END"
    )


SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), n AS (
  SELECT doc_id, text,
         coalesce(lead(text) OVER o, first_value(text) OVER o) AS following
  FROM d WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, md5(text))
), e AS (
  SELECT *, substr(text, 1, length(text) - length(text) // 2) || substr(following, 1, length(text) // 2) AS edited FROM n
)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, {_root_sql("text")} AS fingerprint,
       {_root_sql("edited")} AS edited_fingerprint, {_likeness_sql("edited")} AS near_edited,
       {_likeness_sql("following")} AS near_next
FROM e
"""
