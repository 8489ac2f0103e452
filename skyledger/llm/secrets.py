"""Secret scans: patterns, and character Markov models compared by log-likelihood ratio.

Two models of first order are trained, one on labelled random strings, one on ordinary
identifiers. The random strings are made from digests, as many for any table. The identifiers
are the names of Spark's functions in the usual spellings, as many for any table, and the long
tokens of all documents without a finding. Pairs of characters back off to single ones, so a
small table gives a weaker model of the same shape, and a token that occurs once does not teach
that it is ordinary. A long token is a secret if the ratio of its likelihoods is large enough.
Counting, scoring and placing are column expressions throughout.

Places come from the pieces between matches: their lengths are summed along a document, by a
window over narrow rows, so a text with many matches costs no more than their number.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import stored

# Kinds in their order, with pattern, group and least length of the group.
PATTERNS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
LEARNED = "random"
KINDS = (*(kind for kind, *_ in PATTERNS), LEARNED)
TOKEN = r"[A-Za-z0-9+/_=-]{12,}"
TOKEN_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LEAST_SCORED = 16
# What each character counts beforehand, and for how many pairs the single characters stand.
SMOOTHING = 0.5
BACK_OFF = 1_000
MADE_STRINGS = 20_000
MADE_NUMBERS = 400
# Nats by which a token must be likelier random than ordinary. Chosen on made strings and
# tokens the models were not trained on, see README.
LEAST_RATIO = 10.0
REDACTED = "[SECRET]"


def _found(text: Column, pattern: str, group: int, least: int) -> Column:
    """Per match: the characters before it since the last, its own, whether it counts, and itself.

    Splitting at a pattern and extracting it walk a text by the same matches, so the two
    lists take turns.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    rows = F.transform(
        F.arrays_zip(pieces.alias("before"), whole.alias("match"), part.alias("part")),
        lambda m: F.struct(
            F.length(m["before"]).alias("gap"),
            F.length(m["match"]).alias("length"),
            (F.length(m["part"]) >= least).alias("counts"),
            m["part"].alias("value"),
        ),
    )
    return F.when(text.rlike(pattern), rows)


def matches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """row, doc_id and per pattern the matches of each whole text; the only pass over texts."""
    whole = F.coalesce(F.col(text), F.lit(""))
    columns = [_found(whole, pattern, group, least).alias(kind) for kind, pattern, group, least in PATTERNS]
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("doc_id"),
        F.md5(whole).alias("text_key"),
        *columns,
        _found(whole, TOKEN, 0, LEAST_SCORED).alias(LEARNED),
    )


def _placed(found: DataFrame) -> DataFrame:
    """row, kind, start, end, value of every match that counts."""
    placed = None
    for rank, kind in enumerate(KINDS):
        by_place = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
        rows = (
            found.where(F.col(kind).isNotNull())
            .select("row", F.posexplode(kind).alias("i", "m"))
            .withColumn("end", F.sum(F.col("m.gap") + F.col("m.length")).over(by_place))
            .where("m.counts")
            .select(
                "row",
                F.lit(rank).alias("rank"),
                F.lit(kind).alias("kind"),
                (F.col("end") - F.col("m.length")).alias("start"),
                "end",
                F.col("m.value").alias("value"),
            )
        )
        placed = rows if placed is None else placed.unionByName(rows)
    return placed


def _pairs(tokens: DataFrame) -> DataFrame:
    """token -> counts of its characters with the one before; `^` stands before the first."""
    marked = F.concat(F.lit("^"), F.col("token"))
    places = F.sequence(F.lit(1), F.length("token"))
    return (
        tokens.where("length(token) > 0")
        .select(F.explode(F.transform(places, lambda i: F.substr(marked, i, F.lit(2)))).alias("pair"))
        .groupBy("pair")
        .agg(F.count("*").alias("n"))
    )


def random_strings(spark, count: int = MADE_STRINGS, seed: str = "made") -> DataFrame:
    """Labelled random strings, 16 to 43 characters of base 64, in both spellings of it, or of
    letters and digits alone."""
    text = F.base64(F.unhex(F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)))
    kinds = [text, F.translate(text, "+/", "-_"), F.regexp_replace(text, "[+/=]", "")]
    spelt = F.element_at(F.array(*kinds), (F.col("id") % len(kinds) + 1).cast("int"))
    length = (F.col("id") % 28 + 16).cast("int")
    return spark.range(count).select(F.substr(spelt, F.lit(1), length).alias("token"))


def known_identifiers(spark) -> DataFrame:
    """Labelled identifiers: names of Spark's functions with `_`, with `-`, in capitals, and run
    together with the first letters large; and numbers of 16 digits."""
    name = F.regexp_extract("function", r"^[a-z][a-z0-9_]{3,}$", 0)
    joined = F.replace(F.initcap(F.replace(name, F.lit("_"), F.lit(" "))), F.lit(" "), F.lit(""))
    spellings = F.array(name, F.replace(name, F.lit("_"), F.lit("-")), F.upper(name), joined)
    numbers = spark.range(MADE_NUMBERS).select(F.lpad((F.abs(F.xxhash64("id")) % 10**16).cast("string"), 16, "0").alias("token"))
    return spark.sql("SHOW SYSTEM FUNCTIONS").select(F.explode(spellings).alias("token")).unionByName(numbers)


def _sources(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The labelled tokens: random ones, ordinary ones."""
    spark = found.sparkSession
    clean = " AND ".join(f"{kind} IS NULL" for kind, *_ in PATTERNS)
    ordinary = found.where(f"{clean} AND {LEARNED} IS NOT NULL").select(F.explode(F.col(f"{LEARNED}.value")).alias("token"))
    return random_strings(spark), known_identifiers(spark).unionByName(ordinary)


def train(found: DataFrame) -> list[float]:
    """Log ratios of the two models by pair of characters, a square table of the alphabet.

    Counts go over all documents; some thousand sums reach the driver.
    """
    firsts = "^" + TOKEN_CHARS
    tables = []
    for tokens in _sources(found):
        counts = {row["pair"]: row["n"] for row in _pairs(tokens).collect()}
        single = {b: SMOOTHING + sum(counts.get(a + b, 0) for a in firsts) for b in TOKEN_CHARS}
        every = sum(single.values())
        table = {}
        for a in firsts:
            seen = sum(counts.get(a + b, 0) for b in TOKEN_CHARS)
            for b in TOKEN_CHARS:
                share = (counts.get(a + b, 0) + BACK_OFF * single[b] / every) / (seen + BACK_OFF)
                table[a + b] = math.log(share)
        tables.append(table)
    return [round(tables[0][a + b] - tables[1][a + b], 5) for a in firsts for b in TOKEN_CHARS]


def ratio(token: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a token of TOKEN_CHARS: how much likelier random than ordinary."""
    cells = F.from_json(F.lit(json.dumps(table)), "array<double>")
    place = lambda i: F.instr(F.lit(TOKEN_CHARS), F.substr(token, i, F.lit(1)))
    one = F.lit(1)
    cell = lambda i: F.when(i == 1, F.lit(0)).otherwise(place(i - one)) * len(TOKEN_CHARS) + place(i)
    return F.aggregate(
        F.sequence(one, F.length(token)),
        F.lit(0.0),
        lambda total, i: total + F.element_at(cells, cell(i)),
    )


def spans(found: DataFrame, table: list[float], least_ratio: float = LEAST_RATIO) -> DataFrame:
    """row, rank, kind, start, end: what patterns find, and learned tokens that lie clear of those."""
    placed = _placed(found).where(
        (F.col("kind") != LEARNED) | F.when(F.col("kind") == LEARNED, ratio(F.col("value"), table) >= least_ratio)
    )
    order = Window.partitionBy("row").orderBy("start", "rank", "end")
    base = F.col("kind") != LEARNED
    before = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    return (
        placed.withColumn("before", before)
        .withColumn("after", after)
        .where(base | (F.coalesce(F.col("before") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("after") >= F.col("end"), F.lit(True))))
        .select("row", "rank", "kind", "start", "end")
    )


def _joined(spans_column: Column) -> Column:
    return F.array_join(
        F.transform(spans_column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", least_ratio: float = LEAST_RATIO) -> DataFrame:
    """doc_id, text_key, spans: every document with its spans in order of start, then kind.

    A span is start, rank, kind, end, in code points, end exclusive. A null text is empty and
    has none. Repeated rows each have a row. An empty table gives no rows. Other columns play
    no part.
    """
    found = stored(matches(docs, key, text), "secret-matches")
    table = train(found)
    per_row = (
        spans(found, table, least_ratio)
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("spans"))
    )
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return found.select("row", "doc_id", "text_key").join(per_row, "row", "left").select(
        "doc_id", "text_key", F.coalesce("spans", empty).alias("spans")
    )


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str | None = "n_chars") -> DataFrame:
    """The documents with each run of overlapping spans replaced by a mark; same columns.

    Spans depend on the text alone, so they meet the texts by its digest. A column of
    lengths, if it is there, follows.
    """
    hit = scan(docs, key, text).where("size(spans) > 0").groupBy("text_key").agg(F.first("spans").alias("spans"))
    merged = F.aggregate(
        "spans",
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] > s["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    hit = hit.select("text_key", merged.alias("cuts"))
    row = docs.select(F.struct("*").alias("row"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("text_key"))
    whole = F.col(f"row.{text}")
    count = F.size("cuts")
    piece = lambda i: F.substr(
        whole,
        (F.when(i == 0, F.lit(0)).otherwise(F.element_at("cuts", i)["end"]) + 1).cast("int"),
        (
            F.when(i == count, F.length(whole).cast("long")).otherwise(F.element_at("cuts", i + 1)["start"])
            - F.when(i == 0, F.lit(0)).otherwise(F.element_at("cuts", i)["end"])
        ).cast("int"),
    )
    rebuilt = F.array_join(F.transform(F.sequence(F.lit(0), count), lambda i: piece(i)), REDACTED)
    joined = row.join(hit, "text_key", "left").withColumn("clean", F.when(F.col("cuts").isNotNull(), rebuilt).otherwise(whole))
    columns = []
    for name in docs.columns:
        if name == text:
            columns.append(F.col("clean").alias(name))
        elif name == chars:
            kind = docs.schema[name].dataType
            length = F.length("clean").cast(kind)
            columns.append(F.when(F.col("cuts").isNotNull(), length).otherwise(F.col(f"row.{name}")).alias(name))
        else:
            columns.append(F.col(f"row.{name}").alias(name))
    return joined.select(*columns)


def query(spark, sf_dir: str) -> DataFrame:
    """op4: secrets of every document."""
    from skyledger.llm.common import table

    scanned = scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != LEARNED)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind, *_ in PATTERNS],
        count(LEARNED).alias("n_random"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
