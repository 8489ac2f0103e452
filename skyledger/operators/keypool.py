"""Key-pool log lines: classify, extract, check, route, count."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.rows import computed_once
from skyledger.functions.text import contains_all, first_match, leading_tokens, strip
from skyledger.functions.times import log_time
from skyledger.operators.fold import fold
from skyledger.schemas import FILE_LEDGER_COLUMNS, KEYPOOL_TABLES, UPSERT_REPLACES

MINIMUM_TOKENS = 5
UNKNOWN = "UNKNOWN"


@dataclass(frozen=True)
class Field:
    """A column, the pattern whose group 1 holds its text, and its type."""

    column: str
    pattern: str
    is_number: bool = True


@dataclass(frozen=True)
class Kind:
    """A kind of event: the words that mark it, its fields and its table."""

    name: str
    words: tuple[str, ...]
    table: str
    counter: str
    fields: tuple[Field, ...]


# The kinds in matching order, their marking words and field patterns. Digits are
# ASCII ones: a cast to a number reads no others.
KINDS = [
    Kind(
        "KEY_CREATION",
        ("createKey", "sequence number"),
        "key_creations",
        "key_creations",
        (
            Field("key_identity", r"identity = '([a-f0-9-]{36})'", is_number=False),
            Field("sequence_number", r"sequence number ([0-9]+)"),
            Field("source_site_id", r"Source site identity = '([0-9]+)'"),
            Field("destination_site_id", r"Destination site identity = '([0-9]+)'"),
            Field("key_pool_type", r"KeyPoolType name = '(PUBLIC|PRIVATE|SHARED)'", is_number=False),
        ),
    ),
    Kind(
        "SYNC_LATENCY",
        ("METRIC_KEY_SYNC_LATENCY",),
        "sync_latency_metrics",
        "sync_latency",
        (Field("latency_ms", r"MS=([0-9]+)"),),
    ),
    Kind(
        "KEY_COUNT",
        ("METRIC_RECEIVED_PUBLIC_KEY_COUNT",),
        "key_count_metrics",
        "key_counts",
        (Field("bits", r"BITS=([0-9]+)"), Field("keys_count", r"KEYS=([0-9]+)")),
    ),
    Kind(
        "CONTROLLER_SYNC",
        ("KeyPoolController", "remote site"),
        "controller_syncs",
        "controller_syncs",
        (
            Field("local_site_id", r"SiteId: ([0-9]+)"),
            Field("remote_site_id", r"remote site ([0-9]+)"),
        ),
    ),
]
KIND_OF_TABLE = {kind.table: kind for kind in KINDS}

STORE_ERRORS = ["missing_fields", "bad_timestamp", "out_of_range"]


def classify(line: Column) -> Column:
    """Name of the first kind whose words all occur, else UNKNOWN."""
    return F.coalesce(
        *[F.when(contains_all(line, *kind.words), kind.name) for kind in KINDS], F.lit(UNKNOWN)
    )


def _texts(line: Column, log_type: Column) -> Column:
    """Texts of the fields of the line's own kind, in field order, empty where missing."""
    chosen = F.lit(None).cast("array<string>")
    for kind in KINDS:
        texts = F.array(*[first_match(line, field.pattern) for field in kind.fields])
        chosen = F.when(log_type == kind.name, texts).otherwise(chosen)
    return chosen


def parse_lines(lines: DataFrame) -> DataFrame:
    """One row per non-blank line, with every field the line holds and why it is not
    stored, if it is not. A narrow job: a line is stripped, classified and searched once,
    and only for its own kind's fields.

    Columns: ord, log_file, raw_line, time_text, site_id, log_type (NULL for a line too
    short to be an entry), timestamp, one column per field, reject_reason (NULL when
    stored).
    """
    carried = ["ord", "log_file", *[c for c in ("file_size",) if c in lines.columns]]
    raw = computed_once(lines, raw_line=strip(F.col("value"))).where("raw_line <> ''")
    split = computed_once(
        raw.select(*carried, "raw_line"),
        tokens=leading_tokens(F.col("raw_line"), MINIMUM_TOKENS),
    )
    line, log_type = F.col("raw_line"), F.col("log_type")
    is_entry = F.size("tokens") == MINIMUM_TOKENS
    typed = computed_once(
        split,
        time_text=F.when(is_entry, F.get("tokens", F.lit(0))),
        site_id=F.when(is_entry, F.get("tokens", F.lit(2))),
        log_type=F.when(is_entry, classify(line)),
    )
    found = computed_once(
        typed,
        timestamp=F.when(log_type != UNKNOWN, log_time(F.col("time_text"))),
        texts=_texts(line, log_type),
    )

    def text(place: int) -> Column:
        return F.get("texts", F.lit(place))

    fields = [
        F.when(
            log_type == kind.name,
            text(i).try_cast("int") if f.is_number else F.nullif(text(i), F.lit("")),
        ).alias(f.column)
        for kind in KINDS
        for i, f in enumerate(kind.fields)
    ]
    too_large = F.coalesce(
        *[
            F.when(
                log_type == kind.name,
                F.greatest(
                    F.lit(False),
                    *[
                        text(i).try_cast("int").isNull()
                        for i, f in enumerate(kind.fields)
                        if f.is_number
                    ],
                ),
            )
            for kind in KINDS
        ]
    )
    reason = (
        F.when(log_type.isNull(), "too_few_tokens")
        .when(log_type == UNKNOWN, "unknown")
        .when(F.array_contains("texts", ""), "missing_fields")
        .when(F.col("timestamp").isNull(), "bad_timestamp")
        .when(too_large, "out_of_range")
    )
    return found.select(
        *carried, "raw_line", "time_text", "site_id", "log_type", "timestamp", *fields,
        reason.alias("reject_reason"),
    )


def stored_rows(entries: DataFrame, table: str) -> DataFrame:
    """Rows of one key-pool table, with their arrival order."""
    kind = KIND_OF_TABLE[table]
    accepted = (F.col("log_type") == kind.name) & F.col("reject_reason").isNull()
    return entries.where(accepted).select("ord", *KEYPOOL_TABLES[table])


def rejected_lines(entries: DataFrame) -> DataFrame:
    """Lines that reach no table, with the reason."""
    return entries.where(F.col("reject_reason").isNotNull()).select(
        "ord", "log_file", "log_type", "raw_line", "reject_reason"
    )


def key_creations(entries: DataFrame, collation: str | None = None) -> DataFrame:
    """Key creations, one row per identity: a repeat replaces the sequence number only."""
    return fold(
        stored_rows(entries, "key_creations"),
        "key_identity",
        replaces=UPSERT_REPLACES["key_creations"],
        collation=collation,
    )


def file_stats(entries: DataFrame, *others: Column) -> DataFrame:
    """Line counts per file, and `others` in the same pass. A line of unknown kind is
    neither counted nor an error."""
    reason = F.col("reject_reason")
    return entries.groupBy(F.col("log_file").alias("filename")).agg(
        F.count(F.lit(1)).alias("total_lines"),
        *[
            F.count_if((F.col("log_type") == kind.name) & reason.isNull()).alias(kind.counter)
            for kind in KINDS
        ],
        F.lit(0).cast("long").alias("unknown"),
        F.count_if(F.coalesce(reason.isin(STORE_ERRORS), F.lit(False))).alias("db_errors"),
        *others,
    )


def file_stats_of_catalogue(catalogue: DataFrame, stats: DataFrame) -> DataFrame:
    """The same counts for every file of a catalogue; a file without lines has zeros."""
    counters = [c for c in stats.columns if c != "filename"]
    return catalogue.join(stats, "filename", "left").select(
        *catalogue.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in counters]
    )


def ledger_rows(stats: DataFrame) -> DataFrame:
    """File statistics as rows of the file ledger (needs file_size and ord)."""
    renamed = {kind.counter: name for kind, name in zip(KINDS, FILE_LEDGER_COLUMNS[3:])}
    return stats.withColumnsRenamed(renamed).select("ord", *FILE_LEDGER_COLUMNS)


def file_ledger(rows: DataFrame, collation: str | None = None) -> DataFrame:
    """The file ledger: a repeat replaces size and line count, the counts stay."""
    return fold(
        rows, "filename", replaces=UPSERT_REPLACES["processed_files"], collation=collation
    )
