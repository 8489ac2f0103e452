"""Log lines and packages derived from the `events` table.

Every event becomes one log line and one package delivery, so the work of a query grows
with the table. Packages come in pairs: an even event is the first delivery of a package,
the odd one after it the second.

Lines and documents are derived once per session and land in the shared folder, as the
producers of a deployment would leave them; each query starts from that text. Streams land
their own files, gzipped: the text is some ten times its compressed size.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.functions.rows import computed_once
from skyledger.operators import assemble
from skyledger.schemas import SECTIONS
from skyledger.session import scratch_folder
from skyledger.sources.packages import parse_documents
from skyledger.sources.tables import read_table

# Merged files of a landing: at least so many, and so many documents in each.
LEAST_FILES = 4
DOCUMENTS_PER_FILE = 20_000


def _event() -> list[Column]:
    return [F.col(c) for c in ("event_id", "user_id", "value", "ts", "event_type")]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/events.parquet").repartition("event_id")


def version(spark: SparkSession, sf_dir: str) -> str:
    """Which files the events lie in, and when they were written; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{sf_dir}/events.parquet")
    meta = files.select(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)").alias("h"))
    return str(tuple(meta.agg(F.count("*").alias("n"), F.sum("h").alias("h")).first()))


_LANDED: dict[tuple[str, str, str, str], tuple[str, StructType]] = {}


def _landed(spark: SparkSession, sf_dir: str, name: str, derive: Callable[[], DataFrame]) -> DataFrame:
    """The derived rows from the shared folder, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name, version(spark, sf_dir))
    if key in _LANDED:
        path, schema = _LANDED[key]
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException:  # the folder is gone: derive anew
            pass
    path, rows = scratch_folder(spark, f"landing-{name}"), derive()
    rows.write.parquet(path)
    _LANDED[key] = path, rows.schema
    return spark.read.schema(rows.schema).parquet(path)


def _choose(selector: Column, *values) -> Column:
    """values[selector]; the last one for anything beyond."""
    *some, last = [v if isinstance(v, Column) else F.lit(v) for v in values]
    chosen = reduce(
        lambda acc, pair: acc.when(selector == pair[0], pair[1]),
        list(enumerate(some))[1:],
        F.when(selector == 0, some[0]),
    )
    return chosen.otherwise(last)


def _div(column: Column, by: int) -> Column:
    return F.floor(column / by)


# ---------------------------------------------------------------- log lines


def _uuid(column: Column) -> Column:
    digest = F.md5(column.cast("string"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def log_lines(spark: SparkSession, sf_dir: str, before: str | None = None) -> DataFrame:
    """ord, log_file, value: one line per event, one file per day; with `before`, as the
    files stood at that moment."""
    lines = _landed(spark, sf_dir, "lines", lambda: _derive_lines(spark, sf_dir))
    if before:
        lines = lines.where(F.col("written") < F.lit(before).cast("timestamp_ntz"))
    return lines.drop("written")


def _derive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, u, v, ts, kind = _event()
    time = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS")
    head = F.concat(time, F.lit("+0000 SiteId: "), (u % 5 + 101).cast("string"), F.lit("  INFO 26 "))
    sync = F.lit("[worker-1] KeySyncServiceImpl : METRIC_KEY_SYNC_LATENCY MS=")
    created = F.lit("[worker-1] KeyPoolServiceImpl : createKey: KeyPoolService successfully created key with ")
    pool = F.concat(
        F.lit("sequence number "), e.cast("string"),
        F.lit(", and KeyPool {Source site identity = '"), (u % 5 + 101).cast("string"),
        F.lit("', Destination site identity = '"), (u % 3 + 201).cast("string"),
        F.lit("', and KeyPoolType name = '"), _choose(e % 3, "PUBLIC", "PRIVATE", "SHARED"), F.lit("'}"),
    )
    keys = u % 10 + 1
    purchase = F.concat(head, created, F.lit("identity = '"), _uuid(u), F.lit("', "), pool)
    view = F.concat(head, sync, F.floor(v).cast("string"))
    click = F.concat(
        head, F.lit("[worker-1] KeySyncServiceImpl : METRIC_RECEIVED_PUBLIC_KEY_COUNT BITS="),
        (keys * 256).cast("string"), F.lit(" KEYS="), keys.cast("string"),
    )
    signup = F.concat(
        head, F.lit("[exec-1] KeyPoolController : Handling qnl db sync with remote site "),
        (u % 5 + 101).cast("string"),
    )
    blank = "\u00a0"
    broken = _choose(
        e % 9,
        F.lit("Invalid log line"),
        F.concat(head, F.lit("Unknown event")),
        F.concat(head, created, pool),
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0000 SiteId: 101  INFO 26 "), sync, F.lit("7")),
        F.concat(head, sync, F.lit("99999999999")),
        F.concat(time, F.lit("-0500 SiteId: 101  INFO 26 "), sync, F.lit("8")),
        F.concat(F.lit("\t "), F.replace(view, F.lit(" "), F.lit(blank)), F.lit(f" {blank}")),
        F.lit(f" \t{blank} "),
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+0000 SiteId: 101  INFO 26 "), sync, F.lit("9")),
    )
    value = (
        F.when(kind == "purchase", purchase)
        .when(kind == "view", view)
        .when(kind == "click", click)
        .when(kind == "signup", signup)
        .otherwise(broken)
    )
    return events(spark, sf_dir).select(
        e.alias("ord"),
        ts.alias("written"),
        F.concat(F.lit("keypool_"), F.date_format(ts, "yyyyMMdd"), F.lit(".log")).alias("log_file"),
        value.alias("value"),
    )


# ---------------------------------------------------------------- packages


def delivery_time() -> Column:
    """A delivery every five seconds, a package every ten."""
    e, *_ = _event()
    return F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=e * 5)


def _package_time() -> Column:
    e, *_ = _event()
    return F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=_div(e, 2) * 10)


def _pass(offset: int = 0) -> Column:
    e, *_ = _event()
    return F.concat(F.lit("pass-"), (_div(e, 20) + offset).cast("string"))


def environment_values() -> dict[str, Column]:
    e, u, v, ts, _ = _event()
    return {
        "timestamp": ts,
        "ogs_id": F.concat(F.lit("OGS-00"), (u % 3 + 1).cast("string")),
        "dome_open": e % 4 != 0,
        "dome_anomaly": e % 4 == 1,
        "temperature": v / 10,
        "wind_speed": v / 50,
        "wind_direction": (e % 360).cast("int"),
        "humidity": v / 5,
        "air_pressure": v / 50 + 1000,
        "cloud_cover": (e % 100).cast("int"),
        "precipitation": e % 10 == 0,
        "brightness": (e % 50000).cast("int"),
    }


def link_values() -> dict[str, Column]:
    e, _, v, ts, _ = _event()
    return {
        "timestamp": ts,
        "pass_id": _pass(),
        "quantum_locked": e % 20 != 0,
        "tracking_status": _choose(e % 3, "TRACKING", "LOST", "LOCKED"),
        "qber": F.when(e % 11 != 0, v / 10000),
        "link_power_margin": v / 100,
        "received_power": -(v / 10),
        "uplink_power": -(v / 20),
        "fso_uplink_power": -(v / 30),
        "fso_downlink_power": -(v / 40),
        "fso_status": F.when(e % 4 == 0, "idle").otherwise("active"),
    }


def summary_values() -> dict[str, Column]:
    e, u, v, ts, kind = _event()
    return {
        "pass_id": _pass(),
        "satellite_id": F.concat(F.lit("SAT-"), (u % 2 + 1).cast("string")),
        "start_time": ts - F.expr("INTERVAL 15 MINUTES"),
        "end_time": ts,
        "total_duration_sec": F.lit(900),
        "locked_duration_sec": (e % 900).cast("int"),
        "lock_percentage": F.when(e % 7 != 0, v / 10),
        "lost_tracking_events": (e % 4).cast("int"),
        "avg_tracking_stability": v / 8,
        "keys_distilled": u.cast("int"),
        "key_size_bits": _choose(e % 3, 128, 256, 512),
        "key_distillation_success": e % 9 != 0,
        "avg_wind_speed": v / 50,
        "avg_temperature": v / 10,
        "avg_humidity": v / 5,
        "precipitation_during_pass": e % 10 == 0,
        "dome_closed_during_pass": e % 4 == 0,
        "notes": kind,
    }


def _alert(alert_id: Column, moment: Column, related: Column) -> Column:
    e, u, _, _, kind = _event()
    values = {
        "timestamp": moment,
        "alert_id": alert_id,
        "severity": F.when(e % 13 == 0, "info").otherwise(_choose(e % 2, "warning", "critical")),
        "severity_code": (e % 2 + 2).cast("int"),
        "component": _choose(e % 3, "weather_monitoring", "link_tracking", "dome_control"),
        "component_id": F.concat(F.lit("SCU-0"), (e % 3 + 1).cast("string")),
        "description": F.concat(kind, F.lit(" "), u.cast("string")),
        "action_taken": F.lit("logged"),
        "related_pass_id": related,
    }
    return assemble.alert_item(values.__getitem__)


def _alerts() -> Column:
    """Errors raise one or two alerts. Ids repeat or are missing; the pass is the own one,
    the next one, an unknown one or none; every other second alert has no time."""
    e, _, _, ts, kind = _event()
    related = _choose(
        e % 5, F.concat(F.lit("unknown-"), e.cast("string")), F.lit(None).cast("string"), _pass(1), _pass(), _pass()
    )
    first = _alert(F.when(e % 50 != 3, F.md5((e % 500).cast("string"))), ts, related)
    second = _alert(
        F.md5(F.concat(F.lit("second-"), e.cast("string"))), F.when(e % 6 != 0, ts), _pass()
    )
    none = F.filter(F.array(first), lambda _: F.lit(False))
    return (
        F.when(kind != "error", none).when(e % 3 == 0, F.array(first, second)).otherwise(F.array(first))
    )


def _planned(offset: int, minutes: int, pass_id: Column) -> Column:
    e, u, v, ts, _ = _event()
    values = {
        "pass_id": pass_id,
        "satellite_id": F.concat(F.lit("SAT-"), (u % 2 + 1).cast("string")),
        "start_time": ts + F.make_dt_interval(mins=F.lit(minutes)),
        "end_time": ts + F.make_dt_interval(mins=F.lit(minutes + 15)),
        "max_elevation": v / 7 + offset,
        "predicted_wind_speed": v / 50 + offset,
        "predicted_precipitation": e % 10 == offset,
        "predicted_cloud_cover": (e % 20 + offset).cast("int"),
        "estimated_qber": v / 10000,
        "estimated_keys": (u + offset).cast("int"),
        "pass_viable": e % 6 != offset,
    }
    return assemble.planned_pass(values.__getitem__)


def _schedule() -> Column:
    e, u, _, ts, _ = _event()
    planned = F.array(
        _planned(1, 10, _pass(1)),
        _planned(2, 110, F.when(e % 40 != 5, _pass(2))),
    )
    return assemble.schedule_section(F.concat(F.lit("OGS-00"), (u % 3 + 1).cast("string")), ts, planned)


def _damaged(section: Column, index: int) -> Column:
    """Every 50th delivery lacks one section, the sections taking turns."""
    e, *_ = _event()
    lost = (e % 50 == 0) & (_div(e, 50) % len(SECTIONS) == index)
    return F.when(~lost, section)


def package_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file_name, ord, document: one JSON package per event."""
    return _landed(spark, sf_dir, "packages", lambda: _derive_documents(spark, sf_dir))


def event_pair() -> Column:
    """The number of a package: both its deliveries have it."""
    e, *_ = _event()
    return _div(e, 2)


def land_documents(spark: SparkSession, sf_dir: str, path: str, third: int) -> None:
    """One third of the documents as merged files, one a line, gzipped and in order.

    Both deliveries of a package land in one file. The events are brought into order, not the
    documents made of them, so what is shuffled and sorted is a small row; the files grow in
    number with the table, so that no task holds more than so many.
    """
    rows = read_table(spark, f"{sf_dir}/events.parquet")
    pairs, count = rows.agg(F.max(event_pair()) + 1, F.count(F.lit(1))).first()
    part = rows.where(F.floor(event_pair() * 3 / F.lit(pairs)) == third)
    files = max(LEAST_FILES, -(-count // (3 * DOCUMENTS_PER_FILE)))
    ordered = part.repartitionByRange(files, event_pair()).sortWithinPartitions("event_id")
    _documents_of(ordered).select("document").write.mode("append").option("compression", "gzip").text(path)


def _derive_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents_of(events(spark, sf_dir))


def _documents_of(rows: DataFrame) -> DataFrame:
    e, u, *_ = _event()
    sections = {
        "environment": assemble.nested(assemble.ENVIRONMENT_COLUMNS, environment_values().__getitem__),
        "link": assemble.nested(assemble.LINK_COLUMNS, link_values().__getitem__),
        "summary": assemble.nested(assemble.SUMMARY_COLUMNS, summary_values().__getitem__),
        "alerts": assemble.alerts_section(_alerts()),
        "schedule": _schedule(),
    }
    document = assemble.package_document(
        F.date_format(_package_time(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        F.concat(F.lit("collector-"), (u % 4).cast("string")),
        F.lit("http://station:5000"),
        {name: _damaged(section, i) for i, (name, section) in enumerate(sections.items())},
        F.lit("operational"),
        F.when(e > 0, F.date_format(delivery_time(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")),
        e.cast("int"),
    )
    built = computed_once(rows, whole=document)
    # Every 50th + 7 delivery comes before its producer's first update: its sections are
    # `{}`, but for the alert list.
    struct = r"\{(?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*\}"
    empty = F.regexp_replace("whole", rf'"(environment|link|summary|schedule)":{struct}', '"$1":{}')
    return built.select(
        assemble.file_name(delivery_time()).alias("file_name"),
        e.alias("ord"),
        F.when(e % 50 == 7, empty).otherwise(F.col("whole")).alias("document"),
    )


def packages(spark: SparkSession, sf_dir: str, *sections: str) -> DataFrame:
    """The packages, parsed; with `sections` only those."""
    return parse_documents(package_documents(spark, sf_dir), list(sections or SECTIONS))
