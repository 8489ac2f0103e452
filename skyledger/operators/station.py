"""Station packages: settle deliveries, flatten sections, enforce keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.rows import collated, spread_key
from skyledger.functions.times import package_time
from skyledger.operators.fold import FIRST_ORD, fold
from skyledger.schemas import (
    ALERT_COLUMNS,
    ENVIRONMENT_COLUMNS,
    LINK_COLUMNS,
    REQUIRED_COLUMNS,
    SCHEDULED_PASS_COLUMNS,
    SECTIONS,
    SUMMARY_COLUMNS,
    UPSERT_KEYS,
    UPSERT_REPLACES,
    Mapping,
)

CHECKED_SECTIONS = ["environment", "link", "summary", "alerts"]
DELIVERY = "delivery_ord"

# Fixed value: alerts a package carries.
BUFFERED_ALERTS = 10


def _flat(section: str, mappings: list[Mapping]) -> list[Column]:
    columns = []
    for m in mappings:
        value = F.col(f"{section}.{m.path}")
        columns.append((package_time(value) if m.is_time else value).alias(m.column))
    return columns


def complete(table: str) -> Column:
    """True when every column the table requires has a value."""
    condition = F.lit(True)
    for name in REQUIRED_COLUMNS[table]:
        condition = condition & F.col(name).isNotNull()
    return condition


# ---------------------------------------------------------------- package status


def section_ok(section: str) -> Column:
    """Whether a section can be stored. A missing section and an empty one look alike:
    their required values are NULL. An empty alert list is fine."""
    if section == "environment":
        return (
            package_time(F.col("environment.timestamp")).isNotNull()
            & F.col("environment.ogs_id").isNotNull()
        )
    if section == "link":
        return package_time(F.col("link.timestamp")).isNotNull()
    if section == "summary":
        return F.col("summary.pass_id").isNotNull()
    if section == "schedule":
        return F.col("schedule.scheduled_passes").isNotNull()
    return F.col(section).isNotNull()


def package_status(packages: DataFrame) -> DataFrame:
    """Per delivery: one flag per checked section and their conjunction."""
    flags = packages.select(
        "ord",
        "file_name",
        "package_timestamp",
        "collector_id",
        *[section_ok(s).alias(f"{s}_ok") for s in CHECKED_SECTIONS],
    )
    every = F.col("environment_ok") & F.col("link_ok") & F.col("summary_ok") & F.col("alerts_ok")
    return flags.withColumn("package_ok", every)


def ingest_counters(packages: DataFrame) -> DataFrame:
    """Packages done, packages not done, and the time of the newest done one.

    A package delivered several times is done once any delivery is valid.
    """
    per_package = (
        package_status(packages)
        .groupBy("package_timestamp", F.when(F.col("package_timestamp").isNull(), F.col("ord")))
        .agg(F.bool_or("package_ok").alias("done"))
    )
    moment = package_time(F.col("package_timestamp"))
    return per_package.agg(
        F.count_if("done").alias("total_processed"),
        F.count_if(~F.col("done")).alias("failed"),
        F.max(F.when(F.col("done"), moment)).alias("last_process"),
    )


# ---------------------------------------------------------------- de-duplication


def _package_key(order: Column) -> list[Column]:
    """A package, and for a delivery without a package time the delivery itself."""
    return [F.col("package_timestamp"), F.when(F.col("package_timestamp").isNull(), order).alias("_loose")]


def settled_order(packages: DataFrame) -> DataFrame:
    """One row per package_timestamp: the delivery each section is taken from.

    Each section comes from its first storable delivery, so a repeated delivery adds nothing,
    and a section that failed at first is taken from the delivery that has it; with none
    storable, from the first. Deliveries without a package_timestamp cannot repeat and are all
    kept. Flags and order numbers alone are folded, by plain minima, before anything is shuffled.
    """
    order = F.col("ord")
    present = [s for s in SECTIONS if s in packages.columns]
    chosen = [
        F.coalesce(F.min(F.when(section_ok(s), order)), F.min(order)).alias(f"{s}_ord") for s in present
    ]
    head = F.min(F.struct(order, "file_name", "collector_id", "ogs_provider")).alias("_head")
    grouped = packages.groupBy(*_package_key(order)).agg(
        head, F.count(F.lit(1)).alias("deliveries"), *chosen
    )
    return grouped.select(
        "package_timestamp",
        "_head.file_name",
        "_head.ord",
        "_head.collector_id",
        "_head.ogs_provider",
        "deliveries",
        *[f"{s}_ord" for s in present],
    )


def settle(packages: DataFrame) -> DataFrame:
    """One row per package_timestamp: each section from its first storable delivery.

    A repeated delivery adds nothing, and a section that failed at first is taken from
    the delivery that has it. `<section>_ord` is the delivery a section came from.
    Deliveries without a package_timestamp cannot repeat and are all kept. The choice is
    a minimum, so repeats fold on the map side before anything is shuffled.
    """
    order = F.col("ord")
    present = [s for s in SECTIONS if s in packages.columns]
    best = []
    for section in present:
        rank = F.struct((~section_ok(section)).alias("bad"), order.alias("ord"))
        chosen = F.min_by(F.struct(F.col(section), order.alias(f"{section}_ord")), rank)
        best.append(chosen.alias(f"_{section}"))
    head = ["file_name", "ord", "collector_id", "ogs_provider", "logs"]
    grouped = packages.groupBy(
        "package_timestamp", F.when(F.col("package_timestamp").isNull(), order).alias("_loose")
    ).agg(
        F.min_by(F.struct(*head), order).alias("_head"),
        F.count(F.lit(1)).alias("deliveries"),
        *best,
    )
    return grouped.select(
        "package_timestamp", "_head.*", "deliveries", *[f"_{s}.*" for s in present]
    )


# ---------------------------------------------------------------- flattening


def environment_rows(settled: DataFrame) -> DataFrame:
    """Weather and dome readings; one row per package with a storable section."""
    rows = settled.select(
        F.col("environment_ord").alias("ord"), *_flat("environment", ENVIRONMENT_COLUMNS)
    )
    return rows.where(complete("ogs_environment_data"))


def link_rows(settled: DataFrame) -> DataFrame:
    """Quantum and classical link readings."""
    rows = settled.select(F.col("link_ord").alias("ord"), *_flat("link", LINK_COLUMNS))
    return rows.where(complete("ogs_link_data"))


def summary_rows(settled: DataFrame) -> DataFrame:
    """Pass summaries as delivered, before the upsert."""
    rows = settled.select(F.col("summary_ord").alias("ord"), *_flat("summary", SUMMARY_COLUMNS))
    return rows.where(complete("ogs_pass_summary"))


def _alert_items(settled: DataFrame) -> DataFrame:
    items = settled.select(
        F.col("alerts_ord").alias(DELIVERY), F.posexplode("alerts.alerts").alias("pos", "alert")
    )
    return items.select(
        DELIVERY, F.struct(DELIVERY, "pos").alias("ord"), *_flat("alert", ALERT_COLUMNS)
    )


def alert_rows(settled: DataFrame) -> DataFrame:
    """Alert occurrences, in package order and then list order."""
    return _alert_items(settled).where(complete("ogs_alerts"))


def offered_alerts(deliveries: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Alert occurrences of all deliveries that were processed.

    A package is retried whole until one delivery of it is done, so each delivery up to that
    one offers its alerts; repeats of an id fall away when alerts are stored. An alert without
    an id cannot be told from its repeat and counts in the first delivery with alerts only.
    `known` has package_timestamp, package_done and alerts_done of earlier batches.
    """
    order, every = F.col("ord"), F.lit(True)
    for section in CHECKED_SECTIONS:
        every = every & F.coalesce(section_ok(section), F.lit(False))
    has_alerts = F.coalesce(section_ok("alerts"), F.lit(False))
    told = deliveries.select(
        *_package_key(order), "ord", every.alias("_ok"), has_alerts.alias("_has"), F.col("alerts")
    )
    key = ["package_timestamp", "_loose"]
    firsts = told.groupBy(*key).agg(
        F.min(F.when(F.col("_ok"), order)).alias("_done"),
        F.min(F.when(F.col("_has"), order)).alias("_first"),
    )
    # NULL package times meet nothing here, and need not: each such delivery stands alone.
    later = firsts.where("package_timestamp IS NOT NULL").drop("_loose")
    joined = told.where("_has").join(later, "package_timestamp", "left")
    if known is None:
        joined = joined.withColumns({"package_done": F.lit(False), "alerts_done": F.lit(False)})
    else:
        joined = joined.join(known.select("package_timestamp", "package_done", "alerts_done"), "package_timestamp", "left")
    no = F.lit(False)
    offered = joined.where(
        ~F.coalesce("package_done", no) & (F.col("_done").isNull() | (order <= F.col("_done")))
    )
    first = (F.coalesce(F.col("_first"), order) == order) & ~F.coalesce("alerts_done", no)
    shaped = offered.select(F.col("ord").alias("alerts_ord"), "alerts", first.alias("_is_first"))
    items = shaped.select(
        F.col("alerts_ord").alias(DELIVERY), "_is_first", F.posexplode("alerts.alerts").alias("pos", "alert")
    )
    rows = items.select(DELIVERY, "_is_first", F.struct(DELIVERY, "pos").alias("ord"), *_flat("alert", ALERT_COLUMNS))
    kept = rows.where(F.col("alert_id").isNotNull() | F.col("_is_first")).drop("_is_first")
    return kept.where(complete("ogs_alerts"))


def _schedule_items(settled: DataFrame) -> DataFrame:
    items = settled.select(
        F.col("schedule_ord").alias(DELIVERY),
        F.col("schedule.ogs_id").alias("ogs_id"),
        package_time(F.col("schedule.generated_at")).alias("generated_at"),
        F.posexplode("schedule.scheduled_passes").alias("pos", "planned"),
    )
    return items.select(
        F.struct(DELIVERY, "pos").alias("ord"),
        "ogs_id",
        "generated_at",
        *_flat("planned", SCHEDULED_PASS_COLUMNS),
    )


def schedule_rows(settled: DataFrame) -> DataFrame:
    """Planned passes as delivered, before the upsert."""
    return _schedule_items(settled).where(complete("ogs_pass_schedule"))


def collector_rows(packages: DataFrame) -> DataFrame:
    """The collector's own status, one row per delivery."""
    return packages.select(
        "ord",
        "package_timestamp",
        "collector_id",
        "ogs_provider",
        F.col("logs.collector_status").alias("collector_status"),
        package_time(F.col("logs.last_fetch")).alias("last_fetch"),
        F.col("logs.total_fetches").alias("total_fetches"),
    )


# ---------------------------------------------------------------- keyed tables


def pass_summary(rows: DataFrame, collation: str | None = None, with_order: bool = False) -> DataFrame:
    """One row per pass: a repeat replaces end time, lock share and key count."""
    table = "ogs_pass_summary"
    return fold(rows, UPSERT_KEYS[table], "ord", UPSERT_REPLACES[table], collation, with_order)


def pass_schedule(rows: DataFrame, collation: str | None = None) -> DataFrame:
    """One row per planned pass: a repeat replaces the forecasts and their time."""
    table = "ogs_pass_schedule"
    return fold(rows, UPSERT_KEYS[table], "ord", UPSERT_REPLACES[table], collation)


def first_seen_passes(summaries: DataFrame, collation: str | None = None) -> DataFrame:
    """When each pass first entered the summary table. Narrow, one row per pass."""
    key = collated(F.col("pass_id"), collation).alias("pass_id")
    return summaries.groupBy(key).agg(F.min("ord").alias(FIRST_ORD))


def linked_alerts(
    occurrences: DataFrame, passes: DataFrame, collation: str | None = None
) -> DataFrame:
    """Alert occurrences whose pass was known when they arrived, or that name none.

    `passes` is (pass_id, first_ord), one row per pass. It grows with the data, so no
    broadcast is asked for: AQE broadcasts it if it has measured it as small, and else
    sorts, merges and cuts the partitions of a hot pass into pieces. Alerts without a
    pass are spread over all tasks by a made-up name; they stay whatever it meets.
    """
    name, own = "_pass", F.col("related_pass_id")
    key = collated(spread_key(own, F.col("ord")), collation)
    first = passes.select(F.col("pass_id").alias(name), FIRST_ORD)
    joined = occurrences.withColumn(name, key).join(first, name, "left")
    kept = joined.where(own.isNull() | (F.col(DELIVERY) >= F.col(FIRST_ORD)))
    return kept.select(*occurrences.columns)


def alerts(
    occurrences: DataFrame, passes: DataFrame, collation: str | None = None, with_order: bool = False
) -> DataFrame:
    """Stored alerts: the first linked occurrence per alert id; alerts without id all."""
    linked = linked_alerts(occurrences, passes, collation).drop(DELIVERY)
    return fold(linked, UPSERT_KEYS["ogs_alerts"], collation=collation, with_order=with_order)


def recent_alert_buffer(stored: DataFrame, size: int = BUFFERED_ALERTS) -> DataFrame:
    """The newest alerts, newest first, with their number."""
    newest = stored.orderBy(F.desc("timestamp"), F.desc("ord")).limit(size).drop("ord")
    # The window spans the limited rows only.
    return newest.withColumn("count", F.count(F.lit(1)).over(Window.partitionBy()))


# ---------------------------------------------------------------- ledger


def bare_sections(packages: DataFrame, *sections: str) -> DataFrame:
    """Deliveries whose sections are emptied but for the values that tell whether they can be
    stored and how many rows they hold; with `sections` only those are.

    `package_status`, `package_ledger` and what is settled for them say the same of both, and
    sort and shuffle rows of some hundred bytes.
    """
    moments = F.transform("alerts.alerts", lambda a: F.struct(a["timestamp"].alias("timestamp")))
    plans = F.transform("schedule.scheduled_passes", lambda _: F.lit(True))
    told = {
        "environment": F.struct("environment.timestamp", "environment.ogs_id"),
        "link": F.struct("link.timestamp"),
        "summary": F.struct("summary.pass_id"),
        "alerts": F.struct(moments.alias("alerts")),
        "schedule": F.struct(plans.alias("scheduled_passes")),
    }
    return packages.withColumns({s: F.when(F.col(s).isNotNull(), told[s]) for s in sections or SECTIONS})


def package_ledger(settled: DataFrame) -> DataFrame:
    """Settled packages with the number of rows each put into the station tables."""
    storable_alerts = F.filter(
        "alerts.alerts", lambda a: package_time(a["timestamp"]).isNotNull()
    )
    flags = {s: F.coalesce(section_ok(s), F.lit(False)) for s in CHECKED_SECTIONS}
    inserted = (
        flags["environment"].cast("int")
        + flags["link"].cast("int")
        + flags["summary"].cast("int")
        + F.coalesce(F.size(storable_alerts), F.lit(0))
    )
    rows = settled.select(
        "package_timestamp",
        "collector_id",
        "deliveries",
        inserted.alias("records_inserted"),
        *[flags[s].alias(f"{s}_done") for s in CHECKED_SECTIONS],
        section_ok("schedule").alias("schedule_done"),
    )
    return rows.where(complete("ogs_processed_packages"))
