"""Packages from table rows: the way back from flat columns to the nested document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.asof import MOMENT, Series, Stream, asof, last_rows
from skyledger.schemas import (
    ALERT_COLUMNS,
    ENVIRONMENT_COLUMNS,
    LINK_COLUMNS,
    SCHEDULED_PASS_COLUMNS,
    SECTIONS,
    SUMMARY_COLUMNS,
    Mapping,
)

FILE_TIME = "yyyyMMdd_HHmmss"
DOCUMENT_TIME = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def file_name(moment: Column) -> Column:
    """Name under which a package of that time lands."""
    return F.concat(F.lit("package_"), F.date_format(moment, FILE_TIME), F.lit(".json"))


def document_time(moment: Column) -> Column:
    return F.date_format(moment, DOCUMENT_TIME)


def nested(mappings: list[Mapping], value=F.col) -> Column:
    """A section out of flat columns, nested along the paths of the mapping."""
    tree: dict = {}
    for m in mappings:
        *parents, leaf = m.path.split(".")
        node = tree
        for parent in parents:
            node = node.setdefault(parent, {})
        column = value(m.column)
        node[leaf] = document_time(column) if m.is_time else column

    def build(node: dict) -> Column:
        return F.struct(
            *[(build(v) if isinstance(v, dict) else v).alias(name) for name, v in node.items()]
        )

    return build(tree)


def environment_section() -> Column:
    return nested(ENVIRONMENT_COLUMNS)


def link_section() -> Column:
    return nested(LINK_COLUMNS)


def summary_section() -> Column:
    return nested(SUMMARY_COLUMNS)


def alert_item(value=F.col) -> Column:
    return nested(ALERT_COLUMNS, value)


def alerts_section(items: Column) -> Column:
    """The alert list with its length."""
    return F.struct(items.alias("alerts"), F.size(items).alias("count"))


def planned_pass(value=F.col) -> Column:
    return nested(SCHEDULED_PASS_COLUMNS, value)


def schedule_section(ogs_id: Column, generated_at: Column, passes: Column) -> Column:
    return F.struct(
        document_time(generated_at).alias("generated_at"),
        ogs_id.alias("ogs_id"),
        passes.alias("scheduled_passes"),
    )


def package_document(
    package_timestamp: Column,
    collector_id: Column,
    ogs_provider: Column,
    sections: dict[str, Column],
    collector_status: Column,
    last_fetch: Column,
    total_fetches: Column,
) -> Column:
    """JSON text of a package; an absent section is written as null."""
    document = F.struct(
        package_timestamp.alias("package_timestamp"),
        collector_id.alias("collector_id"),
        ogs_provider.alias("ogs_provider"),
        F.struct(*[section.alias(name) for name, section in sections.items()]).alias("data"),
        F.struct(
            collector_status.alias("collector_status"),
            last_fetch.alias("last_fetch"),
            total_fetches.alias("total_fetches"),
        ).alias("logs"),
    )
    return F.to_json(document, {"ignoreNullFields": "false"})


def _upto(rows: DataFrame, moment: str, at: Column) -> DataFrame:
    return rows.where(F.col(moment) <= at)


def _newest(rows: DataFrame, moment: str, item: Column) -> Column:
    """The section of the newest row as a one-value subquery."""
    return rows.orderBy(F.desc(moment), F.desc("ord")).limit(1).select(item).scalar()


def _newest_plan(schedule: DataFrame) -> Column:
    """The schedule section of the newest plan, with all its passes in their order.

    A plan is what one delivery brought; the passes of that one are gathered.
    """
    place = F.struct("generated_at", F.col("ord.delivery_ord").alias("delivery"))
    newest = schedule.agg(F.max(place)).scalar()
    passes = F.array_sort(F.collect_list(F.struct(F.col("ord.pos").alias("pos"), planned_pass().alias("planned"))))
    gathered = schedule.where(place == newest).agg(
        F.any_value("ogs_id").alias("ogs_id"),
        F.max("generated_at").alias("generated_at"),
        F.transform(passes, lambda p: p["planned"]).alias("passes"),
    )
    section = schedule_section(F.col("ogs_id"), F.col("generated_at"), F.col("passes"))
    return gathered.where(F.size("passes") > 0).select(section).scalar()


def snapshot(
    environment: DataFrame,
    link: DataFrame,
    summaries: DataFrame,
    stored_alerts: DataFrame,
    schedule: DataFrame,
    collector: DataFrame,
    at,
    buffer: int = 10,
) -> DataFrame:
    """The package a collector would write at time `at`: the newest row of each section up
    to then, the last `buffer` alerts and all passes of the newest plan. One row: file_name,
    document."""
    spark = environment.sparkSession
    moment = F.lit(str(at)).cast("timestamp_ntz")
    recent = _upto(stored_alerts, "timestamp", moment).orderBy(F.desc("timestamp"), F.desc("ord")).limit(buffer)
    ordered = F.reverse(F.array_sort(F.collect_list(F.struct("timestamp", "ord", alert_item().alias("item")))))
    items = recent.agg(F.transform(ordered, lambda r: r["item"])).scalar()
    sections = {
        "environment": _newest(_upto(environment, "timestamp", moment), "timestamp", environment_section()),
        "link": _newest(_upto(link, "timestamp", moment), "timestamp", link_section()),
        "summary": _newest(_upto(summaries, "end_time", moment), "end_time", summary_section()),
        "alerts": alerts_section(items),
        "schedule": _newest_plan(_upto(schedule, "generated_at", moment)),
    }
    status = _newest(_upto(collector, "last_fetch", moment), "last_fetch", _status())
    base = spark.range(1).select(
        moment.alias(MOMENT),
        status.alias("status"),
        *[section.alias(name) for name, section in sections.items()],
    )
    return base.select(file_name(F.col(MOMENT)).alias("file_name"), _written().alias("document"))


def _status() -> Column:
    return F.struct("collector_id", "ogs_provider", "collector_status", "last_fetch", "total_fetches")


def _written() -> Column:
    """The document of a row of sections, collector status and moment."""
    return package_document(
        document_time(F.col(MOMENT)),
        F.col("status.collector_id"),
        F.col("status.ogs_provider"),
        {name: F.col(name) for name in SECTIONS},
        F.col("status.collector_status"),
        document_time(F.col("status.last_fetch")),
        F.col("status.total_fetches"),
    )


def plans(schedule: DataFrame, by: list[str] = ()) -> DataFrame:
    """One row per plan that has passes: generated_at, ord, and the section with its passes in
    their order. A plan is what one delivery brought at one time."""
    passes = F.array_sort(F.collect_list(F.struct(F.col("ord.pos").alias("pos"), planned_pass().alias("planned"))))
    key = [*by, "generated_at", F.col("ord.delivery_ord").alias("delivery")]
    gathered = schedule.groupBy(*key).agg(
        F.min_by("ogs_id", "ord").alias("ogs_id"), F.transform(passes, lambda p: p["planned"]).alias("passes")
    )
    section = schedule_section(F.col("ogs_id"), F.col("generated_at"), F.col("passes"))
    return gathered.select(*by, "generated_at", F.col("delivery").alias("ord"), section.alias("section"))


def package_series(
    environment: DataFrame,
    link: DataFrame,
    summaries: DataFrame,
    stored_alerts: DataFrame,
    schedule: DataFrame,
    collector: DataFrame,
    series: Series,
    stations: DataFrame | None = None,
    buffer: int = 10,
) -> DataFrame:
    """The packages a collector would write at each moment of a series, as `snapshot` does for
    one: (station columns,) moment, file_name, document.

    `stations` has one row per station; all inputs then have its columns, and each station has
    documents of its own. Without it there is one station, whose rows need no mark.
    """
    if stations is None:
        stations = environment.sparkSession.range(1).select()
    by = stations.columns
    alerts = last_rows(series, stored_alerts, "timestamp", alert_item(), buffer, stations)
    found = asof(
        series,
        {
            "environment": Stream(environment, "timestamp", environment_section()),
            "link": Stream(link, "timestamp", link_section()),
            "summary": Stream(summaries, "end_time", summary_section()),
            "recent": alerts,
            "schedule": Stream(plans(schedule, by), "generated_at", F.col("section")),
            "status": Stream(collector, "last_fetch", _status()),
        },
        stations,
    )
    no_alerts = F.array().cast(found.schema["recent"].dataType)
    told = found.withColumn("alerts", alerts_section(F.coalesce("recent", no_alerts)))
    return told.select(*by, MOMENT, file_name(F.col(MOMENT)).alias("file_name"), _written().alias("document"))
