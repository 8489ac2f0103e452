"""Table shapes: the package document, the stored tables and the paths between them."""

from __future__ import annotations

from dataclasses import dataclass

# The package document.
ENVIRONMENT_DOCUMENT = """
timestamp string, ogs_id string,
dome_status struct<is_open: boolean, last_opened: string, anomaly_detected: boolean>,
weather struct<wind_speed_mps: double, wind_direction_deg: int, brightness_lux: int,
  precipitation: boolean, temperature_c: double, humidity_percent: double,
  air_pressure_hpa: double, cloud_cover_percent: int, source_station: string>
"""
LINK_DOCUMENT = """
timestamp string, pass_id string,
link_status struct<
  quantum: struct<locked: boolean, tracking_status: string, qber: double,
    link_power_margin_dB: double, received_power_dBm: double, uplink_power_dBm: double>,
  classical_fso: struct<uplink_power_dBm: double, downlink_power_dBm: double, status: string>>
"""
SUMMARY_DOCUMENT = """
pass_id string, satellite_id string, start_time string, end_time string,
link_lock struct<total_duration_sec: int, locked_duration_sec: int, lock_percentage: double>,
tracking_summary struct<lost_tracking_events: int, avg_tracking_stability_percent: double>,
weather_conditions struct<avg_wind_speed_mps: double, avg_temperature_c: double,
  avg_humidity_percent: double, precipitation_during_pass: boolean, cloud_cover_percent: int>,
dome_closed_during_pass boolean,
key_distillation struct<keys_distilled: int, key_size_bits: int, success: boolean>,
anomalies_detected array<string>, notes string
"""
ALERTS_DOCUMENT = """
alerts array<struct<timestamp: string, alert_id: string, severity: string,
  severity_code: int, component: string, component_id: string, description: string,
  action_taken: string, related_pass_id: string>>, count int
"""
SCHEDULE_DOCUMENT = """
generated_at string, ogs_id string,
scheduled_passes array<struct<pass_id: string, satellite_id: string, start_time: string,
  end_time: string, max_elevation_deg: double,
  predicted_weather: struct<wind_speed_mps: double, precipitation: boolean,
    cloud_cover_percent: int>,
  estimated_qber: double, estimated_keys: int, pass_viable: boolean>>
"""
LOGS_DOCUMENT = "collector_status string, last_fetch string, total_fetches int"

SECTION_DOCUMENTS = {
    "environment": ENVIRONMENT_DOCUMENT,
    "link": LINK_DOCUMENT,
    "summary": SUMMARY_DOCUMENT,
    "alerts": ALERTS_DOCUMENT,
    "schedule": SCHEDULE_DOCUMENT,
}
SECTIONS = list(SECTION_DOCUMENTS)


def package_schema(sections: list[str] = tuple(SECTIONS)) -> str:
    """Schema of a package, cut to the sections that are wanted; a parser skips the rest."""
    data = ", ".join(f"{name}: struct<{SECTION_DOCUMENTS[name]}>" for name in sections)
    return (
        "package_timestamp string, collector_id string, ogs_provider string, "
        f"data struct<{data}>, logs struct<{LOGS_DOCUMENT}>"
    )


@dataclass(frozen=True)
class Mapping:
    """One table column, the path it has in its section, and whether it is a time."""

    column: str
    path: str
    is_time: bool = False


# Table column, path in the document.
ENVIRONMENT_COLUMNS = [
    Mapping("timestamp", "timestamp", is_time=True),
    Mapping("ogs_id", "ogs_id"),
    Mapping("dome_open", "dome_status.is_open"),
    Mapping("dome_anomaly", "dome_status.anomaly_detected"),
    Mapping("temperature", "weather.temperature_c"),
    Mapping("wind_speed", "weather.wind_speed_mps"),
    Mapping("wind_direction", "weather.wind_direction_deg"),
    Mapping("humidity", "weather.humidity_percent"),
    Mapping("air_pressure", "weather.air_pressure_hpa"),
    Mapping("cloud_cover", "weather.cloud_cover_percent"),
    Mapping("precipitation", "weather.precipitation"),
    Mapping("brightness", "weather.brightness_lux"),
]
LINK_COLUMNS = [
    Mapping("timestamp", "timestamp", is_time=True),
    Mapping("pass_id", "pass_id"),
    Mapping("quantum_locked", "link_status.quantum.locked"),
    Mapping("tracking_status", "link_status.quantum.tracking_status"),
    Mapping("qber", "link_status.quantum.qber"),
    Mapping("link_power_margin", "link_status.quantum.link_power_margin_dB"),
    Mapping("received_power", "link_status.quantum.received_power_dBm"),
    Mapping("uplink_power", "link_status.quantum.uplink_power_dBm"),
    Mapping("fso_uplink_power", "link_status.classical_fso.uplink_power_dBm"),
    Mapping("fso_downlink_power", "link_status.classical_fso.downlink_power_dBm"),
    Mapping("fso_status", "link_status.classical_fso.status"),
]
SUMMARY_COLUMNS = [
    Mapping("pass_id", "pass_id"),
    Mapping("satellite_id", "satellite_id"),
    Mapping("start_time", "start_time", is_time=True),
    Mapping("end_time", "end_time", is_time=True),
    Mapping("total_duration_sec", "link_lock.total_duration_sec"),
    Mapping("locked_duration_sec", "link_lock.locked_duration_sec"),
    Mapping("lock_percentage", "link_lock.lock_percentage"),
    Mapping("lost_tracking_events", "tracking_summary.lost_tracking_events"),
    Mapping("avg_tracking_stability", "tracking_summary.avg_tracking_stability_percent"),
    Mapping("keys_distilled", "key_distillation.keys_distilled"),
    Mapping("key_size_bits", "key_distillation.key_size_bits"),
    Mapping("key_distillation_success", "key_distillation.success"),
    Mapping("avg_wind_speed", "weather_conditions.avg_wind_speed_mps"),
    Mapping("avg_temperature", "weather_conditions.avg_temperature_c"),
    Mapping("avg_humidity", "weather_conditions.avg_humidity_percent"),
    Mapping("precipitation_during_pass", "weather_conditions.precipitation_during_pass"),
    Mapping("dome_closed_during_pass", "dome_closed_during_pass"),
    Mapping("notes", "notes"),
]
ALERT_COLUMNS = [
    Mapping("timestamp", "timestamp", is_time=True),
    Mapping("alert_id", "alert_id"),
    Mapping("severity", "severity"),
    Mapping("severity_code", "severity_code"),
    Mapping("component", "component"),
    Mapping("component_id", "component_id"),
    Mapping("description", "description"),
    Mapping("action_taken", "action_taken"),
    Mapping("related_pass_id", "related_pass_id"),
]
SCHEDULED_PASS_COLUMNS = [
    Mapping("pass_id", "pass_id"),
    Mapping("satellite_id", "satellite_id"),
    Mapping("start_time", "start_time", is_time=True),
    Mapping("end_time", "end_time", is_time=True),
    Mapping("max_elevation", "max_elevation_deg"),
    Mapping("predicted_wind_speed", "predicted_weather.wind_speed_mps"),
    Mapping("predicted_precipitation", "predicted_weather.precipitation"),
    Mapping("predicted_cloud_cover", "predicted_weather.cloud_cover_percent"),
    Mapping("estimated_qber", "estimated_qber"),
    Mapping("estimated_keys", "estimated_keys"),
    Mapping("pass_viable", "pass_viable"),
]

# Columns of the key-pool tables.
KEYPOOL_TABLES = {
    "key_creations": [
        "key_identity",
        "sequence_number",
        "source_site_id",
        "destination_site_id",
        "key_pool_type",
        "timestamp",
        "log_file",
    ],
    "sync_latency_metrics": ["latency_ms", "timestamp", "log_file"],
    "key_count_metrics": ["bits", "keys_count", "timestamp", "log_file"],
    "controller_syncs": ["local_site_id", "remote_site_id", "timestamp", "log_file"],
}
FILE_LEDGER_COLUMNS = [
    "filename",
    "file_size",
    "total_lines",
    "key_creations_count",
    "sync_latency_count",
    "key_count_count",
    "controller_sync_count",
]

# Columns that may not be empty, per station table.
REQUIRED_COLUMNS = {
    "ogs_environment_data": ["timestamp", "ogs_id"],
    "ogs_link_data": ["timestamp"],
    "ogs_pass_summary": ["pass_id"],
    "ogs_alerts": ["timestamp"],
    "ogs_pass_schedule": ["pass_id"],
    "ogs_processed_packages": ["package_timestamp"],
}

# Which columns an upsert replaces; all others keep their first value.
UPSERT_REPLACES = {
    "key_creations": ["sequence_number"],
    "processed_files": ["file_size", "total_lines"],
    "ogs_pass_summary": ["end_time", "lock_percentage", "keys_distilled"],
    "ogs_pass_schedule": [
        "predicted_wind_speed",
        "predicted_precipitation",
        "predicted_cloud_cover",
        "estimated_qber",
        "estimated_keys",
        "generated_at",
    ],
    "ogs_alerts": [],
}
UPSERT_KEYS = {
    "key_creations": "key_identity",
    "processed_files": "filename",
    "ogs_pass_summary": "pass_id",
    "ogs_pass_schedule": "pass_id",
    "ogs_alerts": "alert_id",
}


def names(mappings: list[Mapping]) -> list[str]:
    return [m.column for m in mappings]


STATION_TABLES = {
    "ogs_environment_data": names(ENVIRONMENT_COLUMNS),
    "ogs_link_data": names(LINK_COLUMNS),
    "ogs_pass_summary": names(SUMMARY_COLUMNS),
    "ogs_alerts": names(ALERT_COLUMNS),
    "ogs_pass_schedule": ["ogs_id", "generated_at", *names(SCHEDULED_PASS_COLUMNS)],
}
