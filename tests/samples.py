"""Sample log lines and packages."""

import copy
import json

PREFIX = "2024-01-01T10:00:00.000000+0000 SiteId: 101  INFO 26 [quartzScheduler_Worker-1] c.e.q.k.k.KeyPoolServiceImpl : "
IDENTITY = "550e8400-e29b-41d4-a716-446655440000"


def created(identity=IDENTITY, sequence=12345, source=101, destination=102, pool="PUBLIC", prefix=PREFIX):
    return (
        f"{prefix}createKey: KeyPoolService successfully created key with identity = '{identity}', "
        f"sequence number {sequence}, and KeyPool {{Source site identity = '{source}', "
        f"Destination site identity = '{destination}', and KeyPoolType name = '{pool}'}}"
    )


LATENCY = PREFIX + "METRIC_KEY_SYNC_LATENCY MS=150"
COUNT = PREFIX + "METRIC_RECEIVED_PUBLIC_KEY_COUNT BITS=12800 KEYS=50"
SYNC = PREFIX + "KeyPoolController : Handling qnl db sync with remote site 102"


def at(time, text="SiteId: 101  INFO 26 [w] x : METRIC_KEY_SYNC_LATENCY MS=150"):
    return f"{time} {text}"


ENVIRONMENT = {
    "timestamp": "2025-11-19T10:49:48Z",
    "ogs_id": "OGS-001",
    "dome_status": {"is_open": True, "last_opened": "2025-11-19T10:40:00Z", "anomaly_detected": False},
    "weather": {
        "wind_speed_mps": 3.5, "wind_direction_deg": 120, "brightness_lux": 25000, "precipitation": False,
        "temperature_c": 20.25, "humidity_percent": 45.5, "air_pressure_hpa": 1012.0,
        "cloud_cover_percent": -5, "source_station": "weather_station_1",
    },
}
LINK = {
    "timestamp": "2025-11-19T10:49:48.123456Z",
    "pass_id": "pass-1",
    "link_status": {
        "quantum": {
            "locked": True, "tracking_status": "LOCKED", "qber": 0.0151, "link_power_margin_dB": 3.1,
            "received_power_dBm": -43.5, "uplink_power_dBm": -42.0,
        },
        "classical_fso": {"uplink_power_dBm": -10.5, "downlink_power_dBm": -11.2, "status": "active"},
    },
}
SUMMARY = {
    "pass_id": "pass-1", "satellite_id": "SAT-1", "start_time": "2025-11-19T10:34:48.5Z",
    "end_time": "2025-11-19T10:49:48Z",
    "link_lock": {"total_duration_sec": 900, "locked_duration_sec": 855, "lock_percentage": 95.0},
    "tracking_summary": {"lost_tracking_events": 1, "avg_tracking_stability_percent": 97.0},
    "weather_conditions": {
        "avg_wind_speed_mps": 4.5, "avg_temperature_c": 22.0, "avg_humidity_percent": 50.0,
        "precipitation_during_pass": False, "cloud_cover_percent": 10,
    },
    "dome_closed_during_pass": False,
    "key_distillation": {"keys_distilled": 110, "key_size_bits": 256, "success": True},
    "anomalies_detected": [], "notes": "first",
}
ALERT = {
    "timestamp": "2025-11-19T10:49:00Z", "alert_id": "a-1", "severity": "warning", "severity_code": 2,
    "component": "dome_control", "component_id": "SCU-01", "description": "d", "action_taken": "t",
    "related_pass_id": "pass-1",
}
PLANNED = {
    "pass_id": "pass-9", "satellite_id": "SAT-1", "start_time": "2025-11-19T11:00:00.1Z",
    "end_time": "2025-11-19T11:15:00Z", "max_elevation_deg": 70.0,
    "predicted_weather": {"wind_speed_mps": 4.0, "precipitation": False, "cloud_cover_percent": 5},
    "estimated_qber": 0.015, "estimated_keys": 120, "pass_viable": True,
}


def package(number, **sections):
    """Package number `number`; a section given as None is null, one not given is the sample."""
    data = {
        "environment": ENVIRONMENT, "link": LINK, "summary": SUMMARY,
        "alerts": {"alerts": [], "count": 0},
        "schedule": {"generated_at": "2025-11-19T10:49:48Z", "ogs_id": "OGS-001", "scheduled_passes": [PLANNED]},
    }
    data.update(sections)
    return copy.deepcopy(
        {
            "package_timestamp": f"2025-11-19T10:00:{number:02d}.000001Z",
            "collector_id": "log_collector_001",
            "ogs_provider": "http://station:5000",
            "data": data,
            "logs": {"collector_status": "operational", "last_fetch": None, "total_fetches": number},
        }
    )


def alerts(*items):
    return {"alerts": list(items), "count": len(items)}


def documents(spark, packages):
    """Rows file_name, ord, document out of package dicts or texts, in list order."""
    rows = [
        (f"package_20251119_{i:06d}.json", i, p if isinstance(p, str) else json.dumps(p, indent=2))
        for i, p in enumerate(packages)
    ]
    return spark.createDataFrame(rows, "file_name string, ord long, document string").repartition(3)


def write_packages(folder, packages, start=0):
    """One pretty-printed file per package, renamed into place."""
    folder.mkdir(parents=True, exist_ok=True)
    for i, p in enumerate(packages, start):
        part = folder / f".{i}.part"
        part.write_text(p if isinstance(p, str) else json.dumps(p, indent=2))
        part.rename(folder / f"package_20251119_{i:06d}.json")
