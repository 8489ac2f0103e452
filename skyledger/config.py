"""Settings of a deployment."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PipelineSettings:
    """One ingest pipeline: where it reads, how often it fires, whether it runs, and where the
    files go that are done; without an archive they stay."""

    landing: str
    interval: str
    enabled: bool = True
    max_files_per_trigger: int = 10_000
    archive: str | None = None


@dataclass(frozen=True)
class Settings:
    """A whole deployment. `warehouse` holds every table, `checkpoints` the progress.

    `rollups` reads what `keypool` has stored and keeps its daily views.
    """

    warehouse: str
    checkpoints: str
    keypool: PipelineSettings
    station: PipelineSettings
    rollups: PipelineSettings
    collation: str | None = None


# Trigger intervals of the two pipelines.
KEYPOOL_INTERVAL = "30 seconds"
STATION_INTERVAL = "15 seconds"


def default_settings(root: str, keypool: bool = True, station: bool = True, rollups: bool = False) -> Settings:
    """The usual folder layout below one root."""
    return Settings(
        warehouse=f"{root}/tables",
        checkpoints=f"{root}/progress",
        keypool=PipelineSettings(f"{root}/landing/logs", KEYPOOL_INTERVAL, keypool),
        station=PipelineSettings(f"{root}/landing/packages", STATION_INTERVAL, station),
        rollups=PipelineSettings(f"{root}/tables", KEYPOOL_INTERVAL, rollups),
    )
