"""Settings of the two-stream pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PipelineConfig:
    """Where messages come from and where tables and checkpoints go.

    ``buckets`` and ``files_per_bucket`` size the keyed tables: a table has up to
    ``buckets * files_per_bucket`` files, and each bucket is the unit that an
    upsert rewrites. Pick them so that a file is about 256 MB.
    """

    warehouse: str
    checkpoints: str
    messages: str | None = None
    bootstrap_servers: str | None = None
    database: str = "ev_db"
    # Topic and table names other programs already use.
    location_topic: str = "electric-vehicle-location"
    evdata_topic: str = "electric-vehicle-evdata"
    location_table: str = "ev_location_data"
    evdata_table: str = "ev_data"
    aggregate_table: str = "ev_aggregation"
    trigger: str = "10 seconds"
    buckets: int = 32
    files_per_bucket: int = 1
    aggregate_buckets: int = 8
    keep_snapshots: int = 10
    keep_seconds: float = 3600
    max_files_per_trigger: int | None = 1000
    max_offsets_per_trigger: int | None = 10_000_000
    source_options: dict[str, str] = field(default_factory=dict)

    def table_path(self, table: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{self.database}.db/{table}"

    def checkpoint_path(self, table: str) -> str:
        return f"{self.checkpoints.rstrip('/')}/{table}"

    def qualified(self, table: str) -> str:
        return f"{self.database}.{table}"
