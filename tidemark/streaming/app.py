"""The two-stream application: keyed tables and the aggregate joined from them."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import PipelineConfig
from tidemark.functions.numeric import mean
from tidemark.operators.aggregates import RANGE_SUMS, range_parts
from tidemark.operators.joins import vehicle_join
from tidemark.operators.parse import judged_evdata, judged_location, valid_evdata, valid_location
from tidemark.schemas import AGGREGATE_SCHEMA, EVDATA, KEY, LOCATION
from tidemark.sources import catalog
from tidemark.sources.additive import AdditiveTable
from tidemark.sources.messages import message_batch, message_stream
from tidemark.sources.tables import PROGRESS, KeyedTable, Snapshot, SnapshotTable
from tidemark.streaming.progress import CONSUMED
from tidemark.streaming.writers import start_upserts

_GROUPS = T.StructType(AGGREGATE_SCHEMA.fields[:2])


def _replaced(old: Snapshot, new: Snapshot) -> set[int]:
    """Buckets that differ between two snapshots of a table."""
    return {int(b) for b in old.versions.keys() | new.versions.keys() if old.versions.get(b) != new.versions.get(b)}


class VehicleTables:
    """The location, vehicle and aggregate tables of one warehouse."""

    def __init__(self, spark: SparkSession, config: PipelineConfig):
        self.spark = spark
        self.config = config
        sizes = {
            "buckets": config.buckets,
            "files_per_bucket": config.files_per_bucket,
            "keep": config.keep_snapshots,
            "keep_seconds": config.keep_seconds,
        }
        self.location = KeyedTable(
            spark, config.table_path(config.location_table), LOCATION.table_schema, KEY, **sizes
        )
        self.evdata = KeyedTable(
            spark, config.table_path(config.evdata_table), EVDATA.table_schema, KEY, **sizes
        )
        path = config.table_path(config.aggregate_table)
        self.aggregate = AdditiveTable(
            spark, path, _GROUPS, RANGE_SUMS, "vehicle_count",
            derived={"avg_electric_range": (T.DoubleType(), mean(F.col("range_sum"), F.col("range_count")))},
            buckets=config.aggregate_buckets, keep=config.keep_snapshots, keep_seconds=config.keep_seconds,
        )

    def ensure(self) -> None:
        """Create the database and catalog entries; the aggregate's is made anew."""
        config = self.config
        catalog.ensure_database(self.spark, config.database, f"{config.warehouse.rstrip('/')}/{config.database}.db")
        for name, kind, table in (
            (config.location_table, LOCATION, self.location),
            (config.evdata_table, EVDATA, self.evdata),
        ):
            columns = T.StructType([kind.table_schema[c] for c in kind.table_columns])
            catalog.create_keyed_table(self.spark, config.qualified(name), columns, table)
        name = config.qualified(config.aggregate_table)
        catalog.drop_entry(self.spark, name)
        catalog.create_keyed_table(self.spark, name, AGGREGATE_SCHEMA, self.aggregate)

    def publish_changes(self, name: str, table: SnapshotTable, before: Snapshot | None, after: Snapshot | None) -> None:
        """Bring the catalog entry of a table to its new snapshot."""
        if after is None:
            return
        old = before.versions if before else {}
        changed = [b for b in after.buckets() if old.get(str(b)) != after.versions[str(b)]]
        emptied = [int(b) for b in old.keys() - after.versions.keys()]
        if changed or emptied:
            catalog.sync_buckets(self.spark, self.config.qualified(name), table, after, changed, emptied)

    def refresh_aggregate(self) -> Snapshot | None:
        """Bring the aggregate up to date with both keyed tables, by what changed since it was.

        The aggregate's snapshot says which snapshots of the tables it stands for. Vehicles
        of the buckets replaced since then are joined as they were and as they are; the
        first are taken from their groups and the second added, so what stayed the same
        cancels out and only buckets of groups that differ are rewritten. A refresh that
        was cut short is made up for by the next. The aggregate is made anew when the
        snapshots it stands for are gone. While a table is missing, or if nothing joins,
        the previous aggregate stays.
        """
        now = {"location": self.location.snapshot(), "evdata": self.evdata.snapshot()}
        if None in now.values():
            return None
        current = self.aggregate.snapshot()
        known = current.sources if current else {}
        before = {name: self._still_there(table, known.get(name)) for name, table in (("location", self.location), ("evdata", self.evdata))}
        if before == now:
            return current
        changes = all(before.values())
        old = before if changes else dict.fromkeys(now, Snapshot(-1))
        stale = sorted({b for name in now for b in _replaced(old[name], now[name])})
        added = self._joined(now, stale)
        sources = {name: snapshot.id for name, snapshot in now.items()}
        if changes or current is None:
            committed = self.aggregate.add(self.aggregate.change(added, self._joined(old, stale)), sources=sources, keep_if_empty=True)
        else:
            made = self.aggregate.change(added)
            if made.isEmpty():
                return current
            committed = self.aggregate.renew(made, sources)
        self.publish_changes(self.config.aggregate_table, self.aggregate, current, committed)
        return committed

    def _still_there(self, table: KeyedTable, snapshot_id: int | None) -> Snapshot | None:
        return table.snapshot(snapshot_id) if snapshot_id is not None and table.has_snapshot(snapshot_id) else None

    def _joined(self, snapshots: dict[str, Snapshot], buckets: list[int]) -> DataFrame:
        """Sums by county and make of the vehicles of some buckets; both tables put a vehicle in the same one."""
        location = self.location.read(buckets, snapshots["location"])
        evdata = self.evdata.read(buckets, snapshots["evdata"])
        return range_parts(vehicle_join(location, evdata))

    def rebuild(self) -> None:
        """Replay all messages into fresh tables, in batch."""
        location = message_batch(self.spark, self.config, self.config.location_topic)
        evdata = message_batch(self.spark, self.config, self.config.evdata_topic)
        for name, table, rows in (
            (self.config.location_table, self.location, valid_location(location)),
            (self.config.evdata_table, self.evdata, valid_evdata(evdata)),
        ):
            before = table.snapshot()
            self.publish_changes(name, table, before, table.rebuild(rows))
        self.refresh_aggregate()

    def consumed(self) -> dict[str, dict[str, int]]:
        """What the streams consumed by table: all rows, unreadable ones, rejected ones and those without a key."""
        out = {}
        for name, table in ((self.config.location_table, self.location), (self.config.evdata_table, self.evdata)):
            snapshot = table.snapshot()
            counts = list(snapshot.progress.values()) if snapshot else []
            out[name] = {c: sum(p.get(c, 0) for p in counts) for c in PROGRESS}
        return out

    def scan(self, name: str) -> DataFrame:
        """A table as catalog readers see it."""
        return catalog.scan(self.spark, self.config.qualified(name))


def start_streams(
    spark: SparkSession, config: PipelineConfig, trigger: str | None = "default"
) -> tuple[VehicleTables, list[StreamingQuery]]:
    """Start both writers; each batch also refreshes the aggregate.

    ``trigger`` None reads what the topics hold and stops. One lock makes the batches of
    the two queries take turns, so a refresh sees both tables at rest.
    """
    tables = VehicleTables(spark, config)
    tables.ensure()
    lock = threading.Lock()
    interval = config.trigger if trigger == "default" else trigger

    def writer(topic: str, judged, name: str, table: KeyedTable) -> StreamingQuery:
        def after(before: Snapshot | None, committed: Snapshot | None) -> None:
            tables.publish_changes(name, table, before, committed)
            tables.refresh_aggregate()

        rows = judged(message_stream(spark, config, topic).observe(CONSUMED, F.count(F.lit(1)).alias("rows")))
        return start_upserts(rows, table, config.checkpoint_path(name), interval, lock, after, name=name)

    queries = [
        writer(config.location_topic, judged_location, config.location_table, tables.location),
        writer(config.evdata_topic, judged_evdata, config.evdata_table, tables.evdata),
    ]
    return tables, queries


def run(spark: SparkSession, config: PipelineConfig) -> None:
    """Run until one of the two queries ends."""
    start_streams(spark, config)
    spark.streams.awaitAnyTermination()
