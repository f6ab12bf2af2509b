"""Catalog entries over the snapshot tables, for SQL and BI readers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.tables import BUCKET, SnapshotTable, Snapshot


def _column_list(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def create_keyed_table(spark: SparkSession, name: str, schema: T.StructType, table: SnapshotTable) -> None:
    """External table over a keyed table, one partition per bucket, if absent."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_column_list(schema)}, {BUCKET} INT) "
        f"USING PARQUET PARTITIONED BY ({BUCKET}) LOCATION '{table.path}'"
    )
    current = table.snapshot()
    if current:
        sync_buckets(spark, name, table, current, current.buckets())


def drop_entry(spark: SparkSession, name: str) -> None:
    """Drop the entry; files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def sync_buckets(
    spark: SparkSession,
    name: str,
    table: SnapshotTable,
    snapshot: Snapshot,
    buckets: list[int],
    emptied: Iterable[int] = (),
) -> None:
    """Point the partitions of changed buckets at the folders of a snapshot; drop ``emptied`` ones."""
    gone = ", ".join(f"PARTITION ({BUCKET}={bucket})" for bucket in sorted(emptied))
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {gone}")
    for bucket in buckets:
        location = table.bucket_path(bucket, snapshot.versions[str(bucket)])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({BUCKET}={bucket}) LOCATION '{location}'")
        spark.sql(f"ALTER TABLE {name} PARTITION ({BUCKET}={bucket}) SET LOCATION '{location}'")
    spark.catalog.refreshTable(name)


def scan(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table without its storage column."""
    return spark.table(name).drop(BUCKET)
