"""Parquet tables that are replaced bucket by bucket and switched in one step."""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.latest import latest_by_key
from tidemark.schemas import ORDER, UNREADABLE, VALID
from tidemark.sources import fs

BUCKET = "bucket"
_VERSION = "v"
#: What is counted of each streaming query, from its first batch on.
PROGRESS = ("rows", "unreadable", "rejected", "rows_without_key")


@dataclass(frozen=True)
class Snapshot:
    """One committed state: the version folder that holds each bucket.

    ``progress`` has, per streaming query, its last merged batch and the rows consumed
    so far; ``sources`` is free for tables derived from other tables. ``layout`` says
    how rows were dealt out to the buckets, ``committed`` when (seconds since 1970).
    """

    id: int
    versions: dict[str, int] = field(default_factory=dict)
    progress: dict[str, dict] = field(default_factory=dict)
    sources: dict = field(default_factory=dict)
    layout: dict = field(default_factory=dict)
    committed: float = 0.0

    def buckets(self) -> list[int]:
        return sorted(int(b) for b in self.versions)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty input that the optimiser removes from unions and joins."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).filter(F.lit(False)).select(*columns)


class SnapshotTable:
    """A Parquet table in buckets, read by snapshot.

    A commit writes the changed buckets into a new version folder and then creates one
    small snapshot file. Until that file exists readers see the previous state, and files
    of a state in use are never overwritten, so a lost driver or executor cannot damage
    the table. The last ``keep`` snapshots stay, and all that were replaced less than
    ``keep_seconds`` ago: no scan may take longer.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keep: int = 10, keep_seconds: float = 3600):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.keep = keep
        self.keep_seconds = keep_seconds

    @property
    def _snapshots(self) -> str:
        return f"{self.path}/_snapshots"

    def _snapshot_ids(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in fs.names(self.spark, self._snapshots) if n.endswith(".json"))

    def snapshot(self, snapshot_id: int | None = None) -> Snapshot | None:
        """The given or the current snapshot; None for a table never written."""
        if snapshot_id is None:
            ids = self._snapshot_ids()
            if not ids:
                return None
            snapshot_id = ids[-1]
        return Snapshot(**json.loads(fs.read_text(self.spark, f"{self._snapshots}/{snapshot_id:010d}.json")))

    def has_snapshot(self, snapshot_id: int) -> bool:
        return snapshot_id in self._snapshot_ids()

    def bucket_path(self, bucket: int, version: int) -> str:
        return f"{self.path}/{_VERSION}={version}/{BUCKET}={bucket}"

    def read(self, buckets: Iterable[int] | None = None, snapshot: Snapshot | None = None) -> DataFrame:
        """The table, or some of its buckets, with the bucket as last column.

        A table without rows is an empty DataFrame; any other failure to read is raised.
        """
        snapshot = snapshot or self.snapshot()
        present = snapshot.versions if snapshot else {}
        wanted = snapshot.buckets() if snapshot else []
        if buckets is not None:
            chosen = set(buckets)
            wanted = [b for b in wanted if b in chosen]
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        if not wanted:
            return no_rows(self.spark, schema)
        paths = [self.bucket_path(b, present[str(b)]) for b in wanted]
        layout = T.StructType([*schema.fields, T.StructField(_VERSION, T.IntegerType())])
        rows = self.spark.read.schema(layout).option("basePath", self.path).parquet(*paths)
        return rows.select(*schema.fieldNames())

    def layout(self) -> dict:
        """What rows have to be placed by; nothing for tables whose caller places them."""
        return {}

    def replace(
        self,
        rows: DataFrame,
        buckets: Iterable[int] | None = None,
        progress: dict[str, dict] | None = None,
        sources: dict | None = None,
    ) -> Snapshot:
        """Commit ``rows`` (with a bucket column) as the new content of ``buckets``.

        Without ``buckets`` the whole table is replaced. Buckets that get no rows end up
        empty.
        """
        current = self.snapshot() or Snapshot(-1)
        version = current.id + 1
        folder = f"{self.path}/{_VERSION}={version}"
        rows.select(*self.schema.fieldNames(), BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        prefix = f"{BUCKET}="
        written = {n.removeprefix(prefix) for n in fs.names(self.spark, folder) if n.startswith(prefix)}
        replaced = None if buckets is None else {str(b) for b in buckets}
        versions = {b: v for b, v in current.versions.items() if replaced is not None and b not in replaced}
        versions.update(dict.fromkeys(written, version))
        committed = Snapshot(
            version,
            versions,
            current.progress if progress is None else progress,
            current.sources if sources is None else sources,
            self.layout(),
            time.time(),
        )
        fs.create_text(self.spark, f"{self._snapshots}/{version:010d}.json", json.dumps(asdict(committed)))
        self._drop_unused()
        return committed

    def _drop_unused(self) -> None:
        """Remove snapshots that are neither recent nor among the last, and versions none of the others use.

        A snapshot goes by the time of the one that replaced it. A bucket's version is never
        taken up again once replaced, so of the older versions only those of the first
        snapshot that stays are still in use.
        """
        ids = self._snapshot_ids()
        limit = time.time() - self.keep_seconds
        gone = 0
        while gone < len(ids) - self.keep and self.snapshot(ids[gone + 1]).committed <= limit:
            gone += 1
        if not gone:
            return
        used = set(self.snapshot(ids[gone]).versions.values())
        for snapshot_id in ids[:gone]:
            fs.delete(self.spark, f"{self._snapshots}/{snapshot_id:010d}.json")
        for name in fs.names(self.spark, self.path):
            if name.startswith(f"{_VERSION}="):
                version = int(name.removeprefix(f"{_VERSION}="))
                if version < ids[gone] and version not in used:
                    fs.delete(self.spark, f"{self.path}/{name}")


class KeyedTable(SnapshotTable):
    """A snapshot table with one row per key, the latest by a fixed order."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str | Sequence[str],
        order: Sequence[str] = ORDER,
        buckets: int = 32,
        files_per_bucket: int = 1,
        keep: int = 10,
        keep_seconds: float = 3600,
    ):
        super().__init__(spark, path, schema, keep, keep_seconds)
        self.key = [key] if isinstance(key, str) else list(key)
        self.order = list(order)
        self.buckets = buckets
        self.files_per_bucket = files_per_bucket

    def layout(self) -> dict:
        return {"key": self.key, "order": self.order, "buckets": self.buckets}

    def _bucket_of_key(self) -> Column:
        complete = F.lit(True)
        for name in self.key:
            complete = complete & F.col(name).isNotNull()
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        return F.when(complete, bucket)

    def upsert(self, batch: DataFrame, query: str | None = None, batch_id: int | None = None) -> Snapshot | None:
        """Merge a batch; the latest row per key stays.

        Only buckets that receive rows are read and rewritten. A batch the query has
        already committed is left alone, and merging it again would give the same table.
        Rows without a complete key are counted in the progress and left out. A batch of
        judged rows (columns ``_valid`` and ``_unreadable``) is counted as it came: all
        rows, unreadable ones and those the rules reject, unreadable ones among them.
        """
        current = self.snapshot()
        if current and current.layout and current.layout != self.layout():
            raise ValueError(f"the table was written with {current.layout}; rebuild it to change that")
        progress = dict(current.progress) if current else {}
        done = {"batch_id": -1, **dict.fromkeys(PROGRESS, 0), **progress.get(query, {})}
        if query is not None and batch_id is not None and batch_id <= done["batch_id"]:
            return current
        judged = VALID in batch.columns
        flags = [VALID, UNREADABLE] if judged else []
        rows = batch.select(*self.schema.fieldNames(), *flags).withColumn(BUCKET, self._bucket_of_key()).persist()
        try:
            valid, unreadable = (F.col(VALID), F.col(UNREADABLE)) if judged else (F.lit(True), F.lit(False))
            counts = rows.groupBy(BUCKET, valid.alias("valid")).agg(F.count(F.lit(1)).alias("n"), F.count_if(unreadable).alias("unreadable")).collect()
            touched = sorted({r[BUCKET] for r in counts if r["valid"] and r[BUCKET] is not None})
            if query is not None:
                progress[query] = {
                    "batch_id": batch_id,
                    "rows": done["rows"] + sum(r["n"] for r in counts),
                    "unreadable": done["unreadable"] + sum(r["unreadable"] for r in counts),
                    "rejected": done["rejected"] + sum(r["n"] for r in counts if not r["valid"]),
                    "rows_without_key": done["rows_without_key"] + sum(r["n"] for r in counts if r["valid"] and r[BUCKET] is None),
                }
            elif not touched:
                return current
            keyed = rows.filter(F.col(BUCKET).isNotNull() & valid).drop(*flags)
            merged = self._merge(self.read(touched, current), keyed)
            return self.replace(merged, touched, progress)
        finally:
            rows.unpersist()

    def _merge(self, existing: DataFrame, batch: DataFrame) -> DataFrame:
        """Latest rows of both, laid out in the files that will be written.

        The batch is reduced first, so what meets the table has at most two rows per
        key and a frequent key is no hot spot. One shuffle by bucket (and file within the
        bucket) then serves the merge and the write.
        """
        candidates = existing.unionByName(latest_by_key(batch, self.key, self.order))
        parts = F.pmod(F.xxhash64(*self.key, F.lit(1)), F.lit(self.files_per_bucket))
        placed = candidates.withColumn("_file", parts).repartition(BUCKET, "_file")
        return latest_by_key(placed, [BUCKET, "_file", *self.key], self.order).drop("_file")

    def rebuild(self, rows: DataFrame) -> Snapshot:
        """Replace the whole table by the latest rows of ``rows``; the counts of what streams consumed stay."""
        bucketed = rows.select(*self.schema.fieldNames()).withColumn(BUCKET, self._bucket_of_key())
        keyed = bucketed.filter(F.col(BUCKET).isNotNull())
        return self.replace(self._merge(self.read([]), keyed))
