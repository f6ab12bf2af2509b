"""Tables of grouped sums that are kept up to date by what is added to them and taken from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import BUCKET, Snapshot, SnapshotTable


class AdditiveTable(SnapshotTable):
    """One row per group with sums; a change is a table of groups with what to add.

    Groups, null ones too, are dealt to buckets by a hash of the group, so a change
    rewrites only the buckets of the groups it has. ``weight`` names the sum of rows: a
    group in which none are left goes. ``derived`` are columns worked out from the sums
    and stored beside them. ``integer`` sums take changes of either sign exactly.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        groups: T.StructType,
        sums: Sequence[str],
        weight: str,
        derived: dict[str, tuple[T.DataType, Column]] | None = None,
        buckets: int = 8,
        keep: int = 10,
        keep_seconds: float = 3600,
        kinds: dict[str, T.DataType] | None = None,
    ):
        self.groups, self.sums, self.weight, self.derived, self.buckets = groups.fieldNames(), list(sums), weight, derived or {}, buckets
        kinds = kinds or {}
        fields = [*groups.fields, *(T.StructField(s, kinds.get(s, T.LongType())) for s in sums)]
        fields += [T.StructField(name, kind) for name, (kind, _) in self.derived.items()]
        super().__init__(spark, path, T.StructType(fields), keep, keep_seconds)

    def layout(self) -> dict:
        return {"groups": self.groups, "buckets": self.buckets}

    def placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the bucket of their group; a null group value counts like any other."""
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*(F.struct(g) for g in self.groups)), F.lit(self.buckets)).cast("int"))

    def summed(self, rows: DataFrame) -> DataFrame:
        """Groups and sums of ``rows``, which are sums already."""
        return rows.groupBy(*self.groups).agg(*(F.sum(s).cast(self.schema[s].dataType).alias(s) for s in self.sums))

    def change(self, added: DataFrame, taken: DataFrame | None = None) -> DataFrame:
        """What ``added`` less ``taken`` makes of each group, without the groups it leaves as they are."""
        names = [*self.groups, *self.sums]
        rows = added.select(*names)
        if taken is not None:
            rows = rows.unionByName(taken.select(*self.groups, *((-F.col(s)).alias(s) for s in self.sums)))
        differs = F.lit(False)
        for s in self.sums:
            differs = differs | (F.col(s) != 0)
        return self.summed(rows).filter(differs)

    def add(
        self,
        change: DataFrame,
        progress: dict[str, dict] | None = None,
        sources: dict | None = None,
        keep_if_empty: bool = False,
    ) -> Snapshot | None:
        """Commit a change. Only buckets that have groups of it are read and written.

        Progress and sources are committed with it, also where nothing changes. With
        ``keep_if_empty`` a change that would leave no group at all is not made.
        """
        current = self.snapshot()
        if current and current.layout and current.layout != self.layout():
            raise ValueError(f"the table was written with {current.layout}; make it anew to change that")
        moved = self.placed(change).persist()
        try:
            touched = sorted(r[BUCKET] for r in moved.select(BUCKET).distinct().collect())
            merged = self.read(touched, current).select(*self.groups, *self.sums).unionByName(moved.select(*self.groups, *self.sums))
            left = self.placed(self.summed(merged).filter(F.col(self.weight) != 0)).withColumns({n: c.cast(k) for n, (k, c) in self.derived.items()})
            if keep_if_empty and current and current.versions and set(current.buckets()) <= set(touched) and left.isEmpty():
                return current
            return self.replace(left.repartition(BUCKET), touched, progress, sources)
        finally:
            moved.unpersist()

    def renew(self, rows: DataFrame, sources: dict | None = None) -> Snapshot:
        """Replace the whole table by these groups and sums."""
        made = self.placed(rows.select(*self.groups, *self.sums)).withColumns({n: c.cast(k) for n, (k, c) in self.derived.items()})
        return self.replace(made.repartition(BUCKET), sources=sources)

    def add_batch(self, batch: DataFrame, query: str, batch_id: int, counts: Callable[[DataFrame], DataFrame], **extra) -> Snapshot | None:
        """Add the sums ``counts`` makes of a micro-batch, once: a batch already committed is left alone."""
        current = self.snapshot()
        progress = dict(current.progress) if current else {}
        if batch_id <= progress.get(query, {"batch_id": -1})["batch_id"]:
            return current
        progress[query] = {"batch_id": batch_id, **extra}
        return self.add(self.change(counts(batch)), progress)
