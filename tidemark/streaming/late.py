"""Sliding windows kept as sums, with rows behind the watermark set aside and added later."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.numeric import mean
from tidemark.operators.windows import WINDOW_SUMS, window_sums
from tidemark.sources import fs
from tidemark.sources.additive import AdditiveTable
from tidemark.sources.tables import Snapshot, no_rows
from tidemark.streaming.writers import _query_id, _start


class LateWindows:
    """A table of window sums, its side output of late rows, and the correction by them.

    The watermark is the latest time of the batches before less ``delay``. Rows behind it
    do not touch their windows, which readers may have taken as final; they are written to
    ``late_path`` by batch. ``correct`` adds them to their windows. Watermark, counts and
    how far was corrected are committed with the sums, so a batch that is repeated after a
    failure gives the same table and the same late rows.
    """

    def __init__(
        self, table: AdditiveTable, late_path: str, rows_schema: T.StructType, time: str, groups: Sequence[str], measure: Column,
        size: str = "5 minutes", slide: str = "1 minute", delay: dt.timedelta = dt.timedelta(minutes=10),
    ):
        self.table, self.late_path, self.rows_schema = table, late_path.rstrip("/"), rows_schema
        self.time, self.groups, self.measure, self.size, self.slide, self.delay = time, list(groups), measure, size, slide, delay

    @staticmethod
    def make_table(spark, path: str, groups: T.StructType, value: T.DataType, **options) -> AdditiveTable:
        """An empty table of sums; ``value`` is the type of the summed measure."""
        window = [T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType())]
        average = {"avg_value": (T.DoubleType(), mean(F.col("value_sum"), F.col("value_count")))}
        return AdditiveTable(spark, path, T.StructType([*window, *groups.fields]), WINDOW_SUMS, "row_count", average, kinds={"value_sum": value}, **options)

    def _sums(self, rows: DataFrame) -> DataFrame:
        return window_sums(rows, self.time, self.groups, self.measure, self.size, self.slide)

    def _folder(self, query: str, batch_id: int) -> str:
        return f"{self.late_path}/{query}/{batch_id}"

    def start(self, rows: DataFrame, checkpoint: str, trigger: str | None = "10 seconds") -> StreamingQuery:
        return _start(rows.sparkSession, rows.writeStream.foreachBatch(lambda batch, batch_id: self.add(batch, _query_id(batch), batch_id)), checkpoint, trigger)

    def add(self, batch: DataFrame, query: str, batch_id: int) -> Snapshot | None:
        """Merge one micro-batch: rows in time into their windows, the others into the side output."""
        current = self.table.snapshot()
        progress = dict(current.progress) if current else {}
        done = {"batch_id": -1, "watermark": None, "rows": 0, "late": 0, "corrected": -1, **progress.get(query, {})}
        if batch_id <= done["batch_id"]:
            return current
        rows = batch.select(*self.rows_schema.fieldNames()).persist()
        try:
            micros = F.unix_micros(self.time)
            behind = F.lit(False) if done["watermark"] is None else F.coalesce(micros < done["watermark"], F.lit(False))
            seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(behind).alias("late"), F.max(micros).alias("latest")).first()
            if seen["late"]:
                rows.filter(behind).write.mode("overwrite").parquet(self._folder(query, batch_id))
            marks = [done["watermark"], None if seen["latest"] is None else seen["latest"] - self.delay // dt.timedelta(microseconds=1)]
            progress[query] = {
                "batch_id": batch_id,
                "watermark": max((m for m in marks if m is not None), default=None),
                "rows": done["rows"] + seen["n"],
                "late": done["late"] + seen["late"],
                "corrected": done["corrected"],
            }
            return self.table.add(self.table.change(self._sums(rows.filter(~behind))), progress)
        finally:
            rows.unpersist()

    def late_rows(self, corrected: bool = True) -> DataFrame:
        """Rows of the side output; without ``corrected`` those not yet added to their windows."""
        spark, snapshot, folders = self.table.spark, self.table.snapshot(), []
        for query, done in (snapshot.progress if snapshot else {}).items():
            for name in fs.names(spark, f"{self.late_path}/{query}"):
                if (-1 if corrected else done["corrected"]) < int(name) <= done["batch_id"]:
                    folders.append(self._folder(query, int(name)))
        return spark.read.schema(self.rows_schema).parquet(*folders) if folders else no_rows(spark, self.rows_schema)

    def correct(self) -> Snapshot | None:
        """Add the late rows of all committed batches to their windows, each once."""
        snapshot = self.table.snapshot()
        if snapshot is None:
            return None
        progress = {query: {**done, "corrected": done["batch_id"]} for query, done in snapshot.progress.items()}
        return self.table.add(self.table.change(self._sums(self.late_rows(corrected=False))), progress)
