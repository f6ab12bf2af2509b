"""Tables written between steps."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import new_run_dir, ship_package
from tidemark.sources import fs

#: Spark's setting by which a query's shuffle files are deleted at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
__all__ = ["drop_table", "materialize", "ship_package"]


def materialize(frame: DataFrame, label: str) -> DataFrame:
    """Write a step's rows to the shared folder and read them back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before. The
    step's shuffle files go when it is written.
    """
    spark = frame.sparkSession
    path = new_run_dir(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def drop_table(frame: DataFrame) -> None:
    """Delete a table made by ``materialize`` that no later step reads."""
    for folder in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
        fs.delete(frame.sparkSession, folder)
