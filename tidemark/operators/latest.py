"""Latest row per key, and the upsert built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import KEY, ORDER


def latest_by_key(
    rows: DataFrame, key: str | Sequence[str] = KEY, order: Sequence[str] = ORDER
) -> DataFrame:
    """One row per key: the greatest in ``order``.

    Spark turns the rank filter into a per-task limit ahead of the shuffle, so a key
    that holds a large part of the input still sends one row per map task. ``order``
    should be unique within a key; the result then depends on the rows alone.
    """
    keys = [key] if isinstance(key, str) else list(key)
    window = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return (
        rows.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def upsert_latest(
    existing: DataFrame,
    batch: DataFrame,
    key: str | Sequence[str] = KEY,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """``existing`` with the rows of ``batch`` merged in, the latest row per key winning.

    Merging is commutative and idempotent: any order or repetition of batches ends in
    the same table. Rows without a key cannot be told apart and are left out.
    """
    keys = [key] if isinstance(key, str) else list(key)
    keyed = existing.unionByName(batch).dropna(subset=keys)
    return latest_by_key(keyed, keys, order)
