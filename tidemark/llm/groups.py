"""Comparing all pairs inside groups of rows, without emitting the pairs.

Rows of a group meet in one task, sorted by the group's key. A group of more than
``BLOCK`` rows is cut into blocks; every two blocks meet in a task of their own, so a
task holds two blocks at most, however large the group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 400


def meet(rows: DataFrame, group: str, size: str, member: str) -> DataFrame:
    """Add ``left``, ``right`` and ``own``: the pair of blocks a row is sent to, and its own block.

    ``size`` names the column with the number of rows of the group. The rows come sorted by
    (group, left, right), each such set within one partition.
    """
    count = F.ceil(F.col(size) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(member), count).cast("int")
    sent: Column = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda other: F.struct(F.least(F.col("own"), other).alias("left"), F.greatest(F.col("own"), other).alias("right")),
    )
    keys = [group, "left", "right"]
    spread = rows.withColumn("own", own).withColumn("to", F.explode(sent)).select("*", "to.left", "to.right").drop("to", size)
    return spread.repartition(*keys).sortWithinPartitions(*keys)


def whole_groups(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole sets of rows that meet, with the number of the set of each row."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        edge = _edges(table, group)
        if not len(edge):
            held = table
            continue
        yield table.slice(0, edge[-1]), _numbers(edge[:-1], edge[-1])
        held = table.slice(edge[-1])
    if held is not None and held.num_rows:
        yield held, np.zeros(held.num_rows, dtype=np.int64)


def _edges(table: pa.Table, group: str) -> np.ndarray:
    differs = np.zeros(max(table.num_rows - 1, 0), dtype=bool)
    for name in (group, "left", "right"):
        values = table.column(name).to_numpy()
        differs |= values[1:] != values[:-1]
    return np.flatnonzero(differs) + 1


def _numbers(edges: np.ndarray, count: int) -> np.ndarray:
    start = np.zeros(count, dtype=np.int64)
    start[edges] = 1
    return np.cumsum(start)


def pairs_at(distance: int, sets: np.ndarray, across: np.ndarray, own: np.ndarray) -> np.ndarray:
    """First rows of the pairs so many rows apart that have to be compared here.

    Where two different blocks meet (``across``), pairs within a block are left to the
    task in which the block meets itself.
    """
    first = np.flatnonzero(sets[:-distance] == sets[distance:])
    return first[~across[first] | (own[first] != own[first + distance])]


def forest_labels(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least row reachable from each row over the links."""
    labels = np.arange(count)
    while True:
        low = np.minimum(labels[left], labels[right])
        before = labels.copy()
        np.minimum.at(labels, labels[left], low)
        np.minimum.at(labels, labels[right], low)
        labels = labels[labels]
        if (labels == before).all():
            return labels
