"""Joins of rows with one row per key that no frequent key can pile up in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys with more than this part of all rows are joined by broadcast; there are fewer of them than ``PARTS``.
PARTS = 1000


def attach(rows: DataFrame, info: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``info``, which has one row per key and, as ``size``, the key's number of rows.

    ``total`` is the sum of the sizes, or more. Fewer than ``PARTS`` keys can hold more than
    total / PARTS rows each: those are broadcast, whatever the data, and every other key
    brings at most that many rows into one task of the shuffled join. Keys are not null.
    """
    frequent = F.col(size) * PARTS > total
    heavy = F.broadcast(info.filter(frequent))
    rest = rows.join(F.broadcast(info.filter(frequent).select(*keys)), keys, "left_anti")
    return rows.join(heavy, keys).unionByName(rest.join(info.filter(~frequent), keys))
