"""Grouped counts, averages, roll-ups and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import mean, merged_parts, sum_of_parts, sum_parts
from tidemark.operators.latest import latest_by_key
from tidemark.schemas import KEY


def count_and_average(joined: DataFrame) -> DataFrame:
    """Vehicles and their average range by county and make.

    Null counties and makes form groups of their own; the count takes every row, the
    average skips null ranges.
    """
    return joined.groupBy("county", "make").agg(
        F.count(F.lit(1)).alias("vehicle_count"),
        F.avg("electric_range").alias("avg_electric_range"),
    )


def distinct_count_and_average(joined: DataFrame, order: Sequence[str] = ("event_time",)) -> DataFrame:
    """:func:`count_and_average` over one row per vehicle, for joins that repeat them."""
    return count_and_average(latest_by_key(joined, KEY, order))


RANGE_SUMS = ("vehicle_count", "range_count", "range_sum")


def range_parts(joined: DataFrame) -> DataFrame:
    """Counts and whole-number sums from which :func:`count_and_average` can be added up."""
    return joined.groupBy("county", "make").agg(
        F.count(F.lit(1)).alias("vehicle_count"),
        F.count("electric_range").alias("range_count"),
        F.sum(F.col("electric_range").cast("long")).alias("range_sum"),
    )


def joined_count_and_average(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    groups: Sequence[str],
    measure: str,
    count_name: str = "row_count",
    avg_name: str = "avg_value",
    scale: int | None = None,
) -> DataFrame:
    """Join facts to a dimension, then count and average a measure by its columns.

    Facts shrink to one row per key on the map side before the join. That
    aggregation and the join share one shuffle of the facts. With the measure's number of
    decimal places as ``scale`` the average does not depend on the order of addition.
    """
    per_key = facts.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *sum_parts(measure, scale),
    )
    joined = per_key.join(dimension.select(key, *groups), key)
    sums = joined.groupBy(*groups).agg(
        F.sum("_rows").alias(count_name),
        *merged_parts(scale),
    )
    return sums.select(*groups, count_name, mean(sum_of_parts(scale), F.col("_n")).alias(avg_name))


def counts_by(rows: DataFrame, *groups: str, count_name: str = "row_count") -> DataFrame:
    return rows.groupBy(*groups).agg(F.count(F.lit(1)).alias(count_name))


def top_counts(rows: DataFrame, group: str, k: int = 10, count_name: str = "row_count") -> DataFrame:
    """The ``k`` most frequent values, equal counts in the order of the values."""
    return ranked_counts(rows, group, count_name).limit(k)


def ranked_counts(rows: DataFrame, group: str, count_name: str = "row_count") -> DataFrame:
    """All values with their counts, most frequent first."""
    return counts_by(rows, group, count_name=count_name).orderBy(F.desc(count_name), F.asc(group))


def ring_counts(rows: DataFrame, outer: str, inner: str, count_name: str = "row_count") -> DataFrame:
    """Counts on two nested levels plus the total, with the level of each row.

    Level 0 is the pair, 1 the outer value, 3 the total. Rows are counted by pair first, so
    the roll-up expands groups and not rows.
    """
    return rings_of(counts_by(rows, outer, inner, count_name=count_name), outer, inner, count_name)


def rings_of(pairs: DataFrame, outer: str, inner: str, count_name: str = "row_count") -> DataFrame:
    """:func:`ring_counts` from rows counted by pair already."""
    counted = pairs.withColumnRenamed(count_name, "_n")
    return counted.rollup(outer, inner).agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("_n").alias(count_name),
    )


def ring_shares(rows: DataFrame, outer: str, inner: str, count_name: str = "row_count") -> DataFrame:
    """:func:`ring_counts` with each segment's share of its ring.

    Every ring adds up to the number of rows, so one scalar serves all of them and
    no level has to be gathered in one task.
    """
    return shares_of(counts_by(rows, outer, inner, count_name=count_name), outer, inner, count_name)


def shares_of(pairs: DataFrame, outer: str, inner: str, count_name: str = "row_count") -> DataFrame:
    """:func:`ring_shares` from rows counted by pair already."""
    total = pairs.agg(F.sum(count_name)).scalar()
    rings = rings_of(pairs, outer, inner, count_name)
    return rings.withColumn("share", F.col(count_name).cast("double") / total)


_AGGREGATES = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "avg": lambda what: mean(F.sum(what), F.count(what))}
_MERGES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def fixed_grain(
    rows: DataFrame,
    fixed: Sequence[str],
    view: Sequence[str],
    inner: dict[str, tuple[str, str | Column]],
    outer: dict[str, Column],
) -> DataFrame:
    """Aggregate at a fixed grain, then again at the grain of the view.

    ``inner`` names aggregates over ``rows`` by ``fixed``, each given as count, sum, min,
    max or avg and what it is taken of; ``outer`` holds aggregates over the inner names
    by ``view``. A view with further columns sees each fixed value once per combination:
    rows are then read once, aggregated at the finest grain, and the parts merged.
    """
    finer = [c for c in view if c not in fixed]
    if finer:
        parts = [part for name, (how, what) in inner.items() for part in _parts(name, how, what)]
        cells = rows.groupBy(*fixed, *finer).agg(*parts)
        per_fixed = cells.select(*fixed, *finer, *(_merged(name, how, fixed) for name, (how, _) in inner.items()))
    else:
        per_fixed = rows.groupBy(*fixed).agg(*(_AGGREGATES[how](what).alias(name) for name, (how, what) in inner.items()))
    return per_fixed.groupBy(*view).agg(*(c.alias(n) for n, c in outer.items()))


def _parts(name: str, how: str, what: str | Column) -> list[Column]:
    if how == "avg":
        return [F.sum(what).alias(f"{name}_sum"), F.count(what).alias(f"{name}_n")]
    return [_AGGREGATES[how](what).alias(name)]


def _merged(name: str, how: str, fixed: Sequence[str]) -> Column:
    """The aggregate of all cells that share the fixed columns."""
    grain = Window.partitionBy(*fixed)
    if how == "avg":
        return mean(F.sum(f"{name}_sum").over(grain), F.sum(f"{name}_n").over(grain)).alias(name)
    return _MERGES[how](name).over(grain).alias(name)
