"""Joins by key and by key within an event-time distance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import KEY


def vehicle_join(location: DataFrame, evdata: DataFrame) -> DataFrame:
    """Inner join of the two keyed tables, reduced to what the aggregate needs."""
    return location.select(KEY, "county").join(evdata.select(KEY, "make", "electric_range"), KEY)


def time_slots(low: Column, high: Column, width_us: int) -> Column:
    """Numbers of the time slots that the span from ``low`` to ``high`` touches."""
    return F.sequence(_slot(low, width_us), _slot(high, width_us))


def _slot(moment: Column, width_us: int) -> Column:
    return F.floor(F.unix_micros(moment) / F.lit(width_us))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    distance_seconds: int = 600,
    watermark: str | None = None,
) -> DataFrame:
    """Inner join on ``key`` with times at most ``distance_seconds`` apart, ends included.

    Works on batch and streaming inputs; streams need a ``watermark``, from which
    Spark derives when join state can go. Column names of the two sides must differ
    except for ``key``.

    Time is cut into slots twice as wide as the distance and the slot joins the
    equality key. A right row has one slot, a left row one or two, so each pair is found
    once, a key that dominates the input is spread over many tasks, and only rows
    that are close in time are compared.
    """
    if watermark:
        left = left.withWatermark(left_time, watermark)
        right = right.withWatermark(right_time, watermark)
    width_us = 2 * distance_seconds * 1_000_000
    distance = F.expr(f"INTERVAL {int(distance_seconds)} SECONDS")
    l_time, r_time = F.col(left_time), F.col(right_time)
    left = left.withColumnRenamed(key, "_left_key").withColumn(
        "_left_slot", F.explode(time_slots(l_time - distance, l_time + distance, width_us))
    )
    right = right.withColumn("_right_slot", _slot(r_time, width_us))
    near = (
        (F.col("_left_key") == F.col(key))
        & (F.col("_left_slot") == F.col("_right_slot"))
        & (l_time >= r_time - distance)
        & (l_time <= r_time + distance)
    )
    return left.join(right, near).drop("_left_key", "_left_slot", "_right_slot")


def vehicle_interval_join(
    location: DataFrame, evdata: DataFrame, watermark: str | None = "10 minutes"
) -> DataFrame:
    """Location and vehicle rows of one key at most ten minutes apart."""
    joined = interval_join(
        location.select(KEY, F.col("event_time").alias("l_time"), "county"),
        evdata.select(KEY, F.col("event_time").alias("e_time"), "make", "electric_range"),
        KEY,
        "l_time",
        "e_time",
        600,
        watermark,
    )
    return joined.select(KEY, F.col("l_time").alias("event_time"), "county", "make", "electric_range")


#: Order of the pairs of a vehicle; a pair equals another if it is equal in all of it.
PAIR_ORDER = ("event_time", "county", "make", "electric_range")


def distinct_pairs(pairs: DataFrame, within: bool = True) -> DataFrame:
    """Pairs without repetitions, as messages sent again leave them.

    On streams a pair is remembered for the watermark's delay (``within``), which bounds
    the state; what comes again later has to be settled where pairs are kept.
    """
    columns = [KEY, *PAIR_ORDER]
    return pairs.dropDuplicatesWithinWatermark(columns) if within and pairs.isStreaming else pairs.dropDuplicates(columns)


def counted_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    fact_groups: Sequence[str],
    dimension_groups: Sequence[str],
    how: str = "left",
    count_name: str = "row_count",
) -> DataFrame:
    """Rows of ``facts`` counted by columns of both sides.

    Facts are counted per key and group before they are joined, so a frequent key
    crosses the shuffle as a few counts. A left join keeps facts without a match.
    """
    groups = [key, *(g for g in fact_groups if g != key)]
    counted = facts.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    joined = counted.join(dimension.select(key, *dimension_groups), key, how)
    return joined.groupBy(*dimension_groups, *fact_groups).agg(F.sum("_n").alias(count_name))


def aligned_totals(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Two sides already reduced to one row per ``key``, side by side.

    Measures of a many-to-many relationship must be aggregated before they meet, or
    each would be repeated by the other side's row count.
    """
    return left.join(right, key, "full_outer")
