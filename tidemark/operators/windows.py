"""Sliding event-time windows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import as_decimal, mean, merged_parts, part_names, sum_of_parts, sum_parts


def sliding_counts(
    rows: DataFrame,
    time: str,
    groups: Sequence[str],
    measure: str,
    size: str = "5 minutes",
    slide: str = "1 minute",
    watermark: str | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Count and average of ``measure`` per sliding window and group.

    With the measure's number of decimal places as ``scale`` the averages are exact.
    """
    if watermark:
        rows = rows.withWatermark(time, watermark)
    # Made before a row is copied into its windows: the cast costs more than the sums.
    exact = None
    if scale is not None:
        rows, exact = rows.withColumn("_exact_value", as_decimal(measure, scale)), F.col("_exact_value")
    windowed = rows.groupBy(F.window(time, size, slide).alias("w"), *groups).agg(
        F.count(F.lit(1)).alias("_rows"),
        *sum_parts(measure, scale, exact),
    )
    return _finish(windowed, groups, scale)


def sliding_counts_by_pane(
    rows: DataFrame,
    time: str,
    groups: Sequence[str],
    measure: str,
    size: str = "5 minutes",
    slide: str = "1 minute",
    scale: int | None = None,
) -> DataFrame:
    """:func:`sliding_counts` for batch inputs; without ``scale`` the last bits of an average may differ.

    Rows are first reduced to panes; only panes are copied into the windows that cover
    them. A pane is as wide as the greatest common divisor of size and slide, so it lies
    in a window wholly or not at all.
    """
    return _finish(_by_pane(rows, time, groups, F.col(measure), size, slide, scale), groups, scale)


def _by_pane(rows: DataFrame, time: str, groups: Sequence[str], measure: Column, size: str, slide: str, scale: int | None = None) -> DataFrame:
    pane = f"{math.gcd(_seconds(size), _seconds(slide))} seconds"
    panes = rows.groupBy(F.window(time, pane).alias("p"), *groups).agg(
        F.count(F.lit(1)).alias("_rows"),
        *sum_parts(measure, scale),
    )
    pane_start = panes.select(F.col("p.start").alias("_start"), *groups, "_rows", *part_names(scale))
    return pane_start.groupBy(F.window("_start", size, slide).alias("w"), *groups).agg(F.sum("_rows").alias("_rows"), *merged_parts(scale))


WINDOW_SUMS = ("row_count", "value_count", "value_sum")


def window_sums(rows: DataFrame, time: str, groups: Sequence[str], measure: Column, size: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Counts and sums per sliding window and group, to be added up; ``measure`` a whole number or decimal."""
    windowed = _by_pane(rows, time, groups, measure, size, slide)
    return windowed.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *groups,
        F.col("_rows").alias("row_count"),
        F.col("_n").alias("value_count"),
        F.col("_sum").alias("value_sum"),
    )


def _seconds(interval: str) -> int:
    """Seconds of an interval such as ``5 minutes``."""
    count, unit = interval.split()
    return int(count) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def _finish(windowed: DataFrame, groups: Sequence[str], scale: int | None = None) -> DataFrame:
    return windowed.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *groups,
        F.col("_rows").alias("row_count"),
        mean(sum_of_parts(scale), F.col("_n")).alias("avg_value"),
    )
