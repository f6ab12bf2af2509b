"""Casts of text to numbers, and averages from parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_int(text: Column) -> Column:
    """Text to int: fractions are cut off, anything unreadable becomes null.

    Text with a point goes by a pattern and never through a cast that fails: a failed
    ``try_cast`` raises an error inside, which costs about as much as reading the row's JSON.
    """
    bare = F.trim(text)
    has_value = bare.rlike(r"^[+-]?(?:[0-9]+\.[0-9]*|\.[0-9]*)$")
    head = F.substring_index(bare, ".", 1)
    cut = F.when(head.isin("", "+", "-"), F.lit(0)).otherwise(head.try_cast("int"))
    return F.when(F.contains(text, F.lit(".")), F.when(has_value, cut)).otherwise(text.try_cast("int"))


def exact_sum(value: str | Column, scale: int | None = None) -> Column:
    """Sum of doubles that have at most ``scale`` decimal places, whatever the order of addition.

    They are added as decimals. NaN, infinities and values of 10 ** 28 and more have no
    decimal: where one occurs the sum is the plain one. Without ``scale`` it always is.
    """
    column = F.col(value) if isinstance(value, str) else value
    if scale is None:
        return F.sum(column)
    exact = as_decimal(column, scale)
    return F.when(F.count(exact) == F.count(column), F.sum(exact).cast("double")).otherwise(F.sum(column))


def as_decimal(value: str | Column, scale: int) -> Column:
    """The decimal that :func:`exact_sum` adds, null where there is none."""
    return (F.col(value) if isinstance(value, str) else value).try_cast(f"decimal(30,{scale})")


def sum_parts(value: str | Column, scale: int | None = None, exact: Column | None = None) -> list[Column]:
    """Aggregates from which :func:`merged_parts` and :func:`sum_of_parts` make :func:`exact_sum` in two steps.

    ``exact`` is a column that holds :func:`as_decimal` of the value already.
    """
    column = F.col(value) if isinstance(value, str) else value
    parts = [F.count(column).alias("_n"), F.sum(column).alias("_sum")]
    if scale is not None:
        exact = as_decimal(column, scale) if exact is None else exact
        parts += [F.count(exact).alias("_exact_n"), F.sum(exact).alias("_exact")]
    return parts


def part_names(scale: int | None = None) -> list[str]:
    return ["_n", "_sum"] if scale is None else ["_n", "_sum", "_exact_n", "_exact"]


def merged_parts(scale: int | None = None) -> list[Column]:
    return [F.sum(name).alias(name) for name in part_names(scale)]


def sum_of_parts(scale: int | None = None) -> Column:
    if scale is None:
        return F.col("_sum")
    return F.when(F.col("_exact_n") == F.col("_n"), F.col("_exact").cast("double")).otherwise(F.col("_sum"))


def mean(total: Column, count: Column) -> Column:
    """Average from a sum and a number of values, null for no values."""
    return total.cast("double") / F.nullif(count, F.lit(0))
