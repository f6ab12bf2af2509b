"""Row to message: key and JSON value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import trimmed


def message_key(identifier: Column, row_index: Column) -> Column:
    """The trimmed identifier, or the 1-based row index where it is missing or empty."""
    return F.coalesce(F.nullif(trimmed(identifier), F.lit("")), row_index.cast("string"))


def row_json(columns: list[str], field_count: Column | None = None) -> Column:
    """The row as one flat JSON object of strings.

    Missing values are written as empty strings. With ``field_count`` only that many
    leading columns are written, which is how short CSV rows are published.
    """
    values = []
    for position, name in enumerate(columns):
        value = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
        if field_count is not None:
            value = F.when(field_count > position, value)
        values.append(value.alias(name))
    return F.to_json(F.struct(*values))
