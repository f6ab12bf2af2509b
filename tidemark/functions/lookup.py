"""Field lookup in flat string maps by any of several spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import non_blank, plain_name, plain_name_of
from tidemark.schemas import NOT_AVAILABLE, MessageType


def field_by_name(fields: Column, *spellings: str, default: str = NOT_AVAILABLE) -> Column:
    """First non-blank value under one of ``spellings``.

    Exact names come first, in the order given; then the first entry of the map whose
    name matches a spelling in letters and digits; then ``default``. Values keep
    their outer blanks.
    """
    exact = [non_blank(F.try_element_at(fields, F.lit(name))) for name in spellings]
    wanted = sorted({plain_name_of(name) for name in spellings})
    alike = F.filter(
        F.map_entries(fields),
        lambda entry: plain_name(entry["key"]).isin(wanted) & non_blank(entry["value"]).isNotNull(),
    )
    return F.coalesce(*exact, F.get(alike, F.lit(0))["value"], F.lit(default))


def all_fields(fields: Column, kind: MessageType) -> list[Column]:
    """Every field of a message type, looked up by all its spellings."""
    return [
        field_by_name(fields, *f.spellings).alias(f.column or f.payload)
        for f in kind.fields
    ]
