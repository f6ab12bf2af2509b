"""Header names, blank tests and name normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The byte-order mark, and its three bytes read as single characters.
BOM = "\ufeff"
MISREAD_BOM = "\u00ef\u00bb\u00bf"

# Characters up to the space, which trimming removes at both ends.
_CONTROL_OR_SPACE = r"[\x00-\x20]"


def header_names(raw: list[str]) -> list[str]:
    """Field names of a CSV header: spaces to underscores, lower case.

    The first name also loses a leading byte-order mark and outer blanks.
    """
    names = list(raw)
    if names:
        first = re.sub(f"^[{BOM}{MISREAD_BOM}]+", "", names[0])
        names[0] = re.sub(f"^{_CONTROL_OR_SPACE}+|{_CONTROL_OR_SPACE}+$", "", first)
    return [name.replace(" ", "_").lower() for name in names]


def trimmed(text: Column) -> Column:
    """``text`` without control characters and spaces at both ends."""
    return F.regexp_replace(text, f"^{_CONTROL_OR_SPACE}+|{_CONTROL_OR_SPACE}+$", "")


def non_blank(text: Column) -> Column:
    """``text`` unchanged, or null when it holds white space only."""
    return F.when(text.rlike(r"\P{javaWhitespace}"), text)


def plain_name(text: Column) -> Column:
    """Lower-case letters and digits of a name, for spelling-insensitive matches."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def plain_name_of(text: str) -> str:
    """:func:`plain_name` of a name known when the query is built."""
    return re.sub("[^a-z0-9]", "", text.lower())
