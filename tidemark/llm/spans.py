"""Places of pattern matches in text, by DataFrame functions alone.

Spark's regular expressions give the matches but not their places. The text between the
matches does: splitting by the same pattern leaves one gap before each match, so a match
starts after all earlier gaps and matches and its own gap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:int,end:int,value:string>"
NONE = f"array<{SPAN}>"
BLOCK = 256


def matches(text: Column, pattern: str, kind: str, present: Column | None = None, group: int | None = None) -> Column:
    """All leftmost, non-overlapping matches as ``array<struct<kind, start, end, value>>``.

    Code points, end exclusive. ``value`` is the match, or its ``group``. ``present`` is a
    cheap condition without which there is no match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(found.alias("match"), F.split(text, pattern, -1).alias("gap"), values.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(NONE).alias("spans"))

    # Appending copies an array, so matches are placed block by block and the blocks then moved:
    # n matches cost n * BLOCK + n * n / BLOCK copies and not n * n.
    def placed(all_parts: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_parts) - 1) / BLOCK).cast("int"))
        return F.aggregate(
            F.transform(numbers, lambda b: F.aggregate(F.slice(all_parts, b * BLOCK + 1, BLOCK), start, step)),
            start,
            lambda done, block: F.struct(
                (done["at"] + block["at"]).alias("at"),
                F.concat(done["spans"], F.transform(block["spans"], lambda s: moved(s, done["at"]))).alias("spans"),
            ),
            lambda done: done["spans"],
        )

    def step(done: Column, part: Column) -> Column:
        begin = done["at"] + F.char_length(part["gap"])
        end = begin + F.char_length(part["match"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), part["value"].alias("value"))
        return F.struct(
            F.coalesce(end, begin).alias("at"),
            F.when(part["match"].isNull(), done["spans"]).otherwise(F.concat(done["spans"], F.array(span))).alias("spans"),
        )

    # The array of one element gives the parts a name: they are worked out once.
    located = F.element_at(F.transform(F.array(parts), placed), 1)
    ready = text.rlike(pattern) if present is None else present & text.rlike(pattern)
    return F.when(ready, located).otherwise(F.array().cast(NONE))


def moved(span: Column, offset: Column) -> Column:
    """The span ``offset`` characters further on."""
    return F.struct(span["kind"].alias("kind"), (span["start"] + offset).alias("start"), (span["end"] + offset).alias("end"), span["value"].alias("value"))


def in_order(spans: Column, kinds: list[str]) -> Column:
    """Spans by start, then by the place of their kind in ``kinds``, then by end."""
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.array_position(F.lit(kinds), s["kind"]).alias("rank"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
            s["value"].alias("value"),
        ),
    )
    return F.transform(
        F.array_sort(keyed),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")),
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, separated by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))
