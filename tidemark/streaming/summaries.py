"""Counts a topic consumer keeps while it reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.lookup import field_by_name
from tidemark.operators.parse import field_maps
from tidemark.schemas import EVDATA, LOCATION, MessageType

# The fields each kind of topic is counted by.
COUNTED_FIELDS = {
    LOCATION.name: ("county", "city"),
    EVDATA.name: ("make", "electric_vehicle_type"),
}

CONSUMED = "_consumed"
UNREADABLE = "_unreadable"

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("field_value", T.StringType()),
        T.StructField("row_count", T.LongType()),
    ]
)


def topic_summary(messages: DataFrame, kind: MessageType) -> DataFrame:
    """Messages counted by each summary field, in one pass, batch or streaming.

    The consumed total takes every message; unreadable ones are counted apart and do not
    enter the other counts. Absent fields count under the default text.
    """
    spellings = {f.column: f.spellings for f in kind.table_fields}
    fields = F.col("fields")
    entries = [
        F.struct(
            F.lit(name).alias("field"),
            field_by_name(fields, *spellings[name]).alias("field_value"),
        )
        for name in COUNTED_FIELDS[kind.name]
    ]
    total = F.struct(F.lit(CONSUMED).alias("field"), F.lit(None).cast("string").alias("field_value"))
    unreadable = F.struct(F.lit(UNREADABLE).alias("field"), F.lit(None).cast("string").alias("field_value"))
    contribution = F.when(fields.isNull(), F.array(total, unreadable)).otherwise(F.array(total, *entries))
    return (
        field_maps(messages)
        .select(F.explode(contribution).alias("entry"))
        .groupBy("entry.field", "entry.field_value")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def top_values(summary: DataFrame, field: str, k: int | None = 10) -> DataFrame:
    """Most frequent values of one summary field; all of them without ``k``."""
    ordered = (
        summary.filter(F.col("field") == field)
        .select("field_value", "row_count")
        .orderBy(F.desc("row_count"), F.asc("field_value"))
    )
    return ordered.limit(k) if k else ordered
