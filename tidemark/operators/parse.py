"""From raw messages to typed, validated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.lookup import all_fields
from tidemark.functions.numeric import lenient_int
from tidemark.schemas import EVDATA, EVDATA_BOUNDS, KEY, LOCATION, UNREADABLE, VALID, MessageType


def decode(messages: DataFrame, key: str = KEY) -> DataFrame:
    """Binary key and value to text; the record's timestamp is the event time."""
    return messages.select(
        F.col("key").cast("string").alias(key),
        F.col("timestamp").alias("event_time"),
        F.col("value").cast("string").alias("payload"),
        F.col("partition").alias("msg_partition"),
        F.col("offset").alias("msg_offset"),
    )


def typed_rows(messages: DataFrame, kind: MessageType) -> DataFrame:
    """Decode, read the JSON under the declared schema and flatten it.

    A payload that is not valid JSON leaves its fields null; numbers that cannot be
    read become null.
    """
    return _typed(messages, kind).drop(UNREADABLE)


def _typed(messages: DataFrame, kind: MessageType) -> DataFrame:
    schema = T.StructType([*kind.payload_schema.fields, T.StructField(UNREADABLE, T.StringType())])
    parsed = _once(decode(messages), F.from_json("payload", schema, {"columnNameOfCorruptRecord": UNREADABLE}), "body")

    def column(field) -> Column:
        text = F.col(f"body.`{field.payload}`")
        return (lenient_int(text) if field.integer else text).alias(field.column)

    typed = _once(parsed, F.struct(*(column(f) for f in kind.table_fields)), "fields")
    return typed.select(
        KEY,
        "event_time",
        *(F.col(f"fields.{f.column}").alias(f.column) for f in kind.table_fields),
        "msg_partition",
        "msg_offset",
        (F.col("body").isNull() | F.col(f"body.{UNREADABLE}").isNotNull()).alias(UNREADABLE),
    )


def _once(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column that is computed once per row, however often it is used.

    Filters on a plain projection are rewritten in terms of its input, which repeats the
    expression for every use. They do not pass a generator, here one of a single row.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def within(rows: DataFrame, bounds: dict[str, tuple[int, int]]) -> DataFrame:
    """Rows whose columns lie in the inclusive bounds; a null fails its bound."""
    for name, (low, high) in bounds.items():
        rows = rows.filter(F.col(name).between(low, high))
    return rows


def valid_location(messages: DataFrame) -> DataFrame:
    """Location rows that have a key."""
    return typed_rows(messages, LOCATION).filter(F.col(KEY).isNotNull())


def valid_evdata(messages: DataFrame, bounds: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Vehicle rows with a plausible range and model year."""
    return within(typed_rows(messages, EVDATA), EVDATA_BOUNDS if bounds is None else bounds)


def judged_location(messages: DataFrame) -> DataFrame:
    """All location rows, with whether the payload could not be read and whether the row is valid."""
    return _typed(messages, LOCATION).withColumn(VALID, F.col(KEY).isNotNull())


def judged_evdata(messages: DataFrame, bounds: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """All vehicle rows, judged likewise."""
    valid = F.lit(True)
    for name, (low, high) in (EVDATA_BOUNDS if bounds is None else bounds).items():
        valid = valid & F.coalesce(F.col(name).between(low, high), F.lit(False))
    return _typed(messages, EVDATA).withColumn(VALID, valid)


def field_maps(messages: DataFrame) -> DataFrame:
    """Each message with its payload read as a flat string map (null if unreadable)."""
    return _once(decode(messages), F.from_json("payload", "map<string,string>"), "fields")


def readable(mapped: DataFrame) -> DataFrame:
    return mapped.filter(F.col("fields").isNotNull())


def parse_errors(messages: DataFrame) -> DataFrame:
    """Messages whose payload could not be read, with their position in the topic."""
    return (
        field_maps(messages)
        .filter(F.col("fields").isNull())
        .select("msg_partition", "msg_offset", "payload")
    )


def consumed_fields(messages: DataFrame, kind: MessageType) -> DataFrame:
    """All display fields of the readable messages, absent ones as the default text."""
    return readable(field_maps(messages)).select(
        "msg_partition", "msg_offset", *all_fields(F.col("fields"), kind)
    )
