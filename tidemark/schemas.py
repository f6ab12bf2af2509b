"""Declared schemas, field renames, aliases and data-quality bounds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

KEY = "dol_vehicle_id"
NOT_AVAILABLE = "N/A"

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
    ]
)

# Position of a message in its topic. Kept beside each row so that rows with equal
# event times still have one fixed order.
ORDER = ("event_time", "msg_partition", "msg_offset")


# Columns of rows that are judged but not yet filtered.
UNREADABLE = "_unreadable"
VALID = "_valid"


@dataclass(frozen=True)
class Field:
    """One payload field: its name in the message, in tables, and its other spellings."""

    payload: str
    column: str | None
    aliases: tuple[str, ...] = ()
    integer: bool = False

    @property
    def spellings(self) -> tuple[str, ...]:
        return (self.payload, *self.aliases)


@dataclass(frozen=True)
class MessageType:
    """A kind of message: the fields of its flat JSON payload."""

    name: str
    fields: tuple[Field, ...]

    @property
    def payload_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.payload, T.StringType()) for f in self.fields])

    @property
    def table_fields(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if f.column)

    @property
    def table_columns(self) -> list[str]:
        return [KEY, "event_time", *(f.column for f in self.table_fields)]

    @property
    def table_schema(self) -> T.StructType:
        """Columns of the keyed table, followed by the message position."""
        columns = [T.StructField(KEY, T.StringType()), T.StructField("event_time", T.TimestampType())]
        columns += [
            T.StructField(f.column, T.IntegerType() if f.integer else T.StringType())
            for f in self.table_fields
        ]
        columns += [T.StructField("msg_partition", T.IntegerType()), T.StructField("msg_offset", T.LongType())]
        return T.StructType(columns)


# Payload field names, table column names and accepted spellings.
# The key is taken from the message key, so the payload's own copy has no column.
LOCATION = MessageType(
    "location",
    (
        Field("vin_(1-10)", "vin", ("vin", "vin_1_10")),
        Field("county", "county"),
        Field("city", "city"),
        Field("state", "state"),
        Field("postal_code", "postal_code", ("postalcode",)),
        Field("dol_vehicle_id", None, ("dolvehicleid",)),
        Field("vehicle_location", "vehicle_location", ("vehiclelocation",)),
    ),
)

EVDATA = MessageType(
    "evdata",
    (
        Field("vin_(1-10)", "vin", ("vin", "vin_1_10")),
        Field("model_year", "model_year", ("modelyear",), integer=True),
        Field("make", "make"),
        Field("model", "model"),
        Field("electric_vehicle_type", "electric_vehicle_type", ("ev_type",)),
        Field("clean_alternative_fuel_vehicle_(cafv)_eligibility", "cafv_eligibility", ("cafv_eligibility",)),
        Field("electric_range", "electric_range", ("electricrange",), integer=True),
        Field("legislative_district", "legislative_district", ("legislativedistrict",)),
        Field("dol_vehicle_id", None, ("dolvehicleid",)),
        Field("electric_utility", "electric_utility", ("electricutility",)),
        Field("2020_census_tract", "census_tract_2020", ("census_tract_2020", "censustract2020")),
    ),
)

# Inclusive bounds of a valid vehicle record.
EVDATA_BOUNDS: dict[str, tuple[int, int]] = {
    "electric_range": (0, 600),
    "model_year": (1990, 2025),
}

AGGREGATE_SCHEMA = T.StructType(
    [
        T.StructField("county", T.StringType()),
        T.StructField("make", T.StringType()),
        T.StructField("vehicle_count", T.LongType()),
        T.StructField("avg_electric_range", T.DoubleType()),
    ]
)
