"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.messages import row_json


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an instant as time; watermarks need one."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def wall_clock(moment: str | Column) -> Column:
    """An instant as the session's wall-clock time, the type the tables hold."""
    return (F.col(moment) if isinstance(moment, str) else moment).cast("timestamp_ntz")


# Days at which the events are cut when a query needs them to arrive in parts.
EVENT_CUTS = ("2024-01-11", "2024-01-21")


def arrivals(rows: DataFrame, time: str, cuts: tuple[str, ...]) -> list[DataFrame]:
    """``rows`` as the parts in which they arrive, cut by time."""
    bounds = [None, *(F.lit(c).cast("timestamp") for c in cuts), None]
    parts = []
    for low, high in zip(bounds, bounds[1:]):
        part = rows
        if low is not None:
            part = part.filter(F.col(time) >= low)
        if high is not None:
            part = part.filter(F.col(time) < high)
        parts.append(part)
    return parts


def as_messages(rows: DataFrame) -> DataFrame:
    """Rows with key, value, timestamp and row_index as messages of a one-partition topic."""
    return rows.select(
        F.lit(0).alias("partition"),
        (F.col("row_index") - 1).alias("offset"),
        "timestamp",
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
    )


def event_records(rows: DataFrame) -> DataFrame:
    """One record per event, keyed by user."""
    body = rows.select(
        "event_id", "ts", F.col("user_id").cast("string").alias("key"), "user_id", "event_type", "value", "props"
    )
    names = ["event_id", "user_id", "event_type", "value", "props"]
    return body.select(
        "key",
        row_json(names).alias("value"),
        F.col("ts").alias("timestamp"),
        (F.col("event_id") + 1).alias("row_index"),
    )


def sighting_records(rows: DataFrame, event_type: str) -> DataFrame:
    """Events of one type as records that have fields of both topics, keyed by user."""
    k = F.get_json_object("props", "$.k").cast("int")
    quarter = F.floor(k / 25).cast("string")
    body = rows.filter(F.col("event_type") == event_type).select(
        F.col("user_id").cast("string").alias("key"),
        F.concat(F.lit("County "), quarter).alias("county"),
        F.concat(F.lit("Make "), quarter).alias("make"),
        k.cast("string").alias("electric_range"),
        F.year("ts").cast("string").alias("model_year"),
        F.col("ts").alias("timestamp"),
        (F.col("event_id") + 1).alias("row_index"),
    )
    value = row_json(["county", "make", "electric_range", "model_year"])
    return body.select("key", value.alias("value"), "timestamp", "row_index")


def location_records(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """One location record per customer: nation as county, market segment as city.

    With ``broken`` the payloads of one nation are cut short.
    """
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("key"),
        F.col("c_custkey").alias("position"),
        F.col("c_name").alias("vin_(1-10)"),
        F.concat(F.lit("County "), F.col("c_nationkey").cast("string")).alias("county"),
        F.col("c_mktsegment").alias("city"),
        F.lit("WA").alias("state"),
        F.col("c_nationkey").cast("string").alias("postal_code"),
        F.col("c_custkey").cast("string").alias("dol_vehicle_id"),
        F.col("c_acctbal").cast("string").alias("vehicle_location"),
        "c_nationkey",
    )
    names = ["vin_(1-10)", "county", "city", "state", "postal_code", "dol_vehicle_id", "vehicle_location"]
    value = row_json(names)
    if broken:
        value = F.when(F.col("c_nationkey") == 7, F.left(value, F.lit(10))).otherwise(value)
    return rows.select(
        "key",
        value.alias("value"),
        F.timestamp_seconds(F.lit(788918400) + F.col("position")).alias("timestamp"),
        (F.col("position") + 1).alias("row_index"),
    )


def evdata_records(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """One vehicle record per order, keyed by customer, so a key has many updates.

    Ranges are fractions of which some are too large, model years partly lie ahead,
    and some ranges are not numbers. With ``broken`` the urgent orders' payloads are
    cut short.
    """
    price = F.col("o_totalprice")
    unreadable = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("key"),
        F.col("o_orderkey").alias("position"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("VIN"), F.col("o_custkey").cast("string")).alias("vin_(1-10)"),
        (F.year("o_orderdate") + F.floor(price / 15000)).cast("string").alias("model_year"),
        F.col("o_orderpriority").alias("make"),
        F.col("o_orderstatus").alias("model"),
        F.when(F.col("o_orderstatus") == "F", "Battery Electric Vehicle (BEV)")
        .otherwise("Plug-in Hybrid Electric Vehicle (PHEV)")
        .alias("electric_vehicle_type"),
        F.lit("Clean Alternative Fuel Vehicle Eligible").alias("clean_alternative_fuel_vehicle_(cafv)_eligibility"),
        F.when(unreadable, "unknown").otherwise((price / 800).cast("string")).alias("electric_range"),
        F.lit("").alias("legislative_district"),
        F.col("o_custkey").cast("string").alias("dol_vehicle_id"),
        F.concat(F.lit("Utility \\ \""), F.col("o_orderstatus"), F.lit('"')).alias("electric_utility"),
        F.col("o_orderkey").cast("string").alias("2020_census_tract"),
    )
    names = [c for c in rows.columns if c not in ("key", "position", "timestamp")]
    value = row_json(names)
    if broken:
        value = F.when(F.col("make") == "1-URGENT", F.left(value, F.lit(25))).otherwise(value)
    return rows.select("key", value.alias("value"), "timestamp", (F.col("position") + 1).alias("row_index"))
