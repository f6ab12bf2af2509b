"""The registered queries over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import PipelineConfig
from tidemark.functions.lookup import field_by_name
from tidemark.functions.messages import message_key, row_json
from tidemark.functions.numeric import exact_sum, lenient_int, mean
from tidemark.functions.text import BOM
from tidemark.operators import aggregates, joins, latest, parse, windows
from tidemark.plans import workbook
from tidemark.plans.inputs import (
    EVENT_CUTS,
    arrivals,
    as_messages,
    evdata_records,
    event_records,
    events,
    location_records,
    sighting_records,
    table,
    wall_clock,
)
from tidemark.schemas import EVDATA, KEY, LOCATION
from tidemark.session import new_run_dir, state_in_rocksdb
from tidemark.sources import catalog, messages
from tidemark.sources.csv import csv_messages, scan_csv
from tidemark.sources.additive import AdditiveTable
from tidemark.sources.tables import PROGRESS, KeyedTable
from tidemark.streaming import app, late, summaries, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Joins, counts and averages


@query
def join_group_count_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.joined_count_and_average(
        table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"),
        table(spark, sf_dir, "customer"),
        "c_custkey",
        ["c_nationkey", "c_mktsegment"],
        "o_totalprice",
        count_name="order_count",
        avg_name="avg_totalprice",
        scale=2,
    )


@query
def extreme_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages of values among which are NaN, an infinity, or very large ones."""
    odd, kind = F.col("event_id") % 500 == 0, F.col("event_type")
    value = (
        F.when(odd & (kind == "click"), F.lit(float("nan")))
        .when(odd & (kind == "view"), F.lit(float("inf")))
        .when(odd & (kind == "purchase"), F.lit(1e15))
        .otherwise(F.col("value"))
    )
    rows = table(spark, sf_dir, "events").withColumn("value", value)
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("row_count"), exact_sum("value", 2).alias("sum_value"), mean(exact_sum("value", 2), F.count("value")).alias("avg_value")
    )


@query
def keyed_join_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics to one row per vehicle, joined, counted and averaged."""
    location = latest.latest_by_key(parse.valid_location(as_messages(location_records(spark, sf_dir))))
    evdata = latest.latest_by_key(parse.valid_evdata(as_messages(evdata_records(spark, sf_dir))))
    return aggregates.count_and_average(joins.vehicle_join(location, evdata))


@query
def null_keys_and_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without a key join nothing; those without county or make form groups of their own."""
    number = F.col("row_index") - 1

    def without(records: DataFrame, name: str, every: int, keyless: int) -> DataFrame:
        value = F.regexp_replace("value", f'"{name}":"[^"]*"', f'"{name}":null')
        return records.withColumn("value", F.when(number % every == 0, value).otherwise(F.col("value"))).withColumn(
            "key", F.when(number % keyless != 0, F.col("key"))
        )

    location = without(location_records(spark, sf_dir), "county", 5, 7)
    evdata = without(evdata_records(spark, sf_dir), "make", 3, 4)
    return aggregates.count_and_average(
        joins.vehicle_join(
            latest.latest_by_key(parse.valid_location(as_messages(location))),
            latest.latest_by_key(parse.valid_evdata(as_messages(evdata))),
        )
    )


def _vehicle_pairs(location: DataFrame, evdata: DataFrame, watermark: str | None = None) -> DataFrame:
    return joins.vehicle_interval_join(parse.valid_location(location), parse.valid_evdata(evdata), watermark)


@query
def vehicle_interval_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of both topics at most ten minutes apart, counted and averaged."""
    rows = events(spark, sf_dir)
    clicks, purchases = (as_messages(sighting_records(rows, kind)) for kind in ("click", "purchase"))
    return aggregates.count_and_average(_vehicle_pairs(clicks, purchases))


def _side(rows: DataFrame, event_type: str, prefix: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return rows.filter(F.col("event_type") == event_type).select(
        "user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"), k.alias(f"{prefix}_k")
    )


def _near_pairs(clicks: DataFrame, purchases: DataFrame, watermark: str | None = None) -> DataFrame:
    return joins.interval_join(
        _side(clicks, "click", "click"),
        _side(purchases, "purchase", "purchase"),
        "user_id",
        "click_ts",
        "purchase_ts",
        600,
        watermark,
    )


def _pair_columns(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "user_id",
        "click_id",
        "purchase_id",
        wall_clock("click_ts").alias("click_ts"),
        wall_clock("purchase_ts").alias("purchase_ts"),
    )


@query
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    return _pair_columns(_near_pairs(rows, rows))


@query
def interval_join_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near pairs reduced to one per user, then counted and averaged."""
    rows = events(spark, sf_dir)
    pairs = _near_pairs(rows, rows).select(
        F.col("user_id").alias(KEY),
        F.col("click_ts").alias("event_time"),
        "click_id",
        "purchase_id",
        F.floor(F.col("click_k") / 25).cast("int").alias("county"),
        F.floor(F.col("purchase_k") / 25).cast("int").alias("make"),
        F.col("purchase_k").alias("electric_range"),
    )
    return aggregates.distinct_count_and_average(pairs, ("event_time", "click_id", "purchase_id"))


@query
def group_two_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.counted_join(
        table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"),
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        ["l_returnflag"],
        ["o_orderpriority"],
    )


@query
def relationship_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers counted by segment and by a supplier attribute; most have no match."""
    return joins.counted_join(
        table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "s_suppkey"),
        table(spark, sf_dir, "supplier").withColumn("s_nationkey", F.col("s_nationkey").cast("string")),
        "s_suppkey",
        ["c_mktsegment"],
        ["s_nationkey"],
    )


@query
def relationship_no_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and customers of each nation, each side aggregated before they meet."""
    suppliers = (
        table(spark, sf_dir, "supplier")
        .groupBy(F.col("s_nationkey").alias("nationkey"))
        .agg(F.count(F.lit(1)).alias("suppliers"), exact_sum("s_acctbal", 2).alias("s_acctbal"))
    )
    customers = (
        table(spark, sf_dir, "customer")
        .groupBy(F.col("c_nationkey").alias("nationkey"))
        .agg(F.count(F.lit(1)).alias("customers"), exact_sum("c_acctbal", 2).alias("c_acctbal"))
    )
    return joins.aligned_totals(suppliers, customers, "nationkey")


# Counts, ranks, roll-ups


@query
def top_k_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.top_counts(table(spark, sf_dir, "orders"), "o_custkey", 10)


@query
def full_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.ranked_counts(table(spark, sf_dir, "events"), "event_type")


@query
def rollup_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.ring_counts(table(spark, sf_dir, "part"), "p_brand", "p_type")


@query
def rollup_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("nation"), "c_mktsegment")
    return aggregates.ring_shares(rows, "nation", "c_mktsegment")


@query
def fixed_grain_avg_vs_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average at the fixed grain beside the maximum, both by nation and segment."""
    joined = _orders_by_customer(spark, sf_dir)
    dims = ["c_nationkey", "c_mktsegment"]
    return aggregates.fixed_grain(
        joined,
        dims,
        dims,
        {"_avg": ("avg", _cents("o_totalprice")), "_max": ("max", "o_totalprice")},
        {"sum_of_avg": F.sum("_avg"), "max_totalprice": F.max("_max")},
    )


@query
def fixed_grain_finer_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed-grain average seen at a finer grain: repeated, not recomputed."""
    return aggregates.fixed_grain(
        _orders_by_customer(spark, sf_dir),
        ["c_nationkey", "c_mktsegment"],
        ["c_nationkey", "c_mktsegment", "o_orderstatus"],
        {"_avg": ("avg", _cents("o_totalprice"))},
        {"fixed_avg": F.sum("_avg")},
    )


@query
def fixed_grain_coarser_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment maxima of each nation summed up at nation level."""
    return aggregates.fixed_grain(
        _orders_by_customer(spark, sf_dir),
        ["c_nationkey", "c_mktsegment"],
        ["c_nationkey"],
        {"_max": ("max", "o_totalprice"), "_n": ("count", F.lit(1))},
        {"sum_of_max": exact_sum("_max", 2), "row_count": F.sum("_n")},
    )


def _cents(column: str):
    """Amounts as the decimals they are."""
    return F.col(column).cast("decimal(18,2)")


def _orders_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_totalprice"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(customer, "c_custkey")


@query
def measure_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum and average of the largest price of each status, and the sum of all prices."""
    per_status = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderstatus")
        .agg(F.max("o_totalprice").alias("top"), F.sum(_cents("o_totalprice")).alias("total"))
    )
    return per_status.agg(
        mean(exact_sum("top", 2), F.count("top")).alias("avg_of_tops"),
        exact_sum("top", 2).alias("sum_of_tops"),
        F.sum("total").cast("double").alias("sum_totalprice"),
    )


@query
def sliding_window_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = windows.sliding_counts_by_pane(events(spark, sf_dir), "ts", ["event_type"], "value", scale=2)
    return _window_columns(result)


def _window_columns(result: DataFrame) -> DataFrame:
    return result.select(
        wall_clock("window_start").alias("window_start"),
        wall_clock("window_end").alias("window_end"),
        "event_type",
        "row_count",
        "avg_value",
    )


# Parsing


@query
def json_decode_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties read under a declared schema and kept within bounds."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.from_json("props", "k string").alias("body")
    )
    typed = rows.select("event_id", "user_id", lenient_int(F.col("body.k")).alias("k"))
    return parse.within(typed, {"k": (10, 60)})


@query
def location_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse.valid_location(as_messages(location_records(spark, sf_dir, broken=True)))
    return rows.select(
        KEY,
        wall_clock("event_time").alias("event_time"),
        *(f.column for f in LOCATION.table_fields),
    )


@query
def evdata_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse.valid_evdata(as_messages(evdata_records(spark, sf_dir, broken=True)))
    return rows.select(KEY, wall_clock("event_time").alias("event_time"), *(f.column for f in EVDATA.table_fields))


@query
def parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_errors(as_messages(evdata_records(spark, sf_dir, broken=True)))


@query
def location_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.consumed_fields(as_messages(location_records(spark, sf_dir, broken=True)), LOCATION)


@query
def evdata_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.consumed_fields(as_messages(evdata_records(spark, sf_dir, broken=True)), EVDATA)


@query
def alias_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field written under different names, blank, or absent."""
    kind, value = F.col("event_type"), F.concat(F.lit(" user "), F.col("user_id").cast("string"))
    spelled = (
        F.when(kind == "click", F.create_map(F.lit("ev_type"), value))
        .when(kind == "view", F.create_map(F.lit("EV Type"), value))
        .when(kind == "purchase", F.create_map(F.lit("electric_vehicle_type"), F.lit(" \t"), F.lit("Ev-Type"), value))
        .when(kind == "signup", F.create_map(F.lit("other"), value))
        .otherwise(F.create_map(F.lit("ev_type"), F.lit("")))
    )
    found = field_by_name(F.col("fields"), "electric_vehicle_type", "ev_type")
    return (
        table(spark, sf_dir, "events")
        .withColumn("fields", spelled)
        .select("event_id", found.alias("found"))
    )


@query
def message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers that are padded, blank or missing."""
    segment = F.col("c_mktsegment")
    identifier = (
        F.when(segment == "BUILDING", F.lit("  "))
        .when(segment == "MACHINERY", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" \t"), F.col("c_name"), F.lit("\n ")))
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", message_key(identifier, F.col("c_custkey") + 1).alias("message_key")
    )


@query
def row_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["p_partkey", "p_name", "p_brand", "p_size"]
    return table(spark, sf_dir, "part").select("p_partkey", row_json(names).alias("value"))


# Latest row per key


@query
def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.latest_by_key(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])


@query
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    cut = F.to_timestamp_ntz(F.lit("2024-01-15"))
    existing = latest.latest_by_key(rows.filter(F.col("ts") < cut), "user_id", ["ts", "event_id"])
    batch = rows.filter(F.col("ts") >= cut)
    return latest.upsert_latest(existing, batch, "user_id", ["ts", "event_id"])


def _event_table(spark: SparkSession, sf_dir: str, path: str) -> KeyedTable:
    schema = table(spark, sf_dir, "events").schema
    return KeyedTable(spark, path, schema, "user_id", ["ts", "event_id"], buckets=8)


def _filled_event_table(spark: SparkSession, sf_dir: str, path: str) -> KeyedTable:
    keyed = _event_table(spark, sf_dir, path)
    for part in reversed(arrivals(table(spark, sf_dir, "events"), "ts", EVENT_CUTS)):
        keyed.upsert(part)
    return keyed


@query
def keyed_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table after three merges, newest part first."""
    return _filled_event_table(spark, sf_dir, new_run_dir(spark, "upsert")).read().drop("bucket")


@query
def catalog_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table through its catalog entry."""
    root = new_run_dir(spark, "catalog")
    database = f"tidemark_{uuid.uuid4().hex}"
    keyed = _filled_event_table(spark, sf_dir, f"{root}/events")
    catalog.ensure_database(spark, database, f"{root}/db")
    catalog.create_keyed_table(spark, f"{database}.events", keyed.schema, keyed)
    return catalog.scan(spark, f"{database}.events")


# CSV and message topics


def _csv_of_customers(spark: SparkSession, sf_dir: str, path: str) -> None:
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("DOL Vehicle ID"),
        F.col("c_name").alias("VIN (1-10)"),
        F.concat(F.lit('a "quoted", '), F.col("c_mktsegment")).alias("County"),
        F.when(F.col("c_nationkey") > 4, F.col("c_nationkey")).alias("Postal Code"),
    )
    rows.write.option("header", True).option("escape", '"').option("encoding", "UTF-8").csv(path)


@query
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as CSV and read back with normalised names."""
    path = new_run_dir(spark, "csv")
    _csv_of_customers(spark, sf_dir, path)
    scan = scan_csv(spark, path)
    return scan.rows.select(*(F.col(f"`{c}`").alias(c.replace("(1-10)", "prefix")) for c in scan.columns))


@query
def csv_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV rows published as JSON messages and read back as location rows."""
    root = new_run_dir(spark, "topic")
    _csv_of_customers(spark, sf_dir, f"{root}/csv")
    log = messages.MessageLog(spark, f"{root}/log")
    log.publish(csv_messages(scan_csv(spark, f"{root}/csv")), "location")
    rows = parse.valid_location(log.read("location"))
    return rows.select(KEY, "vin", "county", "postal_code")


@query
def csv_row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of CSV rows over many files: byte-order mark, line breaks in quotes, blank and missing identifiers."""
    path = new_run_dir(spark, "csv-keys")
    segment = F.col("c_mktsegment")
    identifier = F.when(segment == "BUILDING", F.lit("  ")).when(segment != "MACHINERY", F.concat(F.lit(" "), F.col("c_name")))
    rows = table(spark, sf_dir, "customer").repartitionByRange("c_custkey").sortWithinPartitions("c_custkey")
    rows.select(
        identifier.alias(f"{BOM}DOL Vehicle ID"),
        F.col("c_custkey").alias("VIN (1-10)"),
        F.concat(segment, F.lit("\nsecond line")).alias("County"),
    ).write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    keyed = csv_messages(scan_csv(spark, path))
    return keyed.select(
        "key",
        F.get_json_object("value", "$['vin_(1-10)']").cast("bigint").alias("c_custkey"),
        F.get_json_object("value", "$.county").alias("county"),
    )


@query
def csv_split_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of CSV files whose records hold line breaks, with blank lines between them, read in splits."""
    path = new_run_dir(spark, "csv-splits")
    number = F.col("c_custkey")
    identifier = F.when(number % 5 == 0, F.lit("")).otherwise(F.col("c_name"))
    record = F.concat(identifier, F.lit(',"'), F.col("c_mktsegment"), F.lit('\nsecond ""line"""'), F.when(number % 11 == 0, "\n").otherwise(""))
    customers = table(spark, sf_dir, "customer")
    rows = customers.select((number % 8).alias("file"), number.alias("place"), record.alias("value"))
    header = rows.select("file").distinct().select("file", F.lit(-1).cast("bigint").alias("place"), F.lit("DOL Vehicle ID,County").alias("value"))
    lines = rows.unionByName(header).repartition("file").sortWithinPartitions("file", "place")
    lines.select("file", "value").write.partitionBy("file").text(path)
    return csv_messages(scan_csv(spark, path)).select("key", "value")


@query
def topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per topic and in total after publishing both topics."""
    log = messages.MessageLog(spark, new_run_dir(spark, "topics"))
    log.publish(location_records(spark, sf_dir), "location")
    log.publish(evdata_records(spark, sf_dir), "evdata")
    return log.topic_counts("location", "evdata")


@query
def bounded_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both CSV inputs published with a limit for each topic, and what the topics then hold."""
    config = _vehicle_config(spark, "publish")
    location_csv, evdata_csv = f"{config.messages}-location", f"{config.messages}-evdata"
    _csv_of_customers(spark, sf_dir, location_csv)
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("DOL Vehicle ID"), F.col("o_orderpriority").alias("Make"))
    orders.write.option("header", True).csv(evdata_csv)
    messages.publish_both(spark, config, location_csv, evdata_csv, 2000)
    return messages.MessageLog(spark, config.messages).topic_counts(config.location_topic, config.evdata_topic)


@query
def bounded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded consume: the first 500 messages of a topic."""
    first = messages.bounded_read(as_messages(event_records(events(spark, sf_dir))), 500)
    return parse.decode(first, "user_key").select("user_key", "msg_offset", wall_clock("event_time").alias("event_time"))


@query
def location_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.topic_summary(as_messages(location_records(spark, sf_dir, broken=True)), LOCATION)


@query
def evdata_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.topic_summary(as_messages(evdata_records(spark, sf_dir, broken=True)), EVDATA)


@query
def top_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = summaries.topic_summary(as_messages(location_records(spark, sf_dir)), LOCATION)
    return summaries.top_values(summary, "county", 10)


@query
def vehicle_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = summaries.topic_summary(as_messages(evdata_records(spark, sf_dir)), EVDATA)
    return summaries.top_values(summary, "electric_vehicle_type", None)


# Vehicle tables and streams


def _vehicle_config(spark: SparkSession, label: str) -> PipelineConfig:
    root = new_run_dir(spark, label)
    return PipelineConfig(
        warehouse=f"{root}/warehouse",
        checkpoints=f"{root}/checkpoints",
        messages=f"{root}/log",
        database=f"tidemark_{uuid.uuid4().hex}",
        buckets=8,
    )


def _order_cuts() -> tuple[str, ...]:
    return ("1997-06-01", "1999-06-01")


@query
def aggregate_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate kept up to date over several upserts of both tables."""
    tables = app.VehicleTables(spark, _vehicle_config(spark, "refresh"))
    tables.ensure()
    evdata = arrivals(evdata_records(spark, sf_dir), "timestamp", _order_cuts())
    tables.evdata.upsert(parse.valid_evdata(as_messages(evdata[1])))
    tables.location.upsert(parse.valid_location(as_messages(location_records(spark, sf_dir))))
    tables.refresh_aggregate()
    for part in (evdata[2], evdata[0]):
        tables.evdata.upsert(parse.valid_evdata(as_messages(part)))
        tables.refresh_aggregate()
    return tables.scan(tables.config.aggregate_table)


def _workbook(spark: SparkSession, sf_dir: str):
    """The workbook's model over catalog tables in which a seventh of the vehicles have no location."""
    tables = app.VehicleTables(spark, _vehicle_config(spark, "workbook"))
    tables.ensure()
    located = location_records(spark, sf_dir).filter(F.col("key").cast("bigint") % 7 != 0)
    for name, keyed, rows in (
        (tables.config.location_table, tables.location, parse.valid_location(as_messages(located))),
        (tables.config.evdata_table, tables.evdata, parse.valid_evdata(as_messages(evdata_records(spark, sf_dir)))),
    ):
        tables.publish_changes(name, keyed, keyed.snapshot(), keyed.upsert(rows))
    tables.refresh_aggregate()
    return workbook.workbook_model(tables)


@query
def worksheet_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workbook.average_and_largest_range(_workbook(spark, sf_dir))


@query
def worksheet_county_make(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workbook.county_and_make(_workbook(spark, sf_dir))


@query
def worksheet_make_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workbook.make_and_model(_workbook(spark, sf_dir))


@query
def worksheet_make_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workbook.make_and_city(_workbook(spark, sf_dir))


def _rounded(measures: DataFrame) -> DataFrame:
    """Sums of doubles to six places: the last bits depend on the order of addition."""
    return measures.withColumns({c: F.round(c, 6) for c in ("avg_of_averages", "sum_of_averages")})


@query
def workbook_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average and sum of the stored averages, and the sum of the stored ranges."""
    return _rounded(workbook.stored_measures(_workbook(spark, sf_dir)))


@query
def workbook_measures_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a dimension of the third table, to which one of them relates many-to-many."""
    return _rounded(workbook.stored_measures(_workbook(spark, sf_dir), ("city",)))


def _publish_vehicles(spark: SparkSession, sf_dir: str, config: PipelineConfig, broken: bool = False) -> messages.MessageLog:
    log = messages.MessageLog(spark, config.messages)
    log.publish(location_records(spark, sf_dir, broken), config.location_topic)
    for part in arrivals(evdata_records(spark, sf_dir, broken), "timestamp", _order_cuts()):
        log.publish(part, config.evdata_topic)
    return log


@query
def stream_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics streamed into their tables, with the aggregate they leave behind."""
    config = _vehicle_config(spark, "streams")
    _publish_vehicles(spark, sf_dir, config)
    tables, queries = app.start_streams(spark, config, trigger=None)
    for running in queries:
        running.awaitTermination()
    return tables.scan(config.aggregate_table)


@query
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both streams consumed, as committed with their tables: broken messages count."""
    config = _vehicle_config(spark, "progress")
    _publish_vehicles(spark, sf_dir, config, broken=True)
    tables, queries = app.start_streams(spark, config, trigger=None)
    for running in queries:
        running.awaitTermination()
    rows = [(name, *(counts[c] for c in PROGRESS)) for name, counts in tables.consumed().items()]
    return spark.createDataFrame(rows, ", ".join(["table_name string", *(f"{c} bigint" for c in PROGRESS)]))


@query
def rebuild_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tables replayed from all messages in batch."""
    config = _vehicle_config(spark, "rebuild")
    _publish_vehicles(spark, sf_dir, config)
    tables = app.VehicleTables(spark, config)
    tables.ensure()
    tables.rebuild()
    return tables.scan(config.aggregate_table)


EVENT_BODY = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("props", T.StringType()),
    ]
)


#: Bytes of files a batch of the events takes: about three million events, the state of which fits in the executors' heap.
BATCH_BYTES = 64 << 20


def _by_arrival(
    log: messages.MessageLog, topic: str, parts: list[DataFrame], start: Callable[[DataFrame], StreamingQuery], arranged: bool = False
) -> None:
    """Publish a part, stream all there is, and go on with the next part.

    Each start resumes from the same checkpoint. A batch takes files up to ``BATCH_BYTES``, so
    a large part spans batches, as many as its bytes ask for and not its files; the files are
    in the order of time, so none of its rows come behind the watermark that the others
    have moved.
    """
    for part in parts:
        log.publish(part, topic, by_time=True, arranged=arranged)
        start(log.read_stream(topic, max_bytes_per_trigger=BATCH_BYTES)).awaitTermination()


def _stream_events(
    spark: SparkSession, sf_dir: str, root: str, start: Callable[[DataFrame], StreamingQuery]
) -> None:
    """Stream the events as they arrive in three parts; ``start`` gets them decoded."""
    parts = [event_records(messages.in_time_ranges(p, "ts", "event_id")) for p in arrivals(events(spark, sf_dir), "ts", EVENT_CUTS)]
    _by_arrival(messages.MessageLog(spark, f"{root}/log"), "events", parts, lambda s: start(_decoded_events(s)), arranged=True)


def _decoded_events(topic: DataFrame) -> DataFrame:
    stream = parse.decode(topic)
    body = stream.select("event_time", F.from_json("payload", EVENT_BODY).alias("e"))
    return body.select(
        F.col("e.event_id").cast("long").alias("event_id"),
        F.col("event_time").alias("ts"),
        F.col("e.user_id").cast("long").alias("user_id"),
        "e.event_type",
        F.col("e.value").cast("double").alias("value"),
        "e.props",
    )


@query
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_run_dir(spark, "stream-upsert")
    keyed = _event_table(spark, sf_dir, f"{root}/table")
    _stream_events(
        spark,
        sf_dir,
        root,
        lambda rows: writers.start_upserts(
            rows.withColumn("ts", wall_clock("ts")), keyed, f"{root}/checkpoint", None
        ),
    )
    return keyed.read().drop("bucket")


@query
def stream_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_run_dir(spark, "stream-join")
    _stream_events(
        spark,
        sf_dir,
        root,
        lambda rows: writers.start_append(
            _pair_columns(_near_pairs(rows, rows, "10 minutes")), f"{root}/pairs", f"{root}/checkpoint", None
        ),
    )
    rows = events(spark, sf_dir)
    return spark.read.schema(_pair_columns(_near_pairs(rows, rows)).schema).parquet(f"{root}/pairs")


@query
def stream_join_rocksdb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join with its state in RocksDB, stopped and started again after every part."""
    with state_in_rocksdb(spark):
        return stream_interval_join(spark, sf_dir)


@query
def stream_vehicle_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics joined as streams, messages sent twice, each vehicle counted once with its latest pair."""
    root = new_run_dir(spark, "stream-once")
    log = messages.MessageLog(spark, f"{root}/log")
    kept: KeyedTable | None = None
    for part in arrivals(events(spark, sf_dir), "ts", EVENT_CUTS):
        for _ in range(2):
            log.publish(sighting_records(part, "click"), "location")
        log.publish(sighting_records(part, "purchase"), "evdata")
        pairs = _vehicle_pairs(log.read_stream("location"), log.read_stream("evdata"), "10 minutes")
        once = joins.distinct_pairs(pairs)
        kept = kept or KeyedTable(spark, f"{root}/table", once.schema, KEY, joins.PAIR_ORDER, buckets=8)
        writers.start_upserts(once, kept, f"{root}/checkpoint", None).awaitTermination()
    return aggregates.count_and_average(kept.read())


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows of parts that arrive out of order: late rows set aside, then added to their windows."""
    root = new_run_dir(spark, "stream-late")
    rows = events(spark, sf_dir)
    groups = T.StructType([rows.schema["event_type"]])
    kept = late.LateWindows.make_table(spark, f"{root}/table", groups, T.DecimalType(28, 2))
    decoded = _decoded_events(as_messages(event_records(rows)))
    windowed = late.LateWindows(kept, f"{root}/late", decoded.schema, "ts", ["event_type"], _cents("value"))
    first, second, third = (event_records(p) for p in arrivals(rows, "ts", EVENT_CUTS))
    log = messages.MessageLog(spark, f"{root}/log")
    _by_arrival(log, "events", [second, first, third], lambda s: windowed.start(_decoded_events(s), f"{root}/checkpoint", None))
    windowed.correct()
    return _window_columns(kept.read())


@query
def stream_vehicle_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics joined as streams within ten minutes, then counted and averaged."""
    root = new_run_dir(spark, "stream-vehicles")
    log = messages.MessageLog(spark, f"{root}/log")
    for part in arrivals(events(spark, sf_dir), "ts", EVENT_CUTS):
        log.publish(sighting_records(part, "click"), "location")
        log.publish(sighting_records(part, "purchase"), "evdata")
        pairs = _vehicle_pairs(log.read_stream("location"), log.read_stream("evdata"), "10 minutes")
        writers.start_append(pairs, f"{root}/pairs", f"{root}/checkpoint", None).awaitTermination()
    return aggregates.count_and_average(spark.read.schema(pairs.schema).parquet(f"{root}/pairs"))


@query
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows kept in a keyed table from the changes of each micro-batch."""
    root = new_run_dir(spark, "stream-windows")
    schema = windows.sliding_counts(events(spark, sf_dir), "ts", ["event_type"], "value").schema
    keyed = KeyedTable(spark, f"{root}/table", schema, ["window_start", "event_type"], ["row_count"], buckets=8)
    _stream_events(
        spark,
        sf_dir,
        root,
        lambda rows: writers.start_upserts(
            windows.sliding_counts(rows, "ts", ["event_type"], "value", watermark="10 minutes", scale=2),
            keyed,
            f"{root}/checkpoint",
            None,
            output_mode="update",
        ),
    )
    return _window_columns(keyed.read())


@query
def stream_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts of a topic, kept in a table while it is read."""
    root = new_run_dir(spark, "stream-summary")
    log = messages.MessageLog(spark, f"{root}/log")
    kept = AdditiveTable(spark, f"{root}/table", T.StructType(summaries.SUMMARY_SCHEMA.fields[:2]), ["row_count"], "row_count")
    _by_arrival(
        log,
        "evdata",
        arrivals(evdata_records(spark, sf_dir, broken=True), "timestamp", _order_cuts()),
        lambda s: writers.start_counts(s, kept, lambda batch: summaries.topic_summary(batch, EVDATA), f"{root}/checkpoint", None),
    )
    return kept.read().drop("bucket")
