"""Rules of the keyed streams, their tables and windows, on small invented rows."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import aggregates, joins, latest, parse, windows
from tidemark.plans.catalogue import QUERIES
from tidemark.sources.csv import csv_messages, scan_csv
from tidemark.sources.messages import MessageLog
from tidemark.sources.tables import KeyedTable

SMALL = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1, 12)


def messages(spark, rows):
    schema = "key binary, value binary, timestamp timestamp, partition int, offset bigint"
    return spark.createDataFrame([(None if k is None else k.encode(), v.encode(), START, 0, i) for i, (k, v) in enumerate(rows)], schema)


def test_bounds_of_range_and_year(spark):
    ranges = ["-1", "0", "600", "601", None, "abc", ""]
    years = ["1989", "1990", "2025", "2026"]
    rows = [("r", '{"electric_range":%s,"model_year":"2000"}' % (f'"{x}"' if x is not None else "null")) for x in ranges]
    rows += [("y", '{"electric_range":"1","model_year":"%s"}' % y) for y in years] + [("b", "{broken")]
    got = parse.valid_evdata(messages(spark, rows)).select("electric_range", "model_year").collect()
    assert sorted(map(tuple, got)) == [(0, 2000), (1, 1990), (1, 2025), (600, 2000)]
    assert parse.valid_evdata(messages(spark, rows), {}).count() == len(rows)


def test_one_parse_per_message(spark):
    rows = parse.valid_evdata(messages(spark, [("a", "{}")]))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_null_key_is_dropped_and_empty_kept(spark):
    got = parse.valid_location(messages(spark, [(None, "{}"), ("", "{}"), ("k", "{broken")])).collect()
    assert sorted(r.dol_vehicle_id for r in got) == ["", "k"]


@pytest.mark.parametrize("size, slide", [("5 minutes", "1 minute"), ("5 minutes", "2 minutes"), ("90 seconds", "60 seconds")])
def test_panes_equal_windows(spark, size, slide):
    rows = spark.createDataFrame([(START + dt.timedelta(seconds=37 * i), "a" if i % 3 else None, float(i)) for i in range(40)], "ts timestamp, g string, v double")
    plain = windows.sliding_counts(rows, "ts", ["g"], "v", size=size, slide=slide)
    paned = windows.sliding_counts_by_pane(rows, "ts", ["g"], "v", size=size, slide=slide)
    assert sorted(map(str, plain.collect())) == sorted(map(str, paned.collect()))


def test_averages_are_not_rounded(spark):
    rows = spark.createDataFrame([("a", START, 0.004)] * 10 + [("b", START, float("nan")), ("c", START, None), ("d", START, 1e18)], "g string, ts timestamp, v double")
    dims = spark.createDataFrame([(g, g.upper()) for g in "abcd"], "g string, n string")
    want = {"A": pytest.approx(0.004), "B": pytest.approx(float("nan"), nan_ok=True), "C": None, "D": 1e18}
    got = {r.n: r.avg_value for r in aggregates.joined_count_and_average(rows, dims, "g", ["n"], "v").collect()}
    assert got == want
    paned = windows.sliding_counts_by_pane(rows, "ts", ["g"], "v").collect()
    assert len(paned) == 20 and all(r.avg_value == want[r.g.upper()] for r in paned)


def test_fixed_values_at_a_finer_view(spark):
    rows = spark.createDataFrame([("x", "p", 1.0), ("x", "p", 2.0), ("x", "q", 6.0), (None, "p", 5.0), ("y", None, None)], "a string, b string, v double")
    inner = {"mean": ("avg", "v"), "top": ("max", "v"), "n": ("count", F.lit(1))}
    outer = {"m": F.sum("mean"), "t": F.max("top"), "c": F.sum("n")}
    got = aggregates.fixed_grain(rows, ["a"], ["a", "b"], inner, outer)
    assert {tuple(r) for r in got.collect()} == {("x", "p", 3.0, 6.0, 3), ("x", "q", 3.0, 6.0, 3), (None, "p", 5.0, 5.0, 1), ("y", None, None, None, 1)}


def test_latest_row_whatever_the_order(spark):
    rows = [("a", START, 1), ("a", START + dt.timedelta(seconds=1), 2), ("b", START + dt.timedelta(seconds=1), 3), ("b", START, 4)]
    for given in (rows, rows[::-1]):
        got = latest.latest_by_key(spark.createDataFrame(given, "k string, event_time timestamp, v int"), "k", ["event_time"])
        assert {r.k: r.v for r in got.collect()} == {"a": 2, "b": 3}


def test_interval_join_includes_its_ends(spark):
    left = spark.createDataFrame([("k", START)], "k string, l timestamp")
    offsets = [dt.timedelta(minutes=10), dt.timedelta(minutes=-10), dt.timedelta(minutes=10, microseconds=1)]
    right = spark.createDataFrame([("k", START + d, i) for i, d in enumerate(offsets)], "k string, r timestamp, i int")
    assert {r.i for r in joins.interval_join(left, right, "k", "l", "r", 600, None).collect()} == {0, 1}


def test_upsert_is_idempotent_and_keeps_its_layout(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.LongType())])
    table = KeyedTable(spark, str(tmp_path / "t"), schema, "k", ["t"], buckets=4)
    batch = spark.createDataFrame([(i, 1) for i in range(6)], schema)
    table.upsert(batch, "q", 0)
    table.upsert(batch.withColumn("t", F.lit(9).cast("long")), "q", 0)
    assert {r.t for r in table.read().collect()} == {1} and table.read().count() == 6
    other = KeyedTable(spark, str(tmp_path / "t"), schema, "k", ["t"], buckets=3)
    with pytest.raises(ValueError):
        other.upsert(batch, "q", 1)
    other.rebuild(batch)
    other.upsert(batch, "q", 2)
    assert other.read().count() == 6


def test_retention_by_age_and_number(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.LongType())])

    def committed(name, seconds):
        table = KeyedTable(spark, str(tmp_path / name), schema, "k", ["t"], buckets=2, keep=2, keep_seconds=seconds)
        for t in range(4):
            table.upsert(spark.createDataFrame([(1, t)] if t else [(i, 0) for i in range(6)], schema))
        assert sorted(map(tuple, table.read().drop("bucket").collect())) == [(0, 0), (1, 3), *((i, 0) for i in range(2, 6))]
        return table._snapshot_ids()

    assert committed("young", 3600) == [0, 1, 2, 3]
    assert committed("old", 0) == [2, 3]


@pytest.mark.parametrize("split_bytes", ["64", "1000000"])
def test_csv_rows_are_numbered_in_order_whatever_the_splits(spark, tmp_path, split_bytes):
    for name, first in (("a", 0), ("b", 40)):
        lines = [f"{'' if i % 3 else f'id{i}'},v{i}" for i in range(first, first + 40)]
        (tmp_path / f"{name}.csv").write_text("\n".join(["\ufeffDOL Vehicle ID,VIN", *lines]) + "\n", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        rows = csv_messages(scan_csv(spark, str(tmp_path)))
        got = sorted((r.row_index, r.key, r.value) for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [(i + 1, str(i + 1) if i % 3 else f"id{i}", '{"dol_vehicle_id":"%s","vin":"v%d"}' % ("" if i % 3 else f"id{i}", i)) for i in range(80)]
    assert got == want


def test_csv_short_rows_line_breaks_and_limit(spark, tmp_path):
    text = 'DOL Vehicle ID,County,Make\nx,"two\nlines",m\n,only\n\n"  ",c,"a ""b"", c"\n'
    (tmp_path / "c.csv").write_text(text, encoding="utf-8")
    rows = csv_messages(scan_csv(spark, str(tmp_path)))
    assert sorted((r.key, r.value) for r in rows.collect()) == [
        ("2", '{"dol_vehicle_id":"","county":"only"}'),
        ("3", '{"dol_vehicle_id":""}'),
        ("4", '{"dol_vehicle_id":"  ","county":"c","make":"a \\"b\\", c"}'),
        ("x", '{"dol_vehicle_id":"x","county":"two\\nlines","make":"m"}'),
    ]
    assert csv_messages(scan_csv(spark, str(tmp_path)), 2).count() == 2


@pytest.mark.parametrize("split_bytes", ["60", "1000000"])
def test_csv_records_over_lines_are_the_same_whatever_the_splits(spark, tmp_path, split_bytes):
    rnd, want = random.Random(3), []
    pieces = ['""', "a", "\n", ",", "b c", "\n\n", "\r\n", "é"]
    for name in "ab":
        body = ["DOL Vehicle ID,County,Make"]
        for i in range(16):
            quoted = "".join(rnd.choice(pieces) for _ in range(rnd.randrange(6)))
            identifier, blank = ("" if i % 4 == 0 else f"{name}{i}"), i % 7 == 3
            body.append("" if blank else f'{identifier},"{quoted}",m')
            fields = {"dol_vehicle_id": ""} if blank else {"dol_vehicle_id": identifier, "county": quoted.replace('""', '"'), "make": "m"}
            number = len(want) + 1
            want.append((number, str(number) if blank or not identifier else identifier, fields))
        (tmp_path / f"{name}.csv").write_bytes("\n".join([*body, ""]).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        got = csv_messages(scan_csv(spark, str(tmp_path))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.row_index, r.key, json.loads(r.value)) for r in got) == want


def test_publishing_without_places_numbers_the_rows(spark, tmp_path):
    log = MessageLog(spark, str(tmp_path / "log"))
    rows = spark.range(0, 50, 1, 4).select(F.col("id").cast("string").alias("key"), F.lit("{}").alias("value"))
    assert log.publish(rows, "t", limit=20) == 20 and log.publish(rows, "t", start=20) == 50
    assert sorted(r.offset for r in log.read("t").collect()) == list(range(70))


def test_stream_equals_batch(spark):
    streamed = QUERIES["stream_sliding"](spark, SMALL)
    batch = QUERIES["sliding_window_agg"](spark, SMALL)
    assert streamed.exceptAll(batch.select(streamed.columns)).isEmpty() and streamed.count() == batch.count()
