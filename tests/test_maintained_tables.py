"""Aggregates kept up to date by changes, the logical model, late rows and running streams, on small invented rows."""

import datetime as dt
import random
import threading
import time
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import PipelineConfig
from tidemark.functions.numeric import exact_sum
from tidemark.operators import joins, parse, windows
from tidemark.operators.aggregates import count_and_average
from tidemark.operators.model import LogicalModel, Measure, Relationship
from tidemark.plans import workbook
from tidemark.schemas import KEY
from tidemark.session import ROCKSDB_STATE, session_settings, state_in_rocksdb
from tidemark.sources import messages as topics
from tidemark.sources.additive import AdditiveTable
from tidemark.sources.messages import MessageLog, bounded_read, kafka_options
from tidemark.sources.tables import KeyedTable
from tidemark.streaming import app, late, writers
from tidemark.streaming.progress import ConsumptionListener

START = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)


def config(tmp_path, **more):
    settings = {"buckets": 4, "aggregate_buckets": 16} | more
    return PipelineConfig(f"{tmp_path}/warehouse", f"{tmp_path}/checkpoints", f"{tmp_path}/log", database=f"t_{uuid.uuid4().hex}", **settings)


def locations(spark, rows):
    """(key, county, time)"""
    body = "{'county':'%s'}".replace("'", '"')
    return parse.valid_location(raw(spark, [(k, body % c if c is not None else "{}", t) for k, c, t in rows]))


def vehicles(spark, rows):
    """(key, make, range, time)"""
    body = '{"make":"%s","electric_range":"%s","model_year":"2000"}'
    return parse.valid_evdata(raw(spark, [(k, body % (m, r), t) for k, m, r, t in rows]))


def raw(spark, rows):
    schema = "key binary, value binary, timestamp timestamp, partition int, offset bigint"
    return spark.createDataFrame([(k and k.encode(), v.encode(), START + dt.timedelta(seconds=t), 0, i) for i, (k, v, t) in enumerate(rows)], schema)


def state(table):
    return sorted((tuple(r) for r in table.read().select("county", "make", "vehicle_count", "avg_electric_range").collect()), key=str)


def test_aggregate_follows_random_upserts(spark, tmp_path):
    tables, rnd = app.VehicleTables(spark, config(tmp_path)), random.Random(9)
    tables.ensure()
    for step in range(5):
        keys = rnd.sample(range(40), 12)
        if step != 2:
            tables.location.upsert(locations(spark, [(f"k{k}", rnd.choice(["a", "b", "c", None]), step) for k in keys]))
        if step != 1:
            tables.evdata.upsert(vehicles(spark, [(f"k{k}", rnd.choice("xyz"), rnd.randrange(300), step) for k in rnd.sample(range(40), 12)]))
        tables.refresh_aggregate()
        if step >= 2:
            want = count_and_average(joins.vehicle_join(tables.location.read(), tables.evdata.read()))
            assert state(tables.aggregate) == sorted((tuple(r) for r in want.collect()), key=str)
    assert sorted(map(str, tables.scan("ev_aggregation").collect())) == sorted(map(str, tables.aggregate.read().select("county", "make", "vehicle_count", "avg_electric_range").collect()))


def test_a_small_change_rewrites_only_buckets_of_its_groups(spark, tmp_path):
    tables = app.VehicleTables(spark, config(tmp_path))
    tables.ensure()
    tables.location.upsert(locations(spark, [(f"k{i}", f"c{i % 30}", 0) for i in range(90)]))
    tables.evdata.upsert(vehicles(spark, [(f"k{i}", "m", i, 0) for i in range(90)]))
    before = tables.refresh_aggregate()
    tables.location.upsert(locations(spark, [("k7", "c8", 1)]))
    after = tables.refresh_aggregate()
    changed = {b for b in before.versions.keys() | after.versions.keys() if before.versions.get(b) != after.versions.get(b)}
    groups = spark.createDataFrame([("c7", "m"), ("c8", "m")], "county string, make string")
    assert changed <= {str(r.bucket) for r in tables.aggregate.placed(groups).collect()}
    counts = {r.county: r.vehicle_count for r in tables.aggregate.read().collect()}
    assert counts["c7"] == 2 and counts["c8"] == 4 and len(counts) == 30


def test_aggregate_stays_while_nothing_joins_and_comes_back_without_old_snapshots(spark, tmp_path):
    tables = app.VehicleTables(spark, config(tmp_path, keep_snapshots=1, keep_seconds=0))
    tables.ensure()
    tables.location.upsert(locations(spark, [("a", "c", 0)]))
    assert tables.refresh_aggregate() is None
    tables.evdata.upsert(vehicles(spark, [("a", "m", 5, 0)]))
    tables.refresh_aggregate()
    assert state(tables.aggregate) == [("c", "m", 1, 5.0)]
    tables.evdata.rebuild(vehicles(spark, [("b", "n", 7, 0)]))
    tables.refresh_aggregate()
    assert state(tables.aggregate) == [("c", "m", 1, 5.0)]
    for t in range(3):
        tables.location.upsert(locations(spark, [("b", f"d{t}", t)]))
    tables.refresh_aggregate()
    assert state(tables.aggregate) == [("d2", "n", 1, 7.0)]


def test_additive_table_counts_a_batch_once_and_drops_empty_groups(spark, tmp_path):
    table = AdditiveTable(spark, str(tmp_path / "t"), T.StructType().add("g", "string"), ["n"], "n", buckets=4)
    rows = spark.createDataFrame([("a",), ("a",), (None,)], "g string")
    count = lambda batch: batch.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    for _ in range(2):
        table.add_batch(rows, "q", 0, count)
    assert {r.g: r.n for r in table.read().collect()} == {"a": 2, None: 1}
    table.add(table.change(count(rows.filter("g is null")), count(rows.filter("g is not null"))))
    assert {r.g: r.n for r in table.read().collect()} == {None: 2}


@pytest.fixture
def model(spark):
    places = spark.createDataFrame([("1", "p", "x"), ("2", "p", "y"), ("3", "q", "x"), ("9", None, "z")], f"{KEY} string, county string, city string")
    cars = spark.createDataFrame([("1", "m", 10), ("2", "m", 20), ("3", "n", 40), ("4", "n", 80), ("9", None, None)], f"{KEY} string, make string, range int")
    sums = spark.createDataFrame([("p", "m", 15.0), ("q", "n", 40.0), ("r", "k", 1.0)], "county string, make string, mean double")
    relations = [Relationship("places", "county", "sums", "county"), Relationship("places", KEY, "cars", KEY)]
    fields = {"county": ("places", "county"), "city": ("places", "city"), "make": ("cars", "make"), "range": ("cars", "range"), "mean": ("sums", "mean"), "sum_make": ("sums", "make")}
    return LogicalModel({"places": places, "cars": cars, "sums": sums}, relations, fields)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_views_read_only_the_tables_they_need(model):
    view = model.view(["make"], {"n": Measure("count", table="cars")})
    assert "Join" not in view._jdf.queryExecution().optimizedPlan().toString()
    assert rows(view) == [("m", 2), ("n", 2), (None, 1)]
    two = model.view(["city"], {"n": Measure("count", table="cars")})._jdf.queryExecution().optimizedPlan().toString()
    assert two.count("Join") == 1


def test_measures_keep_rows_without_partner_and_do_not_fan_out(model):
    assert rows(model.view(["county", "make"], {"n": Measure("count", table="cars"), "top": Measure("max", "range")})) == [("p", "m", 2, 20), ("q", "n", 1, 40), (None, "n", 1, 80), (None, None, 1, None)]
    # County p has two places but its stored mean counts once for each city, and once in all.
    assert rows(model.view(["city"], {"s": Measure("sum", "mean"), "r": Measure("sum", "range")})) == sorted([("x", 55.0, 50), ("y", 15.0, 20), ("z", None, None), (None, 1.0, 80)], key=str)
    assert rows(model.view([], {"s": Measure("sum", "mean"), "a": Measure("avg", "mean"), "r": Measure("sum", "range")})) == [(56.0, 56 / 3, 150)]


def test_fixed_measures_at_coarser_and_finer_views(model):
    fixed = Measure("avg", "range", fixed=("county", "make"))
    assert rows(model.view(["county", "make"], {"f": fixed})) == [("p", "m", 15.0), ("q", "n", 40.0), (None, "n", 80.0), (None, None, None)]
    assert rows(model.view(["make"], {"f": fixed})) == [("m", 15.0), ("n", 120.0), (None, None)]
    assert rows(model.view(["city", "make"], {"f": fixed, "n": Measure("count", table="cars")})) == [("x", "m", 15.0, 1), ("x", "n", 40.0, 1), ("y", "m", 15.0, 1), ("z", None, None, 1), (None, "n", 80.0, 1)]


def test_unrelated_tables_are_refused(spark, model):
    apart = LogicalModel({"cars": model.tables["cars"], "sums": model.tables["sums"]}, [], {"make": ("cars", "make"), "mean": ("sums", "mean")})
    with pytest.raises(ValueError):
        apart.view(["make"], {"s": Measure("sum", "mean")})
    with pytest.raises(ValueError):
        LogicalModel(model.tables, [], {"x": ("cars", "no column")})
    assert set(workbook.FIELDS.values()) >= {(workbook.TOTALS, "avg_electric_range")}


def test_sums_do_not_depend_on_the_order(spark):
    values = [0.1, 0.2, 0.3, 1e15, -1e15, 0.05, None] * 50
    for given in (values, sorted(values, key=str)):
        assert spark.createDataFrame([(v,) for v in given], "v double").agg(exact_sum("v", 2)).first()[0] == 32.5
    for odd, want in ((float("nan"), None), (float("inf"), float("inf")), (1e30, 1e30)):
        got = spark.createDataFrame([(1.25,), (odd,)], "v double").agg(exact_sum("v", 2)).first()[0]
        assert got == want or (want is None and got != got)
    assert spark.createDataFrame([], "v double").agg(exact_sum("v", 2)).first()[0] is None


def test_bounded_read_sorts_nothing(spark, monkeypatch):
    rnd = random.Random(1)
    held = [(p, o) for p, n in ((0, 700), (2, 500), (5, 1)) for o in rnd.sample(range(0, 10**7), n)] + [(2, 12345)] * 3
    frame = spark.createDataFrame(held, "partition int, offset bigint")
    monkeypatch.setattr(topics, "RANGES", 16)
    for limit in (1, 350, 600, 700, 701, 1000, len(held), len(held) + 5):
        assert rows(bounded_read(frame, limit)) == sorted(sorted(held)[:limit], key=str)
    assert rows(bounded_read(frame, 0)) == sorted(held, key=str)
    same = spark.createDataFrame([(1, 7)] * 9, "partition int, offset bigint")
    assert bounded_read(same, 4).count() == 4
    plan = bounded_read(frame, 600)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Sort" not in plan


def late_windows(spark, root):
    schema = T.StructType().add("ts", "timestamp").add("g", "string").add("v", "integer")
    table = late.LateWindows.make_table(spark, f"{root}/table", T.StructType().add("g", "string"), T.LongType(), buckets=2)
    return late.LateWindows(table, f"{root}/late", schema, "ts", ["g"], F.col("v")), schema


def window_rows(frame):
    return sorted((tuple(r) for r in frame.select("window_start", "g", "row_count", "avg_value").collect()), key=str)


def test_late_rows_are_set_aside_and_added_once(spark, tmp_path):
    windowed, schema = late_windows(spark, tmp_path)
    given = [(START + dt.timedelta(seconds=20 * i), "a" if i % 3 else None, i) for i in range(120)]
    parts = [given[60:90], given[:60], given[90:], [(None, "a", 1), (START, "b", None)]]
    for number, part in enumerate(parts):
        batch = spark.createDataFrame(part, schema)
        windowed.add(batch, "q", number)
        windowed.add(batch, "q", number)
    done = windowed.table.snapshot().progress["q"]
    behind = [r for r in given[:60] if r[0] < given[89][0] - dt.timedelta(minutes=10)] + [(START, "b", None)]
    assert (done["rows"], done["late"]) == (122, len(behind)) and windowed.late_rows().count() == len(behind)
    batch = spark.createDataFrame([r for p in parts for r in p], schema)
    want = windows.sliding_counts(batch.filter("ts is not null"), "ts", ["g"], "v")
    assert window_rows(windowed.table.read()) != window_rows(want)
    for _ in range(2):
        windowed.correct()
        assert window_rows(windowed.table.read()) == window_rows(want)
    assert windowed.late_rows(corrected=False).isEmpty() and windowed.late_rows().count() == len(behind)


def publish_parts(spark, log, sizes):
    """Parts of so many files, one after the other in time."""
    at = 0
    for files in sizes:
        span = range(at, at + 40 * files)
        part = spark.createDataFrame([(f"k{i % 5}", str(i), START + dt.timedelta(seconds=30 * i), i + 1) for i in random.Random(at).sample(span, len(span))], "key string, value string, timestamp timestamp, row_index bigint")
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", files)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        log.publish(part, "t", by_time=True)
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        at += 40 * files


def test_a_part_over_many_batches_loses_no_row(spark, tmp_path):
    log = MessageLog(spark, str(tmp_path / "log"))
    publish_parts(spark, log, (10, 1, 1))
    assert log.file_count("t") == 12
    stream = log.read_stream("t", 1).select(F.col("timestamp").alias("ts"), F.col("value").cast("string").cast("long").alias("v"), F.lit("g").alias("g"))
    counted = windows.sliding_counts(stream, "ts", ["g"], "v", watermark="10 minutes")
    table = KeyedTable(spark, str(tmp_path / "w"), counted.schema, ["window_start", "g"], ["row_count"], buckets=2)
    query = writers.start_upserts(counted, table, str(tmp_path / "c"), None, output_mode="update")
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p.numInputRows]
    assert len(progress) == 12 and sum(o.numRowsDroppedByWatermark for p in progress for o in p.stateOperators) == 0
    batch = log.read("t").select(F.col("timestamp").alias("ts"), F.col("value").cast("string").cast("long").alias("v"), F.lit("g").alias("g"))
    assert window_rows(table.read()) == window_rows(windows.sliding_counts(batch, "ts", ["g"], "v"))


def fill_topics(spark, settings, step):
    log = MessageLog(spark, settings.messages)
    body = "key string, value string, timestamp timestamp, row_index bigint"
    at = START + dt.timedelta(seconds=step)
    log.publish(spark.createDataFrame([("a", '{"county":"c"}', at, 1), ("b", "{broken", at, 2), (None, "{}", at, 3)], body), settings.location_topic)
    good = '{"make":"m","electric_range":"%d","model_year":"2000"}' % step
    log.publish(spark.createDataFrame([("a", good, at, 1), ("a", "{broken", at, 2), ("a", '{"electric_range":"900"}', at, 3), (None, good, at, 4)], body), settings.evdata_topic)


def test_consumed_rows_are_counted_with_the_tables_and_heard_by_the_listener(spark, tmp_path):
    settings, listener = config(tmp_path), ConsumptionListener()
    spark.streams.addListener(listener)
    try:
        for step in (1, 2):
            fill_topics(spark, settings, step)
            tables, queries = app.start_streams(spark, settings, trigger=None)
            for q in queries:
                q.awaitTermination()
        want = {"ev_location_data": (6, 2, 2, 0), "ev_data": (8, 2, 4, 2)}
        assert {n: tuple(c.values()) for n, c in tables.consumed().items()} == want
        assert state(tables.aggregate) == [("c", "m", 1, 2.0)]
        limit = time.time() + 20
        while time.time() < limit and {n: c["rows"] for n, c in listener.totals().items()} != {"ev_location_data": 6, "ev_data": 8}:
            time.sleep(0.2)
        assert {n: c["rows"] for n, c in listener.totals().items()} == {"ev_location_data": 6, "ev_data": 8}
    finally:
        spark.streams.removeListener(listener)


def test_run_with_its_trigger_until_a_query_ends(spark, tmp_path):
    settings = config(tmp_path)
    assert settings.trigger == "10 seconds"
    fill_topics(spark, settings, 3)
    running = threading.Thread(target=app.run, args=(spark, settings), daemon=True)
    running.start()
    limit = time.time() + 60
    tables = app.VehicleTables(spark, settings)
    while time.time() < limit and (tables.aggregate.snapshot() is None or len(spark.streams.active) < 2):
        time.sleep(0.3)
    for query in spark.streams.active:
        query.processAllAvailable()
    for query in spark.streams.active:
        query.stop()
    running.join(30)
    assert not running.is_alive() and state(tables.aggregate) == [("c", "m", 1, 3.0)]


def test_a_batch_that_failed_after_its_commit_is_not_counted_twice(spark, tmp_path):
    log = MessageLog(spark, str(tmp_path / "log"))
    log.publish(spark.createDataFrame([(str(i), "{}", START, i + 1) for i in range(5)], "key string, value string, timestamp timestamp, row_index bigint"), "t")
    rows_ = lambda: parse.judged_location(log.read_stream("t"))
    table = KeyedTable(spark, str(tmp_path / "t"), parse.typed_rows(log.read("t"), parse.LOCATION).schema, KEY, buckets=2)

    def crash(before, after):
        raise RuntimeError("lost between commit and checkpoint")

    with pytest.raises(Exception, match="lost between"):
        writers.start_upserts(rows_(), table, str(tmp_path / "c"), None, after=crash).awaitTermination()
    assert table.read().count() == 5
    writers.start_upserts(rows_(), table, str(tmp_path / "c"), None).awaitTermination()
    assert table.read().count() == 5 and sum(p["rows"] for p in table.snapshot().progress.values()) == 5


def test_settings_of_sessions_and_topics(spark, tmp_path):
    assert session_settings(hive=True)["spark.sql.catalogImplementation"] == "hive" and "spark.sql.catalogImplementation" not in session_settings()
    assert ROCKSDB_STATE.items() <= session_settings(rocksdb_state=True).items()
    name = next(iter(ROCKSDB_STATE))
    before = spark.conf.get(name, None)
    with state_in_rocksdb(spark):
        assert spark.conf.get(name) == ROCKSDB_STATE[name]
    assert spark.conf.get(name, None) == before
    options = kafka_options(PipelineConfig("w", "c", bootstrap_servers="h:1", source_options={"failOnDataLoss": "true"}), "t")
    assert options == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": "10000000"}
    assert "maxOffsetsPerTrigger" not in kafka_options(PipelineConfig("w", "c", max_offsets_per_trigger=None), "t")
