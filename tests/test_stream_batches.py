"""How many batches and state partitions streams use, on small invented rows."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidemark.operators import windows
from tidemark.plans import catalogue
from tidemark.session import shared_dir
from tidemark.sources.messages import ROW_GROUP_BYTES, MessageLog, in_time_ranges
from tidemark.streaming import writers

START = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)


def records(spark, count):
    schema = "key string, value string, timestamp timestamp, row_index long"
    return spark.createDataFrame([("k", str(i), START + dt.timedelta(minutes=i), i + 1) for i in range(count)], schema)


def published_in_files(spark, tmp_path, start):
    """Stream 40 messages, published in one file a shuffle partition, as a query's parts are; the offsets in time order."""
    log = MessageLog(spark, str(tmp_path / "log"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        catalogue._by_arrival(log, "t", [records(spark, 40)], start)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return log


def test_batches_follow_bytes_and_not_files(spark, tmp_path):
    started = []

    def start(stream):
        started.append(writers.start_append(stream.select("offset"), str(tmp_path / "out"), str(tmp_path / "checkpoint"), None))
        return started[-1]

    log = published_in_files(spark, tmp_path, start)
    assert log.file_count("t") > 2
    assert [p.numInputRows for p in started[0].recentProgress if p.numInputRows] == [40]
    assert sorted(r.offset for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(40))


def test_a_limit_in_bytes_cuts_batches_without_late_rows(spark, tmp_path):
    log = published_in_files(spark, tmp_path, lambda s: writers.start_append(s.select("offset"), str(tmp_path / "all"), str(tmp_path / "c0"), None))
    stream = log.read_stream("t", max_bytes_per_trigger=1).select(F.col("timestamp").alias("ts"), F.lit("g").alias("g"), F.lit(1.0).alias("v"))
    counts = windows.sliding_counts(stream, "ts", ["g"], "v", watermark="1 minute", scale=2)
    running = writers.start_append(counts, str(tmp_path / "out"), str(tmp_path / "c1"), None)
    running.awaitTermination()
    assert len([p for p in running.recentProgress if p.numInputRows]) == log.file_count("t")
    assert sum(o.numRowsDroppedByWatermark for p in running.recentProgress for o in p.stateOperators) == 0


def test_state_is_dealt_by_cores_and_the_session_keeps_its_setting(spark, tmp_path):
    log = MessageLog(spark, str(tmp_path / "log"))
    log.publish(records(spark, 10), "t")
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)

    def state_partitions(setting):
        spark.conf.set(name, setting)
        try:
            once = log.read_stream("t").withWatermark("timestamp", "1 minute").dropDuplicatesWithinWatermark(["offset"])
            running = writers.start_append(once, str(tmp_path / f"out{setting}"), str(tmp_path / f"c{setting}"), None)
            assert spark.conf.get(name) == setting
            running.awaitTermination()
            assert spark.read.parquet(str(tmp_path / f"out{setting}")).count() == 10
            return running.lastProgress.stateOperators[0].numShufflePartitions
        finally:
            spark.conf.set(name, before)

    assert state_partitions("64") == max(16, 2 * spark.sparkContext.defaultParallelism)
    assert state_partitions("3") == 3


def test_sliding_windows_commit_once_a_part_however_many_files(spark, tmp_path):
    """Each of the three parts is one batch and the one that ends the watermark; the table is written no more often."""
    shared = Path(shared_dir(spark)) / "tidemark"
    known = set(shared.glob("stream-windows-*"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = catalogue.QUERIES["stream_sliding"](spark, "/root/testdata/sf0.001").count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows == catalogue.QUERIES["sliding_window_agg"](spark, "/root/testdata/sf0.001").count()
    (run,) = set(shared.glob("stream-windows-*")) - known
    assert len(list(run.glob("log/topic=events/part-*.parquet"))) > 6
    assert len(list(run.glob("table/_snapshots/*.json"))) <= 6


def test_files_of_a_topic_are_shared_by_tasks(spark, tmp_path):
    """A batch of few files keeps more cores busy than it has files: each holds several row groups."""
    log = MessageLog(spark, str(tmp_path / "log"))
    long = F.concat_ws("", *(F.sha2(F.concat("id", F.lit(i)).cast("string"), 512) for i in range(4)))
    rows = spark.range(60000).select(F.lit("k").alias("key"), long.alias("value"), F.timestamp_seconds("id").alias("timestamp"), (F.col("id") + 1).alias("row_index"))
    for topic, by_time in (("a", False), ("b", True)):
        log.publish(rows.coalesce(1), topic, by_time=by_time)
        files = list((tmp_path / "log" / f"topic={topic}").glob("part-*.parquet"))
        groups = [pq.ParquetFile(f).metadata for f in files]
        assert sum(g.num_rows for g in groups) == 60000
        largest = max(g.row_group(i).total_byte_size for g in groups for i in range(g.num_row_groups))
        assert max(g.num_row_groups for g in groups) > 1 and largest < 2 * ROW_GROUP_BYTES


def test_arranged_messages_are_made_once(spark, tmp_path):
    """Ranges of time are found without making the messages, and the files are the same as of ``by_time`` alone."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def value(number):
        made.add(1)
        return str(number)

    def published(rows, topic, **options):
        messages = rows.select(F.lit("k").alias("key"), value("id").alias("value"), "timestamp", (F.col("id") + 1).alias("row_index"))
        log = MessageLog(spark, str(tmp_path / "log"))
        log.publish(messages, topic, by_time=True, **options)
        files = sorted((tmp_path / "log" / f"topic={topic}").glob("part-*.parquet"))
        return [pq.read_table(f, partitioning=None).column("offset").to_pylist() for f in files]

    rows = spark.range(200).select("id", F.timestamp_seconds((F.col("id") * 37) % 200).alias("timestamp"))
    arranged = published(in_time_ranges(rows, "timestamp", "id"), "arranged", arranged=True)
    assert made.value == 200
    places = [i * 173 % 200 for i in range(200)]
    assert [n for part in arranged for n in part] == places == [n for part in published(rows, "plain") for n in part]
