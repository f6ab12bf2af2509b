"""Message topics: a Kafka cluster, or a Parquet log with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.config import PipelineConfig
from tidemark.schemas import MESSAGE_SCHEMA
from tidemark.sources import fs
from tidemark.sources.csv import csv_messages, scan_csv, with_row_index
from tidemark.sources.tables import no_rows

# Fixed value: partitions per topic.
TOPIC_PARTITIONS = 3
#: Parts of an offset range that one round of ``bounded_read`` counts.
RANGES = 1024
#: Size at which a file of a topic begins a new row group. Tasks share a file by its row groups: with
#: Parquet's own 128 MB a micro-batch of a few files would keep as few cores busy.
ROW_GROUP_BYTES = 8 << 20

_COLUMNS = MESSAGE_SCHEMA.fieldNames()


class MessageLog:
    """Topics kept as folders of Parquet files below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _topic_path(self, topic: str) -> str:
        return f"{self.root}/topic={topic}"

    def file_count(self, topic: str) -> int:
        return sum(n.startswith("part-") for n in fs.names(self.spark, self._topic_path(topic)))

    def read(self, topic: str) -> DataFrame:
        """All messages of a topic."""
        if not self.file_count(topic):
            return no_rows(self.spark, MESSAGE_SCHEMA)
        return self.spark.read.schema(MESSAGE_SCHEMA).parquet(self._topic_path(topic))

    def read_stream(self, topic: str, max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
        """The topic from its beginning, then whatever is published later.

        A limit in bytes makes batches of even size, however small the files are; a file is
        never cut. Only one of the limits may be given.
        """
        reader = self.spark.readStream.schema(MESSAGE_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        if max_bytes_per_trigger:
            reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
        return reader.parquet(self._topic_path(topic))

    def publish(self, messages: DataFrame, topic: str, limit: int = 0, start: int = 0, by_time: bool = False, arranged: bool = False) -> int:
        """Append messages (key, value and, if present, timestamp and row_index).

        With ``by_time`` each file holds a range of times and is dated after the one before, so that
        a stream that takes a few files at a time sees the times in order and its
        watermark passes none of them. With ``arranged`` too the messages are made of rows that
        :func:`in_time_ranges` gave by the same times and places.

        ``row_index``, from 1, is the place of a message in its topic; without it the rows
        are numbered in their order. ``start`` is added for inputs numbered apart from what
        the topic holds already: it only settles ties of time, and nothing is looked up.
        Returns the number of messages written.
        """
        if "row_index" not in messages.columns:
            messages = with_row_index(messages, "row_index")
        if limit > 0:
            messages = first_rows(messages, limit)
        timestamp = F.col("timestamp") if "timestamp" in messages.columns else F.current_timestamp()
        key = F.col("key").cast("string")
        records = messages.select(
            F.pmod(F.hash(key), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
            (F.col("row_index") - 1 + start).alias("offset"),
            timestamp.alias("timestamp"),
            key.cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
        )
        path = self._topic_path(topic)

        def append(rows: DataFrame) -> None:
            rows.write.mode("append").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)

        if not by_time:
            return _counted_write(records, append)
        known = set(fs.names(self.spark, path))
        ordered = records if arranged else in_time_ranges(records, "timestamp", "offset")
        written = _counted_write(ordered, append)
        fs.date_in_order(self.spark, path, [n for n in fs.names(self.spark, path) if n.startswith("part-") and n not in known])
        return written

    def topic_counts(self, *topics: str) -> DataFrame:
        """Number of messages per topic and in total."""
        parts = [self.read(t).select(F.lit(t).alias("topic")) for t in topics]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionAll(part)
        counts = rows.groupBy("topic").agg(F.count(F.lit(1)).alias("_n"))
        return counts.rollup("topic").agg(F.sum("_n").alias("messages")).fillna({"topic": "total"})


def in_time_ranges(rows: DataFrame, time: str, place: str) -> DataFrame:
    """Rows dealt to partitions by ranges of time, in order.

    Finding the ranges reads the rows once more. Where messages are costly to make, the rows
    they are made of are arranged instead, and each message is made once.
    """
    return rows.repartitionByRange(time, place).sortWithinPartitions(time, place)


def _counted_write(rows: DataFrame, write) -> int:
    """Write and count in the same job."""
    seen = Observation()
    write(rows.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def first_rows(messages: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows in the order of the input, without gathering them."""
    if "row_index" not in messages.columns:
        messages = with_row_index(messages, "row_index")
    return messages.filter(F.col("row_index") <= limit)


def kafka_options(config: PipelineConfig, topic: str) -> dict[str, str]:
    """Options of the streaming reader; further ones pass through from the config."""
    limit = {"maxOffsetsPerTrigger": str(config.max_offsets_per_trigger)} if config.max_offsets_per_trigger else {}
    return {
        "kafka.bootstrap.servers": config.bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        **limit,
        **config.source_options,
    }


def publish_kafka(messages: DataFrame, config: PipelineConfig, topic: str, limit: int = 0, **options: str) -> int:
    """Send key and value to a Kafka topic; ``options`` go to the producer unchanged."""
    if limit > 0:
        messages = first_rows(messages, limit)
    settings = {"kafka.bootstrap.servers": config.bootstrap_servers, "topic": topic, **options}
    return _counted_write(
        messages.select(F.col("key").cast("string"), F.col("value").cast("string")),
        lambda rows: rows.write.format("kafka").options(**settings).save(),
    )


def message_stream(spark: SparkSession, config: PipelineConfig, topic: str) -> DataFrame:
    """The topic as an unbounded DataFrame, from the earliest message on."""
    if config.bootstrap_servers:
        stream = spark.readStream.format("kafka").options(**kafka_options(config, topic)).load()
        return stream.select(*_COLUMNS)
    return MessageLog(spark, config.messages).read_stream(topic, config.max_files_per_trigger)


def message_batch(spark: SparkSession, config: PipelineConfig, topic: str) -> DataFrame:
    """All messages the topic holds now."""
    if config.bootstrap_servers:
        options = {k: v for k, v in kafka_options(config, topic).items() if k != "maxOffsetsPerTrigger"}
        return spark.read.format("kafka").options(**options).load().select(*_COLUMNS)
    return MessageLog(spark, config.messages).read(topic)


def bounded_read(messages: DataFrame, limit: int = 0) -> DataFrame:
    """The first ``limit`` messages by partition and offset; all of them for 0.

    Nothing is sorted: counts by offset range narrow down where the last of these
    messages lies, and a filter does the rest. Each round counts the range that holds it in
    ``RANGES`` parts, so four rounds do for 10 ** 12 offsets.
    """
    if limit <= 0:
        return messages
    cut = _last_position(messages, limit)
    if cut is None:
        return messages
    partition, offset, wanted, there = cut
    at = (F.col("partition") == partition) & (F.col("offset") == offset)
    earlier = (F.col("partition") < partition) | ((F.col("partition") == partition) & (F.col("offset") < offset))
    if wanted == there:
        return messages.filter(earlier | at)
    # Several messages of one position, as after an offset was given twice.
    return messages.filter(earlier).unionByName(messages.filter(at).limit(wanted))


def _last_position(messages: DataFrame, limit: int) -> tuple[int, int, int, int] | None:
    """Partition and offset of message number ``limit``, how many are wanted there and how many there are."""
    found = messages.groupBy("partition").agg(F.count(F.lit(1)).alias("n"), F.min("offset").alias("low"), F.max("offset").alias("high")).collect()
    wanted = limit
    for part in sorted(found, key=lambda r: r["partition"]):
        if wanted <= part["n"]:
            break
        wanted -= part["n"]
    else:
        return None
    low, high, count = part["low"], part["high"], part["n"]
    while low < high:
        width = -(-(high - low + 1) // RANGES)
        inside = messages.filter((F.col("partition") == part["partition"]) & F.col("offset").between(low, high))
        counts = inside.groupBy(F.floor((F.col("offset") - low) / width).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
        for row in sorted(counts, key=lambda r: r["k"]):
            if wanted <= row["n"]:
                break
            wanted -= row["n"]
        low, high, count = low + row["k"] * width, min(high, low + (row["k"] + 1) * width - 1), row["n"]
    return part["partition"], low, wanted, count


def publish_csv(spark: SparkSession, config: PipelineConfig, path: str, topic: str, limit: int = 0) -> int:
    """Publish the rows of a CSV input as JSON messages; returns how many were sent."""
    messages = csv_messages(scan_csv(spark, path), limit)
    if config.bootstrap_servers:
        return publish_kafka(messages, config, topic)
    return MessageLog(spark, config.messages).publish(messages, topic)


def publish_both(
    spark: SparkSession, config: PipelineConfig, location_csv: str, evdata_csv: str, limit_per_topic: int = 0
) -> dict[str, int]:
    """Publish both inputs; the number of messages per topic and in total."""
    counts = {
        config.location_topic: publish_csv(spark, config, location_csv, config.location_topic, limit_per_topic),
        config.evdata_topic: publish_csv(spark, config, evdata_csv, config.evdata_topic, limit_per_topic),
    }
    return {**counts, "total": sum(counts.values())}
