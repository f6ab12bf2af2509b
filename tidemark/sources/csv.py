"""CSV scan and its conversion to messages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.messages import message_key, row_json
from tidemark.functions.text import header_names
from tidemark.schemas import KEY
from tidemark.session import new_run_dir, ship_package

_RAW = "_raw_record"
FIELD_COUNT = "_field_count"
ROW_INDEX = "_row_index"
_AT = "_at"
#: Splits looked up by broadcast: about 40 bytes for each, whatever the split holds.
BROADCAST_SPLITS = 1_000_000


@dataclass(frozen=True)
class CsvScan:
    """Rows of a CSV input: string columns, the number of fields each record had and its index from 1."""

    rows: DataFrame
    columns: list[str]


def _line_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each line stands in its split, for both cases: the split begins outside quotes, or inside.

    ``inside`` is 1 if an odd number of quotes precede the line in its split; ``even`` and
    ``odd`` count the lines up to this one that begin with an even or odd number: the
    records that have begun if the split began outside or inside quotes.
    """
    place, split, parity, counts = None, 0, 0, np.zeros(2, dtype=np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        at, start, file = (batch.column(n).to_numpy(zero_copy_only=False) for n in (_AT, "start", "file"))
        quoted = batch.column("quoted").to_numpy().astype(np.int64)
        n = len(at)
        fresh = np.append(place != (file[0], start[0]), (file[1:] != file[:-1]) | (start[1:] != start[:-1]))
        cuts = [*np.flatnonzero(fresh).tolist(), n]
        inside, even, odd, splits = (np.empty(n, dtype=np.int64) for _ in range(4))
        for first, end in zip([0, *cuts[:-1]] if cuts[0] else cuts[:-1], cuts if cuts[0] else cuts[1:]):
            if fresh[first]:
                split, parity, counts = at[first], 0, np.zeros(2, dtype=np.int64)
            own = slice(first, end)
            seen = np.cumsum(quoted[own])
            inside[own] = (parity + seen - quoted[own]) % 2
            even[own] = counts[0] + np.cumsum(1 - inside[own])
            odd[own] = counts[1] + np.cumsum(inside[own])
            splits[own] = split
            parity, counts = (parity + int(seen[-1])) % 2, np.array([even[end - 1], odd[end - 1]])
        place = (file[-1], start[-1])
        added = [pa.array(c) for c in (splits, inside, even, odd)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "split", "inside", "even", "odd"])


def _records(spark: SparkSession, path: str, quote: str) -> DataFrame:
    """(file_no, number, record): all records of a folder, blank lines too, numbered from 1 in each file.

    Lines are read in splits of any size. Which of them begin a record depends on the
    quotes before them in the file, so each split counts for both cases; one small row for
    each split, summed up along its file, decides between them. Only records with line
    breaks inside are brought together from their lines.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias(_AT),
        F.col("value").alias("line"),
        ((F.length("value") - F.length(F.replace("value", F.lit(quote)))) % 2).alias("quoted"),
    )
    schema = f"file string, start bigint, {_AT} bigint, line string, quoted int, split bigint, inside bigint, even bigint, odd bigint"
    folder = new_run_dir(spark, "csv-lines")
    lines.mapInArrow(_line_states, schema).write.parquet(folder)
    written = spark.read.schema(schema).parquet(folder)

    splits = written.groupBy("split", "file", "start").agg((F.sum("quoted") % 2).alias("quoted"), F.max("even").alias("even"), F.max("odd").alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begun = splits.withColumn("within", F.coalesce(F.sum("quoted").over(before) % 2, F.lit(0))).withColumn("records", F.when(F.col("within") == 0, F.col("even")).otherwise(F.col("odd")))
    begun = begun.withColumn("earlier", F.coalesce(F.sum("records").over(before), F.lit(0)))
    files = begun.groupBy("file").agg(F.sum("records").alias("n"))
    order = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.row_number().over(Window.orderBy("file")).alias("file_no"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    starts_path = new_run_dir(spark, "csv-splits")
    begun.join(files, "file").select("split", "within", "earlier", "file_no", "base").write.parquet(starts_path)
    starts = spark.read.parquet(starts_path)
    starts = F.broadcast(starts) if starts.count() <= BROADCAST_SPLITS else starts

    placed = written.join(starts, "split").select(
        "file_no", "base", "start", _AT, "line",
        (F.col("earlier") + F.when(F.col("within") == 0, F.col("even")).otherwise(F.col("odd"))).alias("number"),
        (F.col("inside") != F.col("within")).alias("goes_on"),
        (F.col("quoted") == 1).alias("turns"),
    )
    # A line that begins outside quotes and has an even number of them is a record.
    whole = placed.filter("not goes_on and not turns").select("file_no", "base", "number", F.col("line").alias("record"))
    pieces = F.array_sort(F.collect_list(F.struct("start", _AT, "line")))
    joined = placed.filter("goes_on or turns").groupBy("file_no", "base", "number").agg(F.array_join(F.transform(pieces, lambda p: p["line"]), "\n").alias("record"))
    return whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))


def scan_csv(spark: SparkSession, path: str, quote: str = '"') -> CsvScan:
    """Read a CSV file or folder whose files have a header row.

    Header names are normalised; all values are text and an empty field is an empty
    string. Files are read in splits also where quotes hold line breaks. A blank line is a
    record with one empty field. Quotes inside quotes are doubled; lines end in a line
    feed, with or without a carriage return before it. The lines are written once to the
    shared folder. A quote that is never closed makes the rest of its file one record.
    """
    ship_package(spark)
    reader = spark.read.option("header", True).option("recursiveFileLookup", True).option("quote", quote).option("escape", quote)
    columns = header_names(reader.csv(path).columns)
    options = {"quote": quote, "escape": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW}
    records = _records(spark, path, quote).filter("number > 1")
    # From_csv reads one record; the generator keeps it from being repeated for every column.
    parsed = records.select(
        (F.col("base") + F.col("number") - F.col("file_no")).alias(ROW_INDEX), "record", F.explode(F.array(F.from_csv("record", _ddl(columns), options))).alias("r")
    )
    count = F.when(F.col("record") == "", F.lit(1)).when(F.col(f"r.`{_RAW}`").isNull(), F.lit(len(columns))).otherwise(F.least(_fields_in(F.col("record")), F.lit(len(columns))))
    counted = parsed.withColumn(FIELD_COUNT, count)
    values = [
        F.when(F.col(FIELD_COUNT) > position, F.coalesce(F.col(f"r.`{name}`"), F.lit(""))).alias(name)
        for position, name in enumerate(columns)
    ]
    return CsvScan(counted.select(*values, FIELD_COUNT, ROW_INDEX), columns)


def _ddl(columns: list[str]) -> str:
    return ", ".join(f"`{name}` STRING" for name in [*columns, _RAW])


def _fields_in(record: Column) -> Column:
    """Number of fields of one record: delimiters outside quotes, plus one."""
    unquoted = F.regexp_replace(record, r'"(?:[^"]|"")*"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","))) + 1


def with_row_index(rows: DataFrame, name: str = ROW_INDEX) -> DataFrame:
    """Number the rows from 1, partition after partition.

    The rows are written once to the shared folder, each with its task's running number;
    counts and numbers both come from what was written, so it does not matter how often or
    in which splits an input would be read. The tasks' starts are one small row each.
    """
    spark = rows.sparkSession
    path = new_run_dir(spark, "numbered-rows")
    placed = rows.select("*", F.monotonically_increasing_id().alias(_AT))
    placed.write.parquet(path)
    written = spark.read.schema(placed.schema).parquet(path).withColumn("_task", F.shiftright(_AT, 33))
    tasks = written.groupBy("_task").agg(F.min(_AT).alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = tasks.select("_task", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    # One row per task that wrote: as many as partitions, not rows.
    numbered = written.join(F.broadcast(starts), "_task").withColumn(name, F.col(_AT) + F.col("_shift") + 1)
    return numbered.select(*(f"`{c}`" for c in rows.columns), name)


def csv_messages(scan: CsvScan, limit: int = 0, key: str = KEY) -> DataFrame:
    """Key, JSON value and row index of each CSV row; the first ``limit`` rows if given."""
    rows = scan.rows
    if limit > 0:
        rows = rows.filter(F.col(ROW_INDEX) <= limit)
    identifier = F.col(f"`{key}`") if key in scan.columns else F.lit(None).cast("string")
    return rows.select(
        message_key(identifier, F.col(ROW_INDEX)).alias("key"),
        row_json(scan.columns, F.col(FIELD_COUNT)).alias("value"),
        F.col(ROW_INDEX).alias("row_index"),
    )
