"""Small-file access through the file system Spark itself uses."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(entry.getPath().getName() for entry in fs.listStatus(target))


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a file in one step, under a name that must be free."""
    fs, target = _open(spark, path)
    draft = target.suffix(f".{uuid.uuid4().hex}.tmp")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(f"{path} was created by another writer")


def date_in_order(spark: SparkSession, folder: str, files: list[str]) -> None:
    """Date files a millisecond apart in the given order, all after the others of the folder."""
    fs, target = _open(spark, folder)
    latest = max((entry.getModificationTime() for entry in fs.listStatus(target) if entry.getPath().getName() not in set(files)), default=0)
    first = max(latest + 1, max((fs.getFileStatus(target.suffix(f"/{name}")).getModificationTime() for name in files), default=0))
    for place, name in enumerate(files):
        fs.setTimes(target.suffix(f"/{name}"), first + place, -1)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)
