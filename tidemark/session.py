"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package, also where it is not installed there.

    The archive goes through Spark's own file server, once per application.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), f"{root.name}.zip")
    Path(path).write_bytes(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


#: State of streaming joins and windows on local disk instead of the executors' heap; checkpoints hold changes only.
ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def session_settings(hive: bool = False, rocksdb_state: bool = False, **conf: str) -> dict[str, str]:
    """The settings this package relies on, and those of the options."""
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **({"spark.sql.catalogImplementation": "hive"} if hive else {}),
        **(ROCKSDB_STATE if rocksdb_state else {}),
        **conf,
    }


def build_session(app_name: str = "tidemark", master: str | None = None, hive: bool = False, rocksdb_state: bool = False, **conf: str) -> SparkSession:
    """A session with the settings this package relies on.

    Shuffle partition counts are left to the cluster's own default and AQE;
    pass ``spark.sql.shuffle.partitions`` in ``conf`` for local runs. ``hive`` keeps the
    catalog in a Hive metastore, ``rocksdb_state`` the state of streams in RocksDB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in session_settings(hive, rocksdb_state, **conf).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB; a checkpoint begun so has to go on so."""
    before = {name: spark.conf.get(name, None) for name in ROCKSDB_STATE}
    for name, value in ROCKSDB_STATE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextmanager
def few_state_partitions(spark: SparkSession) -> Iterator[None]:
    """Streams started inside deal their state to at most two partitions a core, or 16.

    Every batch loads and commits each partition's state, rows or not, so partitions beyond
    those that run at once only add to the time of a batch. A checkpoint keeps the number
    it began with, and a session that sets fewer keeps its own.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), max(16, 2 * spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(CHECKPOINT_DIR, fallback)
    return fallback


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one; each run gets its own."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
