"""Session settings and the shared work folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # One task may write many collections; open writers instead of sorting the lines by collection.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # A stream of files lists the files of a batch by their paths; by default that is a task for each of them.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # Chunks of file content travel in Arrow batches, so bound a batch by bytes as well as by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
}
# For scans of many small files: dealt to tasks by their size, where 4 MiB a file would make a task of every few of them,
# and looked up by their paths in a few tasks. Their listings are used once, so the session does not keep them (up to 250 MB).
SMALL_FILES = {
    "spark.sql.files.openCostInBytes": str(16 * 1024),
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
}

_test_folders: dict[str, str] = {}
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application, wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent.parent
        target = f"{tempfile.mkdtemp(prefix='snapforge-package-')}/snapforge"
        context.addPyFile(shutil.make_archive(target, "zip", root, "snapforge"))
        _shipped.add(context.applicationId)


def bound_batches(spark: SparkSession) -> None:
    """The bound of Arrow batches in a session that was built elsewhere, where a smaller one stays, and of the tasks that look
    up the files of a stream's batch."""
    lookup = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    spark.conf.set(lookup, SETTINGS[lookup])
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = spark.conf.get(name, None)
    if given is None or not given.isdigit() or not 0 < int(given) <= int(SETTINGS[name]):
        spark.conf.set(name, SETTINGS[name])


def build_session(app_name: str = "snapforge", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app_id = spark.sparkContext.applicationId
    if app_id not in _test_folders:
        _test_folders[app_id] = tempfile.mkdtemp(prefix="snapforge-")
    return _test_folders[app_id]


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one; nothing else writes to it."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a while; what a query was started with stays its own."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def overwrite_touched_partitions(spark: SparkSession) -> Iterator[None]:
    """``insertInto`` ignores the writer option, so the session setting has to be switched and put back."""
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        yield
