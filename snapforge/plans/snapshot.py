"""The snapshot run: list, select, decode, write, publish, record."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from snapforge.functions import dates, names
from snapforge.operators import decode, listing, notices, parameters, state
from snapforge.operators.records import flatten_equality
from snapforge.session import SMALL_FILES, new_run_dir, settings
from snapforge.sinks import claims, files, tables
from snapforge.sources import objects
from snapforge.sources import tables as sources

log = logging.getLogger(__name__)

# Files per decode job. Their metadata, about 400 bytes a file, is broadcast, and the driver names them to the scan.
FILES_PER_JOB = 50_000
# A binary scan holds a file in one array of the JVM, so this is what Spark can read at most.
MAX_FILE_BYTES = 2**31 - 16


STATUS_SCHEMA = "correlation_id string, collection string, status string, at timestamp, seq int"


class RunFailed(Exception):
    """At least one collection failed; the others were still processed."""


@dataclass(frozen=True)
class Audit:
    """Audit tables and their columns (column name -> JSON key)."""

    database: str
    fields: dict[str, str]
    # name -> (table, columns, location)
    projections: dict[str, tuple[str, Sequence[str], str]] = field(default_factory=dict)

    @property
    def raw(self) -> str:
        return f"{self.database}.auditlog_raw"

    @property
    def typed(self) -> str:
        return f"{self.database}.auditlog_managed"


@dataclass(frozen=True)
class Run:
    correlation_id: str
    snapshot_type: str
    export_date: str
    run_stamp: str
    input_root: str
    output_root: str
    database: str
    state_database: str
    audit: Audit
    equality_table: str
    equality_location: str | None = None
    # Prefix of an earlier run that is continued; only its failed collections are processed.
    existing_prefix: str | None = None
    # Shuffle the lines into few files per collection; else every decoding task writes its own.
    few_files: bool = False
    clock: Callable[[], datetime] = datetime.now

    def __post_init__(self) -> None:
        empty = [name for name in ("correlation_id", "input_root", "output_root") if not getattr(self, name)]
        if empty:
            raise ValueError(f"missing {', '.join(empty)}")
        if self.snapshot_type not in (parameters.FULL, parameters.INCREMENTAL):
            raise ValueError("snapshot_type must be full or incremental")
        datetime.strptime(self.export_date, "%Y-%m-%d")

    @property
    def prefix(self) -> str:
        return self.existing_prefix or f"{self.output_root}/{self.snapshot_type}/{self.run_stamp}"

    @property
    def data_root(self) -> str:
        return f"{self.output_root}/dated"

    @property
    def full_database(self) -> str:
        return self.database if self.snapshot_type == "full" else f"{self.database}_incremental"


def continued(spark: SparkSession, run: Run) -> Run:
    """The run, continuing the prefix of an earlier one with the same correlation id if the ledger has one."""
    table = f"{run.state_database}.run_ledger"
    if not spark.catalog.tableExists(table):
        return run
    asked = spark.createDataFrame(
        [(run.correlation_id, f"snapshot-{run.snapshot_type}", run.snapshot_type)],
        "correlation_id string, data_product string, snapshot_type string",
    )
    earlier = sources.ledger_rows(spark.table(table), run.correlation_id, f"snapshot-{run.snapshot_type}")
    row = state.output_prefix(asked, state.ledger_current(earlier, ["at"]), run.output_root, run.run_stamp).first()
    return replace(run, existing_prefix=row["output_prefix"]) if row["existing"] else run


def described(manifest: DataFrame) -> DataFrame:
    """``path, iv, ciphertext`` of each file once; entries that contradict each other count as no entry."""
    entries = manifest.groupBy(files.plain_path(F.col("path")).alias("path")).agg(
        F.min(F.struct("iv", "ciphertext")).alias("_low"), F.max(F.struct("iv", "ciphertext")).alias("_high")
    )
    return entries.where(F.col("_low").eqNullSafe(F.col("_high"))).select("path", "_low.*")


def listed_input(spark: SparkSession, run: Run) -> DataFrame:
    """``path, name, length`` of every file below the input, listed once and kept as a table in the shared folder."""
    return objects.write_listing(spark, run.input_root, new_run_dir(spark, "listing"))


def listing_plan(spark: SparkSession, listed: DataFrame, config: DataFrame, manifest: DataFrame) -> DataFrame:
    """Metadata only: ``path, collection, handler, length, iv, ciphertext`` of every file to be decoded.

    Written once to the shared folder, as several steps read it. It holds no plaintext keys.
    """
    chosen = listing.allowed(listing.matched(listing.last_per_name(listed)), config)
    work = chosen.join(described(manifest), "path", "left").select(
        "path", "collection", names.handler(F.col("collection")).alias("handler"), "length", "iv", "ciphertext"
    )
    location = new_run_dir(spark, "work")
    work.write.parquet(location)
    return spark.read.schema(work.schema).parquet(location)


def decode_and_write(
    spark: SparkSession, work: DataFrame, keys: DataFrame, cipher: str, codec: str, root: str, by: list[str],
    few_files: bool = False,
) -> Counter[str]:
    """Decode the files of ``work(path, length, iv, ciphertext, *by)`` and add their lines and errors below ``root``;
    returns how many lines, characters and errors were written, as the writes counted them.

    The files are dealt to jobs by ranges of their path, so that the metadata of a job is always small enough to be
    broadcast, whatever one collection holds, and one job meets few collections. Each job scans its own files only: each
    is read once and its content is never shuffled. Files beyond what a scan can read, and files that are gone when it
    begins, become error rows.
    """
    location = new_run_dir(spark, "jobs")
    n_jobs = max(-(-work.count() // FILES_PER_JOB), 1)
    dealt = work.repartitionByRange(n_jobs, "path") if n_jobs > 1 else work.coalesce(1)
    dealt.withColumn("_job", F.spark_partition_id()).write.partitionBy("_job").parquet(location)
    # Asked for once, not by every job; in memory only, as plain keys are not to be written.
    plain = decode.single_keys(keys).persist(StorageLevel.MEMORY_ONLY)
    schema = work.schema
    written: Counter[str] = Counter()
    try:
        with settings(spark, SMALL_FILES):
            for number in range(n_jobs):
                folder = f"{location}/_job={number}"
                if files.exists(spark, folder):
                    part = spark.read.schema(schema).parquet(folder)
                    written.update(decode_part(spark, part, plain, cipher, codec, root, by, few_files))
    finally:
        plain.unpersist()
    return written


def decode_part(
    spark: SparkSession, part: DataFrame, plain: DataFrame, cipher: str, codec: str, root: str, by: list[str],
    few_files: bool = False, tasks: int | None = None,
) -> dict[str, int]:
    """The same in one job, for files whose metadata is small enough to be broadcast; ``plain(ciphertext, plain_key)`` has a
    data key once at most. Call it under ``session.SMALL_FILES``."""
    readable = part.where(F.col("length") <= MAX_FILE_BYTES)

    def refused(rows: DataFrame, problem: str) -> DataFrame:
        return rows.select(*by, "path", F.lit(None).cast("string").alias("val"), F.lit(problem).alias("error"))

    decoded = refused(part.where(F.col("length") > MAX_FILE_BYTES), "too large for one read")
    paths = [row["path"] for row in readable.select("path").collect()]  # FILES_PER_JOB on average
    if paths:
        content = objects.read_chosen(spark, paths).withColumn("path", files.plain_path(F.col("path")))
        keyed = readable.join(plain, "ciphertext", "left").select("path", "iv", "plain_key", *by)
        lines = decode.decode_objects(content.join(F.broadcast(keyed), "path"), cipher, codec, by, error_only=["path"])
        decoded = lines.select(decoded.columns).unionByName(decoded)
        if content.count() < len(paths):  # counted without being read
            gone = readable.join(content.select("path"), "path", "left_anti")
            decoded = decoded.unionByName(refused(gone, "no content"))
    return files.write_decoded(decoded, root, by, few_files, mode="append", tasks=tasks)


def _decode(
    spark: SparkSession, run: Run, work: DataFrame, keys: DataFrame, found: Sequence[Row], dated: bool
) -> tuple[set[str], Counter[str]]:
    """Write the lines of the collections; those with a file that could not be decoded are returned and leave none. Also
    returns what was written, of failed collections as well."""
    if not found:
        return set(), Counter()
    root = run.data_root if dated else run.prefix
    by = ["collection", "export_date"] if dated else ["collection"]
    day = f"/export_date={run.export_date}" if dated else ""

    def clear(collection: str) -> None:
        for kind in (files.LINES, files.ERRORS):
            files.delete_prefix(spark, f"{root}/kind={kind}/collection={collection}{day}")

    for row in found:
        clear(row["collection"])
    names_of = [row["collection"] for row in found]
    part = work.where(F.col("collection").isin(names_of)).withColumn("export_date", F.lit(run.export_date))
    part = part.select("path", "length", "iv", "ciphertext", *by)
    written = decode_and_write(spark, part, keys, "ctr", "gzip", root, by, run.few_files)
    failures = files.read_failures(spark, root, by).where(F.col("collection").isin(names_of))
    if dated:
        failures = failures.where(F.col("export_date") == run.export_date)
    beside = f"{run.output_root}/failures/{run.snapshot_type}/{run.run_stamp}"
    broken = {row["collection"] for row in files.set_aside_failures(failures, by, beside)}
    for collection in broken:
        clear(collection)
    return broken, written


def _location(spark: SparkSession, run: Run, collection: str, dated: bool) -> str:
    """Folder of the written lines; made here if all files of the collection were empty."""
    if dated:
        location = files.lines_location(run.data_root, collection=collection, export_date=run.export_date)
    else:
        location = files.lines_location(run.prefix, collection=collection)
    if not files.exists(spark, location):
        spark.createDataFrame([], "value string").write.text(location)
    return location


def publish_audit(spark: SparkSession, audit: Audit, lines: DataFrame, dates: Sequence[str]) -> None:
    """Raw and typed audit tables for all dates at once, then the projections date by date."""
    tables.create_database(spark, audit.database)
    tables.load_audit_raw(lines, audit.raw)
    tables.load_audit_typed(lines, audit.typed, audit.fields)
    for table, columns, location in audit.projections.values():
        for date_str in dates:
            tables.load_audit_projection(spark, audit.typed, table, columns, date_str, location)


def _publish_dated(spark: SparkSession, run: Run, collection: str, handler: str) -> None:
    location = _location(spark, run, collection, True)
    if handler == "audit":
        publish_audit(spark, run.audit, sources.read_lines(spark, location, run.export_date), [run.export_date])
    else:
        tables.create_database(spark, run.equality_table.split(".")[0], run.equality_location)
        flat = flatten_equality(sources.read_lines(spark, location), F.lit(run.clock().date()))
        tables.append_equality(flat, run.equality_table)


def run_snapshot(
    spark: SparkSession, run: Run, config: DataFrame, manifest: DataFrame, keys: DataFrame
) -> DataFrame:
    """Process every configured collection and return its last status.

    One decode job covers all raw collections and one the two dated ones. A collection that fails does not stop
    the others; after all are done :class:`RunFailed` is raised and no run parameters are written.
    """
    history: list[tuple] = []
    stored = 0

    def note(collection: str, status: str) -> None:
        history.append((run.correlation_id, collection, status, run.clock(), len(history)))

    def store() -> None:
        """Append what was noted since the last time; one small write per phase, not per collection."""
        nonlocal stored
        if stored < len(history):
            tables.append_state(spark.createDataFrame(history[stored:], STATUS_SCHEMA), statuses)
            stored = len(history)

    statuses = f"{run.state_database}.collection_status"
    tables.create_database(spark, run.full_database)
    tables.create_database(spark, run.state_database)
    started = run.clock()
    ledger = _open_ledger(spark, run, started)
    if run.existing_prefix:
        config = _unfinished(spark, run, config)
        # Fixed here: this run adds to the statuses the choice was made from.
        location = new_run_dir(spark, "config")
        config.write.parquet(location)
        config = spark.read.schema(config.schema).parquet(location)

    listed = listed_input(spark, run)
    work = listing_plan(spark, listed, config, manifest)
    found = (
        work.groupBy("collection", "handler")
        .agg(F.sum("length").alias("total_bytes"), F.count("*").alias("n_files"))
        .withColumn("table_name", names.table_name(F.col("collection")))
        .orderBy("collection")
        .collect()  # one row per configured collection
    )
    shared = {row["collection"] for row in listing.table_collisions(work).toLocalIterator()}
    for row in found:
        note(row["collection"], state.PROCESSING)
    store()
    failed: set[str] = set()
    written: Counter[str] = Counter()
    for dated in (False, True):
        group = [row for row in found if (row["handler"] != "raw") == dated]
        broken, counted = _decode(spark, run, work, keys, group, dated)
        failed |= broken
        written.update(counted)

    raw = {}
    for row in found:
        note(row["collection"], state.FAILED_PROCESSING if row["collection"] in failed else state.PUBLISHING)
    store()
    for row in found:
        collection = row["collection"]
        if collection in failed:
            continue
        if collection in shared:
            note(collection, state.FAILED_PUBLISHING)  # another collection has the same table name
        elif row["handler"] == "raw":
            raw[f"{run.full_database}.{row['table_name']}"] = collection
        else:
            try:
                _publish_dated(spark, run, collection, row["handler"])
                note(collection, state.COMPLETED)
            except Exception as failure:  # recorded; the other collections go on
                log.warning("publishing %s failed: %s", collection, failure)
                note(collection, state.FAILED_PUBLISHING)
            store()
    locations = {table: _location(spark, run, collection, False) for table, collection in raw.items()}
    known = config.join(work.select("collection").distinct(), "collection", "left_semi")
    tags = {row["collection"]: row["tags"] or {} for row in known.toLocalIterator()}
    properties = {
        table: {**tags[collection], "snapshot_type": run.snapshot_type} for table, collection in raw.items() if tags[collection]
    }
    errors = tables.publish_raw_tables(spark, locations, properties)
    for table, collection in raw.items():
        if table in errors:
            log.warning("publishing %s failed: %s", collection, errors[table])
        note(collection, state.FAILED_PUBLISHING if table in errors else state.COMPLETED)

    if run.snapshot_type == "incremental":
        empty = listing.placeholders(config, work, run.prefix).collect()
        files.write_placeholders(spark, [row["path"] for row in empty])
        for row in empty:
            note(row["collection"], state.EMPTY)

    store()
    noted = spark.createDataFrame(history, STATUS_SCHEMA)
    return _record(spark, run, config, listed, work, noted, ledger, written)


def _unfinished(spark: SparkSession, run: Run, config: DataFrame) -> DataFrame:
    """The configured collections that the run to be continued did not bring to an end.

    These are the failed ones and those it was stopped at or before. The choice is written, as this run adds to the
    statuses it was made from.
    """
    table = f"{run.state_database}.collection_status"
    if not spark.catalog.tableExists(table):
        return config
    earlier = sources.status_of_run(spark.table(table), run.correlation_id)
    ended = state.latest_status(earlier, ["at", "seq"]).where(F.col("status").isin(state.COMPLETED, state.EMPTY))
    location = new_run_dir(spark, "config")
    config.join(ended.select("collection"), "collection", "left_anti").write.parquet(location)
    return spark.read.schema(config.schema).parquet(location)


def _claims(spark: SparkSession, run: Run) -> str:
    """Folder of the run numbers, beside the state tables; Spark does not read folders that begin with ``_``."""
    root = spark.catalog.getDatabase(run.state_database).locationUri
    return claims.folder(f"{root}/_claims", run.correlation_id, f"snapshot-{run.snapshot_type}")


def live_runs(spark: SparkSession, run: Run, lease: timedelta) -> list[int]:
    """Numbers of the runs of this key that have not ended and began, or renewed their claim, within the lease."""
    return claims.live(spark, _claims(spark, run), run.clock(), lease)


def _open_ledger(spark: SparkSession, run: Run, started: datetime) -> DataFrame:
    """The ledger row of the run, written as in progress before any work; it carries run number and prefix."""
    product = f"snapshot-{run.snapshot_type}"
    asked = spark.createDataFrame([(run.correlation_id, product)], "correlation_id string, data_product string")
    table = f"{run.state_database}.run_ledger"
    highest = state.next_run_id(asked, spark.table(table)).first()["run_id"] if spark.catalog.tableExists(table) else 1
    # Runs that start together read the same ledger; the claim gives each a number of its own.
    run_id = claims.claim(spark, _claims(spark, run), highest)
    at = F.lit(started)
    row = asked.select(
        "correlation_id",
        "data_product",
        F.lit(run_id).cast("long").alias("run_id"),
        F.lit(run.export_date).alias("date"),
        F.lit(state.RUN_IN_PROGRESS).alias("status"),
        F.lit("snapshot").alias("current_step"),
        F.lit(run.input_root).alias("input_prefix"),
        F.lit(run.prefix).alias("output_prefix"),
        F.lit(run.snapshot_type).alias("snapshot_type"),
        at.alias("started_at"),
        at.alias("at"),
        dates.expires_at(at).alias("expires_at"),
    )
    tables.append_state(row, table)
    return row


def _sizes(objects_of: DataFrame, everything: DataFrame) -> DataFrame:
    """Bytes per collection, and as ``all_collections`` what lies below the whole prefix."""
    each = objects_of.groupBy("collection").agg(F.sum("length").alias("total_bytes"))
    total = everything.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"))
    return each.unionByName(total.withColumn("collection", F.lit("all_collections")))


def _record(
    spark: SparkSession, run: Run, config: DataFrame, listed: DataFrame, work: DataFrame, noted: DataFrame, ledger: DataFrame,
    counted: Counter[str],
) -> DataFrame:
    """Tags and sizes of what was completed, times, notices, the outcome in the ledger."""
    latest = state.latest_status(noted, ["at", "seq"])
    store = run.state_database
    now = F.lit(run.clock())
    sound = latest.where(F.col("status") == state.COMPLETED).select("collection")
    totals = [(f"decoded_{name}", "all_collections", counted[name]) for name in ("lines", "characters")]
    sized = [
        _sizes(work, listed).withColumn("metric", F.lit("input_bytes")),
        spark.createDataFrame(totals, "metric string, collection string, total_bytes long"),
    ]
    left, written = None, None
    for root, below, suffix in ((run.prefix, f"/kind={files.LINES}/", ""), (run.data_root, f"/kind={files.LINES}/", f"/export_date={run.export_date}/")):
        if files.exists(spark, root):
            found = objects.kept_listing(spark, root, new_run_dir(spark, "left"))
            left = found if left is None else left
            out = found.where(F.contains("path", F.lit(below)) & F.contains("path", F.lit(suffix)))
            out = out.withColumn("collection", F.regexp_extract("path", "/collection=([^/]+)/", 1))
            out = out.join(sound, "collection", "left_semi")
            written = out if written is None else written.unionByName(out)
    if written is not None:
        total = left if files.exists(spark, run.prefix) else written
        sized.append(_sizes(written, total).withColumn("metric", F.lit("output_bytes")))
        tags = listing.tags_of(written, config, run.snapshot_type)
        tables.append_state(tags, f"{store}.object_tags")
    spans = state.elapsed(noted, "at").select("collection", F.col("seconds").alias("total_bytes"))
    sized.append(spans.withColumn("metric", F.lit("seconds")))
    for metric in sized:
        rows = metric.select("metric", "collection", F.col("total_bytes").cast("long").alias("value"), now.alias("at"))
        tables.append_state(rows, f"{store}.metrics")
    tables.append_state(notices.failure_notices(latest, run.snapshot_type), f"{store}.notices")

    broken = latest.where(state.is_failed(F.col("status"))).orderBy("collection").collect()
    ended = state.RUN_FAILED if broken else state.RUN_COMPLETED
    ended_row = ledger.withColumns({"status": F.lit(ended), "at": now, "expires_at": dates.expires_at(now)})
    tables.append_state(ended_row, f"{store}.run_ledger")
    claims.release(spark, _claims(spark, run), ledger.first()["run_id"])
    announced = ledger.select(
        "correlation_id", F.col("output_prefix").alias("s3_prefix"), "snapshot_type", F.col("date").alias("export_date")
    )
    if broken:
        raise RunFailed(", ".join(f"{row['collection']}: {row['status']}" for row in broken))
    files.write_run_parameters(announced, f"{run.output_root}/{run.snapshot_type}/run_parameters")
    done = notices.completion_notices(announced).withColumns(
        {"collection": F.lit("all_collections"), "status": F.lit(ended)}
    )
    tables.append_state(done.select("correlation_id", "collection", "status", "payload"), f"{store}.notices")
    return latest
