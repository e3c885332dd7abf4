"""Date-range backfill of audit and equality exports laid out in day folders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapforge.functions.dates import day_prefixes
from snapforge.operators import state
from snapforge.operators.records import flatten_equality
from snapforge.plans.snapshot import Audit, RunFailed, decode_and_write, described, publish_audit
from snapforge.sinks import files, tables
from snapforge.sources import objects


@dataclass(frozen=True)
class Backfill:
    correlation_id: str
    start_date: str
    end_date: str
    input_root: str
    output_root: str
    collection: str
    load_date: str
    # Where the days' outcomes and the tags of what was written are kept, if anywhere.
    state_database: str | None = None

    @property
    def tags(self) -> dict[str, str]:
        folder, table = self.collection.removeprefix("db.").split(".", 1)
        return {"pii": "true", "db": folder, "table": table}


def days_of(spark: SparkSession, job: Backfill) -> list[str]:
    """The days of the range; the driver needs them to name the folders."""
    ranges = spark.createDataFrame([(job.start_date, job.end_date)], "start_date string, end_date string")
    rows = day_prefixes(ranges, f"{job.input_root}/").orderBy("day").collect()
    return [row["day"] for row in rows]


def _decode_days(
    spark: SparkSession, job: Backfill, days: list[str], manifest: DataFrame, keys: DataFrame
) -> dict[str, str]:
    """Decode all days in one job and return the status per day."""
    present = [day for day in days if files.exists(spark, f"{job.input_root}/{day}")]
    outcome = {day: "Empty" for day in days}
    if not present:
        return outcome
    folders = [f"{job.input_root}/{day}" for day in present]
    listed = objects.list_objects(spark, folders).withColumn("path", files.plain_path(F.col("path")))
    start = len(files.plain(job.input_root).rstrip("/")) + 2
    below = F.substring(F.col("path"), F.lit(start), F.length("path"))
    work = listed.join(described(manifest), "path", "left").select(
        "path",
        "length",
        F.lit(job.collection).alias("collection"),
        F.substring_index(below, "/", 1).alias("export_date"),
        "iv",
        "ciphertext",
    )
    by = ["collection", "export_date"]

    def clear(day: str) -> None:
        for kind in (files.LINES, files.ERRORS):
            files.delete_prefix(spark, f"{job.output_root}/kind={kind}/collection={job.collection}/export_date={day}")

    for day in present:
        clear(day)
    decode_and_write(spark, work, keys, "eax", "zlib", job.output_root, by)
    for row in work.select("export_date").distinct().toLocalIterator():
        outcome[row["export_date"]] = state.COMPLETED
    failures = files.read_failures(spark, job.output_root, by)
    failures = failures.where((F.col("collection") == job.collection) & F.col("export_date").isin(present))
    beside = f"{job.output_root}/failures/{job.correlation_id}"
    for row in files.set_aside_failures(failures, by, beside):
        outcome[row["export_date"]] = state.FAILED_PROCESSING
        clear(row["export_date"])
    return outcome


def _sound_lines(spark: SparkSession, job: Backfill, outcome: dict[str, str]) -> tuple[DataFrame | None, list[str]]:
    """Written lines of the days without a failure, with ``date_str``."""
    root = files.lines_location(job.output_root, collection=job.collection)
    days = [
        day for day, status in outcome.items()
        if status == state.COMPLETED and files.exists(spark, f"{root}/export_date={day}")
    ]
    if not days:
        return None, []
    written = (
        spark.read.schema("value string, export_date string")
        .option("basePath", root)
        .text([f"{root}/export_date={day}" for day in days])
    )
    return written.select(F.col("value").alias("val"), F.col("export_date").alias("date_str")), days


def _finish(spark: SparkSession, job: Backfill, outcome: dict[str, str], days: list[str]) -> DataFrame:
    """Outcome per day; ``days`` are those with lines, whose files get the tags of the collection."""
    rows = [(job.correlation_id, day, status) for day, status in sorted(outcome.items())]
    statuses = spark.createDataFrame(rows, "correlation_id string, day string, status string")
    if job.state_database:
        tables.create_database(spark, job.state_database)
        tables.append_state(statuses, f"{job.state_database}.day_status")
        if days:
            root = files.lines_location(job.output_root, collection=job.collection)
            written = objects.list_objects(spark, [f"{root}/export_date={day}" for day in days])
            tags = F.create_map(*[F.lit(part) for pair in job.tags.items() for part in pair])
            tables.append_state(
                written.select("path", F.explode(tags).alias("key", "value")), f"{job.state_database}.object_tags"
            )
    broken = [day for day, status in sorted(outcome.items()) if status.startswith("Failed")]
    if broken:
        raise RunFailed(", ".join(broken))
    return statuses


def backfill_audit(
    spark: SparkSession, job: Backfill, audit: Audit, manifest: DataFrame, keys: DataFrame
) -> DataFrame:
    """Raw and typed audit partitions for every day of the range; repeatable. No projections."""
    outcome = _decode_days(spark, job, days_of(spark, job), manifest, keys)
    lines, days = _sound_lines(spark, job, outcome)
    if lines is not None:
        publish_audit(spark, Audit(audit.database, audit.fields), lines, days)
    return _finish(spark, job, outcome, days)


def backfill_equality(
    spark: SparkSession, job: Backfill, table: str, location: str | None, manifest: DataFrame, keys: DataFrame
) -> DataFrame:
    """Append the flattened equality rows of the range."""
    outcome = _decode_days(spark, job, days_of(spark, job), manifest, keys)
    lines, days = _sound_lines(spark, job, outcome)
    tables.create_database(spark, table.split(".")[0], location)
    tables.create_equality_table(spark, table)
    if lines is not None:
        tables.append_equality(flatten_equality(lines, F.lit(job.load_date)), table)
    return _finish(spark, job, outcome, days)
