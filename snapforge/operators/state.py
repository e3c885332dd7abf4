"""Collection status, run ledger and metrics.

The three stores are append-only tables. Readers take the latest value per key with one aggregate, which
combines on the map side, so a key with very many rows does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapforge.operators import history

# The states of a collection.
PROCESSING, PUBLISHING, COMPLETED, EMPTY = "Processing", "Publishing", "Completed", "Empty"
FAILED_PROCESSING, FAILED_PUBLISHING = "Failed_Processing", "Failed_Publishing"

# The states of a run.
RUN_IN_PROGRESS, RUN_COMPLETED, RUN_FAILED, RUN_CANCELLED = "IN_PROGRESS", "COMPLETED", "FAILED", "CANCELLED"


def is_failed(status: Column) -> Column:
    return F.startswith(status, F.lit("Failed"))


def latest_status(history_rows: DataFrame, at: list[str]) -> DataFrame:
    """``correlation_id, collection, status``: the last status written per key."""
    return history_rows.groupBy("correlation_id", "collection").agg(
        F.max_by("status", F.struct(*at)).alias("status")
    )


def failed_collections(history_rows: DataFrame, at: list[str]) -> DataFrame:
    return latest_status(history_rows, at).where(is_failed(F.col("status")))


def rerun_set(config: DataFrame, failed: DataFrame) -> DataFrame:
    """Configured collections that failed in the earlier run, per run."""
    return failed.join(config.select("collection", "tags"), "collection")


def collections_to_run(config: DataFrame, failed: DataFrame, existing: bool) -> DataFrame:
    """All configured collections, or the failed ones only if the run continues an earlier one."""
    return config.join(failed.select("collection").distinct(), "collection", "left_semi") if existing else config


def outcome(decode_error: Column, publish_error: Column) -> Column:
    return (
        F.when(decode_error.isNotNull(), FAILED_PROCESSING)
        .when(publish_error.isNotNull(), FAILED_PUBLISHING)
        .otherwise(COMPLETED)
    )


def run_outcome(latest: DataFrame) -> DataFrame:
    """Per run: failed as soon as one collection failed."""
    return latest.groupBy("correlation_id").agg(
        F.count_if(is_failed(F.col("status"))).alias("n_failed"),
        F.count("*").alias("n_collections"),
        F.when(F.max(is_failed(F.col("status"))), RUN_FAILED).otherwise(RUN_COMPLETED).alias("run_status"),
    )


def ledger_current(ledger: DataFrame, at: list[str], key: tuple[str, ...] = ("correlation_id", "data_product")) -> DataFrame:
    """The ledger row per key; an update that leaves a field out (NULL) keeps its earlier value."""
    stamp = F.struct(*at)
    fields = [c for c in ledger.columns if c not in key and c not in at]
    return ledger.groupBy(*key).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), stamp)).alias(c) for c in fields]
    )


def output_prefix(requests: DataFrame, current: DataFrame, location: str, run_stamp: str) -> DataFrame:
    """The prefix of an earlier run of the same key if there is one, else a new one; flag ``existing``."""
    fresh = F.concat_ws("/", F.lit(location), F.col("snapshot_type"), F.lit(run_stamp))
    earlier = current.select("correlation_id", "data_product", F.col("output_prefix").alias("_earlier"))
    joined = requests.join(earlier, ["correlation_id", "data_product"], "left")
    return joined.select(
        *requests.columns,
        F.coalesce("_earlier", fresh).alias("output_prefix"),
        F.col("_earlier").isNotNull().alias("existing"),
    )


def next_run_id(requests: DataFrame, ledger: DataFrame) -> DataFrame:
    """1 for a new key, else one more than the highest so far."""
    highest = ledger.groupBy("correlation_id", "data_product").agg(F.max("run_id").alias("_highest"))
    joined = requests.join(highest, ["correlation_id", "data_product"], "left")
    return joined.select(*requests.columns, (F.coalesce("_highest", F.lit(0)) + 1).alias("run_id"))


def run_counter(ledger: DataFrame, order: list[str], bucket: str) -> DataFrame:
    """Run number of every start in the history of a key."""
    return history.with_running_number(ledger, ["correlation_id", "data_product"], order, bucket, "run_id")


def steps_to_run(steps: DataFrame, failed: DataFrame) -> DataFrame:
    """Steps from the failed one on; runs without a failed step run everything.

    ``steps(correlation_id, ordinal, step)``, ``failed(correlation_id, step)``. If the failed step is not among
    the steps of the run, all of them are skipped.
    """
    wanted = failed.select("correlation_id", F.col("step").alias("_failed_step")).distinct()
    at = (
        steps.join(wanted, "correlation_id")
        .groupBy("correlation_id")
        .agg(F.min(F.when(F.col("step") == F.col("_failed_step"), F.col("ordinal"))).alias("_from"))
        .withColumn("_resumed", F.lit(True))
    )
    joined = steps.join(at, "correlation_id", "left")
    keep = F.col("_resumed").isNull() | (F.col("ordinal") >= F.col("_from"))
    return joined.where(keep).select(*steps.columns)


def latest_metrics(metrics: DataFrame, at: list[str]) -> DataFrame:
    """One value per (metric, collection), the last written."""
    return metrics.groupBy("metric", "collection").agg(F.max_by("value", F.struct(*at)).alias("value"))


def elapsed(history_rows: DataFrame, ts: str = "ts") -> DataFrame:
    """Rounded seconds from first to last status per collection and, as ``all_collections``, per run."""
    spans = history_rows.groupBy("correlation_id", "collection").agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last")
    )
    runs = spans.groupBy("correlation_id").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    both = spans.unionByName(runs.withColumn("collection", F.lit("all_collections")))
    micros = F.unix_micros(F.col("_last").cast("timestamp")) - F.unix_micros(F.col("_first").cast("timestamp"))
    return both.select("correlation_id", "collection", F.bround(micros / 1e6).cast("long").alias("seconds"))
