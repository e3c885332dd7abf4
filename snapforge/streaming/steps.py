"""Ledger updates from a stream of step observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from snapforge.operators import changes
from snapforge.operators.records import latest_version
from snapforge.sinks.files import delete_prefix, exists


def _earlier(spark: SparkSession, location: str, batch_id: int) -> DataFrame | None:
    """Last observation per run as left by the batch before."""
    before = f"{location}/batch_id={batch_id - 1}"
    return spark.read.parquet(before) if batch_id > 0 and exists(spark, before) else None


def follow_steps(
    observations: DataFrame, order: list[str], bucket: str, final_step: str,
    updates: str, memory: str, checkpoint: str,
) -> StreamingQuery:
    """Write to ``updates`` one row per ledger update, as the batch operator would.

    ``memory`` keeps the last observation per run and whether the run has ended, one folder per batch. Both are
    overwritten when a batch is repeated, so an update is neither lost nor doubled. Observations that are not
    newer than the remembered one came too late to be compared with the one before them: they change nothing and
    are kept in ``<updates>_late/batch_id=N``. Later observations of an ended run are ignored, as in the batch operator.
    """
    columns = observations.columns

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = _earlier(spark, memory, batch_id)
        fresh, seen = batch, batch.withColumn("_ended", F.lit(False))
        if known is not None:
            last = known.select(
                "correlation_id", F.struct(*order).alias("_last"), F.col("_ended").alias("_run_ended")
            )
            beside = batch.join(last, "correlation_id", "left")
            newer = F.col("_last").isNull() | (F.struct(*order) > F.col("_last"))
            fresh = beside.where(newer & ~F.coalesce("_run_ended", F.lit(False))).select(*columns)
            beside.where(~newer).select(*columns).write.mode("overwrite").parquet(f"{updates}_late/batch_id={batch_id}")
            seen = known.unionByName(fresh.withColumn("_ended", F.lit(False)))
        marked = seen.where(~F.col("_ended")).select(*columns)
        written = changes.state_changes(marked, order, bucket, final_step)
        if known is not None:
            # The remembered rows only serve as predecessors; they were reported by an earlier batch.
            written = written.join(known.select("correlation_id", *order), ["correlation_id", *order], "left_anti")
        written.select(*columns, "ledger_status").write.mode("overwrite").parquet(f"{updates}/batch_id={batch_id}")

        final = changes.is_final(F.col("step"), F.col("state"), final_step)
        ends = seen.groupBy("correlation_id").agg(F.max(F.col("_ended") | final).alias("_ended"))
        newest = latest_version(seen.drop("_ended"), ["correlation_id"], order)
        newest.join(ends, "correlation_id").write.mode("overwrite").parquet(f"{memory}/batch_id={batch_id}")
        delete_prefix(spark, f"{memory}/batch_id={batch_id - 2}")  # a repeated batch needs the one before only

    return (
        observations.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(one_batch)
        .start()
    )
