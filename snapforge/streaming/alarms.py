"""Alarms on a stream of cluster events."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from snapforge.operators import alerts


def alarm_stream(events: DataFrame, clusters: Mapping[str, str], late: str = "10 minutes") -> DataFrame:
    """Windows of ``events(ts, value)``; ``ts`` becomes a TIMESTAMP, which watermarks need."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return alerts.alarm_windows(alerts.classify(alerts.parse_events(timed), clusters))


def write_alarms(alarms: DataFrame, location: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write alarms as Parquet until the source is used up.

    In ``append`` mode a window comes out once the watermark has passed it, so the newest ones stay open. In
    ``complete`` mode every batch replaces the output with all windows so far.
    """
    writer = alarms.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        return writer.format("parquet").option("path", location).start()
    return writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(location)).start()
