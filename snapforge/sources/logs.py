"""Service logs: one JSON-like text line per message."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The shape of a log line and of the two timing messages.
LOG_LINE = r'^\{ "timestamp": "([^"]*)", "log_level": "([^"]*)", "message": "(.*)" \}$'
COLLECTION_TIME = r"time taken for (.*?)\s*: *([0-9]+)$"
RUN_TIME = r"\ball collections: ([0-9]+)\b"


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_log_lines(spark.read.text(path))


def parse_log_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``logged_at, log_level, message``; lines of another shape are dropped.

    Messages may hold unescaped quotes, so this is a pattern and not a JSON parse.
    """
    return lines.where(F.col(value).rlike(LOG_LINE)).select(
        F.regexp_extract(value, LOG_LINE, 1).alias("logged_at"),
        F.regexp_extract(value, LOG_LINE, 2).alias("log_level"),
        F.regexp_extract(value, LOG_LINE, 3).alias("message"),
    )


def processing_times(messages: DataFrame) -> DataFrame:
    """``collection, time_taken`` from the timing messages, slowest first."""
    timed = messages.where(F.col("message").rlike(COLLECTION_TIME)).select(
        F.regexp_extract("message", COLLECTION_TIME, 1).alias("collection"),
        F.regexp_extract("message", COLLECTION_TIME, 2).try_cast("long").alias("time_taken"),
    )
    return timed.orderBy(F.desc("time_taken"), "collection")


def run_times(messages: DataFrame) -> DataFrame:
    """``logged_at, time_taken`` of whole runs; 0 where the message has no number."""
    found = F.regexp_extract("message", RUN_TIME, 1)
    return messages.where(F.contains("message", F.lit("all collections:"))).select(
        "logged_at", F.coalesce(found.try_cast("long"), F.lit(0)).alias("time_taken")
    )
