"""A full table kept in buckets by its key, into which increments are merged.

The full table is read bucket by bucket and written in the same buckets: only the increment is shuffled, to the buckets
of its keys. The merged table is written beside the old one and takes its name by two renames of the catalog, so a merge
that fails leaves the old one as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapforge.operators.records import latest_version
from snapforge.sinks.tables import quoted


def _buckets(spark: SparkSession, table: str) -> int:
    described = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {quoted(table)}").collect()}
    return int(described["Num Buckets"])


def _write(rows: DataFrame, table: str, key: list[str], buckets: int) -> None:
    rows.write.format("parquet").bucketBy(buckets, *key).sortBy(*key).saveAsTable(table)


def create_full(records: DataFrame, table: str, key: list[str], buckets: int) -> None:
    """The full table; one shuffle by the key, so that a bucket is one file."""
    _write(records.repartition(buckets, *key), table, key, buckets)


def merged(full: DataFrame, increment: DataFrame, key: list[str], version: list[str]) -> DataFrame:
    """The newest row per key of both; ``full`` has one row per key. Of equal versions the increment's row stays."""
    rest = [c for c in full.columns if c not in key]
    newest = latest_version(increment.select(*full.columns), key, version).select(*key, F.struct(*rest).alias("_new"))
    both = full.select(*key, F.struct(*rest).alias("_old")).join(newest, key, "full")
    old, new = (F.struct(*(F.col(f"{side}.{c}") for c in version)) for side in ("_old", "_new"))
    keeps_old = F.col("_new").isNull() | (F.col("_old").isNotNull() & (old > new))
    row = F.when(keeps_old, F.col("_old")).otherwise(F.col("_new"))
    return both.select(*key, row.alias("_row")).select(*key, "_row.*").select(*full.columns)


def merge_increment(increment: DataFrame, table: str, key: list[str], version: list[str]) -> None:
    """Merge ``increment``, which may hold several versions of a key, into the full table."""
    spark = increment.sparkSession
    mark = uuid.uuid4().hex
    beside, before = f"{table}_{mark}_next", f"{table}_{mark}_before"
    _write(merged(spark.table(table), increment, key, version), beside, key, _buckets(spark, table))
    spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted(before)}")
    spark.sql(f"ALTER TABLE {quoted(beside)} RENAME TO {quoted(table)}")
    spark.sql(f"DROP TABLE {quoted(before)}")
