"""Previous row and running number inside groups of any size.

A plain window sorts a whole group in one task, and one group may hold a third of all rows. Here the window runs
inside (group, time bucket) only, and one value per bucket is carried over from the buckets before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame, group: list[str], order: list[str], values: list[str], bucket: str, into: str = "previous"
) -> DataFrame:
    """Add struct ``into`` with ``values`` of the row before; NULL for the first of a group.

    ``order`` must be unique inside a group and ``bucket`` a column that grows with it.
    """
    value, at = F.struct(*values), F.struct(*order)
    inner = Window.partitionBy(*group, bucket).orderBy(*order)
    marked = df.withColumn("_inner", F.lag(value).over(inner)).withColumn(
        "_first", F.row_number().over(inner) == 1
    )
    ends = df.groupBy(*group, bucket).agg(F.max_by(value, at).alias("_end"))
    carried = ends.select(
        *group, bucket, F.lag("_end").over(Window.partitionBy(*group).orderBy(bucket)).alias("_carried")
    )
    joined = marked.join(carried, [*group, bucket], "left")
    previous = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_inner"))
    return joined.select(*df.columns, previous.alias(into))


def with_running_number(
    df: DataFrame, group: list[str], order: list[str], bucket: str, into: str = "number"
) -> DataFrame:
    """Add ``into``: 1 for the first row of a group, then one more for each, in ``order``."""
    inner = Window.partitionBy(*group, bucket).orderBy(*order)
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*group, bucket).agg(F.count("*").alias("_count"))
    offsets = counts.select(*group, bucket, F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_offset"))
    numbered = df.withColumn("_inner", F.row_number().over(inner)).join(offsets, [*group, bucket], "left")
    return numbered.select(*df.columns, (F.col("_inner") + F.col("_offset")).alias(into))
