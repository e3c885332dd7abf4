"""Helpers shared by the operators: reading tables, cutting lineage, column pieces."""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapforge.session import new_run_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage is cut, lost executors take nothing with them, and the planner
    knows the size of what is read next."""
    folder = new_run_dir(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores before it until no column of ``taken`` has it in upper or lower case."""
    names = {c.lower() for c in taken}
    while name.lower() in names:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else. ``lower`` does just that to text of one byte per character and is much cheaper."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def first_by_hash(rows: DataFrame, key: str, number: str, sample: int) -> DataFrame:
    """Of each key the ``sample`` rows that come first by ``number``, a hash as a long; ties go by the other columns.

    No key is sorted or shuffled whole: rows are counted by the first 12 bits of the hash, which tells where the sample of a
    key ends, and only rows up to there are numbered. ``rows`` is read twice. The ends, one row a key, are broadcast: callers
    take ``sample`` rows of each key to the driver, so there are never many keys.
    """
    part = F.shiftright(number, 52)
    counted = rows.groupBy(F.col(key).alias("_key"), part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    needed = counted.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(F.col("_before") < sample)
    last = needed.groupBy("_key").agg(F.max("_part").alias("_last"))
    near = rows.join(F.broadcast(last), F.col(key) == F.col("_key")).where(part <= F.col("_last")).select(*rows.columns)
    order = Window.partitionBy(key).orderBy(number, *(c for c in rows.columns if c not in (key, number)))
    return near.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= sample).drop("_place")
