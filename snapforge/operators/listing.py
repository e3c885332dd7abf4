"""Listed keys, the collections they belong to, and the match with the configuration.

Keys stay one per row: a collection may hold any number of them, so they are never gathered into one value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapforge.functions import names


def last_per_name(objects: DataFrame) -> DataFrame:
    """One key per file name; where a name stands in several folders the last in listing order stays."""
    rest = [F.col(c) for c in objects.columns if c not in ("path", "name")]
    last = objects.groupBy("name").agg(F.max(F.struct("path", *rest)).alias("_last"))
    return last.select("name", "_last.*").select(*objects.columns)


def with_collection(objects: DataFrame) -> DataFrame:
    return objects.withColumn("collection", names.collection_of(F.col("name")))


def matched(objects: DataFrame) -> DataFrame:
    return with_collection(objects).where(F.col("collection").isNotNull())


def rejects(objects: DataFrame) -> DataFrame:
    """Keys whose name does not follow the pattern."""
    return with_collection(objects).where(F.col("collection").isNull()).drop("collection")


def group_summary(keys: DataFrame) -> DataFrame:
    """Per collection: number of keys and the first and last in listing order."""
    return keys.groupBy("collection").agg(
        F.count("*").alias("n_keys"), F.min("path").alias("first_key"), F.max("path").alias("last_key")
    )


def allowed(keys: DataFrame, config: DataFrame) -> DataFrame:
    return keys.join(config.select("collection"), "collection", "left_semi")


def unlisted(keys: DataFrame, config: DataFrame) -> DataFrame:
    """Listed but not configured: dropped with a warning."""
    return keys.join(config.select("collection"), "collection", "left_anti")


def missing(config: DataFrame, keys: DataFrame) -> DataFrame:
    """Configured, but without any file."""
    return config.join(keys.select("collection").distinct(), "collection", "left_anti")


def reconcile(keys: DataFrame, config: DataFrame) -> DataFrame:
    """Every listed or configured collection once: ``allowed``, ``unlisted`` or ``missing``."""
    listed = keys.groupBy("collection").agg(F.count("*").alias("n_keys"))
    known = config.select("collection", F.lit(True).alias("configured"))
    outcome = (
        F.when(F.col("n_keys").isNull(), "missing").when(F.col("configured"), "allowed").otherwise("unlisted")
    )
    return listed.join(known, "collection", "full").select(
        "collection", F.coalesce("n_keys", F.lit(0)).alias("n_keys"), outcome.alias("outcome")
    )


def placeholders(config: DataFrame, keys: DataFrame, run_prefix: str) -> DataFrame:
    """What an incremental run leaves for a configured collection without files."""
    folder = names.folder_name(F.col("collection"))
    return missing(config, keys).select(
        "collection",
        F.concat_ws("/", F.lit(run_prefix), folder, F.lit("empty.txt")).alias("path"),
        F.lit("Empty").alias("status"),
    )


def tags_of(objects: DataFrame, config: DataFrame, snapshot_type: str) -> DataFrame:
    """``path, key, value``: the configured tags and the snapshot type, or one marker where there are none."""
    full = F.map_concat("tags", F.create_map(F.lit("snapshot_type"), F.lit(snapshot_type)))
    unset = F.create_map(F.lit("collection_tag"), F.lit("NOT_SET"))
    tags = F.when(F.size("tags") > 0, full).otherwise(unset)
    joined = objects.join(config.select("collection", "tags"), "collection", "left")
    return joined.select("path", F.explode(tags).alias("key", "value"))


def sizes(keys: DataFrame) -> DataFrame:
    """Bytes per collection and, as ``all_collections``, in total.

    The total is made from the sums per collection, so the rows themselves are read and shuffled once.
    """
    per_collection = keys.groupBy("collection").agg(
        F.sum("length").alias("total_bytes"), F.count("*").alias("n_keys")
    )
    rolled = per_collection.rollup("collection").agg(
        F.sum("total_bytes").alias("total_bytes"), F.sum("n_keys").alias("n_keys")
    )
    return rolled.withColumn("collection", F.coalesce("collection", F.lit("all_collections")))


def table_collisions(collections: DataFrame) -> DataFrame:
    """Collections that would be published under one table name, one per row."""
    named = collections.select("collection", names.table_name(F.col("collection")).alias("table_name")).distinct()
    shared = named.groupBy("table_name").count().where("count > 1")
    return named.join(shared.select("table_name"), "table_name", "left_semi")


ADDED, CHANGED, REMOVED = "added", "changed", "removed"


def listing_changes(before: DataFrame, after: DataFrame, compare: tuple[str, ...] = ("length",)) -> DataFrame:
    """``path, change`` of all objects that differ between two listings of one folder, with both values of ``compare``.

    Both listings meet in one aggregate that combines before its shuffle, so nothing is joined. A path that a listing
    holds several times counts once, with its largest values; null is a value like any other.
    """
    seen = F.struct(*compare)
    sides = before.select("path", seen.alias("_old"), F.lit(None).cast(after.select(seen.alias("s")).schema["s"].dataType).alias("_new"))
    sides = sides.unionByName(after.select(
        "path", F.lit(None).cast(before.select(seen.alias("s")).schema["s"].dataType).alias("_old"), seen.alias("_new")))
    met = sides.groupBy("path").agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    change = F.when(F.col("_old").isNull(), ADDED).when(F.col("_new").isNull(), REMOVED).otherwise(CHANGED)
    return met.where(~F.col("_old").eqNullSafe(F.col("_new"))).select(
        "path", change.alias("change"),
        *[F.col("_old").getField(c).alias(f"old_{c}") for c in compare], *[F.col("_new").getField(c).alias(c) for c in compare])
