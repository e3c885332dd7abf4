"""Collection, folder and table names derived from object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The file-name pattern and the two collections with tables of their own.
COLLECTION_PATTERN = r"^(?:db.)?([\w-]+)\.([A-Za-z]+-?[A-Za-z]+)"
AUDIT_COLLECTION = "data/businessAudit"
EQUALITY_COLLECTION = "data/equality"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_segment(path: Column) -> Column:
    """The second last path segment: the day folder of ``audit/2021-07-02/file``."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def collection_of(name: Column) -> Column:
    """The whole pattern match, ``db.`` included; NULL where the name does not match."""
    return F.nullif(F.regexp_extract(name, "(?U)" + COLLECTION_PATTERN, 0), F.lit(""))


def collection_path(collection: Column) -> Column:
    """First ``db.`` removed wherever it stands, dots to slashes, hyphens to underscores."""
    at = F.locate("db.", collection)
    without_db = F.when(at > 0, F.overlay(collection, F.lit(""), at, F.lit(3))).otherwise(collection)
    return F.replace(F.replace(without_db, F.lit("."), F.lit("/")), F.lit("-"), F.lit("_"))


def folder_name(collection: Column) -> Column:
    return F.replace(collection_path(collection), F.lit("_"), F.lit("-"))


def table_name(collection: Column) -> Column:
    return F.replace(collection_path(collection), F.lit("/"), F.lit("_"))


def handler(collection: Column) -> Column:
    """Which publisher takes the collection: its own audit or equality tables, or a raw text table."""
    folder = folder_name(collection)
    return (
        F.when(folder == AUDIT_COLLECTION, F.lit("audit"))
        .when(folder == EQUALITY_COLLECTION, F.lit("equality"))
        .otherwise(F.lit("raw"))
    )


def output_location(collection: Column, run_prefix: Column, data_root: Column, export_date: Column) -> Column:
    """Audit and equality are kept by export date under the data root, the rest under the run prefix."""
    folder = folder_name(collection)
    return F.when(
        handler(collection) == "raw", F.concat_ws("/", run_prefix, folder, F.lit(""))
    ).otherwise(F.concat_ws("/", data_root, folder, export_date, F.lit("")))
