"""Object listings and whole-file reads."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapforge.functions import names
from snapforge.session import SMALL_FILES, settings
from snapforge.sinks.files import exists, hadoop_path, plain_path

FOLDERS_AT_ONCE = 64
LOOSE_FILES = 10_000


def _files(spark: SparkSession, roots: list[str], name_glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    # As one text, which the JVM splits: handed over one by one they take 0.1 ms each.
    return reader._df(reader._jreader.load(spark._jvm.java.util.regex.Pattern.compile("\\x00").split("\0".join(roots))))


def list_objects(spark: SparkSession, roots: str | list[str], name_glob: str | None = None) -> DataFrame:
    """``path, name, length, modificationTime`` of every file below the roots; no content is read."""
    roots = [roots] if isinstance(roots, str) else roots
    listed = _files(spark, roots, name_glob).select("path", "length", "modificationTime")
    return listed.withColumn("name", names.base_name(F.col("path")))


def read_objects(spark: SparkSession, roots: str | list[str], name_glob: str | None = None) -> DataFrame:
    """``path, content`` in one scan; small files are packed into partitions by size."""
    roots = [roots] if isinstance(roots, str) else roots
    return _files(spark, roots, name_glob).select("path", "content")


def kept_listing(spark: SparkSession, root: str, location: str) -> DataFrame:
    """``path, name, length`` of every file below the root, paths as Spark gives them, kept as a table at ``location``."""
    with settings(spark, SMALL_FILES):
        listed = list_objects(spark, root).select("path", "name", "length")
        listed.write.parquet(location)
    return spark.read.schema(listed.schema).parquet(location)


def folders_below(spark: SparkSession, root: str) -> list[list[str]]:
    """What lies directly below the root, in groups that are listed one after the other, so that the driver holds the
    listing of FOLDERS_AT_ONCE folders at most. A root with more than LOOSE_FILES files of its own is listed whole."""
    path, fs = hadoop_path(spark, root)
    folders, loose, found = [], [], fs.listStatusIterator(path)
    while found.hasNext():
        entry = found.next()
        (folders if entry.isDirectory() else loose).append(entry.getPath().toString())
        if len(loose) > LOOSE_FILES:
            return [[root]]
    folders.sort()
    groups = [folders[k:k + FOLDERS_AT_ONCE] for k in range(0, len(folders), FOLDERS_AT_ONCE)]
    return ([loose] if loose else []) + groups or [[root]]


def write_listing(spark: SparkSession, root: str, location: str) -> DataFrame:
    """``path, name, length`` of every file below the root, kept as a table at ``location``."""
    with settings(spark, SMALL_FILES):
        for group in folders_below(spark, root):
            listed = list_objects(spark, [no_pattern(path) for path in group])
            listed = listed.select(plain_path(F.col("path")).alias("path"), "name", "length")
            listed.write.mode("append").parquet(location)
    return spark.read.schema(listed.schema).parquet(location)


def no_pattern(path: str) -> str:
    """The path with what Hadoop would read as a pattern escaped."""
    return re.sub(r"([\\{}\[\]*?,])", r"\\\1", path)


def read_chosen(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, content`` of these files, paths as a listing gave them; files that are gone have no row.

    The scan is given the files themselves, so neither their folders are listed nor do their names stand in the plan,
    which the driver keeps as text. Call it under ``session.SMALL_FILES``, which has them looked up in a few tasks.
    """
    try:
        return _files(spark, [no_pattern(path) for path in paths], None).select("path", "content")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
    left = [path for path in paths if exists(spark, path)]
    if not left:
        return spark.createDataFrame([], "path string, content binary")
    return _files(spark, [no_pattern(path) for path in left], None).select("path", "content")


def is_under(path: Column, prefix: str) -> Column:
    """Under the prefix, but not the folder-marker key that equals it."""
    return F.startswith(path, F.lit(prefix)) & (path != prefix)


def under_prefix(objects: DataFrame, prefix: str) -> DataFrame:
    return objects.where(is_under(F.col("path"), prefix))


def first_level_folders(objects: DataFrame, prefix: str) -> DataFrame:
    """Distinct ``folder`` values one level below the prefix; keys directly below it have none."""
    rest = F.substring(F.col("path"), F.lit(len(prefix) + 1), F.length("path"))
    nested = objects.where(F.startswith(F.col("path"), F.lit(prefix)) & F.contains(rest, F.lit("/")))
    return nested.select(
        F.concat(F.lit(prefix), F.substring_index(rest, "/", 1), F.lit("/")).alias("folder")
    ).distinct()
