"""Many files: listed by folders, read by their paths with names that stay out of the plan, few tasks and few outputs."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from snapforge.checks import recovery_queries
from snapforge.plans import snapshot
from snapforge.plans.snapshot import decode_and_write, described
from snapforge.session import SMALL_FILES, SETTINGS, bound_batches, settings
from snapforge.sinks import files, tables
from snapforge.sources import objects


def test_listing_goes_by_groups_of_folders(spark, tmp_path, monkeypatch):
    root = tmp_path / "in"
    names = [f"f{k}/odd {{{k}}}.gz" for k in range(5)] + ["loose.gz"]
    for name in names:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"x")
    monkeypatch.setattr(objects, "FOLDERS_AT_ONCE", 2)
    assert [len(group) for group in objects.folders_below(spark, str(root))] == [1, 2, 2, 1]
    listed = objects.write_listing(spark, str(root), str(tmp_path / "listing"))
    assert sorted(row["path"] for row in listed.collect()) == sorted(f"{root}/{name}" for name in names)
    monkeypatch.setattr(objects, "LOOSE_FILES", 0)
    assert objects.folders_below(spark, str(root)) == [[str(root)]]


def test_chosen_files_stay_out_of_the_plan(spark, tmp_path):
    paths = []
    for k in range(200):
        (tmp_path / f"file-{k}").write_bytes(b"%d" % k)
        paths.append(str(tmp_path / f"file-{k}"))
    (tmp_path / "other").write_bytes(b"x")
    with settings(spark, SMALL_FILES):
        read = objects.read_chosen(spark, [*paths[:150], str(tmp_path / "gone")])
        assert sorted(bytes(row["content"]) for row in read.collect()) == sorted(b"%d" % k for k in range(150))
        assert read.rdd.getNumPartitions() <= 16
        assert objects.read_chosen(spark, [str(tmp_path / "gone")]).count() == 0
    assert "file-149" not in read._jdf.queryExecution().toString()


def test_small_files_share_tasks(spark, exports, tmp_path):
    """A task of its own for every 32 files left as many outputs."""
    made = exports().write({f"db.a.bb.{k:04d}.gz.enc": f"{k}\n" for k in range(300)})
    work = objects.list_objects(spark, str(tmp_path / "in")).select(files.plain_path(F.col("path")).alias("path"), "length")
    work = work.join(described(made.manifest), "path").withColumn("collection", F.lit("db.a.bb"))
    seen = decode_and_write(spark, work, made.key_table, "ctr", "gzip", str(tmp_path / "out"), ["collection"])
    assert seen["lines"] == 300 and seen["errors"] == 0
    assert len(list((tmp_path / "out").rglob("part-*"))) <= 5


def test_batches_are_bounded_in_any_session(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    for given, kept in ((str(1 << 30), SETTINGS[name]), ("64MB", SETTINGS[name]), ("1000000", "1000000")):
        with settings(spark, {name: given}):
            bound_batches(spark)
            assert spark.conf.get(name) == kept


def test_keys_are_asked_for_once_by_all_jobs(spark, exports, tmp_path, monkeypatch):
    """Every job made the frame of the keys anew."""
    made = exports().write({f"db.a.bb.{k:04d}.gz.enc": f"{k}\n" for k in range(6)})
    asked = tmp_path / "asked"
    asked.mkdir()

    def ask(batches):
        open(asked / os.urandom(8).hex(), "w").close()
        yield from batches

    keys = made.key_table.coalesce(1).mapInArrow(ask, made.key_table.schema)
    work = objects.list_objects(spark, str(tmp_path / "in")).select(files.plain_path(F.col("path")).alias("path"), "length")
    work = work.join(described(made.manifest), "path").withColumn("collection", F.lit("db.a.bb"))
    monkeypatch.setattr(snapshot, "FILES_PER_JOB", 2)
    seen = decode_and_write(spark, work, keys, "ctr", "gzip", str(tmp_path / "out"), ["collection"])
    assert (seen["lines"], seen["errors"]) == (6, 0)
    assert len(list(asked.iterdir())) == 1


def test_gone_and_emptied_files_are_errors(spark, exports, tmp_path):
    made = exports().write({f"db.a.bb.{k:04d}.gz.enc": f"{k}\n" for k in range(4)})
    listed = objects.list_objects(spark, str(tmp_path / "in")).select(files.plain_path(F.col("path")).alias("path"), "length")
    work = spark.createDataFrame(
        listed.join(described(made.manifest), "path").withColumn("collection", F.lit("db.a.bb")).collect(),
        "path string, length long, iv string, ciphertext string, collection string")
    (tmp_path / "in" / "db.a.bb.0001.gz.enc").unlink()
    (tmp_path / "in" / "db.a.bb.0002.gz.enc").write_bytes(b"")
    seen = decode_and_write(spark, work, made.key_table, "ctr", "gzip", str(tmp_path / "out"), ["collection"])
    assert (seen["lines"], seen["errors"]) == (2, 2)
    failed = files.read_failures(spark, str(tmp_path / "out"), ["collection"]).collect()
    assert sorted((r["path"].rsplit(".", 3)[1], r["error"]) for r in failed) == [("0001", "no content"), ("0002", "no content")]


def test_tables_are_counted_by_groups(spark, tmp_path, monkeypatch):
    """As one plan, eighty tables took 80 stages at once on the driver."""
    tables.create_database(spark, "counted", str(tmp_path / "db"))
    for k in range(5):
        spark.createDataFrame([(str(n),) for n in range(k + 1)], "value string").write.text(str(tmp_path / "own" / f"t{k}"))
        tables.publish_raw_table(spark, f"counted.t{k}", str(tmp_path / "own" / f"t{k}"))
    monkeypatch.setattr(recovery_queries, "TABLES_AT_ONCE", 2)
    found = recovery_queries._published(spark, "counted", str(tmp_path / "own"))
    assert sorted(map(tuple, found.collect())) == [(f"t{k}", k + 1, k + 1) for k in range(5)]
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 0


def test_a_listing_that_is_kept_has_the_paths_of_a_listing(spark, tmp_path):
    for k in range(40):
        (tmp_path / "in" / f"f{k % 3}").mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / f"f{k % 3}" / f"n {k}").write_bytes(b"x" * (k + 1))
    kept = objects.kept_listing(spark, str(tmp_path / "in"), str(tmp_path / "kept"))
    listed = objects.list_objects(spark, str(tmp_path / "in")).select("path", "name", "length")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, listed.collect()))
    with settings(spark, SMALL_FILES):
        assert spark.conf.get("spark.sql.hive.filesourcePartitionFileCacheSize") == "0"
