from __future__ import annotations

import json
import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from snapforge.operators import changes, history, listing, notices, parameters, policy, records, state
from snapforge.session import new_run_dir, shared_dir
from snapforge.sinks import files, tables
from snapforge.sources import logs, objects
from snapforge.sources import tables as sources


def keys(spark, *paths: str):
    rows = [(p, p.rsplit("/", 1)[-1], len(p)) for p in paths]
    return spark.createDataFrame(rows, "path string, name string, length long")


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def config(spark, tags):
    return spark.createDataFrame(list(tags.items()), "collection string, tags map<string,string>")


def test_marker_key_and_prefix(spark):
    listed = keys(spark, "in/", "in/db.a.bb.1", "in/sub/db.a.bb.2", "inx/db.a.bb.3", "out/db.a.bb.4")
    assert rows(objects.under_prefix(listed, "in/").select("path")) == [("in/db.a.bb.1",), ("in/sub/db.a.bb.2",)]
    assert rows(objects.first_level_folders(keys(spark, "r/2020/a", "r/2020/b", "r/2021/x/y", "r/z", "q/1/a"), "r/")) == [
        ("r/2020/",), ("r/2021/",)
    ]


def test_last_key_per_name(spark):
    listed = keys(spark, "b/db.a.bb.1", "a/db.a.bb.1", "a/db.a.bb.2")
    assert rows(listing.last_per_name(listed).select("path", "name")) == [("a/db.a.bb.2", "db.a.bb.2"), ("b/db.a.bb.1", "db.a.bb.1")]


def test_grouping_does_not_need_sorted_keys(spark):
    listed = keys(spark, "db.core.contract.2", "db.core.accounts.1", "db.core.contract.1", "bad")
    assert rows(listing.group_summary(listing.matched(listed))) == [
        ("db.core.accounts", 1, "db.core.accounts.1", "db.core.accounts.1"),
        ("db.core.contract", 2, "db.core.contract.1", "db.core.contract.2"),
    ]
    assert rows(listing.rejects(listed).select("path")) == [("bad",)]


def test_reconcile(spark):
    listed = listing.matched(keys(spark, "db.core.contract.1", "db.core.contract.2", "db.not.wanted.1"))
    known = config(spark, {"db.core.contract": {}, "db.fake.empty": {}})
    assert rows(listing.allowed(listed, known).select("path")) == [("db.core.contract.1",), ("db.core.contract.2",)]
    assert rows(listing.unlisted(listed, known).select("path")) == [("db.not.wanted.1",)]
    assert rows(listing.missing(known, listed).select("collection")) == [("db.fake.empty",)]
    assert rows(listing.reconcile(listed, known)) == [
        ("db.core.contract", 2, "allowed"), ("db.fake.empty", 0, "missing"), ("db.not.wanted", 1, "unlisted")
    ]


def test_tags(spark):
    listed = listing.matched(keys(spark, "db.core.contract.1", "db.core.accounts.1", "db.core.other.1"))
    known = config(spark, {"db.core.contract": {"pii": "true"}, "db.core.accounts": {}})
    assert rows(listing.tags_of(listed, known, "full")) == [
        ("db.core.accounts.1", "collection_tag", "NOT_SET"),
        ("db.core.contract.1", "pii", "true"),
        ("db.core.contract.1", "snapshot_type", "full"),
        ("db.core.other.1", "collection_tag", "NOT_SET"),
    ]


def test_sizes(spark):
    listed = listing.matched(keys(spark, "db.core.contract.1", "db.core.contract.22", "db.core.accounts.1"))
    assert rows(listing.sizes(listed)) == [("all_collections", 55, 3), ("db.core.accounts", 18, 1), ("db.core.contract", 37, 2)]


def test_table_collisions(spark):
    found = spark.createDataFrame([("db.a.b-c",), ("db.a.b_c",), ("db.a.bc",), ("a.b-c",)], "collection string")
    assert rows(listing.table_collisions(found).select("collection")) == [("a.b-c",), ("db.a.b-c",), ("db.a.b_c",)]


@pytest.mark.parametrize("given,kind,database", [
    ("incremental", "incremental", "pub_incremental"), ("INCREMENTAL", "incremental", "pub_incremental"),
    ("full", "full", "pub"), ("anything", "full", "pub"), (None, "full", "pub"),
])
def test_snapshot_type(spark, given, kind, database):
    frame = spark.createDataFrame([(given,)], "v string").select(parameters.snapshot_type(F.col("v")).alias("k"))
    assert frame.select("k", parameters.database_name(F.lit("pub"), F.col("k"))).first() == (kind, database)


def test_parameter_checks(spark):
    schema = "correlation_id string, s3_prefix string, snapshot_type string"
    required = ["correlation_id", "s3_prefix", "snapshot_type"]
    good = spark.createDataFrame([("1", "p", "full"), ("2", "p", "Incremental")], schema)
    assert parameters.violations(good, required).count() == 0
    assert parameters.checked(good, required).count() == 2
    bad = spark.createDataFrame([(None, "p", "full"), ("2", "p", "partial")], schema)
    assert rows(parameters.violations(bad, required).select("violation")) == [
        ("missing correlation_id",), ("snapshot_type must be full or incremental",)
    ]
    with pytest.raises(PySparkException, match="run parameters are not valid"):
        parameters.checked(bad, required).collect()


T0 = datetime(2021, 7, 2)


def test_status_and_rerun(spark):
    written = [
        ("r1", "db.a.bb", "Processing", T0, 0), ("r1", "db.a.bb", "Failed_Processing", T0, 1),
        ("r1", "db.c.dd", "Failed_Publishing", T0, 0), ("r1", "db.c.dd", "Completed", T0 + timedelta(seconds=1), 0),
        ("r1", "db.gone.xx", "Failed_Processing", T0, 0), ("r2", "db.c.dd", "Completed", T0, 0),
    ]
    frame = spark.createDataFrame(written, "correlation_id string, collection string, status string, at timestamp, seq int")
    assert rows(state.latest_status(frame, ["at", "seq"])) == [
        ("r1", "db.a.bb", "Failed_Processing"), ("r1", "db.c.dd", "Completed"), ("r1", "db.gone.xx", "Failed_Processing"),
        ("r2", "db.c.dd", "Completed"),
    ]
    failed = state.failed_collections(sources.status_of_run(frame, "r1"), ["at", "seq"])
    known = config(spark, {"db.a.bb": {}, "db.c.dd": {}})
    assert rows(state.rerun_set(known, failed).select("collection")) == [("db.a.bb",)]
    assert rows(state.collections_to_run(known, failed, True).select("collection")) == [("db.a.bb",)]
    assert rows(state.collections_to_run(known, failed, False).select("collection")) == [("db.a.bb",), ("db.c.dd",)]
    outcome = rows(state.run_outcome(state.latest_status(frame, ["at", "seq"])))
    assert outcome == [("r1", 2, 3, "FAILED"), ("r2", 0, 1, "COMPLETED")]


def test_ledger(spark):
    schema = ("correlation_id string, data_product string, status string, current_step string, output_prefix string,"
              " run_id long, at timestamp, seq int")
    ledger = spark.createDataFrame(
        [("r1", "snapshot-full", "IN_PROGRESS", None, None, 1, T0, 0), ("r1", "snapshot-full", None, "submit", "out/1", None, T0, 1),
         ("r1", "snapshot-full", "FAILED", "submit", None, None, T0, 2)], schema)
    current = state.ledger_current(ledger, ["at", "seq"])
    assert rows(current) == [("r1", "snapshot-full", "FAILED", "submit", "out/1", 1)]
    assert sources.ledger_rows(ledger, "r1", "snapshot-full").count() == 3
    asked = spark.createDataFrame([("r1", "full", "snapshot-full"), ("r2", "full", "snapshot-full")],
                                  "correlation_id string, snapshot_type string, data_product string")
    assert rows(state.output_prefix(asked, current, "base", "stamp").select("correlation_id", "output_prefix", "existing")) == [
        ("r1", "out/1", True), ("r2", "base/full/stamp", False)
    ]
    assert rows(state.next_run_id(asked, ledger).select("correlation_id", "run_id")) == [("r1", 2), ("r2", 1)]


def test_resume(spark):
    names = ["flush", "managed", "submit", "notify"]
    steps = spark.createDataFrame([(run, k, n) for run in ("a", "b", "c") for k, n in enumerate(names)],
                                  "correlation_id string, ordinal int, step string")
    failed = spark.createDataFrame([("a", "submit"), ("b", "unknown")], "correlation_id string, step string")
    left = rows(state.steps_to_run(steps, failed))
    assert [r[2] for r in left if r[0] == "a"] == ["submit", "notify"]
    assert [r for r in left if r[0] == "b"] == []
    assert len([r for r in left if r[0] == "c"]) == 4


def test_step_name(spark):
    frame = spark.createDataFrame([("/opt/x/send_report.py",), ("file:/var/ci/flush.sh",), ("spark-submit",)], "v string")
    assert [r[0] for r in frame.select(changes.step_name(F.col("v"))).collect()] == ["send_report", "flush", "spark-submit"]


def test_metrics_last_value_wins(spark):
    written = spark.createDataFrame(
        [("size", "core/contract", 1, T0), ("size", "core/contract", 2, T0 + timedelta(hours=1)), ("time", "core/contract", 3, T0)],
        "metric string, collection string, value long, at timestamp")
    assert rows(state.latest_metrics(written, ["at"])) == [("size", "core/contract", 2), ("time", "core/contract", 3)]


def test_history_with_a_hot_group(spark):
    """Bucketed numbers and predecessors against plain windows; one group holds most of the rows."""
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.7 else f"g{rng.randrange(5)}", T0 + timedelta(minutes=rng.randrange(4000)), k, rng.choice("abc"))
            for k in range(3000)]
    frame = spark.createDataFrame(data, "g string, ts timestamp, id long, v string").withColumn("hour", F.date_trunc("hour", "ts"))
    plain = Window.partitionBy("g").orderBy("ts", "id")
    want = frame.select("id", F.lag("v").over(plain).alias("p"), F.row_number().over(plain).alias("n"))
    got = history.with_running_number(frame, ["g"], ["ts", "id"], "hour", "n")
    got = history.with_previous(got, ["g"], ["ts", "id"], ["v"], "hour").select("id", "previous.v", "n")
    assert sorted(map(str, rows(want))) == sorted(str(r) for r in rows(got))


def test_failure_notice(spark):
    statuses = spark.createDataFrame([("r1", "db.a.bb", "Failed_Processing"), ("r1", "db.c.dd", "Completed")],
                                     "correlation_id string, collection string, status string")
    (row,) = notices.failure_notices(statuses, "full").collect()
    assert json.loads(row["payload"]) == {
        "severity": "High", "notification_type": "Error", "slack_username": "snapshot-full",
        "title_text": "Collection set to failure status",
        "custom_elements": [
            {"key": "Collection Name", "value": "db.a.bb"}, {"key": "Collection Status", "value": "Failed_Processing"},
            {"key": "Correlation Id", "value": "r1"}, {"key": "Snapshot Type", "value": "full"},
        ],
    }


@pytest.mark.parametrize("skip,kind,sent", [("false", "full", 1), ("TRUE", "full", 0), ("false", "Incremental", 0)])
def test_completion_notice(spark, skip, kind, sent):
    run = spark.createDataFrame([("r1", "out/1", kind, "2021-07-02")],
                                "correlation_id string, s3_prefix string, snapshot_type string, export_date string")
    found = notices.completion_notices(run, skip).collect()
    assert len(found) == sent
    if sent:
        assert json.loads(found[0]["payload"]) == run.first().asDict()


def test_policies(spark):
    data = [("p/1", {"Pii": "false", "collection_tag": "crown"}), ("p/2", {"pii": "true", "collection_tag": "crown"}),
            ("p/3", {}), ("q/4", {"PII": "false"}), ("p/5", None)]
    frame = spark.createDataFrame(data, "path string, tags map<string,string>")
    allowed = [policy.ReadPolicy("crown", ("p/",), {"collection_tag": "crown"}), policy.ReadPolicy("open", ("p/", "q/"), {"pii": "false"}),
               policy.ReadPolicy("all", ("p/",))]
    assert rows(policy.readable(frame, allowed)) == [
        ("p/1", "all"), ("p/1", "crown"), ("p/1", "open"), ("p/2", "all"), ("p/2", "crown"), ("p/3", "all"), ("p/5", "all"),
        ("q/4", "open"),
    ]


def test_retention(spark):
    now = datetime(2021, 7, 10)
    data = [("a/full/1", now - timedelta(days=8)), ("a/full/2", now - timedelta(days=7)), ("a/data/3", now - timedelta(days=80))]
    frame = spark.createDataFrame(data, "path string, modificationTime timestamp")
    assert rows(policy.expired(frame, F.lit(now), ["a/full"]).select("path")) == [("a/full/1",)]
    assert rows(policy.expired(frame, F.lit(now), ["a/"], ["a/data"]).select("path")) == [("a/full/1",)]


def test_logs(spark, tmp_path):
    lines = ['{ "timestamp": "2021-07-02 01:02:03.004", "log_level": "INFO", "message": "time taken for core_contract: 12" }',
             '{ "timestamp": "t", "log_level": "INFO", "message": "time taken for core_accounts:120" }',
             '{ "timestamp": "t", "log_level": "WARNING", "message": "he said "no"" }',
             '{ "timestamp": "t", "log_level": "INFO", "message": "time for all collections: 77 \' ]" }', "Traceback"]
    (tmp_path / "log").write_text("\n".join(lines))
    found = logs.read_log_lines(spark, str(tmp_path / "log"))
    assert found.count() == 4
    assert [tuple(r) for r in logs.processing_times(found).collect()] == [("core_accounts", 120), ("core_contract", 12)]
    assert [r["time_taken"] for r in logs.run_times(found).collect()] == [77]


def test_small_sources(spark, tmp_path):
    (tmp_path / "config.json").write_text(json.dumps({"collections_all": {"db.a.bb": {"pii": "true"}, "db.c.dd": {}}}, indent=1))
    assert [(r["collection"], r["tags"]) for r in sources.read_collection_config(spark, str(tmp_path / "config.json")).collect()] == [
        ("db.a.bb", {"pii": "true"}), ("db.c.dd", {})
    ]
    (tmp_path / "m.json").write_text('{"path":"p","iv":"i","ciphertext":"c","key_id":"k"}\n')
    assert rows(sources.read_manifest(spark, str(tmp_path / "m.json"))) == [("p", "i", "c", "k")]
    (tmp_path / "p.csv").write_text("correlation_id,s3_prefix,snapshot_type,export_date\n1,p,full,d\n2,q,full,e\n")
    assert rows(sources.read_run_parameters(spark, str(tmp_path / "p.csv"))) == [("2", "q", "full", "e")]
    (tmp_path / "columns.txt").write_text("visits_30, actor\n")
    assert sources.read_column_list(spark, str(tmp_path / "columns.txt")) == ["visits_30", "actor"]
    (tmp_path / "t.txt").write_text("a\n\nb\n")
    assert rows(sources.read_lines(spark, str(tmp_path / "t.txt"), "2021-07-02")) == [
        ("", "2021-07-02"), ("a", "2021-07-02"), ("b", "2021-07-02")
    ]


@pytest.fixture
def database(spark):
    name = f"d_{uuid.uuid4().hex[:8]}"
    tables.create_database(spark, name, new_run_dir(spark, "db"))
    return name


def lines(spark, *pairs):
    return spark.createDataFrame(list(pairs), "val string, date_str string")


def test_audit_overwrites_its_dates_only(spark, database):
    table = f"{database}.auditlog_raw"
    tables.load_audit_raw(lines(spark, ("a", "2021-01-01"), ("b", "2021-01-02")), table)
    tables.load_audit_raw(lines(spark, ("c", "2021-01-02"), ("d", "2021-01-02")), table)
    assert rows(spark.table(table)) == [("a", "2021-01-01"), ("c", "2021-01-02"), ("d", "2021-01-02")]
    plan = sources.read_partition(spark, table, "2021-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_str" in plan and "= 2021-01-02)]" in plan


def test_projection_replaces_one_date_even_if_empty(spark, database, tmp_path):
    source, target = f"{database}.auditlog_managed", f"{database}.auditlog_red_v"
    fields = {"1_abroad": "1_abroad", "name": "name"}
    one = '{"1_abroad":"x","name":"n"}'
    tables.load_audit_typed(lines(spark, (one, "2021-01-01"), (one, "2021-01-02")), source, fields)

    def load(date: str) -> None:
        tables.load_audit_projection(spark, source, target, ["1_abroad"], date, str(tmp_path / "red"))

    load("2021-01-01"), load("2021-01-02"), load("2021-01-01")
    assert rows(spark.table(target)) == [("x", "2021-01-01"), ("x", "2021-01-02")]
    spark.sql(f"ALTER TABLE {source} DROP PARTITION (date_str = '2021-01-02')")
    load("2021-01-02")
    assert rows(spark.table(target)) == [("x", "2021-01-01")]
    with pytest.raises(ValueError, match="unknown columns: secret"):
        tables.load_audit_projection(spark, source, target, ["secret"], "2021-01-01", str(tmp_path / "red"))


def test_raw_table_is_replaced(spark, database, tmp_path):
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    (tmp_path / "a/part").write_text("x\n\ny\n"), (tmp_path / "b/part").write_text("z\n")
    for folder in ("a", "b"):
        tables.publish_raw_table(spark, f"{database}.core_contract", str(tmp_path / folder))
    assert rows(spark.table(f"{database}.core_contract")) == [("z",)]
    tables.set_table_tags(spark, f"{database}.core_contract", {"pii": "it's", "db": "core"})
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {database}.core_contract").collect()}
    assert found["pii"] == "it's" and found["db"] == "core"
    errors = tables.publish_raw_tables(spark, {f"{database}.one": str(tmp_path / "a"), "no_such_database.two": str(tmp_path / "a")})
    assert list(errors) == ["no_such_database.two"] and spark.table(f"{database}.one").count() == 3


def test_add_partition(spark, database, tmp_path):
    table = f"{database}.dated"
    tables.create_dated_table(spark, table, ["val"], str(tmp_path / "t"))
    lines(spark, ("a", "x")).select("val").write.orc(str(tmp_path / "elsewhere"))
    for _ in range(2):
        tables.add_partition(spark, table, "2021-01-01", str(tmp_path / "elsewhere"))
    assert rows(spark.table(table)) == [("a", "2021-01-01")]


def test_equality_append_and_keyed(spark, database):
    val = '{"message":{"type":"t","CLAIMANTID":"c","religion":null}}'
    source = spark.createDataFrame([(val,), ("{bad",)], "val string")
    flat = records.flatten_equality(source, F.lit("2021-07-02"))
    for _ in range(2):
        tables.append_equality(flat, f"{database}.plain")
        tables.replace_equality(flat, f"{database}.keyed", "2021-07-01")
    assert spark.table(f"{database}.plain").count() == 4
    assert spark.table(f"{database}.keyed").count() == 2
    tables.replace_equality(flat, f"{database}.keyed", "2021-07-02")
    assert spark.table(f"{database}.keyed").count() == 4
    first = spark.table(f"{database}.plain").where("type = 't'").first()
    assert (first["claimantid"], first["religion"], str(first["load_date"])) == ("c", None, "2021-07-02")


def test_run_parameters_round_trip(spark, tmp_path):
    run = spark.createDataFrame([("r,1", 'out/"x"', "full", "2021-07-02")],
                                "correlation_id string, s3_prefix string, snapshot_type string, export_date string")
    for _ in range(2):
        files.write_run_parameters(run, str(tmp_path / "p"))
    assert sources.read_run_parameters(spark, str(tmp_path / "p")).collect() == run.collect()


def test_latest_version_and_envelope(spark):
    body = {"traceId": "t", "message": {"db": "core", "collection": "x", "_id": {"declarationId": "1"}, "@type": "MONGO_INSERT",
                                        "_lastModifiedDateTime": "2020-03-09T11:05:09.250+0000"}}
    newer = json.loads(json.dumps(body))
    newer["message"]["_lastModifiedDateTime"] = "2020-03-09T12:05:09.250+0100"  # the same moment elsewhere, plus a later one
    latest = json.loads(json.dumps(body))
    latest["message"]["_lastModifiedDateTime"] = "2020-03-09T11:05:09.251+0000"
    frame = spark.createDataFrame([(json.dumps(b),) for b in (latest, body, newer)] + [("{bad",)], "val string")
    decoded = records.decode_envelope(frame)
    assert decoded.where("id IS NULL").count() == 1
    (row,) = records.latest_version(decoded.where("id IS NOT NULL"), ["id"], ["modified_at"]).collect()
    assert row["last_modified"] == "2020-03-09T11:05:09.251+0000" and row["message_type"] == "MONGO_INSERT"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_run_dir(spark, "x").startswith(shared_dir(spark))
