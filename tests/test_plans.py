"""End-to-end runs on real encrypted files."""

from __future__ import annotations

import gzip
import itertools
import json
import random
import uuid
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snapforge.plans.backfill import Backfill, backfill_audit, backfill_equality
from snapforge.plans.snapshot import Audit, Run, RunFailed, continued, run_snapshot
from snapforge.sources import tables as sources

DATE = "2021-07-02"
CONTRACT = '{"ref":"k-17"}\n{"ref":"k-18"}\n'
CONTRACT_LINES = ['{"ref":"k-17"}', '{"ref":"k-18"}']
AUDIT_LINES = ['{"actor":"Ada","action":"open","visits in 30 days":"4"}', '{"actor":"Bo","action":"close"}']
AUDIT_FIELDS = {"actor": "actor", "action": "action", "visits_30": "visits in 30 days"}
EQUALITY_ROWS = [("CLAIM", "c-1", "e-2", "s-3", "o-4", "r-5", "m-6"), ("CLAIM", "c-7", "e-8", "s-9", "o-10", "r-11", "m-12")]
EQUALITY_KEYS = ("type", "claimantId", "ethnicGroup", "ethnicitySubgroup", "sexualOrientation", "religion", "maritalStatus")
EQUALITY_LINES = [json.dumps({"message": dict(zip(EQUALITY_KEYS, row))}) for row in EQUALITY_ROWS]
TAGS = {"pii": "false", "db": "ledger", "table": "claims"}


def config(spark, *collections: str):
    return spark.createDataFrame([(c, TAGS) for c in collections], "collection string, tags map<string,string>")


@pytest.fixture
def make_run(spark, tmp_path):
    tick = itertools.count()
    name = uuid.uuid4().hex[:8]

    def make(made, **changes) -> Run:
        audit = Audit(
            f"audit_{name}", AUDIT_FIELDS,
            {"sec": (f"audit_{name}.auditlog_sec_v", ["visits_30"], str(tmp_path / "sec")),
             "red": (f"audit_{name}.auditlog_red_v", ["action"], str(tmp_path / "red"))},
        )
        given = dict(
            correlation_id="run-1", snapshot_type="full", export_date=DATE, run_stamp="2021-07-02_01-02-03",
            input_root=str(made.root), output_root=str(tmp_path / "out"), database=f"pub_{name}",
            state_database=f"state_{name}", audit=audit, equality_table=f"equality_{name}.equality_managed",
            clock=lambda: datetime(2021, 7, 2) + timedelta(seconds=next(tick)),
        )
        return Run(**{**given, **changes})

    return make


def values(spark, table: str) -> list[str]:
    return sorted(row["val"] for row in spark.table(table).collect())


def table_rows(spark, table: str) -> list[tuple]:
    return sorted((tuple(row) for row in spark.table(table).collect()), key=str)


def test_full_run(spark, exports, make_run):
    made = exports().write(
        {
            "db.core.contract.01.gz.enc": CONTRACT,
            "db.core.contract.02.gz.enc": "\n" + CONTRACT.rstrip("\n"),
            "old/db.core.accounts.01.gz.enc": "stale",
            "other/db.core.accounts.01.gz.enc": '{"a":1}',
            "db.core.unknown.01.gz.enc": "x",
            "no-collection": "x",
        }
    )
    run = make_run(made)
    latest = run_snapshot(spark, run, config(spark, "db.core.contract", "db.core.accounts", "db.fake.empty"), made.manifest, made.key_table)
    assert {r["collection"]: r["status"] for r in latest.collect()} == {
        "db.core.contract": "Completed", "db.core.accounts": "Completed"
    }
    assert values(spark, f"{run.database}.core_contract") == sorted(["", *CONTRACT_LINES * 2])
    assert values(spark, f"{run.database}.core_accounts") == ['{"a":1}']
    assert sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {run.database}").collect()) == ["core_accounts", "core_contract"]

    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {run.database}.core_contract").collect()}
    assert {**TAGS, "snapshot_type": "full"}.items() <= properties.items()

    store = run.state_database
    history = spark.table(f"{store}.collection_status").orderBy("seq").where("collection = 'db.core.contract'").collect()
    assert [r["status"] for r in history] == ["Processing", "Publishing", "Completed"]
    tags = {(r["key"], r["value"]) for r in spark.table(f"{store}.object_tags").where("path LIKE '%db.core.contract%'").collect()}
    assert tags == {*TAGS.items(), ("snapshot_type", "full")}
    metrics = {(r["metric"], r["collection"]): r["value"] for r in spark.table(f"{store}.metrics").collect()}
    size = sum(p.stat().st_size for p in Path(made.root).rglob("db.core.contract*"))
    assert metrics["input_bytes", "db.core.contract"] == size
    everything = sum(p.stat().st_size for p in Path(made.root).rglob("*") if p.is_file())
    assert metrics["input_bytes", "all_collections"] == everything > metrics["input_bytes", "db.core.accounts"] + size
    assert metrics["seconds", "db.core.contract"] > 0 and ("output_bytes", "all_collections") in metrics
    parameters = sources.read_run_parameters(spark, f"{run.output_root}/full/run_parameters").first().asDict()
    assert parameters == {"correlation_id": "run-1", "s3_prefix": run.prefix, "snapshot_type": "full", "export_date": DATE}
    assert spark.table(f"{store}.run_ledger").orderBy(F.desc("at")).first()["status"] == "COMPLETED"
    (notice,) = spark.table(f"{store}.notices").collect()
    assert (notice["collection"], notice["status"]) == ("all_collections", "COMPLETED")
    assert json.loads(notice["payload"]) == parameters


def test_incremental_run(spark, exports, make_run):
    made = exports().write({"db.core.contract.01.gz.enc": CONTRACT, "db.core.nothing.01.gz.enc": ""})
    run = make_run(made, snapshot_type="incremental")
    latest = run_snapshot(
        spark, run, config(spark, "db.core.contract", "db.core.nothing", "db.fake.empty"), made.manifest, made.key_table
    )
    assert {r["collection"]: r["status"] for r in latest.collect()} == {
        "db.core.contract": "Completed", "db.core.nothing": "Completed", "db.fake.empty": "Empty"
    }
    assert values(spark, f"{run.database}_incremental.core_contract") == CONTRACT_LINES
    assert values(spark, f"{run.database}_incremental.core_nothing") == []
    empty = Path(run.prefix) / "fake/empty/empty.txt"
    assert empty.exists() and empty.stat().st_size == 0
    assert not spark.catalog.tableExists(f"{run.database}_incremental.fake_empty")


def test_failed_collection_and_rerun(spark, exports, make_run):
    made = exports()
    made.write({"db.core.contract.01.gz.enc": CONTRACT, "db.core.accounts.01.gz.enc": "good", "db.core.accounts.02.gz.enc": "bad"},
               corrupt=("db.core.accounts.02.gz.enc",))
    run = make_run(made)
    both = config(spark, "db.core.contract", "db.core.accounts")
    with pytest.raises(RunFailed, match="db.core.accounts: Failed_Processing"):
        run_snapshot(spark, run, both, made.manifest, made.key_table)
    assert values(spark, f"{run.database}.core_contract") == CONTRACT_LINES
    assert not spark.catalog.tableExists(f"{run.database}.core_accounts")
    assert not Path(run.output_root, "full/run_parameters").exists()
    notice = spark.table(f"{run.state_database}.notices").collect()
    assert [(n["collection"], n["status"]) for n in notice] == [("db.core.accounts", "Failed_Processing")]
    assert spark.table(f"{run.state_database}.run_ledger").orderBy(F.desc("at")).first()["status"] == "FAILED"

    tagged = spark.table(f"{run.state_database}.object_tags").count()
    before = {p: p.stat().st_mtime_ns for p in Path(run.prefix).rglob("*contract*/part-*")}
    repaired = exports().write({"db.core.contract.01.gz.enc": "not read again", "db.core.accounts.01.gz.enc": "good", "db.core.accounts.02.gz.enc": "repaired"})
    again = continued(spark, make_run(repaired, run_stamp="another"))
    assert again.existing_prefix == run.prefix
    assert continued(spark, make_run(repaired, correlation_id="run-2")).existing_prefix is None
    latest = run_snapshot(spark, again, both, repaired.manifest, repaired.key_table)
    assert [(r["collection"], r["status"]) for r in latest.collect()] == [("db.core.accounts", "Completed")]
    assert values(spark, f"{run.database}.core_accounts") == ["good", "repaired"]
    tags = spark.table(f"{run.state_database}.object_tags")
    assert tags.count() > tagged and tags.where("key = 'collection_tag'").count() == 0
    ledger = spark.table(f"{run.state_database}.run_ledger").orderBy("at").collect()
    assert [(r["run_id"], r["status"]) for r in ledger] == [
        (1, "IN_PROGRESS"), (1, "FAILED"), (2, "IN_PROGRESS"), (2, "COMPLETED")]
    assert before == {p: p.stat().st_mtime_ns for p in Path(run.prefix).rglob("*contract*/part-*")}


def test_file_without_metadata_fails_its_collection_only(spark, exports, make_run):
    made = exports().write({"db.core.contract.01.gz.enc": CONTRACT, "db.core.accounts.01.gz.enc": "x"})
    manifest = made.manifest.where("path NOT LIKE '%accounts%'")
    run = make_run(made)
    with pytest.raises(RunFailed, match="db.core.accounts"):
        run_snapshot(spark, run, config(spark, "db.core.contract", "db.core.accounts"), manifest, made.key_table)
    assert spark.table(f"{run.database}.core_contract").count() == 2


def test_table_name_collision_is_reported(spark, exports, make_run):
    made = exports().write({"db.core-a.contract.1.gz": "x", "db.core_a.contract.1.gz": "y", "db.core.accounts.1.gz": "z"})
    run = make_run(made)
    with pytest.raises(RunFailed, match="db.core-a.contract: Failed_Publishing, db.core_a.contract: Failed_Publishing"):
        run_snapshot(spark, run, config(spark, "db.core-a.contract", "db.core_a.contract", "db.core.accounts"), made.manifest, made.key_table)
    assert values(spark, f"{run.database}.core_accounts") == ["z"]


def test_audit_twice(spark, exports, make_run):
    made = exports().write({"db.data.businessAudit.01.gz.enc": "\n".join(AUDIT_LINES) + "\n"})
    run = make_run(made)
    for _ in range(2):
        run_snapshot(spark, run, config(spark, "db.data.businessAudit"), made.manifest, made.key_table)
    audit = run.audit
    assert table_rows(spark, audit.raw) == [(line, DATE) for line in sorted(AUDIT_LINES)]
    assert table_rows(spark, audit.typed) == [("Ada", "open", "4", DATE), ("Bo", "close", None, DATE)]
    assert table_rows(spark, audit.projections["sec"][0]) == [("4", DATE), (None, DATE)]
    assert table_rows(spark, audit.projections["red"][0]) == [("close", DATE), ("open", DATE)]

    next_day = exports(folder="next").write({"db.data.businessAudit.02.gz.enc": "{bad\n\n" + AUDIT_LINES[0]})
    later = make_run(next_day, export_date="2021-07-03")
    run_snapshot(spark, later, config(spark, "db.data.businessAudit"), next_day.manifest, next_day.key_table)
    counts = {r["date_str"]: r["count"] for r in spark.table(audit.typed).groupBy("date_str").count().collect()}
    assert counts == {DATE: 2, "2021-07-03": 3}
    assert spark.table(audit.projections["sec"][0]).where("date_str = '2021-07-03'").count() == 3
    location = Path(run.data_root, "kind=lines/collection=db.data.businessAudit", f"export_date={DATE}")
    assert len(list(location.glob("part-*"))) == 1


def test_equality_appends_with_the_date_of_the_run(spark, exports, make_run):
    made = exports().write({"db.data.equality.01.gz.enc": "\n".join(EQUALITY_LINES)})
    run = make_run(made, clock=lambda: datetime(2022, 2, 3))
    for _ in range(2):
        run_snapshot(spark, run, config(spark, "db.data.equality"), made.manifest, made.key_table)
    rows = sorted(tuple(str(v) for v in r) for r in spark.table(run.equality_table).collect())
    assert rows == sorted([(*row, "2022-02-03") for row in EQUALITY_ROWS] * 2)


def test_a_failed_collection_leaves_nothing_behind(spark, exports, make_run):
    made = exports().write({"db.core.contract.1.gz": CONTRACT, "db.core.accounts.1.gz": "good", "db.core.accounts.2.gz": "bad",
                            "db.data.businessAudit.1.gz": AUDIT_LINES[0], "db.data.businessAudit.2.gz": "x"},
                           corrupt=("db.core.accounts.2.gz", "db.data.businessAudit.2.gz"))
    run = make_run(made)
    with pytest.raises(RunFailed, match="accounts.*businessAudit"):
        run_snapshot(spark, run, config(spark, "db.core.contract", "db.core.accounts", "db.data.businessAudit"),
                     made.manifest, made.key_table)
    left = {p.parent.name for root in (run.prefix, run.data_root) for p in Path(root).rglob("part-*")}
    assert left == {"collection=db.core.contract"}
    store = run.state_database
    assert spark.table(f"{store}.object_tags").where("path NOT LIKE '%db.core.contract%'").count() == 0
    sized = {r["collection"] for r in spark.table(f"{store}.metrics").where("metric = 'output_bytes'").collect()}
    assert sized == {"db.core.contract", "all_collections"}
    failures = spark.read.json(f"{run.output_root}/failures/full/{run.run_stamp}")
    assert {Path(r["path"]).name for r in failures.collect()} == {"db.core.accounts.2.gz", "db.data.businessAudit.2.gz"}


def test_a_stopped_run_is_continued(spark, exports, make_run, monkeypatch):
    made = exports().write({"db.core.contract.1.gz": CONTRACT, "db.data.equality.1.gz": "\n".join(EQUALITY_LINES)})
    run, both = make_run(made), config(spark, "db.core.contract", "db.data.equality")

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr("snapforge.plans.snapshot.tables.publish_raw_tables", stop)
        with pytest.raises(KeyboardInterrupt):
            run_snapshot(spark, run, both, made.manifest, made.key_table)
    open_row = spark.table(f"{run.state_database}.run_ledger").first()
    assert (open_row["run_id"], open_row["status"], open_row["current_step"], open_row["output_prefix"]) == (
        1, "IN_PROGRESS", "snapshot", run.prefix)
    again = continued(spark, make_run(made, run_stamp="another"))
    assert again.prefix == run.prefix
    latest = run_snapshot(spark, again, both, made.manifest, made.key_table)
    assert [(r["collection"], r["status"]) for r in latest.collect()] == [("db.core.contract", "Completed")]
    assert values(spark, f"{run.database}.core_contract") == CONTRACT_LINES
    assert spark.table(run.equality_table).count() == len(EQUALITY_ROWS)


def test_entries_that_contradict_each_other_fail_their_collection(spark, exports, make_run):
    made = exports().write({"db.core.contract.1.gz": CONTRACT, "db.core.accounts.1.gz": "x"})
    other = made.manifest.where("path LIKE '%accounts%'").selectExpr("path", "'AAAA' AS iv", "ciphertext", "key_id")
    manifest = made.manifest.unionByName(made.manifest).unionByName(other)
    with pytest.raises(RunFailed, match="^db.core.accounts: Failed_Processing$"):
        run_snapshot(spark, make_run(made), config(spark, "db.core.contract", "db.core.accounts"), manifest, made.key_table)


def test_a_file_too_large_for_a_scan_fails_its_collection_only(spark, exports, make_run, monkeypatch):
    monkeypatch.setattr("snapforge.plans.snapshot.MAX_FILE_BYTES", 200)
    noise = "".join(random.Random(3).choices("abcdefghijklmnop", k=2000))
    made = exports().write({"db.core.contract.1.gz": CONTRACT, "db.core.accounts.1.gz": noise})
    run = make_run(made)
    with pytest.raises(RunFailed, match="^db.core.accounts: Failed_Processing$"):
        run_snapshot(spark, run, config(spark, "db.core.contract", "db.core.accounts"), made.manifest, made.key_table)
    assert values(spark, f"{run.database}.core_contract") == CONTRACT_LINES


def test_audit_backfill(spark, exports, tmp_path):
    made = exports("eax", "zlib").write(
        {
            "2021-07-01/auditlog.1.json.gz.enc": AUDIT_LINES[0],
            "2021-07-02/auditlog.1.json.gz.enc": AUDIT_LINES[1] + '\n{bad\n',
            "2021-07-02/auditlog.2.json.gz.enc": '{"actor":"Cy"}',
            "2021-07-05/auditlog.1.json.gz.enc": "outside",
        }
    )
    name = uuid.uuid4().hex[:8]
    audit = Audit(f"backfill_{name}", AUDIT_FIELDS)
    job = Backfill("run-1", "2021-07-01", "2021-07-03", str(made.root), str(tmp_path / "out"), "db.data.businessAudit", DATE,
                   f"state_{name}")
    for _ in range(2):
        done = backfill_audit(spark, job, audit, made.manifest, made.key_table)
    assert {r["day"]: r["status"] for r in done.collect()} == {
        "2021-07-01": "Completed", "2021-07-02": "Completed", "2021-07-03": "Empty"
    }
    rows = sorted((tuple(r) for r in spark.table(audit.typed).collect()), key=str)
    assert rows == sorted(
        [("Ada", "open", "4", "2021-07-01"), ("Bo", "close", None, "2021-07-02"), (None, None, None, "2021-07-02"),
         ("Cy", None, None, "2021-07-02")], key=str)
    assert spark.table(audit.raw).count() == 4
    tags = spark.table(f"state_{name}.object_tags").where("path LIKE '%export_date=2021-07-01%'").select("key", "value").distinct()
    assert {r["key"]: r["value"] for r in tags.collect()} == {"pii": "true", "db": "data", "table": "businessAudit"}
    assert spark.table(f"state_{name}.day_status").count() == 6


def test_backfill_with_a_bad_day_and_a_reversed_range(spark, exports, tmp_path):
    made = exports("eax", "zlib")
    made.write({"2021-07-01/a.gz.enc": AUDIT_LINES[0], "2021-07-02/a.gz.enc": "x"}, corrupt=("2021-07-02/a.gz.enc",))
    audit = Audit(f"backfill_{uuid.uuid4().hex[:8]}", AUDIT_FIELDS)
    job = Backfill("run-1", "2021-07-01", "2021-07-02", str(made.root), str(tmp_path / "out"), "db.data.businessAudit", DATE)
    with pytest.raises(RunFailed, match="2021-07-02"):
        backfill_audit(spark, job, audit, made.manifest, made.key_table)
    assert [r["date_str"] for r in spark.table(audit.typed).collect()] == ["2021-07-01"]
    reverse = Backfill("run-1", "2021-07-02", "2021-07-01", str(made.root), str(tmp_path / "out"), "db.data.businessAudit", DATE)
    assert backfill_audit(spark, reverse, audit, made.manifest, made.key_table).count() == 0


def test_equality_backfill(spark, exports, tmp_path):
    made = exports("eax", "zlib").write({"2021-07-02/equality.1.json.gz.enc": EQUALITY_LINES[0] + "\n"})
    table = f"equality_{uuid.uuid4().hex[:8]}.equality_managed"
    job = Backfill("run-1", DATE, DATE, str(made.root), str(tmp_path / "out"), "db.data.equality", "2021-08-01")
    backfill_equality(spark, job, table, str(tmp_path / "equality"), made.manifest, made.key_table)
    assert [str(r["load_date"]) for r in spark.table(table).collect()] == ["2021-08-01"]
    assert spark.table(table).select("ethnicGroup").first()[0] == "e-2"
    written = next(Path(job.output_root).rglob("part-*.gz"))
    assert gzip.decompress(written.read_bytes()).decode() == EQUALITY_LINES[0] + "\n"


@pytest.mark.parametrize("few_files", [False, True])
def test_many_jobs_give_the_same_tables(spark, exports, make_run, monkeypatch, few_files):
    monkeypatch.setattr("snapforge.plans.snapshot.FILES_PER_JOB", 1)
    made = exports().write({"db.core.contract.1.gz": "a", "db.core.contract.2.gz": "b", "db.core.contractual.{1,[2*.gz": "c"})
    run = make_run(made, few_files=few_files)
    run_snapshot(spark, run, config(spark, "db.core.contract", "db.core.contractual"), made.manifest, made.key_table)
    assert values(spark, f"{run.database}.core_contract") == ["a", "b"]
    assert values(spark, f"{run.database}.core_contractual") == ["c"]


@pytest.mark.parametrize("change", [{"snapshot_type": "partial"}, {"correlation_id": ""}, {"export_date": "2021/07/02"}])
def test_run_is_validated(exports, make_run, change):
    with pytest.raises(ValueError):
        make_run(exports(), **change)
