from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from snapforge.checks import inputs
from snapforge.operators import alerts, changes
from snapforge.streaming import alarms, ingest, steps

T0 = datetime(2024, 1, 1)
OBSERVED = "correlation_id string, step string, state string, ts timestamp_ntz, seq int, hour timestamp_ntz"


def observations(seed: int, rows: int, runs: int):
    rng = random.Random(seed)
    out, at = [], T0
    for seq in range(rows):
        at += timedelta(minutes=rng.randrange(0, 25))
        state = rng.choices(["PENDING", "RUNNING", "COMPLETED", "FAILED"], [5, 5, 5, 0.2])[0]
        run, step = f"run-{rng.randrange(runs)}", rng.choice(["a", "b", "c", "last"])
        out.append((run, step, state, at, seq, at.replace(minute=0)))
    return out


def expected(rows):
    """The rule, row by row."""
    before, ended, out = {}, set(), []
    for run, step, state, ts, seq, _ in rows:
        if run in ended:
            continue
        final = state in ("FAILED", "CANCELLED") or (step == "last" and state == "COMPLETED")
        last = before.get(run, (None, None))
        if final or (step != last[0] and state != last[1]):
            out.append((run, seq, None if not final else "FAILED" if state != "COMPLETED" else "COMPLETED"))
        before[run] = (step, state)
        if final:
            ended.add(run)
    return sorted(out)


def found(frame):
    return sorted((r["correlation_id"], r["seq"], r["ledger_status"]) for r in frame.collect())


def test_step_changes_batch(spark):
    rows = observations(1, 600, 12)
    frame = spark.createDataFrame(rows, OBSERVED)
    assert found(changes.state_changes(frame, ["ts", "seq"], "hour", "last")) == expected(rows)


def test_step_changes_stream_in_batches(spark, tmp_path):
    """The stream over several batches gives what one batch over everything gives."""
    rows = observations(2, 400, 10)
    source = str(tmp_path / "observations")
    stream = None
    for start in range(0, 400, 100):
        spark.createDataFrame(rows[start:start + 100], OBSERVED).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(OBSERVED).parquet(source)
        steps.follow_steps(
            stream, ["ts", "seq"], "hour", "last", str(tmp_path / "updates"), str(tmp_path / "memory"), str(tmp_path / "check")
        ).awaitTermination()
    assert found(spark.read.parquet(str(tmp_path / "updates"))) == expected(rows)
    assert spark.read.parquet(str(tmp_path / "updates_late")).count() == 0


def test_late_observations_are_kept(spark, tmp_path):
    def row(run, step, minute):
        at = T0 + timedelta(minutes=minute)
        return (run, step, "RUNNING" if step == "a" else "COMPLETED", at, minute, at.replace(minute=0))

    batches = [[row("x", "a", 1), row("x", "b", 9), row("y", "last", 5)],
               [row("x", "c", 3), row("x", "b", 9), row("x", "a", 10), row("y", "a", 2), row("y", "a", 7), row("z", "a", 1)]]
    source = str(tmp_path / "observations")
    for rows in batches:
        spark.createDataFrame(rows, OBSERVED).coalesce(1).write.mode("append").parquet(source)
        steps.follow_steps(
            spark.readStream.schema(OBSERVED).parquet(source), ["ts", "seq"], "hour", "last", str(tmp_path / "updates"),
            str(tmp_path / "memory"), str(tmp_path / "check"),
        ).awaitTermination()
    late = spark.read.parquet(str(tmp_path / "updates_late")).collect()
    assert sorted((r["correlation_id"], r["seq"]) for r in late) == [("x", 3), ("x", 9), ("y", 2)]
    updates = found(spark.read.parquet(str(tmp_path / "updates")))
    assert [u[:2] for u in updates] == [("x", 1), ("x", 9), ("x", 10), ("y", 5), ("z", 1)]


def cluster_rows(spark):
    rng = random.Random(3)
    rows = [
        (k, T0 + timedelta(seconds=rng.randrange(3600)), rng.randrange(20), rng.choice(["view", "error", "click", "signup", "purchase"]),
         rng.random() * 60)
        for k in range(500)
    ]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")


def test_alarm_stream_equals_batch(spark, tmp_path):
    source = str(tmp_path / "events")
    inputs.cluster_events(cluster_rows(spark)).write.parquet(source)
    schema = "event_id long, ts timestamp_ntz, value string"
    batch = alerts.alarm_windows(alerts.classify(alerts.parse_events(spark.read.parquet(source)), inputs.CLUSTERS))
    want = sorted(tuple(r) for r in batch.withColumn("window_start", F.col("window_start").cast("string")).collect())

    def run(mode: str):
        stream = alarms.alarm_stream(spark.readStream.schema(schema).parquet(source), inputs.CLUSTERS, "1 minute")
        alarms.write_alarms(stream, str(tmp_path / mode), str(tmp_path / f"check-{mode}"), mode).awaitTermination()
        out = spark.read.parquet(str(tmp_path / mode))
        return sorted(tuple(r) for r in out.withColumn("window_start", F.col("window_start").cast("string")).collect())

    assert run("complete") == want
    closed = run("append")
    newest = max(row[0] for row in want)
    assert set(closed) < set(want) and all(row in closed for row in want if row[0] < newest[:14] + "50")


def test_alert_severity(spark):
    one = inputs.cluster_events(cluster_rows(spark))
    got = {r["rule"]: (r["severity"], r["notice_type"]) for r in
           alerts.alarm_windows(alerts.classify(alerts.parse_events(one), inputs.CLUSTERS)).collect()}
    assert got == {
        "failed": ("Critical", "Error"), "terminated": ("High", "Information"), "success": ("Critical", "Information"),
        "success_with_errors": ("High", "Warning"), "running": ("Critical", "Information"),
    }


def test_threshold_and_malformed_events(spark):
    lines = spark.createDataFrame([(1, T0, "{bad"), (2, T0, "{}")], "event_id long, ts timestamp_ntz, value string")
    assert alerts.classify(alerts.parse_events(lines), inputs.CLUSTERS).count() == 0
    events = alerts.classify(alerts.parse_events(inputs.cluster_events(cluster_rows(spark))), inputs.CLUSTERS)
    assert {r["n"] for r in alerts.alarm_windows(events, threshold=3).collect()} <= set(range(3, 100))


def test_new_files_are_ingested_once(spark, exports, tmp_path):
    made = exports().write({"db.core.contract.01.gz.enc": "a\nb\n", "db.other.thing.01.gz.enc": "no"})
    known = spark.createDataFrame([("db.core.contract", {})], "collection string, tags map<string,string>")

    def go():
        ingest.ingest_files(
            spark, str(made.root), known, lambda: made.manifest, lambda: made.key_table,
            str(tmp_path / "out"), str(tmp_path / "check"),
        ).awaitTermination()
        rows = spark.read.text(str(tmp_path / "out")).where("kind = 'lines'").collect()
        return sorted((r["value"], r["batch_id"]) for r in rows)

    assert go() == [("a", 0), ("b", 0)]
    made.write({"db.core.contract.02.gz.enc": "c", "db.core.contract.03.gz.enc": "d", "odd": "e"}, corrupt=("db.core.contract.03.gz.enc",))
    assert go() == [("a", 0), ("b", 0), ("c", 1)]
    assert go() == [("a", 0), ("b", 0), ("c", 1)]
    became = spark.read.parquet(str(tmp_path / "out_files")).collect()
    assert sorted((r["path"].rsplit("/", 1)[1], r["status"], r["batch_id"]) for r in became) == [
        ("db.core.contract.01.gz.enc", "Completed", 0), ("db.core.contract.02.gz.enc", "Completed", 1),
        ("db.core.contract.03.gz.enc", "Failed_Processing", 1), ("db.other.thing.01.gz.enc", "Unlisted", 0), ("odd", "Rejected", 1),
    ]


def test_a_batch_takes_few_jobs_and_leaves_few_files(spark, exports, tmp_path):
    """Some twenty jobs a batch and a file of each decoding task and collection made many batches of small files slow."""
    names = [f"db.core.c{chr(97 + k % 5)}.{k:02d}.gz.enc" for k in range(30)]
    made = exports().write({name: f"{name}\n" for name in names} | {"db.other.thing.01.gz.enc": "no"}, corrupt=(names[7],))
    known = spark.createDataFrame([(f"db.core.c{letter}", {}) for letter in "abcde"], "collection string, tags map<string,string>")
    manifest, keys = made.manifest, made.key_table
    stream = ingest.ingest_files(
        spark, str(made.root), known, lambda: manifest, lambda: keys, str(tmp_path / "out"), str(tmp_path / "check"), 10)
    stream.awaitTermination()
    became = spark.read.parquet(str(tmp_path / "out_files")).groupBy("batch_id", "status").count().collect()
    batches = {r["batch_id"] for r in became}
    assert len(batches) == 4
    assert {s: sum(r["count"] for r in became if r["status"] == s) for s in ("Completed", "Failed_Processing", "Unlisted")} == {
        "Completed": 29, "Failed_Processing": 1, "Unlisted": 1}
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "out" / "kind=lines")).collect()) == sorted(set(names) - {names[7]})
    for folder in (tmp_path / "out" / "kind=lines").glob("collection=*/batch_id=*"):
        assert len(list(folder.glob("part-*"))) == 1
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(stream.runId))) <= 16 * len(batches)


def test_a_batch_asks_a_new_manifest_and_new_keys_again(spark, exports, tmp_path):
    """A frame that is given again is read once; frames that are new for each batch are not taken for the last ones."""
    made = exports().write({f"db.core.contract.{k:02d}.gz.enc": f"{k}" for k in range(3)})
    known = spark.createDataFrame([("db.core.contract", {})], "collection string, tags map<string,string>")
    path, empty = spark.createDataFrame(made.entries[:0], made.manifest.schema), spark.createDataFrame([], made.key_table.schema)
    manifests, keys = iter([path, made.manifest, made.manifest]), iter([made.key_table, empty, made.key_table])
    ingest.ingest_files(
        spark, str(made.root), known, lambda: next(manifests), lambda: next(keys), str(tmp_path / "out"), str(tmp_path / "check"), 1
    ).awaitTermination()
    became = spark.read.parquet(str(tmp_path / "out_files")).orderBy("batch_id").collect()
    assert [(r["status"], r["error"]) for r in became] == [
        ("Failed_Processing", "no metadata or data key"), ("Failed_Processing", "no metadata or data key"), ("Completed", None)]


def test_a_repeated_batch_replaces_its_output(spark, exports, tmp_path):
    made = exports().write({"db.core.contract.01.gz.enc": "a", "db.core.contract.02.gz.enc": "b"})
    known = spark.createDataFrame([("db.core.contract", {})], "collection string, tags map<string,string>")
    for _ in range(2):  # a checkpoint of its own each time: the batch comes again
        ingest.ingest_files(
            spark, str(made.root), known, lambda: made.manifest, lambda: made.key_table,
            str(tmp_path / "out"), str(tmp_path / f"check-{_}"),
        ).awaitTermination()
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "out" / "kind=lines")).collect()) == ["a", "b"]
    assert spark.read.parquet(str(tmp_path / "out_files")).count() == 2
