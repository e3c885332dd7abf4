"""Collection status, run ledger, metrics, logs, notices and alerts."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from snapforge.checks import inputs as i
from snapforge.functions import codes
from snapforge.operators import alerts, changes, notices, patterns, policy, state
from snapforge.session import new_run_dir
from snapforge.sources import logs
from snapforge.streaming import alarm_states, alarms, step_timers, steps

QUERIES: dict = {}
SQL: dict[str, str] = {}
AT = ["ts", "event_id"]


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return register


STATUS = "WITH " + i.STATUS_SQL


@query("latest_status", STATUS + "SELECT * FROM latest")
def latest_status(spark, sf):
    return state.latest_status(i.status_history(spark, sf), AT)


@query("failed_collections", STATUS + "SELECT * FROM latest WHERE starts_with(status, 'Failed')")
def failed_collections(spark, sf):
    return state.failed_collections(i.status_history(spark, sf), AT)


@query("rerun_set", STATUS + "," + i.CONFIG_SQL + """
    SELECT correlation_id, collection, status, db, tbl AS table_tag
    FROM latest JOIN config USING (collection) WHERE starts_with(status, 'Failed')""")
def rerun_set(spark, sf):
    again = state.rerun_set(i.config(spark, sf), state.failed_collections(i.status_history(spark, sf), AT))
    return again.select(
        "correlation_id", "collection", "status", F.col("tags")["db"].alias("db"), F.col("tags")["table"].alias("table_tag")
    )


@query("run_outcome", STATUS + """
    SELECT correlation_id, count(*) FILTER (WHERE starts_with(status, 'Failed')) AS n_failed,
           count(*) AS n_collections,
           CASE WHEN bool_or(starts_with(status, 'Failed')) THEN 'FAILED' ELSE 'COMPLETED' END AS run_status
    FROM latest GROUP BY correlation_id""")
def run_outcome(spark, sf):
    return state.run_outcome(state.latest_status(i.status_history(spark, sf), AT))


@query("failure_class", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'Failed_Processing'
                          WHEN event_type = 'click' THEN 'Failed_Publishing' ELSE 'Completed' END AS status
    FROM events""")
def failure_class(spark, sf):
    event = F.col("event_type")
    return i.table(spark, sf, "events").select(
        "event_id", state.outcome(F.when(event == "error", "inflate"), F.when(event == "click", "table")).alias("status")
    )


@query("elapsed_seconds", STATUS + """
    SELECT correlation_id, coalesce(collection, 'all_collections') AS collection,
           CAST(round_even((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 0) AS BIGINT) AS seconds
    FROM history GROUP BY GROUPING SETS ((correlation_id, collection), (correlation_id))""")
def elapsed_seconds(spark, sf):
    return state.elapsed(i.status_history(spark, sf))


@query("failure_notices", STATUS + """
    SELECT correlation_id, collection, status,
           '{"severity":"High","notification_type":"Error","slack_username":"snapshot-full",'
           || '"title_text":"Collection set to failure status","custom_elements":['
           || '{"key":"Collection Name","value":"' || collection || '"},'
           || '{"key":"Collection Status","value":"' || status || '"},'
           || '{"key":"Correlation Id","value":"' || correlation_id || '"},'
           || '{"key":"Snapshot Type","value":"full"}]}' AS payload
    FROM latest WHERE starts_with(status, 'Failed')""")
def failure_notices(spark, sf):
    return notices.failure_notices(state.latest_status(i.status_history(spark, sf), AT), "full")


LEDGER = "WITH " + i.LEDGER_SQL


@query("ledger_current", LEDGER + "SELECT * FROM current")
def ledger_current(spark, sf):
    return state.ledger_current(i.ledger(spark, sf), ["at", "seq"])


@query("output_prefix", LEDGER + """
    SELECT r.correlation_id, r.snapshot_type, r.data_product,
           coalesce(c.output_prefix, 'out/' || r.snapshot_type || '/2021-07-02_01-02-03') AS output_prefix,
           c.output_prefix IS NOT NULL AS existing
    FROM requests AS r LEFT JOIN current AS c USING (correlation_id, data_product)""")
def output_prefix(spark, sf):
    current = state.ledger_current(i.ledger(spark, sf), ["at", "seq"])
    return state.output_prefix(i.requests(spark, sf), current, "out", "2021-07-02_01-02-03")


RUN_COUNTER = LEDGER + """
    , counted AS (
        SELECT correlation_id, data_product, seq,
               row_number() OVER (PARTITION BY correlation_id, data_product ORDER BY stamp, seq) AS run_id FROM ledger)"""


def _counted(spark, sf):
    rows = i.ledger(spark, sf).withColumn("month", F.date_trunc("month", "at"))
    return state.run_counter(rows, ["at", "seq"], "month")


@query("run_counter", RUN_COUNTER + "SELECT correlation_id, data_product, seq, run_id FROM counted")
def run_counter(spark, sf):
    return _counted(spark, sf).select("correlation_id", "data_product", "seq", "run_id")


@query("next_run_id", RUN_COUNTER + """
    , highest AS (SELECT correlation_id, data_product, max(run_id) AS h FROM counted GROUP BY ALL)
    SELECT correlation_id, snapshot_type, data_product, coalesce(h, 0) + 1 AS run_id
    FROM requests LEFT JOIN highest USING (correlation_id, data_product)""")
def next_run_id(spark, sf):
    return state.next_run_id(i.requests(spark, sf), _counted(spark, sf))


@query("completion_notices", LEDGER + """
    SELECT r.correlation_id, '{"correlation_id":"' || r.correlation_id || '","s3_prefix":"' || c.output_prefix
           || '","snapshot_type":"full","export_date":"2021-07-02"}' AS payload
    FROM requests AS r JOIN current AS c USING (correlation_id, data_product)
    WHERE c.output_prefix IS NOT NULL AND r.snapshot_type = 'full'""")
def completion_notices(spark, sf):
    current = state.ledger_current(i.ledger(spark, sf), ["at", "seq"])
    runs = i.requests(spark, sf).join(current, ["correlation_id", "data_product"]).where("output_prefix IS NOT NULL")
    runs = runs.withColumnRenamed("output_prefix", "s3_prefix").withColumn("export_date", F.lit("2021-07-02"))
    return notices.completion_notices(runs)


@query("expired_ledger", """
    SELECT o_orderkey AS seq FROM orders
    WHERE epoch_ms(o_orderdate) + 604800000 < epoch_ms(TIMESTAMP '1997-06-01 00:00:00')""")
def expired_ledger(spark, sf):
    from snapforge.functions import dates

    stamped = i.ledger(spark, sf).withColumn("expires_at", dates.expires_at(F.col("at")))
    now = F.unix_millis(F.lit("1997-06-01 00:00:00").cast("timestamp"))
    return policy.expired_rows(stamped, now).select("seq")


@query("resume_steps", """
    WITH steps AS (
        SELECT l_orderkey, l_linenumber AS ordinal, 'step-' || l_linenumber AS step FROM lineitem),
    failed AS (
        SELECT o_orderkey AS l_orderkey, 'step-' || substr(o_orderpriority, 1, 1) AS failed_step
        FROM orders WHERE o_orderstatus = 'F'),
    placed AS (
        SELECT l_orderkey, min(CASE WHEN step = failed_step THEN ordinal END) AS from_ordinal
        FROM steps JOIN failed USING (l_orderkey) GROUP BY l_orderkey)
    SELECT 'o' || steps.l_orderkey AS correlation_id, ordinal, step
    FROM steps LEFT JOIN placed ON steps.l_orderkey = placed.l_orderkey
    WHERE placed.l_orderkey IS NULL OR ordinal >= from_ordinal""")
def resume_steps(spark, sf):
    planned = i.table(spark, sf, "lineitem").select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("correlation_id"),
        F.col("l_linenumber").alias("ordinal"),
        F.concat(F.lit("step-"), F.col("l_linenumber").cast("string")).alias("step"),
    )
    failed = i.table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("correlation_id"),
        F.concat(F.lit("step-"), F.substring("o_orderpriority", 1, 1)).alias("step"),
    )
    return state.steps_to_run(planned, failed)


@query("status_code", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 3 WHEN 'P' THEN 2 END AS code FROM orders""")
def status_code(spark, sf):
    status = F.col("o_orderstatus")
    named = F.when(status == "O", "RUNNING").when(status == "F", "Failed").otherwise("completed")
    return i.table(spark, sf, "orders").select("o_orderkey", codes.status_code(named).alias("code"))


CHANGES_SQL = "WITH " + i.OBSERVED_SQL + """
    SELECT correlation_id, step, state, event_id,
           CASE WHEN state IN ('FAILED', 'CANCELLED') THEN 'FAILED' WHEN final THEN 'COMPLETED' END AS ledger_status
    FROM compared
    WHERE final OR (step IS DISTINCT FROM before_step AND state IS DISTINCT FROM before_state)"""


@query("state_changes", CHANGES_SQL)
def state_changes(spark, sf):
    out = changes.state_changes(i.observations(spark, sf), AT, "hour", "purchase")
    return out.select("correlation_id", "step", "state", "event_id", "ledger_status")


@query("state_changes_stream", CHANGES_SQL)
def state_changes_stream(spark, sf):
    base = new_run_dir(spark, "steps")
    observed = i.observed(_event_stream(spark, sf)).withColumn("step", changes.step_name(F.col("step")))
    follow = steps.follow_steps(
        observed, AT, "hour", "purchase", f"{base}/updates", f"{base}/memory", f"{base}/checkpoint"
    )
    follow.awaitTermination()
    return spark.read.parquet(f"{base}/updates").select("correlation_id", "step", "state", "event_id", "ledger_status")


def _closing(spark, sf, stream, base: str):
    """The stream with one more row far behind the others, which closes what is still waiting."""
    newest = i.table(spark, sf, "events").agg(F.max("ts").alias("ts"))
    closing = newest.select(*(F.expr("ts + interval 30 days").alias("ts") if f.name == "ts" else
                              F.lit("closing" if f.name == "correlation_id" else None).cast(f.dataType).alias(f.name)
                              for f in stream.schema))
    closing.coalesce(1).write.parquet(f"{base}/closing")
    return stream.unionByName(spark.readStream.schema(closing.schema).parquet(f"{base}/closing"))


def timed_updates(spark, sf):
    """What keyed state with timers gives for all observations."""
    base = new_run_dir(spark, "timed")
    observed = i.observed(_event_stream(spark, sf)).withColumn("step", changes.step_name(F.col("step")))
    step_timers.follow_steps_in_order(
        _closing(spark, sf, observed, base), AT, "purchase", "1 hour", f"{base}/updates", f"{base}/checkpoint",
        keep_ms=10**12).awaitTermination()
    return spark.read.parquet(f"{base}/updates")


@query("state_changes_timed", CHANGES_SQL)
def state_changes_timed(spark, sf):
    """The same through keyed state with timers."""
    return timed_updates(spark, sf).where("not late").select("correlation_id", "step", "state", "event_id", "ledger_status")


@query("latest_metrics", """
    SELECT event_type AS metric, 'db.user.c' || user_id AS collection,
           arg_max(CAST(json_extract(props, '$.k') AS BIGINT), (ts, event_id)) AS value
    FROM events GROUP BY ALL""")
def latest_metrics(spark, sf):
    written = i.table(spark, sf, "events").select(
        F.col("event_type").alias("metric"),
        F.concat(F.lit("db.user.c"), F.col("user_id").cast("string")).alias("collection"),
        F.get_json_object("props", "$.k").cast("long").alias("value"),
        "ts",
        "event_id",
    )
    return state.latest_metrics(written, AT)


LOG = "WITH " + i.LOG_SQL


@query("log_messages", LOG + "SELECT * FROM messages")
def log_messages(spark, sf):
    return logs.parse_log_lines(i.log_lines(spark, sf))


@query("processing_times", LOG + """
    SELECT regexp_extract(message, 'time taken for (\\S+) : (\\d+)', 1) AS collection,
           CAST(regexp_extract(message, ' : (\\d+)$', 1) AS BIGINT) AS time_taken
    FROM messages WHERE starts_with(message, 'time taken')""")
def processing_times(spark, sf):
    return logs.processing_times(logs.parse_log_lines(i.log_lines(spark, sf)))


@query("run_times", LOG + """
    SELECT logged_at, CAST(regexp_extract(message, 'collections: (\\d+)', 1) AS BIGINT) AS time_taken
    FROM messages WHERE starts_with(message, 'Time for')""")
def run_times(spark, sf):
    return logs.run_times(logs.parse_log_lines(i.log_lines(spark, sf)))


ALERT = "WITH " + i.ALERT_SQL


@query("alert_class", ALERT + """
    SELECT event_id, kind, rule, CASE WHEN rule IN ('terminated', 'success_with_errors') THEN 'High'
           ELSE 'Critical' END AS severity FROM classified""")
def alert_class(spark, sf):
    events = alerts.parse_events(i.cluster_events(i.table(spark, sf, "events")))
    return alerts.classify(events, i.CLUSTERS).select(
        "event_id", "kind", "rule", codes.severity(F.col("rule")).alias("severity")
    )


def _rule_patterns() -> dict[str, str]:
    """The rules of both clusters as JSON patterns."""
    wanted = {"failed": ("TERMINATED_WITH_ERRORS", None), "running": ("RUNNING", None)}
    wanted.update({outcome: ("TERMINATED", reason) for outcome, reason in alerts.REASONS.items()})
    rules = {}
    for kind, cluster in i.CLUSTERS.items():
        for outcome, (cluster_state, reason) in wanted.items():
            detail = {"state": [cluster_state], "name": [cluster]} | ({"stateChangeReason": [reason]} if reason else {})
            rules[f"{kind}_{outcome}"] = json.dumps(
                {"source": [alerts.EVENT_SOURCE], "detail-type": [alerts.EVENT_TYPE], "detail": detail})
    return rules


@query("fired_rules", ALERT + "SELECT event_id, kind || '_' || rule AS rule FROM classified")
def fired_rules(spark, sf):
    events = i.cluster_events(i.table(spark, sf, "events"))
    return patterns.fired_rules(events, _rule_patterns()).select("event_id", "rule")


def _readable(fired):
    return fired.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query("alarm_windows", ALERT + "SELECT * FROM windows")
def alarm_windows(spark, sf):
    events = alerts.parse_events(i.cluster_events(i.table(spark, sf, "events")))
    return _readable(alerts.alarm_windows(alerts.classify(events, i.CLUSTERS)))


def _event_stream(spark, sf):
    schema = i.table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


@query("alarm_windows_stream", ALERT + "SELECT * FROM windows")
def alarm_windows_stream(spark, sf):
    base = new_run_dir(spark, "alarms")
    fired = alarms.alarm_stream(i.cluster_events(_event_stream(spark, sf)), i.CLUSTERS)
    alarms.write_alarms(fired, f"{base}/out", f"{base}/checkpoint", "complete").awaitTermination()
    return _readable(spark.read.parquet(f"{base}/out"))


@query("alarm_changes_stream", ALERT + """
    , fired AS (SELECT CAST(window_start AS TIMESTAMP) AS w, kind, rule FROM windows)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, kind, rule, 'ALARM' AS state
    FROM fired WHERE (w - INTERVAL 60 SECOND, kind, rule) NOT IN (SELECT (w, kind, rule) FROM fired)
    UNION ALL
    SELECT strftime(w + INTERVAL 60 SECOND, '%Y-%m-%d %H:%M:%S'), kind, rule, 'OK'
    FROM fired WHERE (w + INTERVAL 60 SECOND, kind, rule) NOT IN (SELECT (w, kind, rule) FROM fired)""")
def alarm_changes_stream(spark, sf):
    """Windows in append mode, and the alarms that go off and re-arm with them."""
    base = new_run_dir(spark, "alarm-changes")
    events = i.cluster_events(_event_stream(spark, sf))
    fired = alarms.alarm_stream(_closing(spark, sf, events, base), i.CLUSTERS)
    alarm_states.write_changes(fired, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return _readable(spark.read.parquet(f"{base}/out"))
