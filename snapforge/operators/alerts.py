"""Cluster state events to alert rules and alarms; the same functions serve batch and stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapforge.functions import codes

EVENT_SCHEMA = """
    source string, `detail-type` string, time string,
    detail struct<state string, name string, stateChangeReason string>
"""

# What a cluster event looks like and which one fires which rule.
EVENT_SOURCE, EVENT_TYPE = "aws.emr", "EMR Cluster State Change"
REASONS = {
    "terminated": '{"code":"USER_REQUEST","message":"User request"}',
    "success": '{"code":"ALL_STEPS_COMPLETED","message":"Steps completed"}',
    "success_with_errors": '{"code":"STEP_FAILURE","message":"Steps completed with errors"}',
}


def parse_events(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add ``source, detail_type, state, name, reason`` from JSON text."""
    parsed = lines.withColumn("_event", F.from_json(value, EVENT_SCHEMA))
    return parsed.select(
        *[c for c in lines.columns if c != value],
        F.col("_event.source").alias("source"),
        F.col("_event.detail-type").alias("detail_type"),
        F.col("_event.detail.state").alias("state"),
        F.col("_event.detail.name").alias("name"),
        F.col("_event.detail.stateChangeReason").alias("reason"),
    )


def matches(
    states: list[str], names: list[str], reasons: list[str] | None = None,
    sources: tuple[str, ...] = (EVENT_SOURCE,), types: tuple[str, ...] = (EVENT_TYPE,),
) -> Column:
    """An event pattern: every field that is given must hold one of its values."""
    rule = F.col("source").isin(*sources) & F.col("detail_type").isin(*types)
    rule = rule & F.col("state").isin(*states) & F.col("name").isin(*names)
    return rule if reasons is None else rule & F.col("reason").isin(*reasons)


def classify(events: DataFrame, clusters: Mapping[str, str]) -> DataFrame:
    """Add ``kind`` (of ``clusters``: kind -> cluster name) and ``rule``; events no rule fits are dropped."""
    names = list(clusters.values())
    rule = F.when(matches(["TERMINATED_WITH_ERRORS"], names), "failed").when(matches(["RUNNING"], names), "running")
    for outcome, reason in REASONS.items():
        rule = rule.when(matches(["TERMINATED"], names, [reason]), outcome)
    kinds = {name: kind for kind, name in clusters.items()}
    # Exploding none or one rule drops the other events; a filter would be pushed down with a copy of the parse
    # for every field it looks at.
    return events.withColumn("kind", codes.lookup(kinds, F.col("name"))).withColumn(
        "rule", F.explode(F.array_compact(F.array(rule)))
    )


def alarm_windows(events: DataFrame, ts: str = "ts", period: str = "60 seconds", threshold: int = 1) -> DataFrame:
    """Tumbling count per kind and rule; fires at the threshold, with the severity of the rule."""
    counted = events.groupBy(F.window(ts, period), "kind", "rule").agg(F.count("*").alias("n"))
    fired = counted.where(F.col("n") >= threshold)
    return fired.select(
        F.col("window.start").alias("window_start"),
        "kind",
        "rule",
        "n",
        codes.severity(F.col("rule")).alias("severity"),
        codes.notice_type(F.col("rule")).alias("notice_type"),
    )
