"""Merging increments into buckets, alarms that re-arm, what a write counts of itself."""

from __future__ import annotations

import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from snapforge.operators.records import latest_version
from snapforge.plans import merge
from snapforge.sinks import files
from snapforge.streaming.alarm_states import AlarmProcessor

RECORDS = "id long, part string, value string, version long"


@pytest.fixture
def database(spark, tmp_path):
    name = "merge_" + tmp_path.name.replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_merge_is_the_latest_version_of_the_union(spark, database):
    pick = random.Random(3)
    full = [(k, "a", f"v{k}", 5) for k in range(200)] + [(None, "a", "nobody", 1)]
    increments = [[(pick.randrange(300), pick.choice("ab"), f"w{n}-{k}", 1 + 10 * k + n) for k in range(80)] for n in (1, 2)]
    table, key, version = f"{database}.records", ["id", "part"], ["version"]
    merge.create_full(spark.createDataFrame(full, RECORDS), table, key, 8)
    for rows in increments:
        merge.merge_increment(spark.createDataFrame(rows, RECORDS), table, key, version)
    union = spark.createDataFrame(full + increments[0] + increments[1], RECORDS)
    want = latest_version(union, key, version).select("id", "part", "value", "version")
    assert sorted(map(tuple, spark.table(table).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    merge.merge_increment(spark.createDataFrame([], RECORDS), table, key, version)
    assert spark.table(table).count() == want.count()
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()] == ["records"]


def test_merge_does_not_shuffle_the_full_table(spark, database):
    table = f"{database}.records"
    merge.create_full(spark.range(1000).select("id", F.lit("a").alias("part"), F.lit("v").alias("value"), F.lit(1).cast("long").alias("version")),
                      table, ["id", "part"], 8)
    increment = spark.createDataFrame([(1, "a", "w", 2)], RECORDS)
    plan = merge.merged(spark.table(table), increment, ["id", "part"], ["version"])._jdf.queryExecution().executedPlan().toString()
    full_side = plan[plan.index("SortMergeJoin"):].split("Exchange")[0]
    assert "FileScan parquet" in full_side and "Bucketed: true" in full_side


def test_merge_of_equal_versions_takes_the_increment(spark, database):
    table = f"{database}.records"
    merge.create_full(spark.createDataFrame([(1, "a", "old", 2), (2, "a", "old", 9)], RECORDS), table, ["id", "part"], 2)
    merge.merge_increment(spark.createDataFrame([(1, "a", "new", 2), (2, "a", "stale", 3)], RECORDS), table, ["id", "part"], ["version"])
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, "a", "new", 2), (2, "a", "old", 9)]


class Handle:
    """State and timers of one key, in memory."""

    def __init__(self) -> None:
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):
        def update(value):
            self.value = value

        return SimpleNamespace(exists=lambda: self.value is not None, get=lambda: self.value, update=update, clear=lambda: update(None))

    def registerTimer(self, at):
        self.timers.add(at)


def changes(windows: list[int], cuts: list[int], period: int) -> list[tuple[int, str]]:
    """What the processor gives when the watermark moves to each cut in turn."""
    handle, processor, out, before = Handle(), AlarmProcessor(period), [], -1
    processor.init(handle)
    for cut in cuts:
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda cut=cut: cut)
        due = [w for w in windows if before < w + period <= cut]
        frames = [pd.DataFrame({"window_ms": due[k:k + 2]}) for k in range(0, len(due), 2)]
        given = list(processor.handleInputRows(("full", "failed"), iter(frames), now)) if due else []
        for timer in sorted(t for t in handle.timers if t <= cut):
            handle.timers.discard(timer)
            given += list(processor.handleExpiredTimer(("full", "failed"), now, None))
        out += [(int(r.window_ms), r.state) for frame in given for r in frame.itertuples()]
        before = cut
    assert handle.value is None and not handle.timers
    return out


@pytest.mark.parametrize("seed", range(20))
def test_alarm_changes_do_not_depend_on_the_cut(seed):
    pick, period = random.Random(seed), 60
    windows = sorted(pick.sample(range(0, 3000, period), 25))
    pick.shuffle(shuffled := list(windows))
    fired = set(windows)
    want = sorted([(w, "ALARM") for w in fired if w - period not in fired] + [(w + period, "OK") for w in fired if w + period not in fired])
    for cuts in ([10_000], sorted(pick.sample(range(10, 3200), 12)) + [10_000], list(range(0, 3300, 7)) + [10_000]):
        got = changes(shuffled, cuts, period)
        assert got == sorted(got) and got == want


def test_a_write_counts_itself(spark, tmp_path):
    rows = [("c1", "p", "ab", None), ("c1", "p", "", None), ("c2", "q", None, "broken"), ("c2", "r", "größe", None)]
    decoded = spark.createDataFrame(rows, "collection string, path string, val string, error string")
    for few in (False, True):
        assert files.write_decoded(decoded, f"{tmp_path}/{few}", ["collection"], few) == {"lines": 3, "characters": 7, "errors": 1}
    assert files.write_decoded(decoded.limit(0), f"{tmp_path}/none", ["collection"]) == {"lines": 0, "characters": 0, "errors": 0}
