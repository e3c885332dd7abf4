"""Keyed state with timers: the outcome is that of the batch rule, however the stream was cut."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest

from snapforge.streaming.step_timers import follow_steps_in_order
from tests.test_streaming import OBSERVED, T0, expected, observations


def followed(spark, tmp_path, batches, **settings):
    """One file a batch, the last one with an observation far behind all others."""
    last = max(row[3] for rows in batches for row in rows) + timedelta(days=30)
    source = str(tmp_path / "observations")
    for rows in [*batches, [("none", "a", "PENDING", last, None, None)]]:
        spark.createDataFrame(rows, OBSERVED).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(OBSERVED).option("maxFilesPerTrigger", 1).parquet(source)
    follow_steps_in_order(stream, ["ts", "seq"], "last", "3 hours", str(tmp_path / "updates"), str(tmp_path / "check"),
                          **settings).awaitTermination()
    return spark.read.parquet(str(tmp_path / "updates"))


def shuffled_inside(rows, hours: float, seed: int):
    """Rows moved by less than the delay of the watermark."""
    rng = random.Random(seed)
    return sorted(rows, key=lambda r: r[3] + timedelta(hours=rng.uniform(0, hours)))


@pytest.mark.parametrize("cuts", [1, 3, 20])
def test_any_cut_gives_the_batch_result(spark, tmp_path, cuts):
    rows = observations(2, 240, 10)
    moved = shuffled_inside(rows, 2.9, cuts)
    size = -(-len(moved) // cuts)
    out = followed(spark, tmp_path, [moved[k:k + size] for k in range(0, len(moved), size)],
                   keep_ms=10**11).collect()
    assert not any(r["late"] for r in out)
    assert sorted((r["correlation_id"], r["seq"], r["ledger_status"]) for r in out) == expected(rows)


def test_a_stopped_query_goes_on_from_its_checkpoint(spark, tmp_path):
    rows, source = observations(5, 90, 4), str(tmp_path / "observations")
    last = rows[-1][3] + timedelta(days=30)
    for part in (rows[:40], rows[40:], [("none", "a", "PENDING", last, 0, last)]):
        spark.createDataFrame(part, OBSERVED).coalesce(1).write.mode("append").parquet(source)
        follow_steps_in_order(
            spark.readStream.schema(OBSERVED).parquet(source), ["ts", "seq"], "last", "3 hours", str(tmp_path / "updates"),
            str(tmp_path / "check"), keep_ms=10**11).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "updates")).collect()
    assert sorted((r["correlation_id"], r["seq"], r["ledger_status"]) for r in out) == expected(rows)


def test_names_used_again_do_not_depend_on_the_cut(spark, tmp_path):
    rows = observations(3, 120, 3)
    outcomes = []
    for number, size in enumerate((120, 31)):
        folder = tmp_path / str(number)
        out = followed(spark, folder, [rows[k:k + size] for k in range(0, 120, size)], keep_ms=3_600_000)
        outcomes.append(sorted((r["correlation_id"], r["seq"], r["ledger_status"]) for r in out.collect()))
    assert outcomes[0] == outcomes[1] != expected(rows)


def test_late_rows_are_given_out_and_ended_runs_forgotten(spark, tmp_path):
    def row(run, step, hour, seq, observed="RUNNING"):
        return (run, step, observed, T0 + timedelta(hours=hour), seq, T0)

    batches = [[row("x", "a", 1, 1), row("y", "a", 1, 2, "FAILED"), row("z", "a", 20, 3)],
               [row("x", "b", 2, 4, "COMPLETED"), row("x", "b", 30, 5, "COMPLETED"), row("y", "b", 21, 6)],
               [row("z", "b", 80, 7, "COMPLETED")], [row("y", "b", 90, 8)]]
    out = followed(spark, tmp_path, batches, keep_ms=3_600_000 * 24).collect()
    assert [r["seq"] for r in out if r["late"]] == [4]
    # y failed at hour 1: hour 21 is ignored, by hour 80 it has been forgotten, so hour 90 is a new run of that name
    assert sorted((r["correlation_id"], r["seq"], r["ledger_status"]) for r in out if not r["late"]) == [
        ("x", 1, None), ("x", 5, None), ("y", 2, "FAILED"), ("y", 8, None), ("z", 3, None), ("z", 7, None)]
