"""Alarms that go off and re-arm, from windows that the watermark has closed.

The windows are counted and closed by Spark's own aggregate in append mode, so what reaches the keyed state is one row a
window, kind and rule, however many events there are. An alarm goes off with the first window that fires and is OK again
with the first that does not; each change comes out once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from snapforge.session import settings
from snapforge.streaming.step_timers import PROVIDER

ALARM, OK = "ALARM", "OK"


class AlarmProcessor(StatefulProcessor):
    """One kind and rule. State is the last window that fired, while the alarm is on; a timer ends it."""

    def __init__(self, period_ms: int) -> None:
        self.period = period_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "window_ms long")

    def _known(self) -> int | None:
        return self.last.get()[0] if self.last.exists() else None

    def _frame(self, key: tuple, changes: list[tuple[int, str]]) -> Iterator[pd.DataFrame]:
        if changes:
            yield pd.DataFrame({"kind": key[0], "rule": key[1], "window_ms": [c[0] for c in changes], "state": [c[1] for c in changes]})

    def _settled(self, last: int | None, passed: int) -> list[tuple[int, str]]:
        """OK for the window after the last that fired, once the watermark has closed it; else a timer for then."""
        if last is not None and last + 2 * self.period <= passed:
            self.last.clear()
            return [(last + self.period, OK)]
        if last is not None:
            self.last.update((last,))
            self.handle.registerTimer(last + 2 * self.period)
        return []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, changes = self._known(), []
        for window in sorted({int(w) for frame in rows for w in frame["window_ms"]}):
            if last is not None and window > last + self.period:
                changes.append((last + self.period, OK))
            if last is None or window > last + self.period:
                changes.append((window, ALARM))
            last = window if last is None else max(last, window)
        yield from self._frame(key, changes + self._settled(last, timerValues.getCurrentWatermarkInMs()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self._known()
        if last is not None and last + 2 * self.period <= timerValues.getCurrentWatermarkInMs():
            yield from self._frame(key, self._settled(last, timerValues.getCurrentWatermarkInMs()))

    def close(self) -> None:
        pass


def alarm_changes(alarms: DataFrame, period_ms: int = 60_000) -> DataFrame:
    """``window_start, kind, rule, state`` of each change, from the stream of windows that fire."""
    marked = alarms.select("window_start", "kind", "rule", F.unix_millis("window_start").alias("window_ms"))
    changed = marked.groupBy("kind", "rule").transformWithStateInPandas(
        AlarmProcessor(period_ms), "kind string, rule string, window_ms long, state string", "Append", "EventTime")
    return changed.select(F.timestamp_millis("window_ms").alias("window_start"), "kind", "rule", "state")


def write_changes(alarms: DataFrame, location: str, checkpoint: str, period_ms: int = 60_000) -> StreamingQuery:
    """Write the changes as Parquet until the source is used up; what the watermark has not closed stays open."""
    with settings(alarms.sparkSession, {"spark.sql.streaming.stateStore.providerClass": PROVIDER}):
        return (alarm_changes(alarms, period_ms).writeStream.format("parquet").option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start(location))
