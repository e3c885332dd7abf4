"""Ledger updates from step observations that arrive in any order, by keyed state and event-time timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BooleanType, IntegralType, StringType, StructField, StructType

from snapforge.operators import state
from snapforge.session import settings

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LAST = "step string, state string, end_ms long"


class StepProcessor(StatefulProcessor):
    """One run: observations wait until the watermark has passed them, then are compared in their order.

    A timer stands at the earliest waiting observation. When it fires, all that the watermark has passed are taken, so
    the outcome does not depend on how the stream was cut. An observation behind the watermark is given out as late. What
    comes up to ``keep_ms`` after the end of a run is ignored; then a second timer forgets the run, and its name is free
    for another.
    """

    def __init__(
        self, columns: StructType, order: list[str], numbers: set[str], final_step: str, keep_ms: int
    ) -> None:
        self.columns, self.order, self.numbers, self.final_step, self.keep_ms = columns, order, numbers, final_step, keep_ms
        self.at = order[0]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.columns)
        self.last = handle.getValueState("last", LAST)

    def _row(self, values: tuple, status: str | None, late: bool) -> tuple:
        return (*values, status, late)

    def _frame(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            names = [*self.columns.names, "ledger_status", "late"]
            yield pd.DataFrame({n: pd.Series(v, dtype=object) for n, v in zip(names, zip(*rows, strict=True), strict=True)})

    def _ms(self, values: tuple) -> int:
        return pd.Timestamp(values[self.columns.names.index(self.at)]).value // 1_000_000

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed, late, fresh = timerValues.getCurrentWatermarkInMs(), [], []
        for frame in rows:
            for values in frame[self.columns.names].astype(object).itertuples(index=False, name=None):
                values = tuple(None if v is None or v is pd.NaT else v for v in values)
                if self._ms(values) <= passed:
                    late.append(self._row(values, None, True))
                else:
                    fresh.append(self._stored(values))
        end = self._known()[2]
        fresh = [v for v in fresh if end is None or self._ms(v) > end + self.keep_ms]
        if fresh:
            self.waiting.appendList(fresh)  # one message to the store for all, not one for each
            self.handle.registerTimer(min(map(self._ms, fresh)))
        yield from self._frame(late)

    def _stored(self, values: tuple) -> tuple:
        return tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v.item() if hasattr(v, "item") else v for v in values)

    def _known(self) -> tuple:
        """Step and state of the last observation, and when the run ended."""
        return tuple(self.last.get()) if self.last.exists() else (None, None, None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        held = [tuple(values) for values in self.waiting.get()] if self.waiting.exists() else []
        due = sorted((v for v in held if self._ms(v) <= passed), key=self._place)
        rest = [v for v in held if self._ms(v) > passed]
        step, observed, end = self._known()
        out = []
        for values in due:
            now = dict(zip(self.columns.names, values, strict=True))
            if end is not None and self._ms(values) > end + self.keep_ms:
                step = observed = end = None
            if end is not None:
                continue
            failed = now["state"] in (state.RUN_FAILED, state.RUN_CANCELLED)
            done = now["step"] == self.final_step and now["state"] == state.RUN_COMPLETED
            if failed or done or (now["step"] != step and now["state"] != observed):
                status = state.RUN_FAILED if failed else state.RUN_COMPLETED if done else None
                out.append(self._row(values, status, False))
            step, observed, end = now["step"], now["state"], self._ms(values) if failed or done else None
        if end is not None:
            rest = [v for v in rest if self._ms(v) > end + self.keep_ms]
        self.waiting.clear()
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(min(map(self._ms, rest)))
        if end is not None and passed >= end + self.keep_ms:
            self.last.clear()
        elif due:
            self.last.update((step, observed, end))
            if end is not None:
                self.handle.registerTimer(end + self.keep_ms)
        yield from self._frame(out)

    def _place(self, values: tuple) -> tuple:
        """Nulls first, as in the batch operator."""
        now = dict(zip(self.columns.names, values, strict=True))
        given = [int(now[c]) if c in self.numbers and now[c] is not None else now[c] for c in self.order]
        return tuple((value is not None, value) for value in given)

    def close(self) -> None:
        pass


def follow_steps_in_order(
    observations: DataFrame, order: list[str], final_step: str, delay: str, updates: str, checkpoint: str,
    keep_ms: int = 86_400_000,
) -> StreamingQuery:
    """Write to ``updates`` the rows that the batch operator would give, once the watermark has passed them.

    ``order`` begins with the event time; ``delay`` is how far behind the newest observation another one may be. Rows have
    the columns of the observations, ``ledger_status`` and ``late``: true for rows behind the watermark or without a
    time, which change nothing. The folder is a file sink, so a repeated batch does not double its rows.
    """
    spark, given = observations.sparkSession, observations.schema
    # whole numbers travel as text: beside nulls they would become floats in a pandas frame
    numbers = {f.name for f in given if isinstance(f.dataType, IntegralType)}
    columns = StructType([StructField(f.name, StringType() if f.name in numbers else f.dataType) for f in given])
    output = StructType([*columns, StructField("ledger_status", StringType()), StructField("late", BooleanType())])
    # the copy is what the processor sees: rows behind the watermark of the other one would be dropped without a word
    marked = observations.withColumn("_at", F.col(order[0]).cast("timestamp")).withWatermark("_at", delay).select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in columns))
    out = marked.groupBy("correlation_id").transformWithStateInPandas(
        StepProcessor(columns, order, numbers, final_step, keep_ms), output, "Append", "EventTime")
    out = out.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in given), "ledger_status", "late")
    # keyed state with timers needs this store; a query keeps the setting it began with
    with settings(spark, {"spark.sql.streaming.stateStore.providerClass": PROVIDER}):
        return out.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(updates)
