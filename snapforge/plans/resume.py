"""From followed steps to the ledger, and from the ledger to the steps that are still to be done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapforge.operators import state
from snapforge.sinks import tables


def record_steps(updates: DataFrame, ledger: str, data_product: str) -> None:
    """Append to the ledger table what a stream of steps gave: ``updates(correlation_id, step, ledger_status, at, late)``.

    A row sets ``current_step``, and ``status`` where a step ended the run; all other columns of the ledger are null,
    which keeps what was there. Columns of the same name as the ledger's go with it, late rows are left out.
    """
    rows = updates.where(~F.col("late")).withColumns({
        "data_product": F.lit(data_product), "status": F.col("ledger_status"), "current_step": F.col("step")})
    fields = updates.sparkSession.table(ledger).schema
    tables.append_state(rows.select(*(
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields)), ledger)


def remaining_steps(ledger: DataFrame, data_product: str, steps: DataFrame, at: list[str]) -> DataFrame:
    """Of ``steps(correlation_id, ordinal, step)`` those from the step on at which a run failed; all of other runs."""
    current = state.ledger_current(ledger.where(F.col("data_product") == data_product), at)
    failed = current.where(F.col("status") == state.RUN_FAILED)
    return state.steps_to_run(steps, failed.select("correlation_id", F.col("current_step").alias("step")))
