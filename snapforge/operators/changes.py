"""Step observations to ledger updates (batch form)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapforge.operators import history, state


def is_final(step: Column, observed: Column, final_step: str) -> Column:
    """A failed or cancelled step ends a run, and so does the completion of the last step."""
    ended = observed.isin(state.RUN_FAILED, state.RUN_CANCELLED)
    return ended | ((step == final_step) & (observed == state.RUN_COMPLETED))


def ledger_status(step: Column, observed: Column, final_step: str) -> Column:
    """What the ledger gets: nothing for a step under way."""
    return (
        F.when(observed.isin(state.RUN_FAILED, state.RUN_CANCELLED), state.RUN_FAILED)
        .when((step == final_step) & (observed == state.RUN_COMPLETED), state.RUN_COMPLETED)
    )


def step_name(script: Column) -> Column:
    """``/opt/steps/send_report.py`` -> ``send_report``."""
    return F.substring_index(F.substring_index(script, "/", -1), ".", 1)


def state_changes(observations: DataFrame, order: list[str], bucket: str, final_step: str) -> DataFrame:
    """Rows the ledger is written for: step and state both differ from the row before, or the run ends.

    ``observations(correlation_id, step, state, ...)``. Rows after the first final one of a run are ignored.
    """
    columns = observations.columns
    final = is_final(F.col("step"), F.col("state"), final_step)
    ends = observations.where(final).groupBy("correlation_id").agg(F.min(F.struct(*order)).alias("_end"))
    running = (
        observations.join(ends, "correlation_id", "left")
        .where(F.col("_end").isNull() | (F.struct(*order) <= F.col("_end")))
        .select(*columns)
    )
    compared = history.with_previous(running, ["correlation_id"], order, ["step", "state"], bucket)
    changed = ~F.col("previous.step").eqNullSafe(F.col("step")) & ~F.col("previous.state").eqNullSafe(F.col("state"))
    return compared.where(changed | final).select(
        *columns, ledger_status(F.col("step"), F.col("state"), final_step).alias("ledger_status")
    )
