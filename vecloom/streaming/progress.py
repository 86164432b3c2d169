"""Training logs as streams: the running mean and the steps that are due, with state that outlives a restart."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def running_mean(log: DataFrame, every: int) -> DataFrame:
    """(run, step, avg_loss) of a stream (run, step, loss): the mean of the run so far, at every `every`-th step.

    The state of a run is a count and a sum, however long it is. Steps of a run arrive in order from batch to batch; inside a
    batch they are put in order. A batch that runs again starts from the state of the batch before it.
    """

    def go_on(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        rows = pd.concat(frames).sort_values("step", ignore_index=True)
        counts, sums = n + 1 + rows.index, total + rows["loss"].cumsum()
        state.update((int(counts[-1]), float(sums.iloc[-1])))
        due = rows["step"] % every == 0
        yield pd.DataFrame({"run": key[0], "step": rows["step"], "avg_loss": sums / counts})[due]

    return log.groupBy("run").applyInPandasWithState(
        go_on, "run string, step long, avg_loss double", "n long, total double", "append", GroupStateTimeout.NoTimeout
    )


def every_n_steps(events: DataFrame, n: int) -> DataFrame:
    """(step) of a stream: one row per step that is due, in whichever batches and however often it is reported."""
    return events.select("step").where((F.col("step") % n == 0) & (F.col("step") > 0)).dropDuplicates(["step"])
