"""Figures of a training log: (epoch, step, loss) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.operators.ordered import running, with_cells


def running_mean(log: DataFrame, every: int, by: str = "epoch", step: str = "step", value: str = "loss") -> DataFrame:
    """The mean loss of the epoch so far, at every `every`-th step."""
    cells = with_cells(log, [F.col(step), F.col(by)])
    totals = {"_sum": ("sum", F.col(value)), "_n": ("sum", F.lit(1).cast("long"))}
    upto = running(cells, [F.col(step)], totals, [by])
    return (
        upto.where(F.col(step) % every == 0)
        .withColumn("avg_loss", F.col("_sum") / F.col("_n"))
        .drop("_sum", "_n")
    )


def epoch_means(batches: DataFrame, by: str = "epoch", value: str = "loss") -> DataFrame:
    """The mean of batch losses; a partial last batch counts as much as any."""
    return batches.groupBy(by).agg(F.avg(value).alias("epoch_loss"), F.count(F.lit(1)).alias("num_batches"))


def batch_means(rows: DataFrame, by: list[str], value: str = "loss") -> DataFrame:
    return rows.groupBy(*by).agg(F.avg(value).alias(value))


def best_so_far(epochs: DataFrame, epoch: str = "epoch", value: str = "epoch_loss") -> DataFrame:
    """Mark the epochs whose loss is strictly below every earlier one."""
    cells = with_cells(epochs, [F.col(epoch)])
    before = running(cells, [F.col(epoch)], {"best_before": ("min", F.col(value))}, exclusive=True)
    is_best = F.col("best_before").isNull() | (F.col(value) < F.col("best_before"))
    return before.withColumn("is_best", is_best)


def every_n_steps(events: DataFrame, n: int, step: str = "step", skip_zero: bool = True) -> DataFrame:
    """One row per step that is due, however often the step was reported."""
    due = events.where(F.col(step) % n == 0)
    if skip_zero:
        due = due.where(F.col(step) > 0)
    return due.select(step).distinct()


def checkpoint_marks(counts: DataFrame, batch: int, every: int, n: str = "n_rows") -> DataFrame:
    """Row counts at which a checkpoint fires: whole batches that reach `every` new rows, then the end."""
    stride = -(-every // batch) * batch
    marks = F.sequence(F.lit(1), F.greatest(F.floor(F.col(n) / stride), F.lit(1)))
    hit = counts.withColumn("mark_no", F.explode(marks)).withColumn("at_rows", F.col("mark_no") * stride)
    hit = hit.where(F.col("at_rows") <= F.col(n)).withColumn("is_final", F.lit(False))
    # A partial last batch that reaches the bound fires too; then the rest is written once more.
    base = F.floor(F.col(n) / stride)
    tail = F.col(n) - base * stride >= every
    last = counts.withColumn("mark_no", base + F.when(tail, 2).otherwise(1))
    last = last.withColumn("at_rows", F.col(n)).withColumn("is_final", F.lit(True))
    extra = counts.where(tail).withColumn("mark_no", base + 1).withColumn("at_rows", F.col(n))
    return hit.unionByName(extra.withColumn("is_final", F.lit(False))).unionByName(last)
