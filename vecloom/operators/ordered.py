"""Ranks, first-N and running totals over an order that spans a whole table.

A window over one key puts all rows of that key into one task. Here the table is dealt out by ranges of the
order itself, whatever the types of its columns, so a cell (a range) holds a bounded share of the table whichever
key the rows belong to. The dealt table is written once; cells are counted with map-side aggregation, what came
before each cell is added up over the (few) cells, and the rest happens inside (key, cell).

An order is a list of ascending columns that tell all rows of a group apart; nulls come first and NaN last, as
Spark sorts. For a falling order of numbers give their negative.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecloom.sources.staging import stage, with_group_figures

CELL = "_cell"
# monotonically_increasing_id holds the partition above this many bits, and the place in it below.
PLACE_BITS = 33

FOLDS = {"sum": F.sum, "min": F.min, "max": F.max}


def _cells(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_cells(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The table, written out, with the cell number of each row; it never falls along the order."""
    return stage(df.repartitionByRange(_cells(df), *order).withColumn(CELL, F.spark_partition_id()), "cells")


def running(
    df: DataFrame,
    order: Sequence[Column],
    totals: dict[str, tuple[str, Column]],
    by: Sequence[str] = (),
    exclusive: bool = False,
) -> DataFrame:
    """Running sum, min or max over `order` (a total order) in each `by` group.

    `df` carries cells that follow the order, and is read twice. What came before a cell enters the
    cell's window as one extra row, so the rows shuffle once and need no join.
    """
    part = [*by, CELL]
    per_cell = df.groupBy(*part).agg(*[FOLDS[f](c).alias(n) for n, (f, c) in totals.items()])
    earlier = Window.partitionBy(*by).orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_cell.select(
        *part, *[FOLDS[f](n).over(earlier).alias(n) for n, (f, _) in totals.items()], F.lit(0).alias("_row")
    )
    rows = df.withColumns({n: c for n, (_, c) in totals.items()} | {"_row": F.lit(1)})
    last = -1 if exclusive else Window.currentRow
    upto = Window.partitionBy(*part).orderBy("_row", *order).rowsBetween(Window.unboundedPreceding, last)
    return (
        rows.unionByName(carry, allowMissingColumns=True)
        .withColumns({n: FOLDS[f](n).over(upto) for n, (f, _) in totals.items()})
        .where("_row = 1")
        .drop("_row", CELL)
    )


def numbered(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), name: str = "rn") -> DataFrame:
    """Row numbers from 1 along the order, per group.

    The rows shuffle once: each is numbered in its sorted range, and a small table tells where the
    numbers of a group begin in each range.
    """
    dealt = df.repartitionByRange(_cells(df), *order).sortWithinPartitions(*by, *order)
    rows = stage(dealt.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    cell, place = F.shiftright("_at", PLACE_BITS), F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    starts = rows.groupBy(*by, cell.alias("_of")).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1
    starts = starts.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], "_of", offset.alias("_offset"))
    same = cell == F.col("_of")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    return rows.join(starts, same).select(*df.columns, (place + F.col("_offset")).alias(name))


def first_n(
    df: DataFrame, order: Sequence[Column], by: str | None, limits: DataFrame | int, name: str = "rn"
) -> DataFrame:
    """The first rows of each group, or of the table without `by`, numbered from 1.

    `limits` is one number, or a configuration table (by, row_limit). The keys alone are numbered first, which
    gives the exact last key of each group; only rows up to it move on with all their columns.
    `available` is what the group could offer, up to its limit.
    """
    keys = [by] if by else []
    at = [f"_o{i}" for i in range(len(order))]
    narrow = df.select(*keys, *[c.alias(n) for c, n in zip(order, at)])
    narrow = numbered(narrow, [F.col(n) for n in at], keys, "_rn")
    if isinstance(limits, int):
        narrow = narrow.withColumn("row_limit", F.lit(limits).cast("long"))
    else:
        narrow = narrow.join(limits, by)
    need = narrow.where("_rn <= row_limit").groupBy(*keys, "row_limit")
    need = stage(need.agg(F.max(F.struct(*at)).alias("_last"), F.count(F.lit(1)).alias("available")), "limits")
    # Nothing past the furthest key is needed; the bound can reach the scan.
    furthest = need.agg(F.max("_last")).first()[0]
    lead = order[0]
    rows = df.where(lead.isNull() | (lead <= F.lit(furthest[0]))) if furthest and furthest[0] is not None else df
    rows = rows.withColumn("_key", F.struct(*[c.alias(n) for c, n in zip(order, at)]))
    kept = with_group_figures(rows, need, by).where(F.col("_key") <= F.col("_last")).drop("_key", "_last")
    return numbered(kept, order, keys, name).where(F.col(name) <= F.col("row_limit"))
