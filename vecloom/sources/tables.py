"""Reading tables and picking splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.sources.staging import stage, with_group_figures

# Order in which splits are tried.
CURATION_SPLITS = ("train", "test")
RETRIEVAL_SPLITS = ("test", "validation", "train")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_split(df: DataFrame, split: str) -> DataFrame:
    return df.where(F.col("split") == split)


def first_present_split(df: DataFrame, order: Sequence[str], by: str | None = None) -> DataFrame:
    """Rows of the best split that is present, per data set if `by` is given."""
    rank = F.lit(len(order))
    for place, split in reversed(list(enumerate(order))):
        rank = F.when(F.col("split") == split, place).otherwise(rank)
    usable = df.where(F.col("split").isin(*order))
    if by is None:
        best = usable.agg(F.min(rank)).first()[0]
        return usable.where(F.col("split") == (order[best] if best is not None else None))
    best = stage(usable.groupBy(by).agg(F.min(rank).alias("_best")), "best-splits")
    return with_group_figures(usable, best, by).where(rank == F.col("_best")).drop("_best")


def with_test_split(df: DataFrame, by: str) -> DataFrame:
    """All splits, and the validation rows once more as `test` where a data set has no test split."""
    has_test = stage(df.groupBy(by).agg(F.max(F.col("split") == "test").alias("_has_test")), "test-splits")
    names = F.when(
        (F.col("split") == "validation") & ~F.col("_has_test"), F.array(F.lit("validation"), F.lit("test"))
    ).otherwise(F.array("split"))
    return with_group_figures(df, has_test, by).withColumn("split", F.explode(names)).drop("_has_test")


def probe_schema(df: DataFrame, name: str, required: Sequence[str]) -> DataFrame:
    """One row per required or present column: is it there, and how many values it has if required.

    A missing column is reported, not raised.
    """
    columns = list(dict.fromkeys([*required, *df.columns]))
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[
            (F.count(c) if c in df.columns and c in required else F.lit(None).cast("long")).alias(f"v_{c}")
            for c in columns
        ],
    )
    entries = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit(c in df.columns).alias("present"),
            F.lit(c in required).alias("required"),
            F.col("_n").alias("n_rows"),
            F.col(f"v_{c}").alias("n_values"),
        )
        for c in columns
    ]
    return counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
