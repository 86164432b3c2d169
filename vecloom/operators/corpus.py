"""Balanced corpora: per-language quotas, scaled down where a language is short."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.operators.ordered import first_n

# Fixed values: (train, validation, test) rows per language.
LARGE_QUOTA = (100_000, 30_000, 10_000)
STANDARD_QUOTA = (10_000, 3_000, 1_000)
LARGE_LANGUAGES = ("en", "tr")
STANDARD_LANGUAGES = (
    "ceb", "nl", "it", "pl", "arz", "de", "ja", "zh", "ar", "vi", "war", "es", "pt", "fa", "fr", "ca",
    "id", "ko", "ce", "no", "fi", "cs", "hu", "tt", "ro", "eu", "sh", "ms", "eo", "he", "ru", "hy",
    "uz", "da", "bg", "cy", "simple", "el",
)
DEFAULT_QUOTAS = [(lang, *LARGE_QUOTA) for lang in LARGE_LANGUAGES] + [
    (lang, *STANDARD_QUOTA) for lang in STANDARD_LANGUAGES
]


def quota_table(spark: SparkSession, quotas: Sequence[tuple[str, int, int, int]]) -> DataFrame:
    return spark.createDataFrame(list(quotas), "lang string, train_n long, val_n long, test_n long")


def corpus_rows(df: DataFrame, columns: Sequence[str] = ("lang", "title", "text", "url")) -> DataFrame:
    """Missing values, and missing columns, become empty strings."""
    filled = [
        (F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("")).alias(c) for c in columns
    ]
    return df.select(*[c for c in df.columns if c not in columns], *filled)


def bounded_scan(df: DataFrame, key: str, n: int, by: str = "lang", groups: Sequence[str] = ()) -> DataFrame:
    """The first n rows of each listed group in source order, numbered in `rn`."""
    limits = df.sparkSession.createDataFrame([(g, n) for g in groups], f"{by} string, row_limit long")
    rows = first_n(df, [F.col(key)], by, F.broadcast(limits))
    return rows.drop("row_limit", "available")


def quota_rows(
    df: DataFrame, key: str, quotas: Sequence[tuple[str, int, int, int]], failed: DataFrame | None = None, on_error: str = "keep"
) -> DataFrame:
    """The first rows of each language up to its quota, with the split sizes it gets.

    `failed` is the record (lang, n_read) of sources that broke off. With on_error="keep" the n_read rows before
    the error count and no later ones, whatever another reading added; with "drop" the language is left out; a language
    without rows is left out either way.
    """
    table = quota_table(df.sparkSession, quotas)
    wanted = F.col("train_n") + F.col("val_n") + F.col("test_n")
    limits = table.select("lang", wanted.alias("row_limit"))
    if failed is not None:
        record = failed.groupBy("lang").agg(F.min("n_read").alias("n_read"))
        if on_error == "drop":
            table = table.join(record, "lang", "left_anti")
            limits = limits.join(record, "lang", "left_anti")
        else:
            limits = limits.join(record, "lang", "left").select("lang", F.least("row_limit", "n_read").alias("row_limit"))
    rows = first_n(df, [F.col(key)], "lang", F.broadcast(limits)).join(F.broadcast(table), "lang")
    short = F.col("available") < wanted
    # Sizes are cut in floating point, as ratio times size, and the test split takes the rest.
    ratio = F.col("available").cast("double") / wanted.cast("double")
    train = F.when(short, F.floor(F.col("train_n") * ratio)).otherwise(F.col("train_n"))
    val = F.when(short, F.floor(F.col("val_n") * ratio)).otherwise(F.col("val_n"))
    return rows.withColumns({"train_k": train, "val_k": val}).drop("train_n", "val_n", "test_n")


def collected_rows(
    rows: DataFrame, record: DataFrame, quotas: Sequence[tuple[str, int, int, int]], on_error: str = "keep"
) -> DataFrame:
    """`quota_rows` of a lazy source (sources/lazy.py), whose rows are numbered by place and limited already."""
    return quota_rows(rows, "place", quotas, record, on_error)


def quota_limits(quotas: Sequence[tuple[str, int, int, int]]) -> dict[str, int]:
    """How many rows a lazy source is asked for, per language."""
    return {lang: train + val + test for lang, train, val, test in quotas}


def split_rows(rows: DataFrame) -> DataFrame:
    """Contiguous train, validation and test parts of each language."""
    split = (
        F.when(F.col("rn") <= F.col("train_k"), "train")
        .when(F.col("rn") <= F.col("train_k") + F.col("val_k"), "validation")
        .otherwise("test")
    )
    return rows.withColumn("split", split).drop("row_limit", "available", "train_k", "val_k")


def write_split_set(df: DataFrame, path: str) -> None:
    df.write.partitionBy("split").mode("overwrite").parquet(path)


def split_totals(rows: DataFrame, quotas: Sequence[tuple[str, int, int, int]]) -> DataFrame:
    """Requested and granted rows per split."""
    splits = "stack(3, 'train', train_n, 'validation', val_n, 'test', test_n) as (split, n)"
    asked = (
        quota_table(rows.sparkSession, quotas).selectExpr(splits).groupBy("split").agg(F.sum("n").alias("requested"))
    )
    granted = rows.groupBy("split").agg(F.count(F.lit(1)).alias("granted"))
    return asked.join(granted, "split", "left").fillna(0, ["granted"])


def dataset_stats(df: DataFrame, column: str) -> DataFrame:
    """Rows per data set and a TOTAL row."""
    rows = df.rollup(column).agg(F.count(F.lit(1)).alias("n_rows"), F.grouping(column).alias("_all"))
    return rows.select(F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col(column)).alias(column), "n_rows")


def concat_sets(sets: Sequence[DataFrame]) -> DataFrame:
    """Rows of all sets, marked with the place of their set; nothing is deduplicated."""
    out = None
    for place, df in enumerate(sets):
        marked = df.withColumn("set_no", F.lit(place))
        out = marked if out is None else out.unionByName(marked)
    return out
