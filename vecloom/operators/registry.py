"""Data sets by configuration: which split, which columns, which label and how many rows, in one plan over all sets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.functions.text import pair_prompt
from vecloom.operators.curation import capped_sample


@dataclass(frozen=True)
class SetConfig:
    name: str
    task: str
    columns: tuple[str, ...] = ("anchor", "positive")
    label: str | None = None
    split: str = "train"
    max_rows: int | None = None


# Data sets of the short training run.
CONFIGURED = (
    SetConfig("msmarco_tr_ft", "ret", max_rows=100_000),
    SetConfig("nfcorpus_tr_ft", "ret"),
    SetConfig("scifact_tr_ft", "ret"),
    SetConfig("fiqa_tr_ft", "ret"),
    SetConfig("quora_tr_ft", "ret", split="dev"),
    SetConfig("wmt16_en_tr_ft", "bitext"),
    SetConfig("wmt16_en_tr", "bitext", ("sentence1", "sentence2"), max_rows=100_000),
    SetConfig("stsb_tr", "sts", ("sentence1", "sentence2"), "score"),
    SetConfig("offenseval", "cls", ("text",), "label"),
    SetConfig("news_cat", "cls", ("text",), "label"),
    SetConfig("thy_sa", "cls", ("text",), "label", "test"),
    SetConfig("irony_tr", "cls", ("text",), "label", "test"),
    SetConfig("ts_timeline_news", "cls", ("text",), "label"),
    SetConfig("snli_tr_ft", "nli", ("premise", "hypothesis"), "label", max_rows=100_000),
    SetConfig("multinli_tr_ft", "nli", ("premise", "hypothesis"), "label", max_rows=100_000),
    SetConfig("xnli_tr_ft", "nli", ("premise", "hypothesis"), "label", "validation"),
)


def config_table(spark, configs: Sequence[SetConfig]) -> DataFrame:
    """(dataset, task, wanted_split, first_column, second_column, label_column, max_samples): a row a set; names are unique."""
    names = [c.name for c in configs]
    if len(set(names)) < len(names):
        raise ValueError("a data set is configured twice")
    rows = [(c.name, c.task, c.split, c.columns[0], c.columns[1] if len(c.columns) > 1 else None, c.label, c.max_rows) for c in configs]
    kinds = "dataset string, task string, wanted_split string, first_column string, second_column string, label_column string, max_samples long"
    return spark.createDataFrame(rows, kinds)


def configured_rows(df: DataFrame, configs: Sequence[SetConfig], key: str, split: str = "split") -> DataFrame:
    """(key, dataset, task, first, second, label) of the rows that the configuration asks for.

    `df` (key, dataset, split, and any columns) holds all sets. Each row meets its set's entry, which names the split
    and the columns to read; there is no plan per set, so many sets cost one scan. Rows of other splits and of sets
    that are not configured are left out, and so are rows without a value in a configured column that the table has; a
    configured column that it lacks reads as null and drops the set's rows. Values are text.
    """
    wanted = {c for s in configs for c in (*s.columns, s.label) if c is not None and c in df.columns}
    values = F.create_map(*[x for c in sorted(wanted) for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]) if wanted else F.create_map().cast("map<string,string>")
    table = config_table(df.sparkSession, configs)
    met = df.select(key, "dataset", F.col(split).alias("_split"), values.alias("_values")).join(F.broadcast(table), "dataset")

    def value(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.try_element_at("_values", F.col(name)))

    rows = met.where(F.col("_split") == F.col("wanted_split")).withColumns(
        {"first": value("first_column"), "second": value("second_column"), "label": value("label_column")}
    )
    for name in ("first", "second", "label"):
        rows = rows.where(F.col(f"{name}_column").isNull() | F.col(name).isNotNull())
    return rows.select(key, "dataset", "task", "first", "second", "label")


def model_inputs(rows: DataFrame) -> DataFrame:
    """(dataset, task, text, other, label): pairs as they are, premise and hypothesis as one prompt with its label."""
    nli = F.col("task") == "nli"
    return rows.withColumns(
        {"text": F.when(nli, pair_prompt(F.col("first"), F.col("second"))).otherwise(F.col("first")), "other": F.when(~nli, F.col("second"))}
    ).drop("first", "second")


def sampled_rows(rows: DataFrame, configs: Sequence[SetConfig], key: str) -> DataFrame:
    """The seeded sample of each set that has a cap and more rows than it, all rows of the others, numbered in `position`."""
    caps = config_table(rows.sparkSession, configs).select("dataset", "max_samples")
    return capped_sample(rows, key, "dataset", caps)


def label_counts(rows: DataFrame) -> DataFrame:
    """(dataset, task, n_rows, num_labels) of sets with labels to choose from."""
    labelled = rows.where(F.col("task").isin("cls", "nli"))
    return labelled.groupBy("dataset", "task").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("label").alias("num_labels"))
