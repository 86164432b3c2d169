"""Score records to leaderboards and reports. A record is (Task, Type, Model, Score)."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.functions.text import shorten
from vecloom.operators.ordered import numbered
from vecloom.sources.staging import stage

# The type of each benchmark task.
TASKS_BY_TYPE = {
    "Classification": [
        "Turkish-Product-Reviews", "News-Cat", "BilTweetNews-Sentiment-Analysis", "Gender-Hate-Speech-TR",
        "Sci-Cite-TR", "Pubmed-RCT-10K-TR", "Thesis-Abstract-Classification-11K",
    ],
    "Classification (NLI)": ["SNLI-TR", "MultiNLI-TR", "Med-NLI-TR"],
    "Retrieval": [
        "MsMarco-TR", "Scifact-TR", "NFCorpus-TR", "Quora-TR", "Fiqa-TR", "Apps-Retrieval-TR",
        "Code-Search-Net-21K-TR", "Stackoverflow-QA-TR", "Cos-QA-TR",
    ],
    "STS": ["STSb-TR"],
}
OTHER = "Other"


def task_types(spark: SparkSession) -> DataFrame:
    rows = [(task, kind) for kind, tasks in TASKS_BY_TYPE.items() for task in tasks]
    return spark.createDataFrame(rows, "Task string, Type string")


def with_task_type(records: DataFrame) -> DataFrame:
    types = F.broadcast(task_types(records.sparkSession))
    return records.join(types, "Task", "left").withColumn("Type", F.coalesce("Type", F.lit(OTHER)))


def unfinished(tasks: DataFrame, records: DataFrame) -> DataFrame:
    """(Task, Model) still to run: those without a record."""
    return tasks.join(records.select("Task", "Model").distinct(), ["Task", "Model"], "left_anti")


def mean_scores(records: DataFrame, index: Sequence[str]) -> DataFrame:
    """The board in long form, (index, Model, Score): repeats are averaged, however many models there are."""
    return records.groupBy(*index, "Model").agg(F.avg("Score").alias("Score"))


def score_pivot(records: DataFrame, index: Sequence[str], models: Sequence[str]) -> DataFrame:
    """One row per index, sorted, one column per model named; repeats are averaged, gaps stay null."""
    return records.groupBy(*index).pivot("Model", list(models)).agg(F.avg("Score")).orderBy(*index)


def mean_by_type(records: DataFrame) -> DataFrame:
    return records.groupBy("Type").agg(F.avg("Score").alias("mean_score"))


def overall_mean(records: DataFrame, by: str = "Task") -> DataFrame:
    """The score per task and an AVERAGE row: the mean over all records."""
    rows = records.rollup(by).agg(F.avg("Score").alias("Score"), F.grouping(by).alias("_all"))
    return rows.select(F.when(F.col("_all") == 1, "AVERAGE").otherwise(F.col(by)).alias(by), "Score")


def ranked(results: DataFrame, score: str = "spearman", name: str = "model") -> DataFrame:
    """Results with their place, best first, and a name short enough to print; equal scores go by name, NaN and
    then missing scores come last."""
    order = [F.col(score).isNull(), -F.col(score), F.col(name)]
    return numbered(results, order, name="place").withColumn("shown", shorten(F.col(name)))


def score_delta(base: DataFrame, final: DataFrame, on: Sequence[str]) -> DataFrame:
    """Scores before and after, and the gain."""
    before = base.select(*on, F.col("Score").alias("baseline"))
    after = final.select(*on, F.col("Score").alias("final"))
    return before.join(after, list(on)).withColumn("delta", F.col("final") - F.col("baseline"))


def markdown_lines(cells: DataFrame, index: Sequence[str], models: Sequence[str], title: str) -> DataFrame:
    """(section, line_no, line) of a markdown table from (index, Model, Score): two decimals, gaps as nan.

    Lines are numbered from 1 in the order of the index columns, each compared on its own.
    """

    # Python's own formatting: exact halves go to even, where the JVM rounds them up.
    @F.pandas_udf("string")
    def two_digits(values: pd.Series) -> pd.Series:
        return values.map(lambda x: f"{x:.2f}")

    shown = cells.withColumn("_shown", two_digits(F.col("Score")))
    table = shown.groupBy(*index).pivot("Model", list(models)).agg(F.first("_shown"))
    columns = [F.col(c) for c in index] + [F.coalesce(F.col(f"`{m}`"), F.lit("nan")) for m in models]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *columns), F.lit(" |"))
    body = numbered(table.select(*index, row.alias("line")), [F.col(c) for c in index], name="line_no")
    head = "| " + " | ".join([*index, *models]) + " |"
    rule = "| " + " | ".join([":---"] * len(index) + ["---:"] * len(models)) + " |"
    top = cells.sparkSession.createDataFrame([(1, head), (2, rule)], "line_no long, line string")
    lines = top.unionByName(body.select((F.col("line_no") + 2).alias("line_no"), "line"))
    return lines.select(F.lit(title).alias("section"), "line_no", "line")


def report_lines(records: DataFrame, models: Sequence[str]) -> DataFrame:
    """The comparison report on the models named: every task by model, then the mean of each type by model.

    The records are folded once; means of types are over records, not over tasks.
    """
    sums = records.groupBy("Type", "Task", "Model").agg(F.sum("Score").alias("_sum"), F.count("Score").alias("_n"))
    sums = stage(sums, "report")
    mean = (F.sum("_sum") / F.nullif(F.sum("_n"), F.lit(0))).alias("Score")
    detail = sums.groupBy("Type", "Task", "Model").agg(mean)
    means = sums.groupBy("Type", "Model").agg(mean)
    return markdown_lines(detail, ["Type", "Task"], models, "Detailed Results").unionByName(
        markdown_lines(means, ["Type"], models, "Average Scores by Type")
    )


def summary_lines(records: DataFrame) -> DataFrame:
    """The report on one model: every task with its metric and score, then the mean of each type."""
    detail = records.select("Type", "Task", "Metric", F.lit("Score").alias("Model"), "Score")
    means = mean_by_type(records).select("Type", F.lit("mean_score").alias("Model"), F.col("mean_score").alias("Score"))
    return markdown_lines(detail, ["Type", "Task", "Metric"], ["Score"], "Evaluation Results").unionByName(
        markdown_lines(means, ["Type"], ["mean_score"], "Averages by Type")
    )


def log_keys(scores: DataFrame, prefix: str) -> DataFrame:
    """(key, value) as a run logs them: one per task and the mean, under baseline/ or final/."""
    means = overall_mean(scores)
    name = F.when(F.col("Task") == "AVERAGE", "mean_score").otherwise(F.col("Task"))
    return means.select(F.concat(F.lit(f"{prefix}/mteb/"), name).alias("key"), F.col("Score").alias("value"))
