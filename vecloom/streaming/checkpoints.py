"""Checkpointed append of new rows."""

from __future__ import annotations

import pyspark.errors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, name_filter: str, files_per_batch: int = 64
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", name_filter)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def append_checkpointed(rows: DataFrame, target: str, progress: str) -> StreamingQuery:
    """Append every micro-batch to `target` until the source is used up.

    Each batch owns one folder and overwrites only that, so a batch that runs again
    after a failure leaves no duplicates. `progress` remembers what is done: a later
    run goes on from there and nothing is written twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def read_checkpointed(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{target}/batch=*")


COMMIT = "batch long, n_rows long, total long, last_mark long, marks long, fired boolean"


def write_counted_source(numbered: DataFrame, folder: str, rows_per_file: int, number: str = "rn") -> None:
    """Files of exactly `rows_per_file` rows, by the number of each row (from 1), for a stream that admits rows by count.

    The file with the rest is written after all others, so a stream that takes one file a batch takes it last.
    """
    last = numbered.agg(F.max(number)).first()[0] or 0
    whole = last - last % rows_per_file
    files = numbered.withColumn("file_no", F.floor((F.col(number) - 1) / rows_per_file))
    for rows in (files.where(F.col(number) <= whole), files.where(F.col(number) > whole)):
        rows.repartition("file_no").write.partitionBy("file_no").mode("append").parquet(folder)


def append_every(rows: DataFrame, target: str, progress: str, every: int) -> StreamingQuery:
    """As `append_checkpointed`, with a checkpoint after each micro-batch that brings `every` new rows or more.

    What a batch did is one row (COMMIT) in a folder of its own: its rows, all rows so far, and whether it fired. A batch
    that runs again reads the commit before it and overwrites its own, so counts hold after a restart.
    """
    spark = rows.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/rows/batch={number}")
        n = spark.read.schema(batch.schema).parquet(f"{target}/rows/batch={number}").count()  # from the footers
        before = _commit_before(spark, target, number)
        total, last, marks = before.total + n if before else n, before.last_mark if before else 0, before.marks if before else 0
        fired = total - last >= every
        row = (number, n, total, total if fired else last, marks + fired, fired)
        spark.createDataFrame([row], COMMIT).coalesce(1).write.mode("overwrite").parquet(f"{target}/commits/at={number}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", progress)
    return writer.trigger(availableNow=True).start()


def _commit_before(spark: SparkSession, target: str, number: int):
    try:
        earlier = spark.read.schema(COMMIT).parquet(f"{target}/commits").where(F.col("batch") < number)
        return earlier.orderBy(F.desc("batch")).first()
    except pyspark.errors.AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def fired_marks(spark: SparkSession, target: str) -> DataFrame:
    """(mark_no, at_rows, is_final) of a finished stream: a row for each checkpoint, and one for the end."""
    commits = spark.read.schema(COMMIT).parquet(f"{target}/commits")
    fired = commits.where("fired").select(F.col("marks").alias("mark_no"), F.col("total").alias("at_rows"), F.lit(False).alias("is_final"))
    end = commits.agg((F.max("marks") + 1).alias("mark_no"), F.max("total").alias("at_rows"), F.lit(True).alias("is_final"))
    return fired.unionByName(end)
