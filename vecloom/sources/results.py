"""Result logs and result trees."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

RESULT_FIELDS = (
    ("model", "string"), ("pearson", "double"), ("spearman", "double"), ("num_samples", "bigint"), ("split", "string"),
    ("processing_time_seconds", "double"),
)
LOG_COLUMNS = f"timestamp string, dataset string, results array<struct<{', '.join(f'{c}:{kind}' for c, kind in RESULT_FIELDS)}>>"


def log_entries(body: Column) -> Column:
    """Entries of a log file: a list as it is, a lone entry wrapped, a broken file empty."""
    body = F.trim(body)
    whole = F.try_parse_json(body).isNotNull()
    wrapped = F.when(body.startswith("["), body).otherwise(F.concat(F.lit("["), body, F.lit("]")))
    return F.when(whole, F.from_json(wrapped, ArrayType(StructType.fromDDL(LOG_COLUMNS))))


def results_of(entries: DataFrame) -> DataFrame:
    """One row per result of every entry."""
    return entries.select("timestamp", "dataset", F.explode("results").alias("r")).select(
        "timestamp", "dataset", "r.*"
    )


def flat_log(files: DataFrame, body: str) -> DataFrame:
    """One row per result of every entry of every log file, given as text."""
    return results_of(files.select(F.explode(log_entries(F.col(body))).alias("e")).select("e.*"))


def append_log(results: DataFrame, path: str, dataset: str) -> None:
    """Add one entry to a log folder: one run with all of its results, ordered by model and split.

    The entry is a folder of its own and counts once its write is committed; a run that fails halfway leaves nothing
    that a reader sees, and runs side by side don't meet.
    """
    result = F.struct(*[F.col(c).cast(kind).alias(c) for c, kind in RESULT_FIELDS])
    entry = results.agg(F.array_sort(F.collect_list(result), _by_model).alias("results"))  # one run's results, one a model and split
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    entry = entry.select(stamp.alias("timestamp"), F.lit(dataset).alias("dataset"), "results")
    entry.coalesce(1).write.json(f"{path}/entry-{uuid.uuid4().hex}")


def _by_model(a: Column, b: Column) -> Column:
    """Order of results: model, then split; nulls first."""
    key = [F.concat_ws("\u0001", x["model"], x["split"]) for x in (a, b)]
    return F.when(key[0] < key[1], -1).when(key[0] > key[1], 1).otherwise(0)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All results of a log folder that `append_log` writes, of committed entries only; broken lines are passed over."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/entry-*/_SUCCESS")
    marks = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop) or []
    entries = [m.getPath().getParent().toString() for m in marks]
    if not entries:
        return results_of(spark.createDataFrame([], LOG_COLUMNS))
    return results_of(spark.read.schema(LOG_COLUMNS).json(entries))


def read_log_files(spark: SparkSession, path: str) -> DataFrame:
    """All results of files that hold one JSON document each."""
    return flat_log(spark.read.text(path, wholetext=True), "value")


def task_name(file_name: Column, body: Column) -> Column:
    """The name that the document gives itself, or that of its file."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(body), "$.task_name", "string"), file_name)


def tree_records(files: DataFrame, path: str, body: str) -> DataFrame:
    """(model, revision, task, body) of files ROOT/model/revision/task.json.

    `__` in a model folder stands for a slash. Model metadata is left out, and so is a
    revision with no more than one JSON file. The name shown has a short revision; a document may name its task itself.
    """
    pattern = r"([^/]+)/([^/]+)/([^/]+)\.json$"
    found = files.where(F.col(path).rlike(pattern)).select(
        *[F.regexp_extract(path, pattern, i).alias(n) for i, n in ((1, "folder"), (2, "revision"), (3, "file"))],
        F.col(body).alias("body"),
    )
    counts = found.groupBy("folder", "revision").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    model = F.replace("folder", F.lit("__"), F.lit("/"))
    return (
        found.where("file <> 'model_meta'")
        .join(counts, ["folder", "revision"], "left_semi")
        .select(
            F.concat(model, F.lit(" ("), F.substring("revision", 1, 6), F.lit(")")).alias("model"),
            task_name(F.col("file"), F.col("body")).alias("task"),
            "body",
        )
    )


def flat_records(files: DataFrame, path: str, body: str) -> DataFrame:
    """(task, body) of a folder FOLDER/task.json of one model; its metadata is left out, and so are broken documents."""
    file = F.regexp_extract(path, r"([^/]+)\.json$", 1)
    found = files.where(F.col(path).endswith(".json") & (file != "model_meta") & F.try_parse_json(body).isNotNull())
    return found.select(task_name(file, F.col(body)).alias("task"), F.col(body).alias("body"))


def _json_files(spark: SparkSession, pattern: str) -> DataFrame:
    files = spark.read.text(pattern, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), "value")


def read_tree(spark: SparkSession, root: str) -> DataFrame:
    return tree_records(_json_files(spark, f"{root}/*/*/*.json"), "path", "value")


def read_flat(spark: SparkSession, folder: str) -> DataFrame:
    return flat_records(_json_files(spark, f"{folder}/*.json"), "path", "value")


def task_table(scored: DataFrame) -> DataFrame:
    """(line, task, score) as printed for one model, from (task, score): tasks by name, then their AVERAGE."""
    rows = scored.select("task", "score")
    average = rows.agg(F.lit("AVERAGE").alias("task"), F.avg("score").alias("score")).where("score IS NOT NULL")
    lines = rows.withColumn("_last", F.lit(0)).unionByName(average.withColumn("_last", F.lit(1)))
    order = Window.orderBy("_last", "task", "score")  # a line a task
    return lines.select(F.row_number().over(order).alias("line"), "task", "score")
