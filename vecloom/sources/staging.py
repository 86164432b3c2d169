"""Written intermediate tables, and figures of groups joined to their rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session may fall back on a folder of this machine.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vecloom-"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# With this setting Spark removes the shuffle files of a query when it ends, not when the driver happens to collect garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a table that is read more than once, and read it back.

    Cuts the lineage, so a lost executor costs a re-read and not a recompute, and
    gives later steps column pruning and real sizes. Shuffle files of the write go with its end.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def drop_staged(*tables: DataFrame) -> None:
    """Delete tables that `stage` returned and that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def with_group_figures(df: DataFrame, side: DataFrame, by: str | None) -> DataFrame:
    """Add to each row the figures of its group, or the one row of figures of the whole table.

    Rows without a group name form a group too.
    """
    if by is not None:
        side = side.withColumnRenamed(by, "_group")
        return df.join(side, F.col(by).eqNullSafe(F.col("_group"))).drop("_group")
    row = side.first()  # of the whole table
    if row is None:
        return df.where("false").withColumns({f.name: F.lit(None).cast(f.dataType) for f in side.schema})
    return df.withColumns({f.name: literal(row[f.name], f.dataType) for f in side.schema})


def literal(value, kind: DataType) -> Column:
    """A value as a column of its type; rows become structs."""
    if value is not None and isinstance(kind, StructType):
        return F.struct(*[literal(value[f.name], f.dataType).alias(f.name) for f in kind])
    return F.lit(value).cast(kind)
