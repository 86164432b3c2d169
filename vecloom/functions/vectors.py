"""Vector expressions over array columns, in double precision."""

from __future__ import annotations

from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_doubles(v: Column) -> Column:
    return v.cast("array<double>")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y))


def norm(v: Column) -> Column:
    return F.sqrt(total(F.transform(as_doubles(v), lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 if either has no length."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / size)


def l2_normalise(df: DataFrame, column: str) -> DataFrame:
    """Vectors of unit length; a zero vector stays as it is."""
    unit = Normalizer(p=2.0, inputCol="_vector", outputCol="_unit")
    return (
        unit.transform(df.withColumn("_vector", array_to_vector(as_doubles(F.col(column)))))
        .withColumn(column, vector_to_array("_unit"))
        .drop("_vector", "_unit")
    )


def squared_error(a: Column, b: Column) -> Column:
    return total(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: (x - y) * (x - y)))


def mean_vector(v: Column) -> Column:
    """Aggregate: the mean per position, combined on the map side."""
    return vector_to_array(Summarizer.mean(array_to_vector(as_doubles(v))))
