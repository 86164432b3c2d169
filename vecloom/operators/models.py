"""Classification and clustering scores of vectors, with Spark ML."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.functions.vectors import as_doubles
from vecloom.operators.agreement import v_measure


def accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    hit = (F.col(label) == F.col(predicted)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("num_samples"))


def linear_probe(train: DataFrame, test: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """Accuracy of a logistic regression fitted on the train vectors."""
    features = array_to_vector(as_doubles(F.col(vector))).alias("features")
    columns = [features, F.col(label).cast("double").alias("label")]
    model = LogisticRegression(maxIter=50, regParam=0.01).fit(train.select(*columns))
    return accuracy(model.transform(test.select(*columns)), "label", "prediction")


def cluster_score(df: DataFrame, k: int, label: str = "label", vector: str = "embedding", seed: int = 42) -> DataFrame:
    """V-measure of k-means clusters against the labels."""
    rows = df.select(array_to_vector(as_doubles(F.col(vector))).alias("features"), label)
    model = KMeans(k=k, seed=seed, maxIter=20).fit(rows)
    return v_measure(model.transform(rows), label, "prediction")
