"""Saving and loading fitted models."""

from __future__ import annotations

from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession


def save_model(model: MLWritable, path: str) -> None:
    """Save an ML estimator or model, replacing what is there."""
    model.write().overwrite().save(path)


def load_model(kind: type[MLReadable], path: str):
    return kind.load(path)


def save_parameters(df: DataFrame, path: str) -> None:
    """Save a parameter table, such as scaler statistics or the nodes of a forest."""
    df.write.mode("overwrite").parquet(path)


def load_parameters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
