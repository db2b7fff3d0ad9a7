"""Sigma rule, dense episodes of outliers, and labels for whole episodes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import attach
from .clean import tails
from .normalize import znorm


def sigma_distance(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "distance") -> DataFrame:
    """Distance from the mean in sample deviations, over the rows given."""
    return znorm(df, value, by, ddof=1, out=out, digits=None)


def sigma_outliers(
    df: DataFrame, value: str, k: float = 4.0, by: Sequence[str] = (), out: str = "distance"
) -> DataFrame:
    """Rows strictly more than ``k`` deviations from the mean."""
    return tails(sigma_distance(df, value, by, out), out, -k, k)


def outlier_episodes(
    outliers: DataFrame, bucket: str, min_count: int = 5, by: Sequence[str] = (), out: str = "n_outliers"
) -> DataFrame:
    """Buckets with strictly more than ``min_count`` outliers, one row each."""
    return (
        outliers.groupBy(*by, bucket)
        .agg(F.count(F.lit(1)).alias(out))
        .filter(F.col(out) > min_count)
    )


def label_episodes(
    df: DataFrame, episodes: DataFrame, bucket: str, by: Sequence[str] = (), out: str = "anomaly"
) -> DataFrame:
    """Label 1 for every row of a flagged bucket, outlier or not, and 0 elsewhere."""
    keys = [*by, bucket]
    flags = episodes.select(*keys, F.lit(1).alias("_n"))
    joined = attach(df, flags, keys, rows="_n")
    return joined.withColumn(out, (F.coalesce("_n", F.lit(0)) > 0).cast("int")).drop("_n")
