"""Standardisation of a signal, overall or per device, with a separate fit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import zscore
from ..plans import attach, attach_scalar


def fit_scaler(df: DataFrame, value: str, by: Sequence[str] = (), ddof: int = 1) -> DataFrame:
    """Mean, deviation and row count: one row, or one per ``by``.

    ``ddof=1`` is the sample deviation, ``ddof=0`` the population deviation.
    """
    if ddof not in (0, 1):
        raise ValueError("ddof is 0 or 1")
    deviation = F.stddev_samp if ddof else F.stddev_pop
    return df.groupBy(*by).agg(
        F.avg(value).alias("mean"),
        deviation(value).alias("sd"),
        F.count(value).alias("n"),
    )


def apply_scaler(
    df: DataFrame,
    stats: DataFrame,
    value: str,
    by: Sequence[str] = (),
    out: str = "zscale",
    digits: int | None = 6,
) -> DataFrame:
    """Standardise with statistics from ``fit_scaler``, of this or of other data."""
    st = stats.select(*by, F.col("mean").alias("_mean"), F.col("sd").alias("_sd"), F.col("n").alias("_n"))
    joined = attach(df, st, by, rows="_n") if by else attach_scalar(df, st)
    z = zscore(value, F.col("_mean"), F.col("_sd"), digits)
    return joined.withColumn(out, z).drop("_mean", "_sd", "_n")


def znorm(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    ddof: int = 1,
    out: str = "zscale",
    digits: int | None = 6,
) -> DataFrame:
    return apply_scaler(df, fit_scaler(df, value, by, ddof), value, by, out, digits)
