"""Distributions, extremes, thresholds and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import round_to
from ..plans import attach, exact_quantiles, top_k, top_k_threshold

#: Rows per group that a map task may hold and send on.
SMALL_K = 1000


def value_histogram(
    df: DataFrame,
    value: str,
    digits: int = 0,
    by: Sequence[str] = (),
    kind: str = "double",
    count_nulls: bool = False,
) -> DataFrame:
    """Rows per rounded value. The NULL bucket counts its rows only with ``count_nulls``."""
    bucket = round_to(value, digits).cast(kind).alias("bucket")
    n = F.count(F.lit(1)) if count_nulls else F.count("bucket")
    return df.select(*by, bucket).groupBy(*by, "bucket").agg(n.alias("n_rows"))


def mode_buckets(
    df: DataFrame, value: str, k: int, digits: int = 0, by: Sequence[str] = (), kind: str = "double"
) -> DataFrame:
    """The ``k`` fullest buckets; equal counts go by the smaller bucket."""
    hist = value_histogram(df, value, digits, by, kind)
    return top_k(hist, k, [F.desc("n_rows"), F.asc("bucket")], by)


def extremes(
    df: DataFrame,
    value: str,
    k: int,
    tie: Sequence[str],
    ascending: bool = False,
    by: Sequence[str] = (),
    rank: str | None = None,
) -> DataFrame:
    """The ``k`` largest (or smallest) readings, overall or per group; ties go by ``tie``.

    Beyond ``SMALL_K`` rows a threshold on the values cuts each group before it is shuffled.
    """
    if k > SMALL_K:
        return top_k_threshold(df, k, value, by, tie, not ascending, rank)
    first = F.asc_nulls_last(value) if ascending else F.desc_nulls_last(value)
    return top_k(df, k, [first, *[F.asc(t) for t in tie]], by, rank)


def mean_and_deviation(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.avg(value).alias("mean_value"), F.stddev_samp(value).alias("sd_value"), F.count(value).alias("n_rows")
    )


def group_counts(df: DataFrame, by: Sequence[str], out: str = "n_rows") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(out))


def count_range(counts: DataFrame, n: str = "n_rows", by: Sequence[str] = ()) -> DataFrame:
    """Smallest and largest of the group counts."""
    return counts.groupBy(*by).agg(F.min(n).alias("min_count"), F.max(n).alias("max_count"))


def percentile_threshold(
    df: DataFrame, value: str, q: float = 0.95, by: Sequence[str] = (), out: str = "threshold"
) -> DataFrame:
    """Exact percentile with linear interpolation."""
    return exact_quantiles(df, value, {out: q}, by)


def approx_percentile_threshold(
    df: DataFrame, value: str, q: float = 0.95, by: Sequence[str] = (), accuracy: int = 10_000,
    out: str = "threshold",
) -> DataFrame:
    """One-pass percentile with a rank error of at most 1/accuracy of the rows."""
    return df.groupBy(*by).agg(F.percentile_approx(value, q, accuracy).alias(out))


def count_gate(
    df: DataFrame, label: str, by: Sequence[str], min_count: int = 7, out: str | None = None
) -> DataFrame:
    """Set the labels of a batch to 0 unless it holds at least ``min_count`` anomalies."""
    counts = df.groupBy(*by).agg(F.sum(label).alias("_hits"), F.count(F.lit(1)).alias("_n"))
    gated = F.when(F.col("_hits") >= min_count, F.col(label)).otherwise(F.lit(0))
    return attach(df, counts, by, rows="_n").withColumn(out or label, gated).drop("_hits", "_n")


def sorted_by(df: DataFrame, *order: Column | str) -> DataFrame:
    """Globally sorted rows: a range-partitioned sort, not a single task."""
    return df.orderBy(*order)
