"""Time-series features that do not depend on the order of the readings.

All are mergeable aggregates, so a hot series is first reduced map-side. Definitions follow the
published feature catalogue of Christ et al. (2018): population deviation and variance, sample
skewness (G1) and sample excess kurtosis (G2).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import attach, exact_quantiles, join_series


def moment_features(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    r: float = 0.25,
    count_range: tuple[float, float] = (-1.0, 1.0),
    count_value: float = 0.0,
) -> DataFrame:
    """Features of one aggregation pass."""
    v = F.col(value).cast("double")
    n = F.col("length")
    low, high = count_range
    base = df.groupBy(*by).agg(
        F.count(v).alias("length"),
        F.sum(v).alias("sum_values"),
        F.avg(v).alias("mean"),
        F.min(v).alias("minimum"),
        F.max(v).alias("maximum"),
        F.sum(v * v).alias("abs_energy"),
        F.stddev_pop(v).alias("standard_deviation"),
        F.var_pop(v).alias("variance"),
        F.skewness(v).alias("_g1"),
        F.kurtosis(v).alias("_g2"),
        F.count_if((v >= low) & (v < high)).alias("range_count"),
        F.count_if(v == count_value).alias("value_count"),
    )
    spread = F.col("maximum") - F.col("minimum")
    skew = F.when(n >= 3, F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n >= 4, ((n + 1) * F.col("_g2") + 6) * F.try_divide(n - 1, (n - 2) * (n - 3)))
    return base.withColumns(
        {
            "root_mean_square": F.sqrt(F.try_divide(F.col("abs_energy"), n)),
            "skewness": skew,
            "kurtosis": kurt,
            "variation_coefficient": F.try_divide(F.col("standard_deviation"), F.col("mean")),
            "large_standard_deviation": F.col("standard_deviation") > r * spread,
            "variance_larger_than_standard_deviation": F.col("variance") > F.col("standard_deviation"),
        }
    ).drop("_g1", "_g2")


def relative_features(
    df: DataFrame, by: Sequence[str], value: str, r_sigma: float = 1.0, bins: int = 10
) -> DataFrame:
    """Features measured against the series' own mean, deviation and range: a second pass."""
    v = F.col(value).cast("double")
    stats = df.groupBy(*by).agg(
        F.count(v).alias("_n"),
        F.avg(v).alias("_mean"),
        F.stddev_pop(v).alias("_sd"),
        F.min(v).alias("_lo"),
        F.max(v).alias("_hi"),
    )
    joined = attach(df.select(*by, value), stats, by, rows="_n")
    place = F.floor(F.try_divide(v - F.col("_lo"), F.col("_hi") - F.col("_lo")) * bins)
    place = F.coalesce(F.least(place, F.lit(bins - 1)), F.lit(0))
    above, below = v > F.col("_mean"), v < F.col("_mean")
    beyond = F.abs(v - F.col("_mean")) > r_sigma * F.col("_sd")
    counted = joined.groupBy(*by).agg(
        F.count(v).alias("_n"),
        F.count_if(above).alias("count_above_mean"),
        F.count_if(below).alias("count_below_mean"),
        F.count_if(beyond).alias("_beyond"),
        *[F.count_if(v.isNotNull() & (place == i)).alias(f"_bin{i}") for i in range(bins)],
    )
    entropy = F.lit(0.0)
    for i in range(bins):
        p = F.try_divide(F.col(f"_bin{i}").cast("double"), F.col("_n").cast("double"))
        entropy = entropy - F.when(p > 0, p * F.log(p)).otherwise(0.0)
    return counted.select(
        *by,
        "count_above_mean",
        "count_below_mean",
        F.try_divide(F.col("_beyond").cast("double"), F.col("_n").cast("double")).alias("ratio_beyond_r_sigma"),
        entropy.alias("binned_entropy"),
    )


def recurrence_features(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Features of how often values recur: counts per value first, then per series."""
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    again = F.col("_c") > 1
    out = counts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_values"),
        F.sum("_c").alias("_points"),
        F.count_if(again).alias("_values_again"),
        F.sum(F.when(again, F.col("_c")).otherwise(0)).alias("_points_again"),
        F.sum(F.when(again, F.col("_v")).otherwise(0.0)).alias("sum_of_reoccurring_values"),
        F.sum(F.when(again, F.col("_v") * F.col("_c")).otherwise(0.0)).alias("sum_of_reoccurring_data_points"),
        (F.max("_c") > 1).alias("has_duplicate"),
        (F.max_by("_c", "_v") > 1).alias("has_duplicate_max"),
        (F.min_by("_c", "_v") > 1).alias("has_duplicate_min"),
    )

    def ratio(a: str, b: str):
        return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))

    return out.withColumns(
        {
            "percentage_of_reoccurring_values_to_all_values": ratio("_values_again", "_values"),
            "percentage_of_reoccurring_datapoints_to_all_datapoints": ratio("_points_again", "_points"),
            "ratio_value_number_to_series_length": ratio("_values", "_points"),
        }
    ).drop("_values", "_points", "_values_again", "_points_again")


def quantile_features(
    df: DataFrame, by: Sequence[str], value: str, quantiles: Sequence[float] = (0.1, 0.9), r: float = 0.05
) -> DataFrame:
    """Median, quantiles, and whether mean and median lie within ``r`` of the range."""
    names = {"median": 0.5, **{f"quantile_{q:g}".replace(".", "_"): q for q in quantiles}}
    q = exact_quantiles(df, value, names, by)
    base = df.groupBy(*by).agg(F.avg(value).alias("_mean"), F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    gap = F.abs(F.col("_mean") - F.col("median"))
    return (
        join_series(base, q, list(by))
        .withColumn("symmetry_looking", gap < r * (F.col("_hi") - F.col("_lo")))
        .drop("_mean", "_lo", "_hi")
    )


def series_features(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    quantiles: Sequence[float] = (0.1, 0.9),
    **options,
) -> DataFrame:
    """All order-free features, one row per series.

    The parts have one row per series and the same partitioning, so joining them is cheap.
    """
    keys = list(by)
    moments = {k: v for k, v in options.items() if k in ("r", "count_range", "count_value")}
    relative = {k: v for k, v in options.items() if k in ("r_sigma", "bins")}
    out = moment_features(df, keys, value, **moments)
    for part in (
        relative_features(df, keys, value, **relative),
        recurrence_features(df, keys, value),
        quantile_features(df, keys, value, quantiles),
    ):
        out = join_series(out, part, keys)
    return out
