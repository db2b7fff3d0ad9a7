"""Time-series features that depend on the order of the readings.

Input rows carry the dense position of ``plans.with_position``. Neighbours come from halo
frames, so a hot series is spread over chunks; what remains is a mergeable aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import attach, exact_quantiles, framed, join_series, running_total, write_scratch
from ..plans.frames import CHUNK_ROWS, chunk_of


def _with_stats(
    df: DataFrame, by: list[str], value: str, pos: str, corridor: tuple[float, float] | None = None
) -> DataFrame:
    """Rows with the length, mean, deviation, extremes and mass of their series, and with the two
    quantiles of ``corridor`` if given: one join for all that needs them."""
    stats = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg(value).alias("_mean"),
        F.stddev_pop(value).alias("_sd"),
        F.min(value).alias("_lo"),
        F.max(value).alias("_hi"),
        F.sum(F.abs(value)).alias("_mass"),
    )
    if corridor:
        low, high = corridor
        stats = join_series(stats, exact_quantiles(df, value, {"_ql": low, "_qh": high}, by), by)
    return attach(df.select(*by, pos, value), stats, by, rows="_n")


def _neighbours(rows, by, value, pos, lag, peak_support, chunk_rows):
    def shifted(k: int):
        return lambda w: F.lag(value, k).over(w)

    columns = {"_l1": shifted(1), "_l2": shifted(2), "_la": shifted(lag), "_lb": shifted(2 * lag)}
    columns["_left"] = lambda w: F.max(value).over(w.rowsBetween(-peak_support, -1))
    columns["_right"] = lambda w: F.max(value).over(w.rowsBetween(1, peak_support))
    back = max(2, 2 * lag, peak_support)
    return framed(rows, by, pos, back, peak_support, columns, chunk_rows=chunk_rows)


def _change_aggregates(value: str, pos: str, crossing: float, peak_support: int) -> list[Column]:
    v = F.col(value)
    step = v - F.col("_l1")
    full = (F.col(pos) >= peak_support) & (F.col(pos) < F.col("_n") - peak_support)
    at_max, at_min = v == F.col("_hi"), v == F.col("_lo")
    return [
        F.first("_n").alias("_n"),
        F.first("_sd").alias("_sd"),
        F.sum(F.abs(step)).alias("absolute_sum_of_changes"),
        F.avg(F.abs(step)).alias("mean_abs_change"),
        F.avg(step).alias("mean_change"),
        F.avg(0.5 * (v - 2 * F.col("_l1") + F.col("_l2"))).alias("mean_second_derivative_central"),
        F.sqrt(F.sum(step * step)).alias("cid_ce"),
        F.avg(v * F.col("_la") * F.col("_lb")).alias("c3"),
        F.avg(v * v * F.col("_la") - F.col("_la") * F.col("_lb") * F.col("_lb")).alias("time_reversal_asymmetry"),
        F.count_if((v > crossing) != (F.col("_l1") > crossing)).alias("number_crossing_m"),
        F.count_if(full & (v > F.col("_left")) & (v > F.col("_right"))).alias("number_peaks"),
        F.min(F.when(at_max, F.col(pos))).alias("_first_max"),
        F.max(F.when(at_max, F.col(pos))).alias("_last_max"),
        F.min(F.when(at_min, F.col(pos))).alias("_first_min"),
        F.max(F.when(at_min, F.col(pos))).alias("_last_min"),
    ]


def _change_columns(aggregated: DataFrame) -> DataFrame:
    n = F.col("_n").cast("double")
    return aggregated.withColumns(
        {
            "cid_ce_normalized": F.try_divide(F.col("cid_ce"), F.col("_sd")),
            "first_location_of_maximum": F.col("_first_max") / n,
            "last_location_of_maximum": (F.col("_last_max") + 1) / n,
            "first_location_of_minimum": F.col("_first_min") / n,
            "last_location_of_minimum": (F.col("_last_min") + 1) / n,
        }
    ).drop("_n", "_sd", "_first_max", "_last_max", "_first_min", "_last_min")


def change_features(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    pos: str = "pos",
    lag: int = 1,
    crossing: float = 0.0,
    peak_support: int = 1,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Changes between neighbours, lagged products, crossings, peaks and the places of extremes."""
    by = list(by)
    rows = _with_stats(df, by, value, pos)
    rows = _neighbours(rows, by, value, pos, lag, peak_support, chunk_rows)
    return _change_columns(rows.groupBy(*by).agg(*_change_aggregates(value, pos, crossing, peak_support)))


def longest_run(
    df: DataFrame,
    by: Sequence[str],
    inside: Column,
    out: str,
    pos: str = "pos",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Most consecutive rows of a series for which ``inside`` holds.

    The rows where it fails break the series; a run is the gap between two breaks. Gaps are
    measured inside chunks, and then between the last break of a chunk and the first of the next.
    """
    by = list(by)
    length = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    breaks = df.filter(~F.coalesce(inside, F.lit(False))).select(
        *by, F.col(pos).alias("_p"), chunk_of(pos, chunk_rows).alias("_c")
    )
    w = Window.partitionBy(*by, "_c").orderBy("_p")
    chunks = (
        breaks.withColumn("_gap", F.col("_p") - F.lag("_p").over(w) - 1)
        .groupBy(*by, "_c")
        .agg(F.min("_p").alias("_first"), F.max("_p").alias("_last"), F.max("_gap").alias("_gap"))
    )
    s = Window.partitionBy(*by).orderBy("_c")
    runs = (
        chunks.withColumn("_jump", F.col("_first") - F.lag("_last", 1, -1).over(s) - 1)
        .groupBy(*by)
        .agg(F.max("_gap").alias("_gap"), F.max("_jump").alias("_jump"), F.max("_last").alias("_last"))
    )
    tail = F.col("_n") - F.coalesce(F.col("_last"), F.lit(-1)) - 1
    best = F.greatest(F.coalesce("_gap", F.lit(0)), F.coalesce("_jump", F.lit(0)), tail)
    return join_series(length, runs, by).select(*by, best.cast("bigint").alias(out))


def _strikes(rows: DataFrame, by: list[str], value: str, pos: str, chunk_rows: int) -> DataFrame:
    above = longest_run(rows, by, F.col(value) > F.col("_mean"), "longest_strike_above_mean", pos, chunk_rows)
    below = longest_run(rows, by, F.col(value) < F.col("_mean"), "longest_strike_below_mean", pos, chunk_rows)
    return join_series(above, below, by)


def strike_features(
    df: DataFrame, by: Sequence[str], value: str, pos: str = "pos", chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Longest strikes above and below the mean."""
    by = list(by)
    return _strikes(_with_stats(df, by, value, pos), by, value, pos, chunk_rows)


def _mass_quantiles(rows, by, value, quantiles, pos, chunk_rows) -> DataFrame:
    mass = F.abs(F.col(value))
    passed = running_total(rows, by, [pos], mass, "_before", chunk_of(pos, chunk_rows))
    share = F.try_divide(F.coalesce("_before", F.lit(0.0)) + mass, F.col("_mass"))
    return passed.groupBy(*by).agg(
        *[
            F.min(F.when(share >= q, (F.col(pos) + 1) / F.col("_n"))).alias(
                f"index_mass_quantile_{q:g}".replace(".", "_")
            )
            for q in quantiles
        ]
    )


def index_mass_quantile(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    quantiles: Sequence[float] = (0.5,),
    pos: str = "pos",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Share of the series after which a share q of the absolute mass has passed."""
    by = list(by)
    return _mass_quantiles(_with_stats(df, by, value, pos), by, value, quantiles, pos, chunk_rows)


def _energy_aggregates(value: str, pos: str, segments: int) -> list[Column]:
    size, longer = F.floor(F.col("_n") / segments), F.col("_n") % segments
    edge = longer * (size + 1)
    part = F.when(F.col(pos) < edge, F.floor(F.col(pos) / (size + 1))).otherwise(
        longer + F.floor(F.try_divide(F.col(pos) - edge, size))
    )
    e = F.col(value) * F.col(value)
    return [
        F.try_divide(F.sum(F.when(part == i, e).otherwise(0.0)), F.sum(e)).alias(f"energy_ratio_{segments}_{i}")
        for i in range(segments)
    ]


def energy_ratio_by_chunks(
    df: DataFrame, by: Sequence[str], value: str, segments: int = 4, pos: str = "pos"
) -> DataFrame:
    """Share of the energy in each of ``segments`` consecutive parts, the first ones longer by one."""
    by = list(by)
    return _with_stats(df, by, value, pos).groupBy(*by).agg(*_energy_aggregates(value, pos, segments))


def _corridor_aggregates(value: str) -> list[Column]:
    low, high = F.col("_ql"), F.col("_qh")
    inside = F.col(value).between(low, high) & F.col("_l1").between(low, high)
    step = F.when(inside, F.col(value) - F.col("_l1"))
    return [
        F.coalesce(F.avg(step), F.lit(0.0)).alias("change_quantiles_mean"),
        F.coalesce(F.avg(F.abs(step)), F.lit(0.0)).alias("change_quantiles_mean_abs"),
        F.coalesce(F.var_pop(step), F.lit(0.0)).alias("change_quantiles_var"),
        F.coalesce(F.var_pop(F.abs(step)), F.lit(0.0)).alias("change_quantiles_var_abs"),
    ]


def change_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    low: float = 0.2,
    high: float = 0.8,
    pos: str = "pos",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Mean and variance of changes between neighbours that both lie between two quantiles."""
    by = list(by)
    rows = _with_stats(df, by, value, pos, (low, high))
    rows = framed(rows, by, pos, 1, 0, {"_l1": lambda w: F.lag(value).over(w)}, chunk_rows=chunk_rows)
    return rows.groupBy(*by).agg(*_corridor_aggregates(value))


def ordered_features(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    pos: str = "pos",
    lag: int = 1,
    crossing: float = 0.0,
    peak_support: int = 1,
    corridor: tuple[float, float] = (0.2, 0.8),
    segments: int = 4,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """All order-dependent features, one row per series.

    The positioned rows with their statistics are written once and read by each part; one frame
    serves all features of neighbours.
    """
    by = list(by)
    rows = write_scratch(_with_stats(df, by, value, pos, corridor), "positioned")
    near = _neighbours(rows, by, value, pos, lag, peak_support, chunk_rows)
    changes = near.groupBy(*by).agg(
        *_change_aggregates(value, pos, crossing, peak_support),
        *_energy_aggregates(value, pos, segments),
        *_corridor_aggregates(value),
    )
    out = join_series(_change_columns(changes), _strikes(rows, by, value, pos, chunk_rows), by)
    return join_series(out, _mass_quantiles(rows, by, value, (0.5,), pos, chunk_rows), by)
