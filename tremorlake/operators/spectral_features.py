"""Correlation, trend, Fourier and entropy features.

Whatever is a sum over rows stays a Spark aggregate for series of any length. Full spectra and
entropies work on consecutive segments of bounded length; near windows are counted by sorting, not by pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import ALL_PAIRS, gaps, near_windows
from ..plans import attach, framed
from ..plans.frames import CHUNK_ROWS, chunk_of


def autocorrelation(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    lags: Sequence[int] = (1, 2, 3),
    pos: str = "pos",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """sum (x_t - mean)(x_(t+lag) - mean) / ((n - lag) var), one column per lag."""
    by = list(by)
    stats = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.avg(value).alias("_mean"), F.var_pop(value).alias("_var")
    )
    joined = attach(df.select(*by, pos, value), stats, by, rows="_n")
    joined = joined.withColumn("_d", F.col(value) - F.col("_mean"))
    rows = framed(
        joined,
        by,
        pos,
        max(lags),
        0,
        {f"_d{k}": (lambda w, k=k: F.lag("_d", k).over(w)) for k in lags},
        chunk_rows=chunk_rows,
    )
    sums = rows.groupBy(*by).agg(
        F.first("_n").alias("_n"),
        F.first("_var").alias("_var"),
        *[F.sum(F.col("_d") * F.col(f"_d{k}")).alias(f"_s{k}") for k in lags],
    )
    return sums.select(
        *by,
        *[
            F.try_divide(F.col(f"_s{k}"), (F.col("_n") - k) * F.col("_var")).alias(f"autocorrelation_{k}")
            for k in lags
        ],
    )


def correlation_summary(
    df: DataFrame, by: Sequence[str], value: str, max_lag: int = 10, pos: str = "pos", chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Mean, median and variance of the autocorrelations up to ``max_lag``, and the partial
    autocorrelations (Durbin-Levinson recursion over the same few numbers)."""
    by = list(by)
    lags = list(range(1, max_lag + 1))
    acf = autocorrelation(df, by, value, lags, pos, chunk_rows)
    names = [f"autocorrelation_{k}" for k in lags]

    @F.pandas_udf("array<double>")
    def partial(series: pd.Series) -> pd.Series:
        out = []
        for r in series:
            r = np.asarray(r, dtype=float)
            phi = np.zeros(0)
            found = []
            for k in range(1, len(r) + 1):
                rest = 1.0 - phi @ r[: k - 1]
                a = np.nan if abs(rest) < 1e-12 else (r[k - 1] - phi @ r[: k - 1][::-1]) / rest
                phi = np.append(phi - a * phi[::-1], a)
                found.append(float(a))
            out.append(found)
        return pd.Series(out)

    known = F.array_compact(F.array(*names))
    size = F.size(known).cast("double")
    mean = F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, b: a + b), size)
    ordered = F.array_sort(known)
    middle = (F.get(ordered, F.floor((F.size(known) - 1) / 2).cast("int")) + F.get(ordered, F.floor(F.size(known) / 2).cast("int"))) / 2
    rows = acf.withColumns({"agg_autocorrelation_mean": mean, "agg_autocorrelation_median": middle})
    spread = F.aggregate(
        known, F.lit(0.0), lambda a, b: a + (b - F.col("agg_autocorrelation_mean")) ** 2
    )
    return (
        rows.withColumn("agg_autocorrelation_var", F.try_divide(spread, size))
        .withColumn("partial_autocorrelation", partial(F.array(*[F.coalesce(c, F.lit(float("nan"))) for c in names])))
        .drop(*names)
    )


def linear_trend(df: DataFrame, by: Sequence[str], value: str, pos: str = "pos") -> DataFrame:
    """Slope, intercept, correlation and standard error of the regression on the position."""
    place = F.when(F.col(value).isNotNull(), F.col(pos))
    moments = df.groupBy(*by).agg(
        F.count(value).alias("_n"),
        F.avg(value).alias("_my"),
        F.avg(place).alias("_mx"),
        F.var_pop(value).alias("_vy"),
        F.var_pop(place).alias("_vx"),
        F.covar_pop(value, place).alias("_cov"),
    )
    # Not regr_slope and corr: these raise on a constant series in ANSI mode.
    slope = F.try_divide(F.col("_cov"), F.col("_vx"))
    fit = moments.withColumns(
        {
            "slope": slope,
            "intercept": F.col("_my") - slope * F.col("_mx"),
            "rvalue": F.try_divide(F.col("_cov"), F.sqrt(F.col("_vx")) * F.sqrt(F.col("_vy"))),
        }
    )
    residual = (1 - F.col("rvalue") ** 2) * F.try_divide(F.col("_vy"), F.col("_vx"))
    stderr = F.sqrt(F.greatest(F.try_divide(residual, F.col("_n") - 2), F.lit(0.0)))
    return fit.withColumn("stderr", stderr).drop("_n", "_mx", "_my", "_vx", "_vy", "_cov")


_PART_AGGREGATES = {"mean": F.avg, "max": F.max, "min": F.min, "var": F.var_pop}


def agg_linear_trend(
    df: DataFrame, by: Sequence[str], value: str, part_rows: int = 10, pos: str = "pos", of: str = "mean"
) -> DataFrame:
    """Trend over an aggregate (mean, max, min or var) of consecutive parts of ``part_rows`` rows."""
    parts = df.groupBy(*by, chunk_of(pos, part_rows).alias("_part")).agg(_PART_AGGREGATES[of](value).cast("double").alias("_m"))
    return linear_trend(parts, by, "_m", "_part")


def fft_coefficients(
    df: DataFrame, by: Sequence[str], value: str, coefficients: Sequence[int] = (0, 1, 2), pos: str = "pos"
) -> DataFrame:
    """Real part, imaginary part, modulus and angle (in degrees) of single Fourier coefficients, as plain sums."""
    by = list(by)
    length = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    joined = attach(df.select(*by, pos, value), length, by, rows="_n")
    aggs = []
    for k in coefficients:
        # k * pos mod n keeps the angle small, and so exact, in long series.
        angle = F.lit(2.0 * np.pi) * F.pmod(F.lit(k) * F.col(pos), F.col("_n")) / F.col("_n")
        aggs.append(F.sum(F.col(value) * F.cos(angle)).alias(f"fft_{k}_real"))
        aggs.append((-F.sum(F.col(value) * F.sin(angle))).alias(f"fft_{k}_imag"))
    out = joined.groupBy(*by).agg(*aggs)
    out = out.withColumns(
        {f"fft_{k}_abs": F.sqrt(F.col(f"fft_{k}_real") ** 2 + F.col(f"fft_{k}_imag") ** 2) for k in coefficients}
    )
    return out.withColumns(
        {f"fft_{k}_angle": F.degrees(F.atan2(f"fft_{k}_imag", f"fft_{k}_real")) for k in coefficients}
    )


def permutation_entropy(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    dimension: int = 3,
    pos: str = "pos",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Entropy of the rank patterns of ``dimension`` consecutive values."""
    by = list(by)
    rows = framed(
        df.select(*by, pos, value),
        by,
        pos,
        dimension - 1,
        0,
        {"_w": lambda w: F.collect_list(value).over(w.rowsBetween(-(dimension - 1), 0))},
        chunk_rows=chunk_rows,
    ).filter(F.size("_w") == dimension)
    # Rank of element j: how many are smaller, or equal and earlier.
    digits = []
    for j in range(dimension):
        xj = F.get("_w", F.lit(j))
        rank = F.lit(0)
        for i in range(dimension):
            if i != j:
                xi = F.get("_w", F.lit(i))
                rank = rank + ((xi < xj) | ((xi == xj) & F.lit(i < j))).cast("int")
        digits.append(rank)
    pattern = F.lit(0)
    for d in digits:
        pattern = pattern * dimension + d
    counts = rows.groupBy(*by, pattern.alias("_pattern")).agg(F.count(F.lit(1)).alias("_c"))
    c = F.col("_c").cast("double")
    # -sum p ln p with p = c / N, written without N inside the sum.
    return counts.groupBy(*by).agg(
        (F.log(F.sum(c)) - F.sum(c * F.log(c)) / F.sum(c)).alias("permutation_entropy")
    )


def _spectrum(x: np.ndarray) -> dict[str, float]:
    y = np.abs(np.fft.rfft(x))
    k = np.arange(len(y))
    total = y.sum()
    nan = float("nan")
    if total == 0:
        return dict.fromkeys(
            ("fft_centroid", "fft_variance", "fft_skew", "fft_kurtosis"), nan
        )
    m1, m2, m3, m4 = (float((k**p) @ y / total) for p in (1, 2, 3, 4))
    var = m2 - m1**2
    skew = nan if var < 0.5 else (m3 - 3 * m1 * var - m1**3) / var**1.5
    kurt = nan if var < 0.5 else (m4 - 4 * m1 * m3 + 6 * m2 * m1**2 - 3 * m1**4) / var**2
    return {"fft_centroid": m1, "fft_variance": var, "fft_skew": skew, "fft_kurtosis": kurt}


def _approximate_entropy(x: np.ndarray, gap: np.ndarray | None, m: int, r: float) -> float:
    if len(x) <= m + 1:
        return 0.0
    fewer, more = (
        float(np.log(c / len(c)).mean()) for c in near_windows(x, gap, (m, m + 1), r * x.std())
    )
    return abs(fewer - more)


def _sample_entropy(x: np.ndarray, gap: np.ndarray | None, m: int = 2) -> float:
    if len(x) <= m + 1:
        return float("nan")
    tolerance = 0.2 * x.std()
    # As many windows of m as of m + 1 values.
    (b,) = near_windows(x[:-1], None if gap is None else gap[:-1, :-1], (m,), tolerance)
    (a,) = near_windows(x, gap, (m + 1,), tolerance)
    b, a = (b - 1).sum(), (a - 1).sum()
    return float(-np.log(a / b)) if a > 0 and b > 0 else float("nan")


def segment_features(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    segment_rows: int,
    pos: str = "pos",
    m: int = 2,
    r: float = 0.5,
) -> DataFrame:
    """Spectral moments and approximate and sample entropy of each segment of a series.

    A segment is ``segment_rows`` consecutive rows, so a group never holds more. The length is
    part of what the features mean, so it has no default. Every row belongs to a segment.

    Rows come to Python sorted by segment, many segments in one Arrow batch: a call per segment costs more than its
    features. A segment that a batch ends in waits for the next one.
    """
    by = [*by, "segment"]
    rows = df.filter(F.col(value).isNotNull()).select(
        *by[:-1], chunk_of(pos, segment_rows).alias("segment"), F.col(pos).alias("_p"),
        F.col(value).cast("double").alias("_v"),
    )
    rows = rows.withColumn("_row", F.row_number().over(Window.partitionBy(*by).orderBy("_p")))
    rows = rows.sortWithinPartitions(*by, "_row").select(*by, "_row", "_v")
    keys = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in by)
    names = [
        "fft_centroid", "fft_variance", "fft_skew", "fft_kurtosis", "approximate_entropy", "sample_entropy",
    ]
    schema = f"{keys}, n_rows bigint, " + ", ".join(f"{c} double" for c in names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room, held = np.empty(ALL_PAIRS * ALL_PAIRS), []
        for batch in batches:
            starts = np.flatnonzero(batch.column("_row").to_numpy() == 1)
            cut = int(starts[-1]) if len(starts) else 0
            held.append(batch.slice(0, cut))
            if len(starts):
                yield from features(held, room)
                held = []
            held.append(batch.slice(cut))
        yield from features(held, room)

    def features(held: list[pa.RecordBatch], room: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not sum(map(len, held)):
            return
        rows = pa.Table.from_batches(held)
        starts = np.flatnonzero(rows["_row"].to_numpy() == 1)
        segments = np.split(rows["_v"].to_numpy(), starts[1:])
        found = []
        for x in segments:
            gap = gaps(x, room)
            row = {**_spectrum(x), "approximate_entropy": _approximate_entropy(x, gap, m, r)}
            found.append(row | {"sample_entropy": _sample_entropy(x, gap)})
        out = rows.select(by).take(pa.array(starts))
        out = out.append_column("n_rows", pa.array([len(x) for x in segments], pa.int64()))
        for c in names:
            out = out.append_column(c, pa.array([f[c] for f in found], pa.float64(), from_pandas=True))
        yield from out.to_batches()

    return rows.mapInArrow(work, schema)
