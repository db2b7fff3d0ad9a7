"""Moving averages and lag windows over dense positions (see ``plans.frames``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.frames import CHUNK_ROWS, framed


def moving_average(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    bucket: str | None,
    reach: int,
    pos: str = "pos",
    out: str = "moving_average",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Centred mean over ``reach`` rows either side, cut at the edges of ``bucket``."""
    return framed(
        df,
        keys,
        pos,
        reach,
        reach,
        {out: lambda w: F.avg(value).over(w.rowsBetween(-reach, reach))},
        within=[bucket] if bucket else [],
        chunk_rows=chunk_rows,
    )


def _mean_of(value: str, n: int, need: int):
    def mean(w):
        f = w.rowsBetween(-(n - 1), 0)
        return F.when(F.count(value).over(f) >= need, F.avg(value).over(f))

    return mean


def _last(value: str, steps: int):
    return lambda w: F.collect_list(value).over(w.rowsBetween(-steps, -1))


def rolling_mean(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    n: int,
    min_periods: int | None = None,
    pos: str = "pos",
    out: str = "rolling_mean",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Mean of the row and the ``n - 1`` before it; NULL below ``min_periods`` readings."""
    need = n if min_periods is None else min_periods
    return framed(df, keys, pos, n - 1, 0, {out: _mean_of(value, n, need)}, chunk_rows=chunk_rows)


def rolling_mean_single_task(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    order: Sequence[str],
    n: int,
    out: str = "rolling_mean",
) -> DataFrame:
    """The same mean as one plain window per series: for series known to be short."""
    from pyspark.sql import Window

    f = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(n - 1), 0)
    return df.withColumn(out, F.when(F.count(value).over(f) >= n, F.avg(value).over(f)))


def lag_windows(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    steps: int,
    pos: str = "pos",
    out: str = "window",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add the array of the ``steps`` values before each row; rows without a full one go.

    The row's own value is the next value of its window. A window never spans two series.
    """
    cut = framed(df, keys, pos, steps, 0, {out: _last(value, steps)}, chunk_rows=chunk_rows)
    return cut.filter(F.size(out) == steps)


def smoothed_windows(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    n: int,
    steps: int,
    pos: str = "pos",
    smoothed: str = "smoothed",
    out: str = "window",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``rolling_mean`` over ``n`` rows and ``lag_windows`` of it over ``steps``, in one shuffle."""
    cut = framed(
        df,
        keys,
        pos,
        n - 1 + steps,
        0,
        {smoothed: _mean_of(value, n, n)},
        {out: _last(smoothed, steps)},
        chunk_rows=chunk_rows,
    )
    return cut.filter(F.size(out) == steps)
