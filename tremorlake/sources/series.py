"""Series laid out once at ingest, so that later window operators need a single shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ..plans import with_position


def write_series(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    pos: str = "pos",
    block: Column | None = None,
) -> None:
    """Store readings with their position, range-sorted by (keys, position).

    A hot device spans many files, and a lookup by device and position skips the others by the
    statistics of their footers.
    """
    rows = with_position(df, keys, order, pos, block)
    by = [*keys, pos]
    rows.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def read_series(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
