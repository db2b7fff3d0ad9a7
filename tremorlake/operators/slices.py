"""Rows that fall into listed time slices, such as hand-picked normal operation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import asof_join, merge_intervals
from ..plans.joins import BROADCAST_BYTES


def in_slices(
    df: DataFrame,
    slices: DataFrame,
    ts: str,
    device: str | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows with start <= ts <= end for some slice (of the same device); each row once.

    ``slices`` has ``slice_start`` and ``slice_end`` (and ``device``), in any order and overlapping. They are
    merged to disjoint ones, so the last that starts at or before a row is the only one that can hold it.
    """
    kind = df.schema[ts].dataType
    keys = [device] if device else []
    cut = slices.select(
        *[F.col(k).alias("_dev") for k in keys],
        F.col("slice_start").cast(kind).alias("_from"),
        F.col("slice_end").cast(kind).alias("_to"),
    )
    merged = merge_intervals(cut, ["_dev"] if device else [], "_from", "_to")
    rows = df.withColumn("_dev", F.col(device)) if device else df
    met = asof_join(rows, merged, ["_dev"] if device else [], ts, "_from", ["_to"], limit)
    return met.filter(F.col("_to") >= F.col(ts)).select(*[F.col(f"`{c}`") for c in df.columns])
