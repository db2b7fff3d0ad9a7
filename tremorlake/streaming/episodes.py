"""Event-time counts of anomalies per device."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def anomaly_counts(
    outliers: DataFrame,
    device: str,
    ts: str,
    window: str = "1 second",
    slide: str | None = None,
    delay: str = "10 minutes",
    min_count: int = 5,
) -> DataFrame:
    """Windows of a device with strictly more than ``min_count`` outliers.

    Tumbling, or sliding with ``slide``. On a stream in append mode a window appears once the
    watermark has passed its end; later rows are dropped and reported in the query progress.
    """
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    return _counts(outliers.withWatermark(ts, delay), device, span, min_count)


def anomaly_sessions(
    outliers: DataFrame, device: str, ts: str, gap: str = "5 seconds", delay: str = "10 minutes", min_count: int = 5
) -> DataFrame:
    """The same over bursts of outliers separated by at least ``gap``."""
    return _counts(outliers.withWatermark(ts, delay), device, F.session_window(ts, gap), min_count)


def _counts(rows: DataFrame, device: str, span, min_count: int) -> DataFrame:
    return (
        rows.groupBy(span.alias("_w"), device)
        .agg(F.count(F.lit(1)).alias("n_outliers"))
        .filter(F.col("n_outliers") > min_count)
        .select(
            device,
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "n_outliers",
        )
    )


def late_rows(query) -> int:
    """Rows that the watermark dropped so far, from the progress of a query."""
    return sum(
        op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"]
    )
