"""Filtering, projection and typing of readings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import int_bucket, signed_axis, round_to
from ..plans import attach, attach_scalar

# The axis along which each device travels, and its direction.
AXIS_MAP = [
    (1, "Z", 1),
    (2, "Z", 1),
    (3, "X", 1),
    (4, "Z", -1),
    (5, "X", 1),
    (6, "Z", -1),
    (7, "Z", 1),
    (8, "X", -1),
    (9, "Z", -1),
    (10, "Z", -1),
    (11, "X", 1),
    (12, "Y", -1),
    (13, "Z", -1),
    (14, "X", -1),
    (15, "Z", 1),
]


def default_axis_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AXIS_MAP, "device_id int, axis string, sign int")


def time_range(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Rows with start <= ts <= end. Literals are typed like ``ts``, so the bounds reach the scan."""
    kind = df.schema[ts].dataType
    return df.filter(F.col(ts).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def value_band(df: DataFrame, value: str, low: float, high: float, closed: bool = False) -> DataFrame:
    v = F.col(value)
    return df.filter((v >= low) & (v <= high) if closed else (v > low) & (v < high))


def tails(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """Rows strictly below ``low`` or strictly above ``high``."""
    return df.filter((F.col(value) > high) | (F.col(value) < low))


def in_bucket(df: DataFrame, value: str, bucket: float, digits: int = 0) -> DataFrame:
    """Rows whose value rounds to ``bucket``, compared as integers.

    A slightly wider band is tested too, because a plain band reaches the scan.
    """
    number = round(bucket * 10**digits)
    low, high = (number - 0.501) / 10**digits, (number + 0.501) / 10**digits
    return df.filter(F.col(value).between(low, high) & (int_bucket(value, digits) == F.lit(number)))


def canonical_axis(
    df: DataFrame,
    axis_map: DataFrame,
    device: str = "device_id",
    axes: Sequence[str] = ("X", "Y", "Z"),
    out: str = "value",
) -> DataFrame:
    """Add the signed reading of the device's own axis; NULL for a device without an entry.

    A device has one entry in ``axis_map`` at most; two are an error, not two rows per reading.
    """
    x, y, z = (F.col(a) for a in axes)
    twice = axis_map.groupBy("device_id").count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"the axis map has several entries for devices {[r['device_id'] for r in twice]}")
    lookup = axis_map.select(
        F.col("device_id").cast(df.schema[device].dataType).alias(device),
        F.col("axis").alias("_axis"),
        F.col("sign").alias("_sign"),
        F.lit(1).alias("_n"),
    )
    joined = attach(df, lookup, [device], rows="_n")
    return joined.withColumn(out, signed_axis(F.col("_axis"), F.col("_sign"), x, y, z)).drop(
        "_axis", "_sign", "_n"
    )


def unmapped_devices(df: DataFrame, axis_map: DataFrame, device: str = "device_id") -> DataFrame:
    """Devices that have readings but no axis, with the number of their readings."""
    counts = df.groupBy(device).agg(F.count(F.lit(1)).alias("n_rows"))
    known = axis_map.select(F.col("device_id").cast(df.schema[device].dataType).alias(device))
    return counts.join(known, device, "left_anti")


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)


def fill_constant(df: DataFrame, values: Mapping[str, float | int | str]) -> DataFrame:
    return df.na.fill(dict(values))


def fill_mean(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Replace NULL by the mean, overall or of the row's own group."""
    by = list(by)
    stats = df.groupBy(*by).agg(F.avg(value).alias("_mean"), F.count(F.lit(1)).alias("_n"))
    joined = attach(df, stats, by, rows="_n") if by else attach_scalar(df, stats)
    return joined.withColumn(value, F.coalesce(value, "_mean")).select(*df.columns)


def rounded(df: DataFrame, value: str, out: str, digits: int = 0, kind: str = "double") -> DataFrame:
    """Add the half-up rounded value as ``kind``: double, int, bigint, decimal(10,0) or string."""
    return df.withColumn(out, round_to(value, digits).try_cast(kind))


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))


def skip_first(df: DataFrame, n: int, pos: str = "pos") -> DataFrame:
    """All but the first ``n`` rows of each series (``pos`` as given by ``with_position``)."""
    return df.filter(F.col(pos) >= n)


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(*columns).distinct() if columns else df.distinct()


def union_devices(*frames: DataFrame) -> DataFrame:
    """Frames of single devices as one, matched by column name."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
