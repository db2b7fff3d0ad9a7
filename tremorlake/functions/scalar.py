"""Column expressions. All are JVM-side; none is a Python UDF."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_seconds(ts: Column | str) -> Column:
    """Text or timestamp -> TIMESTAMP cut to the second; unreadable text -> NULL."""
    return F.date_trunc("second", F.try_to_timestamp(_col(ts).cast("string")))


def iso_seconds_text(ts: Column | str) -> Column:
    """Text timestamp without its fraction of a second."""
    return F.substring_index(_col(ts), ".", 1)


def time_bucket(ts: Column | str, unit: str = "second") -> Column:
    return F.date_trunc(unit, _col(ts))


def round_to(c: Column | str, digits: int = 0) -> Column:
    """Half-up rounding, the one rounding rule used in this library."""
    return F.round(_col(c), digits)


def int_bucket(c: Column | str, digits: int = 0) -> Column:
    """Rounded value as an integer count of 10^-digits: equality is exact."""
    return F.round(_col(c) * F.lit(float(10**digits)), 0).cast("bigint")


def to_decimal(c: Column | str, precision: int = 10, scale: int = 0) -> Column:
    return _col(c).try_cast(f"decimal({precision},{scale})")


def zscore(value: Column | str, mean: Column, sd: Column, digits: int | None = 6) -> Column:
    """(x - mean) / sd. A constant signal scores 0, a NULL reading stays NULL."""
    v = _col(value)
    z = F.when(v.isNotNull() & (sd == 0), F.lit(0.0)).otherwise(F.try_divide(v - mean, sd))
    return z if digits is None else F.round(z, digits)


def abs_error(actual: Column | str, predicted: Column | str) -> Column:
    return F.abs(_col(actual) - _col(predicted))


def label_above(c: Column | str, threshold: Column | float) -> Column:
    """1 where the value exceeds the threshold, 0 where it does not, NULL for NULL."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return (_col(c) > t).cast("int")


def label_outside(c: Column | str, low: float, high: float) -> Column:
    v = _col(c)
    return ((v < F.lit(low)) | (v > F.lit(high))).cast("int")


def vector_element(vec: Column | str, i: int = 0, dtype: str = "float64") -> Column:
    """Element of an ML vector (0-based), NULL past its end."""
    return F.get(vector_to_array(_col(vec), dtype), F.lit(i))


def signed_axis(axis: Column, sign: Column, x: Column, y: Column, z: Column) -> Column:
    """Signed reading of the axis a device moves along; NULL without a mapping."""
    return sign * F.when(axis == "X", x).when(axis == "Y", y).when(axis == "Z", z)


def precision_expr(tp: Column | str, fp: Column | str) -> Column:
    return F.try_divide(_col(tp).cast("double"), (_col(tp) + _col(fp)).cast("double"))


def recall_expr(tp: Column | str, fn: Column | str) -> Column:
    return F.try_divide(_col(tp).cast("double"), (_col(tp) + _col(fn)).cast("double"))


def f1_expr(tp: Column | str, fp: Column | str, fn: Column | str) -> Column:
    """2PR/(P+R), written on the counts so that it is NULL only without any positive."""
    two_tp = F.lit(2.0) * _col(tp)
    return F.try_divide(two_tp, two_tp + _col(fp) + _col(fn))
