"""Joining rows with statistics of their own group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import write_scratch

BROADCAST_BYTES = 64 << 20
_CELL_BYTES = 16


def attach_scalar(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row.

    The aggregate becomes one scalar subquery: no join, and no trip through user code on
    the driver.
    """
    names = stats.columns
    row = stats.select(F.struct(*names).alias("_row"))
    return df.withColumn("_row", row.scalar()).select(
        *df.columns, *[F.col(f"_row.{n}").alias(n) for n in names]
    )


def measured_bytes(df: DataFrame) -> int:
    """Size of a written table, measured: fixed-width cells plus the text they hold."""
    text = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType))]
    extra = [F.coalesce(F.sum(F.octet_length(F.col(c).cast("string"))), F.lit(0)) for c in text]
    row = df.agg(F.count(F.lit(1)), *extra).first()
    return row[0] * _CELL_BYTES * (len(df.columns) + 1) + sum(row[1:])


def attach(
    df: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    rows: str,
    how: str = "left",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``df`` with ``stats``, a table with one row per ``keys``.

    ``stats`` is written and its size measured. Up to ``limit`` bytes it is broadcast, and
    ``df`` is not shuffled. Beyond that only the groups with the most rows (as many as fit
    the limit; ``rows`` names the count column) are broadcast, and the other groups, each at
    most a 1/k-th of the data, meet ``df`` in a shuffle join from which the rows that are
    already served are spread away by a salt. NULL keys have statistics of their own. The result has the
    columns of ``df`` and then those of ``stats``, whichever way is taken.
    """
    keys = list(keys)
    values = [c for c in stats.columns if c not in keys]
    table = write_scratch(stats, "stats")
    size = measured_bytes(table)
    side = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]

    same: list[Column] = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]

    if size <= limit:
        joined = df.join(F.broadcast(table.select(*side, F.struct(*values).alias("_st"))), same, how)
    else:
        per_row = max(size // max(table.count(), 1), 1)
        most = table.orderBy(F.desc(rows), *keys).limit(max(limit // per_row, 1))
        hot = write_scratch(most.select(*side, F.struct(*values).alias("_hot")), "hot")
        cold = table.join(F.broadcast(hot.drop("_hot")), same, "left_anti")
        cold = cold.select(*side, F.struct(*values).alias("_cold"), F.lit(-1).cast("bigint").alias("_kk"))
        served = df.join(F.broadcast(hot), same, "left").drop(*[f"_k{i}" for i in range(len(keys))])
        # Rows that are served meet nothing below; numbering them spreads even equal rows of one key.
        number = F.when(F.col("_hot").isNotNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1).cast("bigint"))
        served = served.withColumn("_salt", number)
        joined = served.join(cold, [*same, F.col("_salt") == F.col("_kk")], "left")
        joined = joined.withColumn("_st", F.coalesce("_hot", "_cold"))
        if how == "inner":
            joined = joined.filter(F.col("_st").isNotNull())
    return joined.select(*df.columns, *[F.col(f"_st.{v}").alias(v) for v in values])


def join_series(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Columns of ``right`` next to every row of ``left``; both have one row per ``keys``, and NULL meets NULL."""
    side = right.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = left.join(side, same, "left") if keys else left.crossJoin(side)
    return joined.drop(*[f"_k{i}" for i in range(len(keys))])
