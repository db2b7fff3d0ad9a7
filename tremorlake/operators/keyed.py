"""Tables keyed by (device, index), with last-write-wins updates.

A keyed table on storage is a log: each batch adds one ``batch_id=N`` folder, so a write costs
what the batch costs and replaying a batch replaces only its own folder. Readers resolve the
newest version of each key; ``compact`` does it once for all.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import write_scratch
from .stats import extremes


#: Types that a hash aggregate can hold in place.
_FIXED = (T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _one_order(df: DataFrame, version: Sequence[str]) -> Column | None:
    """Up to two whole numbers or times as one number that orders alike, NULL being the smallest."""
    parts = []
    for c in version:
        kind = df.schema[c].dataType
        if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
            parts.append(F.unix_micros(F.col(c).cast("timestamp")))
        elif isinstance(kind, T.IntegralType):
            parts.append(F.col(c))
        else:
            return None
    # A long has 19 digits, and the smallest is no value that anything counts up to.
    longs = [F.coalesce(p.cast("bigint"), F.lit(-(1 << 63))) for p in parts]
    if len(longs) == 1:
        return longs[0]
    if len(longs) != 2:
        return None
    shift = F.lit(Decimal(10**19)).cast("decimal(20,0)")
    return (longs[0].cast("decimal(19,0)") * shift + longs[1].cast("decimal(19,0)")).cast("decimal(38,0)")


def latest_version(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The newest row of each key: an aggregate, so copies of a hot key meet map-side.

    Where the version is one or two whole numbers or times and the other columns have a fixed width, it is a hash
    aggregate, and nothing is sorted.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = _one_order(df, version)
    if order is not None and all(isinstance(df.schema[c].dataType, _FIXED) for c in rest):
        newest = df.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in rest])
        return newest.select(*df.columns)
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("_row"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def upsert(
    base: DataFrame, updates: DataFrame, keys: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """Base with updates applied; of several rows with one key the highest version stays.

    At equal versions an update beats the base.
    """
    both = base.withColumn("_src", F.lit(0)).unionByName(updates.withColumn("_src", F.lit(1)))
    return latest_version(both, keys, [*version, "_src"]).drop("_src")


def merge_newer(base: DataFrame, updates: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """One row per key of two tables that have one row per key: the higher version, or the update at equal ones.

    The sides meet by a hash join on the keys, which are never NULL. A side that is dealt by the keys already, as a
    bucketed table is, is neither shuffled nor sorted.
    """
    columns = base.columns
    old = base.select(*[F.col(c).alias(f"_o_{c}") for c in columns], F.lit(True).alias("_old"))
    new = updates.select(*[F.col(c).alias(f"_n_{c}") for c in columns], F.lit(True).alias("_new"))
    same = [F.col(f"_o_{k}") == F.col(f"_n_{k}") for k in keys]
    both = old.join(new.hint("shuffle_hash"), same, "full_outer")
    stays = F.col("_new").isNull() | (F.col("_old").isNotNull() & (F.col(f"_o_{version}") > F.col(f"_n_{version}")))
    return both.select(*[F.when(stays, F.col(f"_o_{c}")).otherwise(F.col(f"_n_{c}")).alias(c) for c in columns])


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of the log; a second write of the same batch replaces the first."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def read_keyed(
    spark: SparkSession, path: str, keys: Sequence[str], version: Sequence[str] = ("batch_id",)
) -> DataFrame:
    """Current state of a keyed table."""
    return latest_version(read_log(spark, path), keys, version)


def compact(spark: SparkSession, path: str, target: str, keys: Sequence[str], version: Sequence[str] = ("batch_id",),
            partition_by: Sequence[str] = ()) -> None:
    """Write the current state, range-sorted by key, to ``target`` (never the folder it reads)."""
    state = read_keyed(spark, path, keys, version)
    state = state.repartitionByRange(*keys).sortWithinPartitions(*keys)
    state.write.mode("overwrite").partitionBy(*partition_by).parquet(target)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    version: Sequence[str],
    partition: str,
) -> None:
    """Merge updates into a table partitioned by ``partition``; other partitions stay as they are.

    The merged partitions are staged first, so no folder is overwritten while it is read. Folders are replaced one after the other, not as one
    transaction; a writer that needs that uses ``append_batch``.
    """
    staged_updates = write_scratch(updates, "updates")
    touched = write_scratch(staged_updates.select(partition).distinct(), "touched")
    base = spark.read.parquet(path)
    base = base.withColumn(partition, F.col(partition).cast(updates.schema[partition].dataType))
    affected = base.join(touched, partition, "left_semi")
    merged = write_scratch(upsert(affected.select(*updates.columns), staged_updates, keys, version), "merged")
    (
        merged.repartitionByRange(partition, *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def point_lookup(df: DataFrame, device: str, device_value, index: str, index_value) -> DataFrame:
    return df.filter((F.col(device) == device_value) & (F.col(index) == index_value))


def range_lookup(df: DataFrame, device: str, device_value, index: str, low, high) -> DataFrame:
    """Readings of one device with low <= index <= high, as a filter that reaches the scan."""
    return df.filter((F.col(device) == device_value) & F.col(index).between(low, high))


def latest_n(df: DataFrame, device: str, index: str, n: int = 500, device_value=None) -> DataFrame:
    """The last ``n`` readings of one device, or of every device."""
    if device_value is not None:
        return extremes(df.filter(F.col(device) == device_value), index, n, [])
    return extremes(df, index, n, [], by=[device])


def anomaly_overlay(df: DataFrame, label: str = "label") -> DataFrame:
    return df.filter(F.col(label) > 0)


def incremental_slice(
    df: DataFrame, cursor: DataFrame, device: str, index: str, n: int, rewind: int = 0
) -> DataFrame:
    """Readings of the next run: cursor - rewind <= index <= cursor - rewind + n, per device.

    ``cursor`` has (device, next_index). A device without a cursor starts at 0.
    """
    from ..plans import attach

    marks = cursor.select(device, F.col("next_index").alias("_at"), F.lit(1).alias("_n"))
    start = F.greatest(F.coalesce("_at", F.lit(0)) - rewind, F.lit(0))
    joined = attach(df, marks, [device], rows="_n")
    return joined.filter(F.col(index).between(start, start + n)).drop("_at", "_n")


def advance_cursor(processed: DataFrame, cursor: DataFrame, device: str, index: str) -> DataFrame:
    """Cursor after a run: one past the highest index that was really read, never backwards."""
    seen = processed.groupBy(device).agg((F.max(index) + 1).alias("next_index"))
    return cursor.select(device, "next_index").unionByName(seen).groupBy(device).agg(
        F.max("next_index").alias("next_index")
    )
