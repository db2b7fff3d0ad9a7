"""Top rows per group: a small k in two rounds, a large one behind a threshold on the values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import attach, attach_scalar, join_series
from .positions import with_position
from .scratch import write_scratch

_SALTS = 256
#: Accuracy of the sketch, and the shares of a group's rows at which it is asked: 1/2, 1/4, ...
_ACCURACY = 10_000
_HALVINGS = 30


def top_k(
    df: DataFrame,
    k: int,
    order: Sequence[Column],
    by: Sequence[str] = (),
    rank: str | None = None,
) -> DataFrame:
    """The first ``k`` rows along ``order``, per ``by`` if given.

    ``order`` must be total, or ties are broken arbitrarily. Spark applies the row-number filter
    before the shuffle too, so a map task sends ``k`` rows per group. The salt is the map task's
    number: the first round merges the tasks of one salt, the second at most ``k`` rows per salt.
    """
    if not by:
        top = df.orderBy(*order).limit(k)
        return top if rank is None else top.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    keys = list(by)
    salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
    first = Window.partitionBy(*keys, "_salt").orderBy(*order)
    last = Window.partitionBy(*keys).orderBy(*order)
    name = rank or "_rank"
    out = (
        salted.withColumn("_r", F.row_number().over(first))
        .filter(F.col("_r") <= k)
        .drop("_r", "_salt")
        .withColumn(name, F.row_number().over(last).cast("bigint"))
        .filter(F.col(name) <= k)
    )
    return out if rank else out.drop(name)


def top_k_threshold(
    df: DataFrame,
    k: int,
    value: str,
    by: Sequence[str] = (),
    ties: Sequence[str] = (),
    descending: bool = True,
    rank: str | None = None,
    accuracy: int = _ACCURACY,
) -> DataFrame:
    """The first ``k`` rows by ``value`` (NULL last), then ``ties``, per ``by``; for a ``k`` of any size.

    A mergeable sketch brackets the k-th value of each group from below: at most about twice ``k`` rows (and a
    2/``accuracy`` of the group) reach the threshold, and only they are shuffled and ranked, by a distributed
    position. A group that the sketch cut too short is taken whole. ``ties`` should make the order total.
    """
    keys = list(by)
    names = [f"_g{i}" for i in range(len(keys))]
    sign = 1 if descending else -1
    number = F.col(value)
    if isinstance(df.schema[value].dataType, T.TimestampType | T.TimestampNTZType | T.DateType):
        number = F.unix_micros(number.cast("timestamp"))
    rows = df.withColumns({**{n: F.col(b) for n, b in zip(names, keys)}, "_v": number.cast("double") * sign})
    # NULL and NaN take no part in the sketch; NaN is the largest value of all.
    sketched = F.when(~F.isnan("_v"), F.col("_v"))
    shares = [0.5 ** (i + 1) for i in range(_HALVINGS)]
    sizes = rows.groupBy(*names).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(sketched).alias("_m"),
        F.percentile_approx(sketched, [1 - s for s in shares], accuracy).alias("_p"),
    )
    # The smallest share of the group that surely holds k rows, whatever the sketch's error in rank.
    sure = F.array(*[F.col("_m") * (s - 2.0 / accuracy) >= k for s in shares])
    pick = F.aggregate(sure, F.lit(0), lambda a, x: a + x.cast("int"))
    cut = sizes.select(*names, "_n", F.when(pick > 0, F.get("_p", pick - 1)).alias("_cut"))
    cut = write_scratch(cut, "thresholds")
    met = attach(rows, cut, names, rows="_n") if keys else attach_scalar(rows, cut)
    reached = F.col("_cut").isNull() | (F.col("_v") >= F.col("_cut"))
    kept = write_scratch(met.filter(reached), "reached")
    had = kept.groupBy(*names).agg(F.count(F.lit(1)).alias("_had"))
    had = join_series(cut, had, names).withColumn("_had", F.coalesce("_had", F.lit(0)))
    short = had.filter(F.col("_had") < F.least("_n", F.lit(k)))
    short = write_scratch(short.select(*names, F.lit(1).cast("bigint").alias("_whole")), "short")
    if not short.isEmpty():
        some = attach(kept, short, names, rows="_whole").filter("_whole is null")
        kept = some.unionByName(attach(met, short, names, rows="_whole", how="inner")).drop("_whole")
    tied = [f"_t{i}" for i in range(len(ties))]
    kept = kept.withColumns({"_class": _class(F.col("_v"), descending), **{t: F.col(c) for t, c in zip(tied, ties)}})
    kept = kept.withColumn("_down", _ascending(F.col(value), df.schema[value].dataType, descending)).drop("_v", "_cut", "_n")
    top = with_position(kept, names, ["_class", "_down", *tied], "_pos").filter(F.col("_pos") < k)
    out = [F.col(f"`{c}`") for c in df.columns]
    return top.select(*out, *([(F.col("_pos") + 1).alias(rank)] if rank else []))


def _class(value: Column, descending: bool) -> Column:
    """NULL comes last; NaN is the largest value."""
    return F.when(value.isNull(), 3).when(F.isnan(value), 0 if descending else 2).otherwise(1)


def _ascending(value: Column, kind: T.DataType, descending: bool) -> Column:
    """Numbers that rise along the order, so that one range sort serves both directions."""
    if isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType):
        value = F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, T.LongType):
        value = value.cast("decimal(20,0)")  # the smallest has no negative of its own kind
    return -value if descending else value
