"""Running totals and dense row positions that survive a hot series.

``sum() over (partition by device order by ...)`` puts a whole device into one task.
Here each series is cut into *blocks* that follow its order: the block totals are
added up first (one row per block), then every block starts from its own offset. The
offset travels as a header row of the block, so there is one shuffle of the data, no
join and nothing broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import BROADCAST_BYTES, measured_bytes
from .scratch import write_scratch

_BLOCK, _HEAD, _W, _ROW = "_block", "_head", "_w", "_row"


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weight: Column,
    out: str,
    block: Column | None = None,
    fold: Callable[[str], Column] = F.sum,
) -> DataFrame:
    """Add ``out``: the total of ``weight`` over the rows that come before, per ``keys``.

    ``fold`` may be another aggregate that combines with itself, such as ``F.max``; before the first row a
    sum is 0, anything else NULL.

    ``order`` must be a total order within ``keys``. ``block`` is an expression that never
    decreases along ``order`` and of which each value covers a bounded number of rows of
    one key, such as ``index div 1048576`` for an index that is unique per device. Without
    one, the rows are range-sorted on (keys, order) and written once; a block is then a
    partition of that sort, whatever the distribution of the data.
    """
    return running_totals(df, keys, order, {out: weight}, block, fold)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weights: Mapping[str, Column],
    block: Column | None = None,
    fold: Callable[[str], Column] = F.sum,
) -> DataFrame:
    """``running_total`` of several weights at once, by the names of their totals."""
    keys, order = list(keys), list(order)
    rows = df.withColumns({f"{_W}{i}": w for i, w in enumerate(weights.values())})
    if block is None:
        rows = _sorted_blocks(rows, keys, order).drop(_ROW)
    else:
        rows = rows.withColumn(_BLOCK, block)
    return _from_heads(rows, keys, order, list(weights), fold)


def _sorted_blocks(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Range-sorted rows, written with their partition and their number in the sort."""
    by = [*keys, *order]
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by)
    return write_scratch(
        rows.withColumns({_BLOCK: F.spark_partition_id(), _ROW: F.monotonically_increasing_id()}), "sorted"
    )


def _from_heads(
    rows: DataFrame, keys: list[str], order: list[str], outs: list[str], fold: Callable[[str], Column] = F.sum
) -> DataFrame:
    along = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    ws = [f"{_W}{i}" for i in range(len(outs))]

    def before(w: str) -> Column:
        total = fold(f"_t{w}").over(along)
        if fold is F.sum:
            total = F.coalesce(total, F.lit(0).cast("double"))
        return total.cast(rows.schema[w].dataType)

    heads = (
        rows.groupBy(*keys, _BLOCK)
        .agg(*[fold(w).alias(f"_t{w}") for w in ws])
        .withColumns({w: before(w) for w in ws})
        .drop(*[f"_t{w}" for w in ws])
        .withColumn(_HEAD, F.lit(True))
    )
    within = (
        Window.partitionBy(*keys, _BLOCK)
        .orderBy(F.desc(_HEAD), *order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn(_HEAD, F.lit(False))
        .unionByName(heads, allowMissingColumns=True)
        .withColumns({out: fold(w).over(within) for out, w in zip(outs, ws)})
        .filter(~F.col(_HEAD))
        .drop(_BLOCK, _HEAD, *ws)
    )


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "pos",
    block: Column | None = None,
) -> DataFrame:
    """Add the 0-based, gap-free position of each row in its series. Arguments as above."""
    one = F.lit(1).cast("bigint")
    if block is not None:
        return running_total(df, keys, order, one, out, block)
    keys = list(keys)
    rows = _sorted_blocks(df, keys, list(order))
    # The sort has numbered the rows: a series only lacks how many rows it has in earlier blocks,
    # one number per (series, partition).
    along = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*keys, _BLOCK)
        .agg(F.count(F.lit(1)).alias("_t"), F.min(_ROW).alias("_first"))
        .withColumn("_shift", F.coalesce(F.sum("_t").over(along), F.lit(0)) - F.col("_first"))
        .drop("_t", "_first")
    )
    starts = write_scratch(starts, "starts")
    if measured_bytes(starts) > BROADCAST_BYTES:
        return _from_heads(rows.drop(_ROW).withColumn(f"{_W}0", one), keys, list(order), [out])
    theirs = starts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, _BLOCK])], "_shift")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate([*keys, _BLOCK])]
    joined = rows.join(F.broadcast(theirs), same)
    return joined.select(*df.columns, (F.col(_ROW) + F.col("_shift")).alias(out))
