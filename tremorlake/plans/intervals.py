"""As-of joins and intervals over series of any length.

The last mark at or before a reading is looked up, never searched among pairs. A small table of marks becomes one
sorted array per key, which is broadcast; a reading finds its place there by halving, and is not moved. A larger
one is sorted together with the readings, and the last mark is carried forward from row to row, across blocks
as in ``plans.positions``, so a device with a third of the data is not gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import BROADCAST_BYTES, attach_scalar, measured_bytes
from .positions import running_total
from .scratch import write_scratch


def count_at_most(values: Column, x: Column, steps: int) -> Column:
    """How many of the sorted ``values`` are at most ``x``, by ``steps`` halvings (enough for 2^steps - 1)."""

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        below = (s["low"] < s["high"]) & (F.get(values, middle) <= x)
        low = F.when(below, middle + 1).otherwise(s["low"])
        high = F.when((s["low"] < s["high"]) & ~below, middle).otherwise(s["high"])
        return F.struct(low.alias("low"), high.alias("high"))

    whole = F.struct(F.lit(0).alias("low"), F.coalesce(F.size(values), F.lit(0)).alias("high"))
    return F.aggregate(F.array_repeat(F.lit(0), steps), whole, halve, lambda s: s["low"])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_at: str,
    right_at: str,
    payload: Sequence[str],
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """All rows of ``left``, with the ``payload`` of the last row of ``right`` where right_at <= left_at.

    Both meet on ``keys``; a NULL key or time meets nothing. Of rows of ``right`` at one time the one with the largest
    payload counts. Rows of ``left`` without a match have NULLs.
    """
    keys = list(keys)
    names = [f"_k{i}" for i in range(len(keys))]
    marks = right.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        F.struct(F.col(right_at).cast(left.schema[left_at].dataType).alias("_at"), *payload).alias("_mark"),
    )
    for n in [*names, "_mark._at"]:
        marks = marks.filter(F.col(n).isNotNull())
    marks = write_scratch(marks, "marks")
    found = F.col("_found")
    if measured_bytes(marks.select(*names, "_mark.*")) <= limit:
        lists = marks.groupBy(*names).agg(F.sort_array(F.collect_list("_mark")).alias("_marks"))
        # The times as a stored array of their own: taken from the marks, they would be copied for every reading.
        lists = write_scratch(lists.withColumn("_ats", F.col("_marks._at")), "lists")
        longest = lists.agg(F.max(F.size("_marks"))).first()[0] or 0
        if keys:
            same = [F.col(k) == F.col(n) for k, n in zip(keys, names)]
            met = left.join(F.broadcast(lists), same, "left")
        else:
            met = attach_scalar(left, lists)
        place = count_at_most(F.col("_ats"), F.col(left_at), longest.bit_length())
        met = met.withColumn("_found", F.get("_marks", place - 1))
    else:
        rows = left.withColumns({n: F.col(k) for k, n in zip(keys, names)})
        rows = rows.withColumns({"_t": F.col(left_at), "_reading": F.lit(True)})
        marks = marks.withColumns({"_t": F.col("_mark._at"), "_reading": F.lit(False)})
        both = rows.unionByName(marks, allowMissingColumns=True)
        # Marks come in the order of time, so the last one is the largest so far.
        both = running_total(both, names, ["_t", "_reading"], F.col("_mark"), "_found", fold=F.max)
        met = both.filter("_reading")
        # What is carried to a NULL time or key is not a match.
        found = F.when(F.col("_found._at") <= F.col("_t"), found)
        for n in names:
            found = F.when(F.col(n).isNotNull(), found)
        met = met.withColumn("_found", found)
    return met.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"_found.{p}").alias(p) for p in payload])


def merge_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Disjoint closed intervals that cover the same points, per ``keys``.

    Intervals that touch become one. An interval that ends before it starts, or has a NULL, covers nothing.
    """
    keys = list(keys)
    rows = df.filter(F.col(start) <= F.col(end)).select(*keys, start, end)
    reach = running_total(rows, keys, [start, end], F.col(end), "_reach", fold=F.max)
    new = (F.col("_reach").isNull() | (F.col("_reach") < F.col(start))).cast("bigint")
    numbered = running_total(reach.withColumn("_new", new), keys, [start, end, "_new"], F.col("_new"), "_before")
    island = (F.col("_before") + F.col("_new")).alias("_island")
    merged = numbered.groupBy(*keys, island).agg(F.min(start).alias(start), F.max(end).alias(end))
    return merged.drop("_island")
