"""Exact quantiles without gathering a group in one task.

Spark's ``percentile`` keeps all distinct values of a group in one buffer. It is used
here only for groups of bounded size. A larger group is bracketed by ``percentile_approx``
(mergeable, bounded memory); only the rows inside the bracket, a fixed small share of the
group, are counted by value and ranked with a distributed running total.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import attach, attach_scalar
from .positions import running_total
from .scratch import write_scratch

ACCURACY = 10_000
SMALL_GROUP = 200_000


def _pick(ranked: DataFrame, by: list[str], quantiles: Mapping[str, float], linear: bool) -> DataFrame:
    at = F.element_at(F.array(*[F.lit(float(q)) for q in quantiles.values()]), F.col("_i") + 1)
    if linear:
        place = at * (F.col("_n") - 1)
        low, high = F.floor(place), F.ceil(place)
    else:
        low = high = F.greatest(F.ceil(at * F.col("_n")) - 1, F.lit(0))
        place = low

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_c")), F.col("_v")))

    picked = ranked.groupBy(*by, "_i").agg(
        value_at(low).alias("_a"),
        value_at(high).alias("_b"),
        F.first(place - low).alias("_f"),
        F.first(high - place).alias("_g"),
    )
    # As Spark's own percentile interpolates, so that a group's size does not show in the last digit.
    between = F.when(F.col("_f") == 0, F.col("_a")).otherwise(F.col("_g") * F.col("_a") + F.col("_f") * F.col("_b"))
    lost = F.raise_error(F.lit("the bracket of a quantile does not cover its rank")).cast("double")
    result = F.when(F.col("_a").isNull() | F.col("_b").isNull(), lost).otherwise(between)
    return picked.groupBy(*by).agg(
        *[F.max(F.when(F.col("_i") == i, result)).alias(name) for i, name in enumerate(quantiles)]
    )


def _bracketed(
    rows: DataFrame, by: list[str], quantiles: Mapping[str, float], linear: bool, accuracy: int
) -> DataFrame:
    """Quantiles of groups of which each has more rows than ``accuracy``."""
    # The rank error of a bracket end is at most n/accuracy; 2/accuracy leaves room for both
    # that and the difference between q*n and q*(n-1).
    margin = 2.0 / accuracy
    ends = [p for q in quantiles.values() for p in (max(q - margin, 0.0), min(q + margin, 1.0))]
    brackets = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", ends, accuracy).alias("_p")
    )
    joined = attach(rows, brackets, by, rows="_n", how="inner") if by else attach_scalar(rows, brackets)
    slots = []
    for i in range(len(quantiles)):
        lo, hi = F.get("_p", F.lit(2 * i)), F.get("_p", F.lit(2 * i + 1))
        # Rows below the bracket count as one NULL value, which sorts first.
        inner = F.when(F.col("_v") >= lo, F.col("_v"))
        slots.append(F.struct(F.lit(i).alias("_i"), inner.alias("_in"), (F.col("_v") <= hi).alias("_keep")))
    counted = (
        joined.select(*by, "_n", F.inline(F.array(*slots)))
        .filter("_keep")
        .groupBy(*by, "_i", F.col("_in").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"))
    )
    ranked = running_total(counted, [*by, "_i"], ["_v"], F.col("_c"), "_before")
    return _pick(ranked, by, quantiles, linear)


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    by: Sequence[str] = (),
    linear: bool = True,
    small_group: int = SMALL_GROUP,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One column per entry of ``quantiles`` (name -> q); one row per ``by``.

    ``linear`` interpolates between neighbours; otherwise the smallest value that at least
    a q-th of the rows do not exceed. NULL values are left out.
    """
    by = list(by)
    if small_group < accuracy:
        raise ValueError("the bracket is only proven for groups larger than the accuracy")
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    if by:
        counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
        large = write_scratch(counts.filter(F.col("_size") > small_group), "large-groups")
        any_large = not large.isEmpty()
    else:
        any_large = rows.count() > small_group

    def small(part: DataFrame) -> DataFrame:
        if linear:
            exprs = [F.percentile("_v", q).alias(n) for n, q in quantiles.items()]
            return part.groupBy(*by).agg(*exprs)
        disc = [
            F.expr(f"percentile_disc({float(q)!r}) within group (order by _v)").alias(n)
            for n, q in quantiles.items()
        ]
        return part.groupBy(*by).agg(*disc)

    if not any_large:
        return small(rows)
    if not by:
        return _bracketed(rows, by, quantiles, linear, accuracy)
    sized = attach(rows, large, by, rows="_size")
    hot = sized.filter(F.col("_size").isNotNull()).drop("_size")
    cold = sized.filter(F.col("_size").isNull()).drop("_size")
    return _bracketed(hot, by, quantiles, linear, accuracy).unionByName(small(cold))
