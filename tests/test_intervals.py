"""As-of joins and merged intervals against plain loops."""

import random

import pytest

from pyspark.sql import functions as F

from tremorlake.operators.slices import in_slices
from tremorlake.plans import asof_join, merge_intervals
from tremorlake.plans.intervals import count_at_most

LIMITS = [1 << 26, 0]


def tables(seed, marks=60):
    random.seed(seed)
    device = lambda: random.choice(["a", "a", "a", "b", "c", None])
    left = [(device(), random.choice([None, *range(40)]), i) for i in range(200)]
    right = [(device(), random.choice([None, *range(0, 40, 3)]), random.randint(0, 5), f"p{i}") for i in range(marks)]
    return left, right


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("marks", [60, 1, 0])
def test_asof_join(spark, limit, marks):
    left, right = tables(marks, marks)
    l_df = spark.createDataFrame(left, "dev string, t int, id int").repartition(3)
    r_df = spark.createDataFrame(right, "dev string, rt int, v int, name string")
    got = asof_join(l_df, r_df, ["dev"], "t", "rt", ["v", "name"], limit)
    assert got.columns == ["dev", "t", "id", "v", "name"]
    want = []
    for dev, t, i in left:
        found = [(rt, v, n) for d, rt, v, n in right if d == dev and d is not None and rt is not None and t is not None and rt <= t]
        want.append((dev, t, i, *(max(found)[1:] if found else (None, None))))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    # Without a key all marks are one series.
    got = asof_join(l_df, r_df.select("rt", "v", "name"), [], "t", "rt", ["v", "name"], limit)
    for dev, t, i, v, n in got.collect():
        found = [(rt, x, m) for _, rt, x, m in right if rt is not None and t is not None and rt <= t]
        assert (v, n) == (max(found)[1:] if found else (None, None))


def test_count_at_most(spark):
    for size in range(9):
        values = list(range(1, 2 * size, 2))
        df = spark.range(-1, 2 * size + 2).withColumn("v", F.array(*[F.lit(x) for x in values]).cast("array<bigint>"))
        got = df.select("id", count_at_most(F.col("v"), F.col("id"), size.bit_length()).alias("n")).collect()
        assert all(r.n == sum(x <= r.id for x in values) for r in got)


@pytest.mark.parametrize("limit", LIMITS)
def test_slices_and_their_union(spark, limit):
    random.seed(4)
    slices = [(random.choice("ab"), s, s + random.randint(-3, 9)) for s in random.choices(range(200), k=60)]
    slices += [("a", None, 3), ("b", 5, None), (None, 0, 500), slices[0]]
    rows = [(random.choice(["a", "b", "z", None]), random.choice([None, *range(220)]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "dev string, t int, id int").repartition(4)
    cut = spark.createDataFrame(slices, "dev string, slice_start int, slice_end int")
    inside = lambda d, t: any(x == d and a <= t <= b for x, a, b in slices if x and a is not None and b is not None)
    want = [r for r in rows if r[0] and r[1] is not None and inside(r[0], r[1])]
    assert sorted(map(tuple, in_slices(df, cut, "t", "dev", limit).collect())) == sorted(want)
    merged = [tuple(r) for r in merge_intervals(cut.filter("dev is not null"), ["dev"], "slice_start", "slice_end").collect()]
    points = {(d, t) for d, a, b in merged for t in range(a, b + 1)}
    assert points == {(d, t) for d in "ab" for t in range(-5, 300) if inside(d, t)}
    last = {}
    for d, a, b in sorted(merged):
        assert a <= b and last.get(d, -1) < a
        last[d] = b


def test_a_day_full_of_slices_takes_one_pass(spark):
    """Neither pairs by day nor a second reading of the rows, and a broadcast leaves them where they are."""
    df = spark.range(1000).select(F.col("id").alias("t"), F.lit("a").alias("dev"))
    cut = spark.range(300).select(F.lit("a").alias("dev"), (F.col("id") * 3).alias("slice_start"), (F.col("id") * 3 + 1).alias("slice_end"))
    found = in_slices(df, cut, "t", "dev")
    assert found.count() == 600
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and plan.count("Range (0, 1000") <= 2
