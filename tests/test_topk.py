"""Top rows for a large k against a plain sort."""

import math
import random

import pytest

from tremorlake.plans import top_k_threshold


def plain(rows, k, descending, by=True):
    def order(r):
        v = r[1]
        if v is None:
            return (3, 0, r[2])
        if math.isnan(v):
            return (0 if descending else 2, 0, r[2])
        return (1, -v if descending else v, r[2])

    groups = {}
    for r in rows:
        groups.setdefault(r[0] if by else 0, []).append(r)
    return sorted(((*r, i + 1) for g in groups.values() for i, r in enumerate(sorted(g, key=order)[:k])), key=str)


def some_rows(seed, count, nan=True):
    random.seed(seed)
    values = lambda: random.choice([random.gauss(0, 1), random.randint(-5, 5), None, math.nan if nan else 0.0])
    floats = lambda v: v if v is None else float(v)
    return [(random.choice(["hot", "hot", "b", None]), floats(values()), i) for i in range(count)]


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("k", [7, 10_000])
def test_equals_a_sort(spark, descending, k):
    rows = some_rows(k, 4000)
    df = spark.createDataFrame(rows, "g string, v double, id int").repartition(5)
    got = top_k_threshold(df, k, "v", ["g"], ["id"], descending, "r")
    assert got.columns == ["g", "v", "id", "r"]
    assert sorted(str(tuple(r)) for r in got.collect()) == list(map(str, plain(rows, k, descending)))
    got = top_k_threshold(df, k, "v", [], ["id"], descending, "r")
    assert sorted(str(tuple(r)) for r in got.collect()) == list(map(str, plain(rows, k, descending, by=False)))


def test_a_group_cut_too_short_is_taken_whole(spark, monkeypatch):
    """As if the sketch's error in rank were larger than promised."""
    from tremorlake.plans import topk

    rows = [("a", float(i), i) for i in range(3000)] + [("b", float(i), i) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, v double, id int")
    approx = topk.F.percentile_approx
    monkeypatch.setattr(topk.F, "percentile_approx", lambda c, p, a: topk.F.transform(approx(c, p, a), lambda x: x + 1000))
    got = top_k_threshold(df, 300, "v", ["g"], ["id"], rank="r")
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, 300, True)


def test_long_and_time_values(spark):
    rows = [(2**62 + i, i) for i in range(2000)] + [(-(2**63), -1)]
    df = spark.createDataFrame(rows, "v bigint, id int").selectExpr("*", "timestamp_micros(id * 1000L + 5) as t", "date_add(date'2020-01-01', id) as d")
    for descending in (True, False):
        want = sorted(rows, reverse=descending)[:1200]
        assert sorted((r.v, r.id) for r in top_k_threshold(df, 1200, "v", descending=descending).collect()) == sorted(want)
        for c in ("t", "d"):
            want = sorted((i for _, i in rows), reverse=descending)[:1200]
            assert sorted(r.id for r in top_k_threshold(df, 1200, c, descending=descending).collect()) == sorted(want)


def test_rows_below_the_threshold_are_not_shuffled(spark):
    df = spark.range(200_000).selectExpr("id % 2 as g", "double(id) as v", "id")
    top = top_k_threshold(df, 2000, "v", ["g"], ["id"], rank="r")
    assert top.count() == 4000
    # What is ranked was written behind the threshold: at most twice k and the sketch's error, per group.
    files = [f for f in top.inputFiles() if "sorted" in f]
    assert files and 4000 <= spark.read.parquet(*files).count() <= 2 * (2 * 2000 + 100)
