import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tremorlake.operators.smooth import lag_windows, moving_average, rolling_mean, rolling_mean_single_task
from tremorlake.plans import attach, exact_quantiles, running_total, top_k, with_halo, with_position, write_scratch


@pytest.fixture(scope="module")
def skewed(spark):
    """One device holds most rows; indices have gaps and arrive shuffled."""
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame(
        {
            "device_id": rng.choice([1, 1, 1, 1, 2, 3], n),
            "index": rng.choice(10 * n, n, replace=False),
            "value": rng.normal(size=n).round(3),
        }
    )
    return spark.createDataFrame(pdf)


def plain_position(df):
    w = Window.partitionBy("device_id").orderBy("index")
    return df.withColumn("pos", F.row_number().over(w).cast("bigint") - 1)


def same(a, b, cols):
    return a.select(*cols).exceptAll(b.select(*cols)).count() == 0 and a.count() == b.count()


@pytest.mark.parametrize("block", [None, "index div 50", "0"])
def test_position_equals_row_number(skewed, block):
    got = with_position(skewed, ["device_id"], ["index"], "pos", block and F.expr(block))
    assert same(got, plain_position(skewed), ["device_id", "index", "value", "pos"])


def test_running_total_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, i, 1.0) for i in range(10)] + [(1, i, 2.0) for i in range(5)], "k int, i int, v double")
    got = running_total(df, ["k"], ["i"], F.col("v"), "t", F.expr("i div 3"))
    assert got.count() == 15
    assert got.filter("k is null and i = 9").first()["t"] == 9.0
    assert got.filter("k = 1 and i = 4").first()["t"] == 8.0


@pytest.mark.parametrize("chunk", [3, 8, 65536])
def test_rolling_over_chunks_equals_one_window(skewed, chunk):
    p = plain_position(skewed)
    want = rolling_mean_single_task(p, "value", ["device_id"], ["index"], 3).withColumn("m", F.round("rolling_mean", 9))
    got = rolling_mean(p, "value", ["device_id"], 3, chunk_rows=chunk).withColumn("m", F.round("rolling_mean", 9))
    assert same(got, want, ["device_id", "index", "m"])


@pytest.mark.parametrize("chunk", [5, 7, 65536])
def test_centred_average_stops_at_the_bucket(skewed, chunk):
    p = plain_position(skewed).withColumn("second", F.expr("index div 40"))
    w = Window.partitionBy("device_id", "second").orderBy("index").rowsBetween(-3, 3)
    want = p.withColumn("m", F.round(F.avg("value").over(w), 9))
    got = moving_average(p, "value", ["device_id"], "second", 3, chunk_rows=chunk)
    got = got.withColumn("m", F.round("moving_average", 9))
    assert same(got, want, ["device_id", "index", "m"])


def test_lag_windows(spark):
    df = spark.createDataFrame([(d, i, float(10 * d + i)) for d in (1, 2) for i in range(8)], "device_id int, pos bigint, value double")
    got = lag_windows(df, "value", ["device_id"], 5, chunk_rows=5)
    assert got.count() == 6
    row = got.filter("device_id = 2 and pos = 5").first()
    assert row["window"] == [20.0, 21.0, 22.0, 23.0, 24.0] and row["value"] == 25.0


def test_series_of_seven_and_eight_rows(spark):
    df = spark.createDataFrame([(d, i, 1.0) for d, n in ((1, 7), (2, 8)) for i in range(n)], "device_id int, pos bigint, value double")
    m = rolling_mean(df, "value", ["device_id"], 3, out="m")
    got = lag_windows(m, "m", ["device_id"], 5)
    assert [(r["device_id"], r["pos"]) for r in got.collect()] == [(2, 7)]


def test_halo_repeats_only_edges(spark):
    df = spark.range(100).withColumnRenamed("id", "pos")
    got = with_halo(df, "pos", 2, 1, chunk_rows=10)
    assert got.filter("not _halo").count() == 100
    assert got.filter("_halo").count() == 10 * 2 + 9 * 1
    # A frame over several chunks: every chunk that it reaches gets the row.
    got = with_halo(df, "pos", 25, 0, chunk_rows=10)
    assert got.filter("not _halo").count() == 100
    reached = got.filter("pos = 7").select("_chunk").toPandas()["_chunk"]
    assert sorted(reached) == [0, 1, 2, 3]


def test_attach_is_the_same_either_way(spark):
    rows = [(None, i, 5.0) for i in range(50)] + [(1, i, 5.0) for i in range(500)] + [(2, i, float(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "k int, i int, v double").select("i", "k", "v")
    stats = df.groupBy("k").agg(F.avg("v").alias("m"), F.count("*").alias("n"))
    small, large = (attach(df, stats, ["k"], rows="n", limit=limit) for limit in (1 << 26, 40))
    assert small.columns == large.columns == ["i", "k", "v", "m", "n"]
    key = lambda r: (r["k"] is None, r["k"], r["i"])
    assert sorted(small.collect(), key=key) == sorted(large.collect(), key=key)
    assert small.filter("k is null and n = 50").count() == 50
    some = stats.filter("k = 1 or k is null")
    for limit in (1 << 26, 40):
        assert attach(df, some, ["k"], rows="n", how="inner", limit=limit).count() == 550
        assert attach(df, some, ["k"], rows="n", limit=limit).filter("m is null").count() == 9


@pytest.mark.parametrize("linear", [True, False])
def test_quantiles_of_large_and_small_groups(spark, linear):
    rng = np.random.default_rng(5)
    big = pd.DataFrame({"g": 1, "v": rng.normal(size=40_000).round(2)})
    small = pd.DataFrame({"g": 2, "v": rng.normal(size=17)})
    ties = pd.DataFrame({"g": 3, "v": np.r_[np.full(30_000, 5.0), rng.normal(size=5000)]})
    pdf = pd.concat([big, small, ties])
    df = spark.createDataFrame(pdf)
    qs = {"a": 0.0, "b": 0.5, "c": 0.95, "d": 1.0}
    got = exact_quantiles(df, "v", qs, ["g"], linear=linear, small_group=10_000, accuracy=1000).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        method = "linear" if linear else "inverted_cdf"
        want = np.quantile(part["v"], list(qs.values()), method=method)
        assert np.allclose(got.loc[g, list(qs)].to_numpy(dtype=float), want), (g, linear)
    whole = exact_quantiles(df, "v", {"p": 0.95}, linear=linear, small_group=10_000).first()["p"]
    assert np.isclose(whole, np.quantile(pdf["v"], 0.95, method="linear" if linear else "inverted_cdf"))


def test_attach_beyond_the_broadcast_limit(spark, skewed):
    stats = skewed.groupBy("device_id").agg(F.avg("value").alias("m"), F.count("*").alias("n"))
    for how in ("left", "inner"):
        want = skewed.join(stats, "device_id", how)
        got = attach(skewed, stats, ["device_id"], rows="n", how=how, limit=60)
        assert got.columns == want.columns
        assert same(got, want, want.columns)
    part = stats.filter("device_id = 2")
    assert attach(skewed, part, ["device_id"], rows="n", limit=1).count() == skewed.count()


def test_top_k_per_group(spark, skewed):
    w = Window.partitionBy("device_id").orderBy(F.desc("value"), "index")
    want = skewed.withColumn("r", F.row_number().over(w)).filter("r <= 4")
    got = top_k(skewed, 4, [F.desc("value"), F.asc("index")], ["device_id"], "r")
    assert same(got, want, ["device_id", "index", "r"])


def test_scratch_round_trip(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    assert write_scratch(df, "t").agg(F.sum("x")).first()[0] == 90
