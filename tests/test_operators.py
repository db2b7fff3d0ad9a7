import datetime as dt

import pytest
from pyspark.sql import functions as F

from tremorlake.functions import (
    abs_error,
    f1_expr,
    int_bucket,
    iso_seconds_text,
    label_above,
    parse_seconds,
    precision_expr,
    to_decimal,
    vector_element,
    zscore,
)
from tremorlake.operators import clean, evaluate, keyed, normalize, sigma, stats
from tremorlake.operators.kmeans import assemble, cluster_rarity
from tremorlake.operators.slices import in_slices


def test_parse_seconds_takes_fractions_and_bad_text(spark):
    df = spark.createDataFrame([("2018-07-09 12:00:00",), ("2018-07-09 12:00:00.75",), ("nonsense",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_seconds("t")).collect()]
    assert got == [dt.datetime(2018, 7, 9, 12), dt.datetime(2018, 7, 9, 12), None, None]
    assert df.select(iso_seconds_text("t")).collect()[1][0] == "2018-07-09 12:00:00"


def test_rounding_ties_and_buckets(spark):
    df = spark.createDataFrame([(0.5,), (-0.5,), (2.5,), (None,)], "v double")
    assert [r[0] for r in clean.rounded(df, "v", "r").select("r").collect()] == [1.0, -1.0, 3.0, None]
    assert [r[0] for r in df.select(int_bucket("v", 1)).collect()] == [5, -5, 25, None]
    assert clean.in_bucket(df, "v", -1.0).count() == 1
    assert clean.in_bucket(df, "v", 0.5, digits=1).count() == 1


def test_zscore_of_constant_and_null(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (1, None), (2, 1.0), (2, 3.0)], "k int, v double")
    got = {(r["k"], r["v"]): r["zscale"] for r in normalize.znorm(df, "v", ["k"]).collect()}
    assert got == {(1, 5.0): 0.0, (1, None): None, (2, 1.0): -0.707107, (2, 3.0): 0.707107}
    pop = {r["v"]: r["zscale"] for r in normalize.znorm(df.filter("k = 2"), "v", ddof=0).collect()}
    assert pop == {1.0: -1.0, 3.0: 1.0}
    assert df.select(zscore("v", F.lit(0.0), F.lit(2.0))).first()[0] == 2.5


def test_znorm_matches_ml_scaler(spark, sf_dir):
    from pyspark.ml.feature import StandardScaler

    df = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "value")
    vec = assemble(df, ["value"], "v")
    ml = StandardScaler(inputCol="v", outputCol="z", withMean=True, withStd=True).fit(vec).transform(vec)
    both = ml.select("event_id", F.round(vector_element("z"), 6).alias("ml")).join(normalize.znorm(df, "value"), "event_id")
    assert both.filter(F.abs(F.col("ml") - F.col("zscale")) > 1.1e-6).count() == 0


def test_fitted_scaler_on_other_data(spark):
    a = spark.createDataFrame([(0.0,), (2.0,)], "v double")
    b = spark.createDataFrame([(5.0,)], "v double")
    assert normalize.apply_scaler(b, normalize.fit_scaler(a, "v", ddof=0), "v").first()["zscale"] == 4.0
    with pytest.raises(ValueError):
        normalize.fit_scaler(a, "v", ddof=2)


def test_axis_map(spark):
    df = spark.createDataFrame([(d, 1.0, 2.0, 3.0) for d in [1, 3, 4, 8, 12, 99]], "device_id int, X double, Y double, Z double")
    axes = clean.default_axis_map(spark)
    got = {r["device_id"]: r["value"] for r in clean.canonical_axis(df, axes).collect()}
    assert got == {1: 3.0, 3: 1.0, 4: -3.0, 8: -1.0, 12: -2.0, 99: None}
    assert [tuple(r) for r in clean.unmapped_devices(df, axes).collect()] == [(99, 1)]


def test_ranges_and_bands(spark):
    df = spark.createDataFrame([("2018-07-09 12:00:00", 1.0), ("2018-07-09 12:00:00.5", 2.0)], "t string, v double")
    df = df.withColumn("ts", F.to_timestamp("t"))
    assert clean.time_range(df, "ts", "2018-07-09 12:00:00", "2018-07-09 12:00:00").count() == 1
    assert clean.value_band(df, "v", 1.0, 2.0).count() == 0
    assert clean.value_band(df, "v", 1.0, 2.0, closed=True).count() == 2
    assert clean.tails(df, "v", 1.5, 1.9).count() == 2


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = clean.time_range(df, "ts", "2024-01-05 00:00:00", "2024-01-06 00:00:00").select("value")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in text and "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text


def test_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (2, None)], "k int, v double")
    assert clean.drop_nulls(df, ["v"]).count() == 1
    assert sorted(r["v"] for r in clean.fill_constant(df, {"v": 0.0}).collect()) == [0.0, 0.0, 2.0]
    got = sorted([(r["k"], r["v"]) for r in clean.fill_mean(df, "v", ["k"]).collect()], key=str)
    assert got == [(1, 2.0), (1, 2.0), (2, None)]


def test_small_expressions(spark):
    df = spark.createDataFrame([(1.0, 3.0, "12.5", "x")], "a double, b double, n string, m string")
    r = df.select(
        abs_error("a", "b"), label_above("b", 3.0), label_above("b", 2.9), to_decimal("n"), to_decimal("m"),
    ).first()
    assert (r[0], r[1], r[2], int(r[3]), r[4]) == (2.0, 0, 1, 13, None)


def test_histogram_null_rules_and_mode(spark):
    df = spark.createDataFrame([(1.2,), (0.9,), (None,), (2.0,)], "v double")
    plain = {r["bucket"]: r["n_rows"] for r in stats.value_histogram(df, "v").collect()}
    assert plain == {1.0: 2, 2.0: 1, None: 0}
    assert {r["bucket"]: r["n_rows"] for r in stats.value_histogram(df, "v", count_nulls=True).collect()}[None] == 1
    assert stats.mode_buckets(df, "v", 1).first()["bucket"] == 1.0


@pytest.mark.parametrize("hits, kept", [(6, 0), (7, 7)])
def test_count_gate(spark, hits, kept):
    df = spark.createDataFrame([(1, int(i < hits)) for i in range(20)], "d int, label int")
    assert stats.count_gate(df, "label", ["d"], 7).agg(F.sum("label")).first()[0] == kept


def test_episode_needs_more_than_five(spark):
    rows = [(1, "a", i) for i in range(5)] + [(1, "b", i) for i in range(6)] + [(2, "b", 0)]
    df = spark.createDataFrame(rows, "device int, second string, i int")
    ep = sigma.outlier_episodes(df, "second", by=["device"])
    assert [tuple(r) for r in ep.collect()] == [(1, "b", 6)]
    labelled = sigma.label_episodes(df, ep, "second", ["device"])
    assert labelled.groupBy("anomaly").count().orderBy("anomaly").collect()[1]["count"] == 6
    assert labelled.count() == len(rows)


def test_planted_spikes_are_outliers(spark):
    df = spark.createDataFrame([(i, 1000.0 if i == 500 else float(i % 7)) for i in range(1000)], "i int, v double")
    assert [r["i"] for r in sigma.sigma_outliers(df, "v").collect()] == [500]


def test_rarity_of_equal_clusters(spark):
    df = spark.createDataFrame([(0,), (0,), (1,), (1,)], "prediction int")
    got = cluster_rarity(df).collect()
    assert {(r["score"], r["anomaly"]) for r in got} == {(None, 0)}
    df = spark.createDataFrame([(0,)] * 5 + [(1,)] * 3 + [(2,)], "prediction int")
    got = {(r["prediction"], r["score"], r["anomaly"]) for r in cluster_rarity(df).collect()}
    assert got == {(0, 0.0, 0), (1, 0.5, 0), (2, 1.0, 1)}


def test_rarity_per_device(spark):
    df = spark.createDataFrame([(1, 0)] * 3 + [(1, 1)] + [(2, 0)] * 2, "device int, prediction int")
    got = cluster_rarity(df, by=["device"])
    assert got.count() == 6 and got.filter("anomaly = 1").collect()[0]["prediction"] == 1


def test_slices_broadcast_and_bucketed(spark, rows):
    df = spark.range(200).select(
        F.col("id"), (F.col("id") % 2).alias("dev"), F.timestamp_seconds(F.col("id") * 3600).alias("ts")
    )
    slices = spark.createDataFrame(
        [(0, "1970-01-01 05:00:00", "1970-01-03 01:00:00"), (0, "1970-01-02 00:00:00", "1970-01-02 12:00:00"),
         (1, "1970-01-05 00:00:00", "1970-01-05 05:00:00")],
        "dev bigint, slice_start string, slice_end string",
    )
    a = in_slices(df, slices, "ts", "dev")
    b = in_slices(df, slices, "ts", "dev", limit=0)
    assert rows(a) == rows(b)
    assert a.count() == len([i for i in range(200) if i % 2 == 0 and 5 <= i <= 49]) + 3


def test_confusion_cells_and_names(spark):
    df = spark.createDataFrame([(0, 0)] * 4 + [(0, 1)] * 3 + [(1, 0)] * 2 + [(1, 1)], "y int, p int")
    r = evaluate.quality(evaluate.confusion(df, "y", "p")).first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (4, 3, 2, 1)
    assert r["precision"] == 0.25 and abs(r["recall"] - 1 / 3) < 1e-12 and abs(r["f1"] - 2 / 7) < 1e-12
    empty = evaluate.quality(evaluate.confusion(df.filter("y = 0 and p = 0"), "y", "p")).first()
    assert empty["precision"] is None and empty["f1"] is None
    assert spark.range(1).select(precision_expr(F.lit(1), F.lit(1)), f1_expr(F.lit(1), F.lit(0), F.lit(0))).first()[1] == 1.0


def test_alignment_by_key(spark):
    p = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "i int, p int")
    t = spark.createDataFrame([(3, 0), (1, 1), (4, 1)], "i int, y int")
    got = {tuple(r) for r in evaluate.align(p, t, ["i"], "p", "y").collect()}
    assert got == {(1, 1, 1), (3, 1, 0)}
    assert tuple(evaluate.unmatched(p, t, ["i"]).first()) == (1, 1, 2)


def test_best_detector_first(spark):
    df = spark.createDataFrame([(1, 1, 0), (0, 0, 1), (1, 1, 1)], "y int, good int, bad int")
    got = [r["detector"] for r in evaluate.compare_detectors(df, "y", ["bad", "good"]).collect()]
    assert got == ["good", "bad"]


def test_upsert_and_log(spark, tmp_path, rows):
    base = spark.createDataFrame([(1, 1, "a", 1), (1, 2, "b", 1)], "d int, i int, v string, ver int")
    new = spark.createDataFrame([(1, 2, "c", 2), (1, 3, "d", 2), (1, 1, "old", 0)], "d int, i int, v string, ver int")
    assert rows(keyed.upsert(base, new, ["d", "i"], ["ver"]).select("d", "i", "v")) == [(1, 1, "a"), (1, 2, "c"), (1, 3, "d")]
    path = str(tmp_path / "log")
    keyed.append_batch(base, path, 0)
    keyed.append_batch(new.filter("ver > 0"), path, 1)
    keyed.append_batch(new.filter("ver > 0"), path, 1)
    assert rows(keyed.read_keyed(spark, path, ["d", "i"]).select("i", "v")) == [(1, "a"), (2, "c"), (3, "d")]
    keyed.compact(spark, path, str(tmp_path / "compact"), ["d", "i"])
    assert spark.read.parquet(str(tmp_path / "compact")).count() == 3


def test_partition_upsert_leaves_other_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    spark.createDataFrame([(1, 1, "a", 1), (2, 1, "x", 1)], "d int, i int, v string, ver int").write.partitionBy("d").parquet(path)
    before = set((tmp_path / "table" / "d=2").glob("*.parquet"))
    updates = spark.createDataFrame([(1, 1, "b", 2), (3, 1, "n", 2)], "d int, i int, v string, ver int")
    keyed.upsert_partitions(spark, path, updates, ["d", "i"], ["ver"], "d")
    assert rows(spark.read.parquet(path).select("d", "v")) == [(1, "b"), (2, "x"), (3, "n")]
    assert set((tmp_path / "table" / "d=2").glob("*.parquet")) == before


def test_cursor_never_passes_what_was_read(spark, rows):
    df = spark.createDataFrame([(d, i) for d in (1, 2) for i in range(10 if d == 1 else 4)], "d int, i bigint")
    cursor = spark.createDataFrame([], "d int, next_index bigint")
    seen = []
    for _ in range(4):
        part = keyed.incremental_slice(df, cursor, "d", "i", 3)
        seen += [tuple(r) for r in part.collect()]
        cursor = spark.createDataFrame(
            [tuple(r) for r in keyed.advance_cursor(part, cursor, "d", "i").collect()], "d int, next_index bigint"
        )
    assert sorted(seen) == rows(df)
    assert rows(cursor) == [(1, 10), (2, 4)]


def test_latest_n_and_lookup(spark, rows):
    df = spark.createDataFrame([(d, i) for d in (1, 2) for i in range(6)], "d int, i int")
    assert rows(keyed.latest_n(df, "d", "i", 2)) == [(1, 4), (1, 5), (2, 4), (2, 5)]
    assert rows(keyed.latest_n(df, "d", "i", 2, device_value=1)) == [(1, 4), (1, 5)]
    assert rows(keyed.range_lookup(df, "d", 1, "i", 2, 3)) == [(1, 2), (1, 3)]


def test_results_do_not_depend_on_partitioning(spark, sf_dir, rows):
    df = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "value")
    again = df.repartition(7, "value")
    for op in (
        lambda x: normalize.znorm(x, "value", ["user_id"]),
        lambda x: stats.percentile_threshold(x, "value", by=["user_id"]),
        lambda x: stats.extremes(x, "value", 5, ["event_id"], by=["user_id"], rank="r"),
    ):
        assert rows(op(df)) == rows(op(again))


def test_axis_map_with_two_entries_is_refused(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, 3.0)], "device_id int, X double, Y double, Z double")
    twice = spark.createDataFrame([(1, "X", 1), (1, "Y", 1)], "device_id int, axis string, sign int")
    with pytest.raises(ValueError, match="several entries"):
        clean.canonical_axis(df, twice)


def test_episodes_without_a_count_column(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a")], "k int, bucket string")
    flagged = spark.createDataFrame([(1, "a"), (None, "a")], "k int, bucket string")
    got = sigma.label_episodes(df, flagged, "bucket", ["k"]).collect()
    assert {(r["k"], r["bucket"]): r["anomaly"] for r in got} == {(1, "a"): 1, (1, "b"): 0, (None, "a"): 1}


def test_null_truth_is_an_error(spark):
    df = spark.createDataFrame([(1, 1), (None, 0)], "a int, p int")
    with pytest.raises(Exception, match="must not be NULL"):
        evaluate.confusion(df, "a", "p").collect()
