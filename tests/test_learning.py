import numpy as np
import pytest
from pyspark.sql import functions as F

from tremorlake.operators.autoencoder import DenseAutoencoder, LstmAutoencoder, train
from tremorlake.operators.iforest import (
    draw_samples,
    fit_forest,
    fit_predict_forest,
    grow_forest,
    grow_tree,
    load_forest,
    mean_path,
    predict_forest,
    save_forest,
    score_forest,
)
from tremorlake.operators.kmeans import assign_clusters, centres, fit_kmeans, kmeans_anomalies, silhouette
from tremorlake.operators.reconstruct import (
    anomalies,
    fit_linear,
    label_losses,
    load_linear,
    mean_abs_loss,
    reconstruction_loss,
    save_linear,
)


@pytest.fixture(scope="module")
def planted(spark):
    """1000 readings around 0 and five far away."""
    rng = np.random.default_rng(1)
    rows = [(i, float(v)) for i, v in enumerate(rng.normal(size=1000))] + [(1000 + i, 40.0 + i) for i in range(5)]
    return spark.createDataFrame(rows, "i bigint, v double").withColumn("x", F.array("v")).cache()


def found(df, label):
    return {r["i"] for r in df.filter(F.col(label) == 1).collect()}


def test_kmeans_finds_the_small_cluster(planted):
    df = planted.withColumn("r", F.round("v", 0))
    assert set(range(1000, 1005)) == {r["i"] for r in kmeans_anomalies(df, ["v", "r"]).collect()}
    model = fit_kmeans(df, ["v", "r"])
    assert centres(df, model).count() == 10
    assert 0 < silhouette(df, model, ["v", "r"]) <= 1
    assert assign_clusters(df.withColumn("v", F.lit(None).cast("double")), model, ["v", "r"]).count() == 0


def test_forest_finds_planted_rows(planted, tmp_path, spark):
    forest = fit_forest(planted, "x", ["i"], trees=50, max_depth=8)
    out = predict_forest(planted, forest, "x")
    hits = found(out, "prediction")
    assert set(range(1000, 1005)) <= hits and len(hits) <= 16
    save_forest(forest, str(tmp_path / "f"))
    again = predict_forest(planted.repartition(5), load_forest(spark, str(tmp_path / "f")), "x")
    assert found(again, "prediction") == hits


def test_forest_is_the_same_on_any_partitioning(planted):
    a = fit_forest(planted, "x", ["i"], trees=10).nodes.collect()
    b = fit_forest(planted.repartition(6, "v"), "x", ["i"], trees=10).nodes.collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


@pytest.mark.parametrize("n", [40, 5_000, 60_000])
def test_every_tree_draws_from_all_rows(spark, n):
    df = spark.range(n).withColumn("x", F.array(F.col("id").cast("double")))
    got = draw_samples(df, ["id"], 20, 64, 1).toPandas()
    assert (got.groupby("tree").size() == min(n, 64)).all() and got["tree"].nunique() == 20
    assert got["id"].nunique() > 0.9 * min(n, 20 * 64) * (0.9 if n != 5_000 else 0.85)


def test_tree_of_equal_rows_is_a_leaf():
    assert len(grow_tree(np.ones((50, 2)), 5, 1)) == 1
    assert mean_path(1) == 0 and mean_path(2) == 1 and abs(mean_path(256) - 10.244) < 1e-2


def test_a_compiled_forest_equals_the_walked_node_table(spark, planted):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(300)]
    df = spark.createDataFrame(rows, "i bigint, x array<double>")
    for depth in (0, 1, 4):
        nodes = grow_forest(df, "x", ["i"], trees=7, sample_rows=32, max_depth=depth)
        got = score_forest(score_forest(df, nodes, "x", 32, "a"), nodes, "x", 32, "b", compiled_nodes=0)
        assert all(abs(r.a - r.b) < 1e-12 for r in got.collect())
        assert "ArrowEvalPython" not in score_forest(df, nodes, "x", 32)._jdf.queryExecution().executedPlan().toString()
    # Each node's rows are those of its children, and the leaves share out the sample.
    by_tree = nodes.toPandas().groupby("tree")
    for _, t in by_tree:
        t = t.set_index("node")
        inner = t[t["feature"] >= 0]
        assert all(r["size"] == t.loc[r["lower"], "size"] + t.loc[r["upper"], "size"] for _, r in inner.iterrows())
        assert t[t["feature"] < 0]["size"].sum() == 32


def test_scores_and_labels_of_the_training_rows(planted):
    df = planted.select("i", "v").withColumn("x", F.array("v"))
    out, forest = fit_predict_forest(df, "x", ["i"], trees=10)
    assert out.columns == ["i", "v", "x", "score", "prediction"] and out.count() == df.count()
    assert found(out, "prediction") == found(predict_forest(df, forest, "x"), "prediction")
    nothing, _ = fit_predict_forest(df.limit(0), "x", ["i"], trees=3)
    assert nothing.count() == 0


def test_loss_and_labels(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0, 4.0])], "a array<double>, b array<double>")
    assert df.select(mean_abs_loss("a", "b")).first()[0] == 1.0
    df = spark.createDataFrame([(1, 1.5), (2, 1.6)], "i int, loss double")
    got = label_losses(df, 1.5)
    assert [r["i"] for r in anomalies(got, columns=["i"]).collect()] == [2]


def test_linear_reconstruction_finds_an_odd_window(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(500, 1)) * np.array([[1.0, 2.0, 3.0, 2.0, 1.0]]) + 5
    base[77] = [5, 5, 25, 5, 5]
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(base)], "i int, w array<double>")
    out = reconstruction_loss(df, fit_linear(df, "w", 1), "w")
    assert out.orderBy(F.desc("loss")).first()["i"] == 77


def test_linear_model_in_one_pass(spark, tmp_path):
    """Far from zero, unevenly dealt, with windows to leave out; against numpy, stored and compiled."""

    class Plain:  # a model that is not known to be linear
        def __init__(self, model):
            self.reconstruct = model.reconstruct

    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4)) + 1e6
    rows = [(i, [float(v) for v in w]) for i, w in enumerate(x)]
    df = spark.createDataFrame(rows + [(-1, None)], "i int, w array<double>").repartition(7, "i")
    model = fit_linear(df, "w", 2)
    _, vectors = np.linalg.eigh(np.cov(x.T, ddof=0))
    project = vectors[:, -2:] @ vectors[:, -2:].T
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.components @ model.components.T, project, atol=1e-6)
    save_linear(spark, model, str(tmp_path / "m"))
    again = load_linear(spark, str(tmp_path / "m"))
    assert np.array_equal(again.mean, model.mean) and np.array_equal(again.components, model.components)
    want = np.abs(model.reconstruct(x) - x).mean(axis=1)
    native = reconstruction_loss(df, again, "w")
    assert "ArrowEvalPython" not in native._jdf.queryExecution().executedPlan().toString()
    for out in (native, reconstruction_loss(df, Plain(again), "w")):
        got = {r.i: r.loss for r in out.collect()}
        assert got.pop(-1) is None and np.allclose([got[i] for i in range(400)], want, atol=1e-6)
    assert label_losses(native, "deployed_window").select("threshold").distinct().collect()[0][0] == 1.5
    with pytest.raises(ValueError):
        fit_linear(df.limit(0), "w", 2)


@pytest.mark.parametrize("model", [DenseAutoencoder(sizes=(5, 7, 3, 5)), LstmAutoencoder(units=4, dropout=0.0)])
def test_gradients_against_differences(model):
    rng = np.random.default_rng(0)
    model.initialise(rng)
    x = rng.normal(size=(6, 5))
    _, grads = model.gradient(x, rng)
    for p, g in zip(model.params, grads):
        for at in list(np.ndindex(p.shape))[:: max(1, p.size // 6)]:
            old, eps = p[at], 1e-6
            p[at] = old + eps
            up = np.abs(model.reconstruct(x) - x).mean(axis=1).sum()
            p[at] = old - eps
            down = np.abs(model.reconstruct(x) - x).mean(axis=1).sum()
            p[at] = old
            assert abs((up - down) / (2 * eps) - g[at]) < 1e-4


@pytest.mark.parametrize("model", [DenseAutoencoder(), DenseAutoencoder(sizes=(5, 6, 5)), LstmAutoencoder(units=8)])
def test_training_lowers_the_loss(spark, model):
    width = 1 if model == DenseAutoencoder() else 5
    rng = np.random.default_rng(4)
    wave = np.sin(rng.uniform(0, 6, size=(400, 1)) + np.arange(width)[None, :] / 2)
    df = spark.createDataFrame([(i, [float(v) for v in w]) for i, w in enumerate(wave)], "i int, w array<double>")
    done = train(df, "w", model, steps=12, rate=0.02)
    assert done.history[-1][0] < 0.9 * done.history[0][0]
    assert done.history[-1][1] < done.history[0][1]
    odd = spark.createDataFrame([(0, [float(v) for v in wave[0]]), (1, [30.0] * width)], "i int, w array<double>")
    scored = {r["i"]: r["loss"] for r in reconstruction_loss(odd, done.model, "w").collect()}
    assert scored[1] > 5 * scored[0]


def test_model_sizes():
    dense, lstm = DenseAutoencoder(), LstmAutoencoder()
    for m in (dense, lstm):
        m.initialise(np.random.default_rng(0))
    assert sum(p.size for p in dense.params) == 176
    assert sum(p.size for p in lstm.params) == 49_985
