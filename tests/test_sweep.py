"""Threshold sweeps and k-means steps against plain loops."""

import random

import numpy as np
import pytest

from tremorlake.operators.evaluate import best_thresholds, long_scores, threshold_sweep
from tremorlake.operators.kmeans import assign_clusters, centres, first_rows, fit_lloyd, quantile_rows, silhouette


def brute_sweep(rows):
    out = []
    for detector in sorted({r[0] for r in rows}):
        mine = [(s, a) for d, s, a in rows if d == detector]
        for t in sorted({s for s, _ in mine if s is not None}):
            flagged = [(s is not None and s >= t, a == 1) for s, a in mine]
            cells = [sum(1 for f, a in flagged if (f, a) == c) for c in ((False, False), (True, False), (False, True), (True, True))]
            out.append((detector, t, *cells))
    return out


def test_sweep_and_choice(spark):
    random.seed(8)
    rows = [(random.choice("xxxy"), random.choice([None, *[i / 8 for i in range(30)]]), int(random.random() < 0.3)) for _ in range(600)]
    rows += [("empty", None, 1), ("none", 0.5, 0)]
    df = spark.createDataFrame(rows, "d string, s double, a int").repartition(5)
    want = brute_sweep(rows)
    got = threshold_sweep(df, "a", "s", ["d"])
    assert got.columns == ["d", "threshold", "tn", "fp", "fn", "tp"]
    assert sorted(map(tuple, got.collect())) == want
    one = [r[1:] for r in brute_sweep([("all", s, a) for _, s, a in rows])]
    assert sorted(map(tuple, threshold_sweep(df, "a", "s").collect())) == one
    best = {r.d: r for r in best_thresholds(df, "a", "s", ["d"]).collect()}
    assert set(best) == {"x", "y", "none"} and best["none"].f1 == 0
    for d in "xy":
        f1 = {t: 2 * tp / (2 * tp + fp + fn) for k, t, tn, fp, fn, tp in want if k == d}
        assert best[d].f1 == max(f1.values()) and best[d].threshold == max(t for t, v in f1.items() if v == best[d].f1)
    with pytest.raises(Exception, match="NULL"):
        threshold_sweep(spark.createDataFrame([("x", 1.0, None)], "d string, s double, a int"), "a", "s").collect()


def test_long_scores(spark):
    df = spark.createDataFrame([(1, 0.5, None, 1)], "i int, p double, q float, a int")
    assert sorted(map(tuple, long_scores(df, ["i", "a"], ["p", "q"]).collect())) == [(1, 1, "p", 0.5), (1, 1, "q", None)]


def brute_lloyd(x, c, steps):
    for _ in range(steps):
        near = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
        c = np.array([x[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
    return c, ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)


def test_lloyd_steps(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(200, 2)), rng.normal(size=(30, 2)) + 8])
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows + [(-1, None, 0.0), (-2, 0.0, None)], "i int, a double, b double").repartition(4)
    start = first_rows(df, ["a", "b"], ["i"], 3)
    assert np.array_equal(start, x[:3])
    start[2] = 1e6  # a centre that nothing is near
    for steps in (0, 1, 6):
        model = fit_lloyd(df, ["a", "b"], start, steps)
        want, near = brute_lloyd(x, start, steps)
        assert np.allclose(model.coordinates, want)
        assert {r.i: r.c for r in assign_clusters(df, model, ["a", "b"], "c").collect()} == dict(enumerate(near))
    assert centres(df, model).count() == 6 and 0 < silhouette(df, model, ["a", "b"]) <= 1
    at = quantile_rows(df, ["a", "b"], 2)
    assert at.tolist() == [[sorted(x[:, j])[int(np.ceil(q * 230)) - 1] for j in (0, 1)] for q in (0.25, 0.75)]
    # Equal distances go to the lower number, and no rows give no centres.
    tie = spark.createDataFrame([(0, 0.0)], "i int, a double")
    assert assign_clusters(tie, fit_lloyd(tie, ["a"], np.array([[1.0], [-1.0]]), 0), ["a"]).collect()[0].prediction == 0
    nothing = df.limit(0)
    for empty in (first_rows(nothing, ["a"], ["i"], 3), quantile_rows(nothing, ["a"], 3)):
        assert assign_clusters(nothing, fit_lloyd(nothing, ["a"], empty), ["a"]).count() == 0
