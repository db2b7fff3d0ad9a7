"""Features against plain numpy on short series, with small chunks so that borders matter."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tremorlake.functions import ranges
from tremorlake.operators import features as free
from tremorlake.operators import ordered_features as ordered
from tremorlake.operators import spectral_features as spectral


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(8)
    parts = {1: rng.normal(size=40).round(1), 2: rng.integers(0, 4, 25).astype(float), 3: np.arange(9.0), 4: np.full(6, 2.0)}
    pdf = pd.concat([pd.DataFrame({"k": k, "pos": np.arange(len(v)), "v": v}) for k, v in parts.items()])
    return parts, spark.createDataFrame(pdf.sample(frac=1.0, random_state=0)).cache()


def check(got, want):
    table = got.toPandas().set_index("k")
    for k, row in want.items():
        for name, value in row.items():
            have = table.loc[k, name]
            if value is None or (isinstance(value, float) and np.isnan(value)):
                assert have is None or pd.isna(have), (k, name, have)
            else:
                assert np.isclose(float(have), float(value), atol=1e-9), (k, name, have, value)


def test_order_free(series):
    parts, df = series
    want = {}
    for k, x in parts.items():
        n, s = len(x), pd.Series(x)
        vals, counts = np.unique(x, return_counts=True)
        hist = np.histogram(x, bins=10)[0] / n
        hist = hist[hist > 0]
        want[k] = {
            "length": n, "sum_values": x.sum(), "abs_energy": (x * x).sum(), "mean": x.mean(), "median": np.median(x),
            "minimum": x.min(), "maximum": x.max(), "standard_deviation": x.std(), "variance": x.var(),
            "root_mean_square": np.sqrt((x * x).mean()), "quantile_0_1": np.quantile(x, 0.1),
            "quantile_0_9": np.quantile(x, 0.9), "count_above_mean": (x > x.mean()).sum(),
            "count_below_mean": (x < x.mean()).sum(), "binned_entropy": -(hist * np.log(hist)).sum(),
            "ratio_beyond_r_sigma": (abs(x - x.mean()) > x.std()).mean(), "range_count": ((x >= -1) & (x < 1)).sum(),
            "value_count": (x == 0).sum(), "has_duplicate": len(vals) < n,
            "has_duplicate_max": (x == x.max()).sum() > 1, "has_duplicate_min": (x == x.min()).sum() > 1,
            "percentage_of_reoccurring_values_to_all_values": (counts > 1).sum() / len(vals),
            "percentage_of_reoccurring_datapoints_to_all_datapoints": counts[counts > 1].sum() / n,
            "sum_of_reoccurring_values": vals[counts > 1].sum(),
            "sum_of_reoccurring_data_points": (vals * counts)[counts > 1].sum(),
            "ratio_value_number_to_series_length": len(vals) / n,
            "symmetry_looking": abs(x.mean() - np.median(x)) < 0.05 * (x.max() - x.min()),
            "large_standard_deviation": x.std() > 0.25 * (x.max() - x.min()),
            "variance_larger_than_standard_deviation": x.var() > x.std(),
        }
        if k != 4:
            want[k] |= {"skewness": s.skew(), "kurtosis": s.kurt(), "variation_coefficient": x.std() / x.mean()}
    check(free.series_features(df, ["k"], "v"), want)


@pytest.mark.parametrize("chunk", [4, 7, 65536])
def test_ordered(series, chunk):
    parts, df = series
    want, strikes, mass = {}, {}, {}
    for k, x in parts.items():
        n, dx = len(x), np.diff(x)
        want[k] = {
            "absolute_sum_of_changes": abs(dx).sum(), "mean_abs_change": abs(dx).mean(), "mean_change": dx.mean(),
            "mean_second_derivative_central": (0.5 * (x[2:] - 2 * x[1:-1] + x[:-2])).mean(),
            "cid_ce": np.sqrt((dx * dx).sum()), "c3": (x[4:] * x[2:-2] * x[:-4]).mean(),
            "time_reversal_asymmetry": (x[4:] ** 2 * x[2:-2] - x[2:-2] * x[:-4] ** 2).mean(),
            "number_crossing_m": (np.diff((x > 1).astype(int)) != 0).sum(),
            "number_peaks": sum(
                all(x[i] > x[j] for j in (i - 2, i - 1, i + 1, i + 2)) for i in range(2, n - 2)
            ),
            "first_location_of_maximum": x.argmax() / n, "last_location_of_maximum": 1 - x[::-1].argmax() / n,
            "first_location_of_minimum": x.argmin() / n, "last_location_of_minimum": 1 - x[::-1].argmin() / n,
        }

        def run(mask):
            best = now = 0
            for m in mask:
                now = now + 1 if m else 0
                best = max(best, now)
            return best

        strikes[k] = {"longest_strike_above_mean": run(x > x.mean()), "longest_strike_below_mean": run(x < x.mean())}
        share = np.cumsum(abs(x)) / abs(x).sum()
        mass[k] = {"index_mass_quantile_0_5": (np.argmax(share >= 0.5) + 1) / n}
    check(ordered.change_features(df, ["k"], "v", lag=2, crossing=1.0, peak_support=2, chunk_rows=chunk), want)
    check(ordered.strike_features(df, ["k"], "v", chunk_rows=chunk), strikes)
    check(ordered.index_mass_quantile(df, ["k"], "v", chunk_rows=chunk), mass)


def test_energy_and_change_quantiles(series):
    parts, df = series
    energy, change = {}, {}
    for k, x in parts.items():
        pieces = np.array_split(x, 4)
        energy[k] = {f"energy_ratio_4_{i}": (p * p).sum() / (x * x).sum() for i, p in enumerate(pieces)}
        lo, hi = np.quantile(x, [0.2, 0.8])
        inside = (x >= lo) & (x <= hi)
        dx = np.diff(x)[inside[1:] & inside[:-1]]
        change[k] = {"change_quantiles_mean": dx.mean() if len(dx) else 0.0, "change_quantiles_var_abs": abs(dx).var() if len(dx) else 0.0}
    check(ordered.energy_ratio_by_chunks(df, ["k"], "v"), energy)
    check(ordered.change_quantiles(df, ["k"], "v", chunk_rows=5), change)


@pytest.mark.parametrize("chunk", [5, 65536])
def test_spectral(series, chunk):
    parts, df = series
    acf, trend, fft, perm, partial = {}, {}, {}, {}, {}
    for k, x in parts.items():
        n, c = len(x), x - x.mean()
        r = [float("nan") if x.var() == 0 else (c[:-lag] * c[lag:]).sum() / ((n - lag) * x.var()) for lag in (1, 2, 3)]
        acf[k] = {f"autocorrelation_{lag}": r[lag - 1] for lag in (1, 2, 3)}
        t = np.arange(n)
        slope, intercept = np.polyfit(t, x, 1)
        trend[k] = {"slope": slope, "intercept": intercept}
        y = np.fft.rfft(x)
        fft[k] = {f"fft_{j}_{p}": getattr(y[j], p) if p != "abs" else abs(y[j]) for j in (0, 1, 2) for p in ("real", "imag", "abs")}
        ranks = [tuple(np.argsort(np.argsort(x[i : i + 3], kind="stable"), kind="stable")) for i in range(n - 2)]
        q = np.unique(ranks, axis=0, return_counts=True)[1] / len(ranks)
        perm[k] = {"permutation_entropy": -(q * np.log(q)).sum()}
        if x.var() > 0:
            partial[k] = r
    check(spectral.autocorrelation(df, ["k"], "v", chunk_rows=chunk), acf)
    check(spectral.linear_trend(df, ["k"], "v"), trend)
    check(spectral.fft_coefficients(df, ["k"], "v"), fft)
    check(spectral.permutation_entropy(df, ["k"], "v", chunk_rows=chunk), perm)
    got = spectral.correlation_summary(df, ["k"], "v", 3, chunk_rows=chunk).toPandas().set_index("k")
    for k, r in partial.items():
        assert np.isclose(got.loc[k, "agg_autocorrelation_mean"], np.mean(r))
        assert np.isclose(got.loc[k, "agg_autocorrelation_median"], np.median(r))
        assert np.isclose(got.loc[k, "agg_autocorrelation_var"], np.var(r))
        first, second = got.loc[k, "partial_autocorrelation"][:2]
        assert np.isclose(first, r[0]) and np.isclose(second, (r[1] - r[0] ** 2) / (1 - r[0] ** 2))


def test_trend_of_parts(series):
    parts, df = series
    got = spectral.agg_linear_trend(df, ["k"], "v", 5).toPandas().set_index("k")
    x = parts[1].reshape(-1, 5).mean(axis=1)
    assert np.isclose(got.loc[1, "slope"], np.polyfit(np.arange(len(x)), x, 1)[0])


def test_segments_cover_every_row(series):
    parts, df = series
    got = spectral.segment_features(df, ["k"], "v", segment_rows=16)
    assert got.agg(F.sum("n_rows")).first()[0] == sum(map(len, parts.values()))
    assert got.filter("k = 1").count() == 3
    one = spectral.segment_features(df, ["k"], "v", segment_rows=4096).toPandas().set_index("k")
    y = abs(np.fft.rfft(parts[1]))
    assert np.isclose(one.loc[1, "fft_centroid"], (np.arange(len(y)) * y).sum() / y.sum())
    x, m, r = parts[1], 2, 0.5 * parts[1].std()

    def phi(m):
        w = np.array([x[i : i + m] for i in range(len(x) - m + 1)])
        c = [(abs(w - a).max(axis=1) <= r).mean() for a in w]
        return np.log(c).mean()

    assert np.isclose(one.loc[1, "approximate_entropy"], abs(phi(m) - phi(m + 1)))


def test_single_row_series_energy_is_the_square(spark):
    df = spark.createDataFrame([(1, 3.0), (2, -2.0)], "k int, v double")
    got = {r["k"]: r["abs_energy"] for r in free.moment_features(df, ["k"], "v").collect()}
    assert got == {1: 9.0, 2: 4.0}


def test_no_series_is_lost(spark):
    rows = [(k, float(v), i) for k in (None, 1) for i, v in enumerate([1, 3, 1, 4, 1, 5, 1, 2, 6])] + [(2, None, i) for i in range(3)]
    df = spark.createDataFrame(rows, "k int, v double, pos bigint")
    got = free.series_features(df, ["k"], "v").toPandas()
    assert len(got) == 3
    same = got[got["k"] != 2].drop(columns="k")
    assert np.allclose(same.iloc[0].astype(float).fillna(-1), same.iloc[1].astype(float).fillna(-1))
    got = ordered.ordered_features(df, ["k"], "v").toPandas()
    assert len(got) == 3
    same = got[got["k"] != 2].drop(columns="k")
    assert np.allclose(same.iloc[0].astype(float).fillna(-1), same.iloc[1].astype(float).fillna(-1))


def test_near_windows_by_sorting():
    """Equal to comparing all pairs, also with ties, and without their growth."""
    rng = np.random.default_rng(1)
    for n in (ranges.ALL_PAIRS + 1, 900):
        for width in (1, 2, 3, 4):
            for points in (rng.normal(size=(n, width)), rng.integers(0, 9, (n, width)) * 0.1, np.zeros((n, width))):
                for tolerance in (0.0, 0.1, 0.3, 2.0):
                    assert (ranges.near_counts(points, tolerance) == ranges._all_pairs(points, tolerance)).all()


def test_near_windows_grow_almost_in_proportion(monkeypatch):
    """Elements looked up per window, up to 4,096 windows."""
    seen = []
    below = ranges._Ranks.below
    monkeypatch.setattr(ranges._Ranks, "below", lambda self, lo, hi, v: seen.append(len(v) * len(self.levels)) or below(self, lo, hi, v))
    each = []
    for n in (1024, 2048, 4096):
        seen.clear()
        ranges.near_counts(np.lib.stride_tricks.sliding_window_view(np.random.default_rng(n).normal(size=n + 2), 3), 0.2)
        each.append(sum(seen) / n)
    assert each[2] < 2 * each[0]  # pairs would take four times as many


def test_near_windows_of_one_matrix():
    """Equal to comparing the windows pair by pair, with and without the matrix of gaps."""
    rng = np.random.default_rng(2)
    room = np.empty(ranges.ALL_PAIRS**2)
    for x in (rng.normal(size=ranges.ALL_PAIRS), rng.integers(0, 9, 60) * 0.1, np.zeros(5), np.array([1.0, np.nan, 1.0, np.inf, np.inf])):
        for tolerance in (0.0, 0.1, 2.0):
            want = [ranges._all_pairs(np.lib.stride_tricks.sliding_window_view(x, n), tolerance) for n in (1, 2, 4)]
            with np.errstate(invalid="ignore"):
                for gap in (ranges.gaps(x, room), ranges.gaps(x), None):
                    got = ranges.near_windows(x, gap, (1, 2, 4), tolerance)
                    assert all((g == w).all() for g, w in zip(got, want))
    assert ranges.gaps(np.zeros(ranges.ALL_PAIRS + 1)) is None


def test_segments_over_batch_borders(spark):
    """Many segments in a call, also where one needs several batches; keys without a value or equal under another name."""
    key, size = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rng = np.random.default_rng(4)
    big = 2**60 + 1
    lengths = {("a", big): 75, ("a", None): 20, (None, big): 41, (None, None): 3, ("b", big + 1): 1, ("c", 0): 600}
    series = {k: rng.normal(size=n).round(1) for k, n in lengths.items()}
    rows = [(*k, p, float(v)) for k, x in series.items() for p, v in enumerate(x)] + [("a", big, 75, None), ("d", 1, 0, None)]
    df = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "name string, k bigint, pos bigint, v double")
    wants, names = {}, [f"fft_{c}" for c in ("centroid", "variance", "skew", "kurtosis")]
    for (a, k), x in series.items():
        for s in range(0, len(x), 20):
            part = x[s : s + 20]
            e = spectral._spectrum(part)
            entropies = spectral._approximate_entropy(part, None, 2, 0.5), spectral._sample_entropy(part, None)
            wants[a, k, s // 20] = [len(part), *(e[c] for c in names), *entropies]
    try:
        for most in ("1", "7", "10000"):
            spark.conf.set(key, most)
            out = spectral.segment_features(df, ["name", "k"], "v", 20)
            assert "FlatMapGroups" not in out._jdf.queryExecution().toString()  # a call per segment
            got = {tuple(r)[:3]: list(r)[3:] for r in out.collect()}
            assert got.keys() == wants.keys()
            for k, want in wants.items():
                assert [v is None for v in got[k]] == [bool(np.isnan(v)) for v in want], k
                assert np.allclose([v for v in got[k] if v is not None], [v for v in want if not np.isnan(v)]), k
    finally:
        spark.conf.set(key, size)
