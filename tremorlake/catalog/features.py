"""Time-series features per device."""

from pyspark.sql import functions as F

from ..operators import features as free
from ..operators import ordered_features as ordered
from ..operators import spectral_features as spectral
from .registry import ORACLE, events, query
from .windows import LINE_ORDER, lines, positioned
from ..plans import with_position


def r6(df, *keep):
    """Doubles at 6 digits, other columns as they are."""
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, 6).alias(c) if kinds[c] == "double" and c not in keep else F.col(c) for c in df.columns])


@query(
    "features_moments",
    """SELECT user_id, count(value) AS length, round(sum(value), 6) AS sum_values, round(avg(value), 6) AS mean,
              min(value) AS minimum, max(value) AS maximum, round(sum(value * value), 6) AS abs_energy,
              round(stddev_pop(value), 6) AS standard_deviation, round(var_pop(value), 6) AS variance,
              count(*) FILTER (value >= -1 AND value < 50) AS range_count, count(*) FILTER (value = 6.55) AS value_count,
              round(sqrt(avg(value * value)), 6) AS root_mean_square, round(skewness(value), 6) AS skewness,
              round(kurtosis(value), 6) AS kurtosis, round(stddev_pop(value) / avg(value), 6) AS variation_coefficient,
              stddev_pop(value) > 0.25 * (max(value) - min(value)) AS large_standard_deviation,
              var_pop(value) > stddev_pop(value) AS variance_larger_than_standard_deviation
       FROM events GROUP BY user_id""",
)
def features_moments(spark, d):
    return r6(free.moment_features(events(spark, d), ["user_id"], "value", count_range=(-1.0, 50.0), count_value=6.55))


_BINS = " + ".join(
    f"(CASE WHEN b{i} > 0 THEN -(b{i} / n) * ln(b{i} / n) ELSE 0 END)" for i in range(10)
)
_PLACE = "least(floor((value - lo) / (hi - lo) * 10), 9)"


@query(
    "features_relative",
    f"""SELECT user_id, above AS count_above_mean, below AS count_below_mean, round(beyond / n, 6) AS ratio_beyond_r_sigma,
               round({_BINS}, 6) AS binned_entropy FROM (
          SELECT user_id, count(*) AS n, count(*) FILTER (value > m) AS above, count(*) FILTER (value < m) AS below,
                 count(*) FILTER (abs(value - m) > sd) AS beyond,
                 {", ".join(f"count(*) FILTER ({_PLACE} = {i}) AS b{i}" for i in range(10))}
          FROM (SELECT user_id, value, avg(value) OVER w AS m, stddev_pop(value) OVER w AS sd, min(value) OVER w AS lo,
                       max(value) OVER w AS hi FROM events WINDOW w AS (PARTITION BY user_id)) GROUP BY user_id)""",
)
def features_relative(spark, d):
    return r6(free.relative_features(events(spark, d), ["user_id"], "value"))


@query(
    "features_recurrence",
    """SELECT user_id, sum(CASE WHEN c > 1 THEN v ELSE 0 END) AS sum_of_reoccurring_values,
              sum(CASE WHEN c > 1 THEN v * c ELSE 0 END) AS sum_of_reoccurring_data_points,
              max(c) > 1 AS has_duplicate, arg_max(c, v) > 1 AS has_duplicate_max, arg_min(c, v) > 1 AS has_duplicate_min,
              round(count(*) FILTER (c > 1) / count(*), 6) AS percentage_of_reoccurring_values_to_all_values,
              round(sum(CASE WHEN c > 1 THEN c ELSE 0 END) / sum(c), 6) AS percentage_of_reoccurring_datapoints_to_all_datapoints,
              round(count(*) / sum(c), 6) AS ratio_value_number_to_series_length
       FROM (SELECT user_id, round(value, 0) AS v, count(*) AS c FROM events GROUP BY ALL) GROUP BY user_id""",
)
def features_recurrence(spark, d):
    df = events(spark, d).select("user_id", F.round("value", 0).alias("v"))
    return r6(free.recurrence_features(df, ["user_id"], "v"))


@query(
    "features_quantiles",
    """SELECT user_id, round(median(value), 6) AS median, round(quantile_cont(value, 0.1), 6) AS quantile_0_1,
              round(quantile_cont(value, 0.9), 6) AS quantile_0_9,
              abs(avg(value) - median(value)) < 0.05 * (max(value) - min(value)) AS symmetry_looking
       FROM events GROUP BY user_id""",
)
def features_quantiles(spark, d):
    return r6(free.quantile_features(events(spark, d), ["user_id"], "value"))


@query(
    "series_features_basic",
    """SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS length, round(sum(value * value), 4) AS abs_energy,
              round(avg(value), 6) AS mean, round(median(value), 6) AS median,
              round(quantile_cont(value, 0.9), 6) AS quantile_0_9, max(value) AS maximum
       FROM events GROUP BY ALL""",
)
def series_features_basic(spark, d):
    """All order-free features in one table, per (event type, day)."""
    df = events(spark, d).select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), "value")
    out = free.series_features(df, ["event_type", "day"], "value")
    return out.select(
        "event_type", "day", "length", F.round("abs_energy", 4).alias("abs_energy"), F.round("mean", 6).alias("mean"),
        F.round("median", 6).alias("median"), F.round("quantile_0_9", 6).alias("quantile_0_9"), "maximum",
    )


#: The parts' SQL over whole numbers, which recur.
_WHOLE = "FROM (SELECT * REPLACE (round(value, 0) AS value) FROM events)"


def _joined_sql(names, replace=()):
    """One row per device with the columns of several registered queries."""
    parts = [ORACLE[n] for n in names]
    for old, new in replace:
        parts = [p.replace(old, new) for p in parts]
    return "SELECT * FROM " + " JOIN ".join(f"({p}) p{i}" + (" USING (user_id)" if i else "") for i, p in enumerate(parts))


@query(
    "series_features_all",
    _joined_sql(["features_moments", "features_relative", "features_recurrence", "features_quantiles"], [("FROM events", _WHOLE)]),
)
def series_features_all(spark, d):
    """Every order-free feature of whole-number readings, in one table."""
    df = events(spark, d).select("user_id", F.round("value", 0).alias("value"))
    return r6(free.series_features(df, ["user_id"], "value", count_range=(-1.0, 50.0), count_value=6.55))


@query("abs_energy_single", "SELECT event_id, round(value * value, 4) AS abs_energy FROM events")
def abs_energy_single(spark, d):
    """One-row series, where the energy is the square."""
    out = free.moment_features(events(spark, d), ["event_id"], "value")
    return out.select("event_id", F.round("abs_energy", 4).alias("abs_energy"))


_SEQ = """SELECT user_id, value, row_number() OVER w - 1 AS pos, lag(value) OVER w AS l1, lag(value, 2) OVER w AS l2,
                 lag(value, 4) OVER w AS l4, lead(value) OVER w AS r1, count(*) OVER (PARTITION BY user_id) AS n,
                 avg(value) OVER (PARTITION BY user_id) AS m, stddev_pop(value) OVER (PARTITION BY user_id) AS sd,
                 max(value) OVER (PARTITION BY user_id) AS hi, min(value) OVER (PARTITION BY user_id) AS lo
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)"""


@query(
    "features_changes",
    f"""SELECT user_id, round(sum(abs(value - l1)), 6) AS absolute_sum_of_changes,
               round(avg(abs(value - l1)), 6) AS mean_abs_change, round(avg(value - l1), 6) AS mean_change,
               round(avg(0.5 * (value - 2 * l1 + l2)), 6) AS mean_second_derivative_central,
               round(sqrt(sum((value - l1) * (value - l1))), 6) AS cid_ce, round(avg(value * l2 * l4), 4) AS c3,
               round(avg(value * value * l2 - l2 * l4 * l4), 4) AS time_reversal_asymmetry,
               count(*) FILTER ((value > 50) <> (l1 > 50)) AS number_crossing_m,
               count(*) FILTER (value > l1 AND value > r1) AS number_peaks,
               round(sqrt(sum((value - l1) * (value - l1))) / any_value(sd), 6) AS cid_ce_normalized,
               round(min(pos) FILTER (value = hi) / any_value(n), 6) AS first_location_of_maximum,
               round((max(pos) FILTER (value = hi) + 1) / any_value(n), 6) AS last_location_of_maximum,
               round(min(pos) FILTER (value = lo) / any_value(n), 6) AS first_location_of_minimum,
               round((max(pos) FILTER (value = lo) + 1) / any_value(n), 6) AS last_location_of_minimum
        FROM ({_SEQ}) GROUP BY user_id""",
)
def features_changes(spark, d):
    out = ordered.change_features(positioned(spark, d, "value"), ["user_id"], "value", lag=2, crossing=50.0)
    big = ["c3", "time_reversal_asymmetry"]
    return r6(out, *big).withColumns({c: F.round(c, 4) for c in big})


def _strike_sql(op):
    return f"""SELECT user_id, max(len) AS n FROM (
        SELECT user_id, grp, count(*) FILTER (value {op} m) AS len FROM (
          SELECT user_id, value, m, sum(CASE WHEN value {op} m THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY pos
                 ROWS UNBOUNDED PRECEDING) AS grp FROM ({_SEQ})) GROUP BY user_id, grp) GROUP BY user_id"""


@query(
    "features_strikes",
    f"""SELECT a.user_id, a.n AS longest_strike_above_mean, b.n AS longest_strike_below_mean
        FROM ({_strike_sql('>')}) a JOIN ({_strike_sql('<')}) b ON a.user_id = b.user_id""",
)
def features_strikes(spark, d):
    return ordered.strike_features(positioned(spark, d, "value"), ["user_id"], "value")


@query(
    "features_mass_quantile",
    """SELECT user_id, round(min(CASE WHEN c / t >= 0.25 THEN pos / n END), 6) AS index_mass_quantile_0_25,
              round(min(CASE WHEN c / t >= 0.75 THEN pos / n END), 6) AS index_mass_quantile_0_75 FROM (
         SELECT user_id, row_number() OVER w AS pos, sum(abs(value)) OVER (w ROWS UNBOUNDED PRECEDING) AS c,
                sum(abs(value)) OVER (PARTITION BY user_id) AS t, count(*) OVER (PARTITION BY user_id) AS n
         FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) GROUP BY user_id""",
)
def features_mass_quantile(spark, d):
    return r6(ordered.index_mass_quantile(positioned(spark, d, "value"), ["user_id"], "value", (0.25, 0.75)))


_PART = "CASE WHEN pos < (n % 4) * (n // 4 + 1) THEN pos // (n // 4 + 1) ELSE n % 4 + (pos - (n % 4) * (n // 4 + 1)) // (n // 4) END"


@query(
    "features_energy_ratio",
    f"""SELECT user_id, {", ".join(f"round(sum(CASE WHEN part = {i} THEN value * value ELSE 0 END) / sum(value * value), 6) AS energy_ratio_4_{i}" for i in range(4))}
        FROM (SELECT user_id, value, {_PART} AS part FROM ({_SEQ})) GROUP BY user_id""",
)
def features_energy_ratio(spark, d):
    return r6(ordered.energy_ratio_by_chunks(positioned(spark, d, "value"), ["user_id"], "value", 4))


@query(
    "features_change_quantiles",
    f"""SELECT user_id, round(coalesce(avg(s), 0), 6) AS change_quantiles_mean,
               round(coalesce(avg(abs(s)), 0), 6) AS change_quantiles_mean_abs,
               round(coalesce(var_pop(s), 0), 4) AS change_quantiles_var,
               round(coalesce(var_pop(abs(s)), 0), 4) AS change_quantiles_var_abs FROM (
          SELECT e.user_id, CASE WHEN value BETWEEN ql AND qh AND l1 BETWEEN ql AND qh THEN value - l1 END AS s
          FROM ({_SEQ}) e JOIN (SELECT user_id, quantile_cont(value, 0.2) AS ql, quantile_cont(value, 0.8) AS qh
                                FROM events GROUP BY user_id) q ON e.user_id = q.user_id) GROUP BY user_id""",
)
def features_change_quantiles(spark, d):
    out = ordered.change_quantiles(positioned(spark, d, "value"), ["user_id"], "value")
    var = ["change_quantiles_var", "change_quantiles_var_abs"]
    return r6(out, *var).withColumns({c: F.round(c, 4) for c in var})


@query(
    "series_features_ordered",
    f"""SELECT c.user_id, round(sum(abs(value - l1)), 6) AS absolute_sum_of_changes,
               count(*) FILTER (value > l1 AND value > r1) AS number_peaks, any_value(a.n) AS longest_strike_above_mean
        FROM ({_SEQ}) c JOIN ({_strike_sql('>')}) a ON a.user_id = c.user_id GROUP BY c.user_id""",
)
def series_features_ordered(spark, d):
    """All order-dependent features in one table."""
    out = ordered.ordered_features(positioned(spark, d, "value"), ["user_id"], "value")
    return out.select(
        "user_id", F.round("absolute_sum_of_changes", 6).alias("absolute_sum_of_changes"), "number_peaks",
        "longest_strike_above_mean",
    )


_MASS_HALF = """SELECT user_id, round(min(CASE WHEN c / t >= 0.5 THEN pos / n END), 6) AS index_mass_quantile_0_5 FROM (
         SELECT user_id, row_number() OVER w AS pos, sum(abs(value)) OVER (w ROWS UNBOUNDED PRECEDING) AS c,
                sum(abs(value)) OVER (PARTITION BY user_id) AS t, count(*) OVER (PARTITION BY user_id) AS n
         FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) GROUP BY user_id"""
_ORDERED_PARTS = ["features_changes", "features_energy_ratio", "features_change_quantiles", "features_strikes"]


@query("ordered_features_all", f"SELECT * FROM ({_joined_sql(_ORDERED_PARTS)}) JOIN ({_MASS_HALF}) USING (user_id)")
def ordered_features_all(spark, d):
    """Every order-dependent feature in one table."""
    out = ordered.ordered_features(positioned(spark, d, "value"), ["user_id"], "value", lag=2, crossing=50.0)
    big = ["c3", "time_reversal_asymmetry", "change_quantiles_var", "change_quantiles_var_abs"]
    return r6(out, *big).withColumns({c: F.round(c, 4) for c in big})


@query(
    "features_autocorrelation",
    f"""SELECT user_id, {", ".join(f"round(sum((value - m) * (lagged{k} - m)) / ((any_value(n) - {k}) * any_value(sd) * any_value(sd)), 6) AS autocorrelation_{k}" for k in (1, 2, 3))}
        FROM (SELECT *, l1 AS lagged1, l2 AS lagged2,
                     lag(value, 3) OVER (PARTITION BY user_id ORDER BY pos) AS lagged3 FROM ({_SEQ})) GROUP BY user_id""",
)
def features_autocorrelation(spark, d):
    return r6(spectral.autocorrelation(positioned(spark, d, "value"), ["user_id"], "value"))


_ACF = ", ".join(
    f"sum((value - m) * (lag_{k} - m)) / ((any_value(n) - {k}) * any_value(sd) * any_value(sd)) AS r{k}" for k in range(1, 7)
)
_LAGGED = ", ".join(f"lag(value, {k}) OVER (PARTITION BY user_id ORDER BY pos) AS lag_{k}" for k in range(1, 7))
_ALL = "[r1, r2, r3, r4, r5, r6]"


def _partial_sql(steps):
    """The recursion of Durbin and Levinson over r, one nested query per coefficient."""
    sql = "SELECT user_id, r, [r[1]] AS phi, [r[1]] AS found FROM a"
    for k in range(2, steps + 1):
        sql = f"""SELECT user_id, r, list_append(list_transform(phi, lambda v, i: v - a * phi[{k} - i]), a) AS phi,
                         list_append(found, a) AS found FROM (
                    SELECT *, (r[{k}] - list_sum(list_transform(phi, lambda v, i: v * r[{k} - i])))
                              / (1 - list_sum(list_transform(phi, lambda v, i: v * r[i]))) AS a FROM ({sql}))"""
    return sql


@query(
    "features_correlation_summary",
    f"""WITH a AS (SELECT user_id, {_ALL} AS r FROM (SELECT user_id, {_ACF} FROM (SELECT *, {_LAGGED} FROM ({_SEQ})) GROUP BY user_id))
        SELECT user_id, round(list_avg(r), 6) AS mean_acf, round(list_median(r), 6) AS median_acf,
               round(list_var_pop(r), 6) AS var_acf, {", ".join(f"round(found[{i}], 6) AS pacf_{i}" for i in range(1, 7))}
        FROM ({_partial_sql(6)})""",
)
def features_correlation_summary(spark, d):
    out = spectral.correlation_summary(positioned(spark, d, "value"), ["user_id"], "value", 6)
    return out.select(
        "user_id",
        *[F.round(f"agg_autocorrelation_{c}", 6).alias(f"{c}_acf") for c in ("mean", "median", "var")],
        *[F.round(F.get("partial_autocorrelation", F.lit(i)), 6).alias(f"pacf_{i + 1}") for i in range(6)],
    )


@query(
    "features_linear_trend",
    f"""SELECT user_id, round(regr_slope(value, pos), 6) AS slope, round(regr_intercept(value, pos), 6) AS intercept,
               round(corr(value, pos), 6) AS rvalue,
               round(sqrt((1 - corr(value, pos) ** 2) * var_pop(value) / var_pop(pos) / (count(*) - 2)), 6) AS stderr
        FROM ({_SEQ}) GROUP BY user_id""",
)
def features_linear_trend(spark, d):
    return r6(spectral.linear_trend(positioned(spark, d, "value"), ["user_id"], "value"))


@query(
    "features_agg_linear_trend",
    f"""SELECT user_id, round(regr_slope(m, part), 9) AS slope, round(regr_intercept(m, part), 9) AS intercept,
               round(corr(m, part), 9) AS rvalue,
               round(sqrt(greatest((1 - corr(m, part) ** 2) * var_pop(m) / var_pop(part) / (count(*) - 2), 0)), 9) AS stderr
        FROM (SELECT user_id, pos // 10 AS part, avg(value) AS m FROM ({_SEQ}) GROUP BY ALL) GROUP BY user_id""",
)
def features_agg_linear_trend(spark, d):
    # Slopes of few part means end after a few digits; nine keep them clear of rounding ties.
    out = spectral.agg_linear_trend(positioned(spark, d, "value"), ["user_id"], "value")
    return out.select("user_id", *[F.round(c, 9).alias(c) for c in ("slope", "intercept", "rvalue", "stderr")])


@query(
    "features_agg_linear_trend_of",
    "SELECT * FROM "
    + " JOIN ".join(
        f"""(SELECT user_id, round(regr_slope(m, part), 9) AS slope_{name}, round(regr_intercept(m, part), 9) AS intercept_{name}
             FROM (SELECT user_id, pos // 10 AS part, {fn}(value) AS m FROM ({_SEQ}) GROUP BY ALL) GROUP BY user_id) {name}s"""
        + (" USING (user_id)" if i else "")
        for i, (name, fn) in enumerate((("max", "max"), ("min", "min"), ("var", "var_pop")))
    ),
)
def features_agg_linear_trend_of(spark, d):
    """Trends of the extremes and of the variance of parts."""
    df, out = positioned(spark, d, "value"), None
    for name in ("max", "min", "var"):
        trend = spectral.agg_linear_trend(df, ["user_id"], "value", of=name)
        part = trend.select("user_id", *[F.round(c, 9).alias(f"{c}_{name}") for c in ("slope", "intercept")])
        out = part if out is None else out.join(part, "user_id")
    return out


@query(
    "features_fft_angle",
    f"""SELECT user_id, round(degrees(atan2(-sum(value * sin(2 * pi() * pos / n)), sum(value * cos(2 * pi() * pos / n)))), 4) AS fft_1_angle,
               round(degrees(atan2(-sum(value * sin(2 * pi() * (2 * pos % n) / n)), sum(value * cos(2 * pi() * (2 * pos % n) / n)))), 4) AS fft_2_angle
        FROM ({_SEQ}) GROUP BY user_id""",
)
def features_fft_angle(spark, d):
    out = spectral.fft_coefficients(positioned(spark, d, "value"), ["user_id"], "value", (1, 2))
    return out.select("user_id", *[F.round(f"fft_{k}_angle", 4).alias(f"fft_{k}_angle") for k in (1, 2)])


_ANGLE = "2 * pi() * ({k} * pos % n) / n"


@query(
    "features_fft",
    "SELECT user_id, "
    + ", ".join(
        f"round(sum(value * cos({_ANGLE.format(k=k)})), 4) AS fft_{k}_real, "
        f"round(-sum(value * sin({_ANGLE.format(k=k)})), 4) + 0.0 AS fft_{k}_imag, "
        f"round(sqrt(sum(value * cos({_ANGLE.format(k=k)})) ** 2 + sum(value * sin({_ANGLE.format(k=k)})) ** 2), 4) AS fft_{k}_abs"
        for k in (0, 1, 2)
    )
    + f" FROM ({_SEQ}) GROUP BY user_id",
)
def features_fft(spark, d):
    out = spectral.fft_coefficients(positioned(spark, d, "value"), ["user_id"], "value")
    names = [f"fft_{k}_{p}" for k in (0, 1, 2) for p in ("real", "imag", "abs")]
    return out.select("user_id", *[(F.round(c, 4) + 0.0).alias(c) for c in names])


@query(
    "features_permutation_entropy",
    f"""SELECT user_id, round(-sum(c / t * ln(c / t)), 6) AS permutation_entropy FROM (
          SELECT user_id, c, sum(c) OVER (PARTITION BY user_id) AS t FROM (
            SELECT user_id, CAST(l2 > l1 AS INT) AS a, CAST(l2 > value AS INT) AS b, CAST(l1 > value AS INT) AS e, count(*) AS c
            FROM ({_SEQ}) WHERE l2 IS NOT NULL GROUP BY ALL)) GROUP BY user_id""",
)
def features_permutation_entropy(spark, d):
    return r6(spectral.permutation_entropy(positioned(spark, d, "value"), ["user_id"], "value"))


_SEGMENTS = f"""
WITH s AS (
  SELECT l_suppkey, pos // 256 AS segment, pos % 256 AS j, v FROM (
    SELECT l_suppkey, l_extendedprice AS v, row_number() OVER (
             PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) - 1 AS pos FROM lineitem)
), g AS (
  SELECT l_suppkey, segment, count(*) AS n, stddev_pop(v) AS sd FROM s GROUP BY ALL
), y AS (
  SELECT s.l_suppkey, s.segment, k, sqrt(sum(v * cos(2 * pi() * (k * j % n) / n)) ** 2 + sum(v * sin(2 * pi() * (k * j % n) / n)) ** 2) AS y
  FROM s JOIN g USING (l_suppkey, segment), range(0, 129) t(k) WHERE k <= n // 2 GROUP BY ALL
), m AS (
  SELECT l_suppkey, segment, sum(k * y) / sum(y) AS m1, sum(k ** 2 * y) / sum(y) AS m2, sum(k ** 3 * y) / sum(y) AS m3,
         sum(k ** 4 * y) / sum(y) AS m4 FROM y GROUP BY ALL
), f AS (
  SELECT *, m2 - m1 ** 2 AS var FROM m
), w AS (
  SELECT s.*, n, sd, lead(v) OVER o AS v1, lead(v, 2) OVER o AS v2 FROM s JOIN g USING (l_suppkey, segment)
  WINDOW o AS (PARTITION BY s.l_suppkey, s.segment ORDER BY j)
), c AS (
  SELECT a.l_suppkey, a.segment, a.j, any_value(a.n) AS n, any_value(a.v2) AS v2,
         count(*) FILTER (abs(a.v - b.v) <= 0.5 * a.sd AND abs(a.v1 - b.v1) <= 0.5 * a.sd) AS c2,
         count(*) FILTER (abs(a.v - b.v) <= 0.5 * a.sd AND abs(a.v1 - b.v1) <= 0.5 * a.sd AND abs(a.v2 - b.v2) <= 0.5 * a.sd) AS c3,
         count(*) FILTER (b.v2 IS NOT NULL AND abs(a.v - b.v) <= 0.2 * a.sd AND abs(a.v1 - b.v1) <= 0.2 * a.sd) AS s2,
         count(*) FILTER (abs(a.v - b.v) <= 0.2 * a.sd AND abs(a.v1 - b.v1) <= 0.2 * a.sd AND abs(a.v2 - b.v2) <= 0.2 * a.sd) AS s3
  FROM w a JOIN w b ON a.l_suppkey = b.l_suppkey AND a.segment = b.segment
  WHERE a.v1 IS NOT NULL AND b.v1 IS NOT NULL GROUP BY ALL
), e AS (
  SELECT l_suppkey, segment, abs(avg(ln(c2 / (n - 1))) - avg(ln(c3 / (n - 2))) FILTER (v2 IS NOT NULL)) AS apen,
         sum(s2 - 1) FILTER (v2 IS NOT NULL) AS near2, sum(s3 - 1) FILTER (v2 IS NOT NULL) AS near3
  FROM c GROUP BY ALL
)
SELECT l_suppkey, segment, n AS n_rows, round(m1, 4) AS fft_centroid, round(var, 4) AS fft_variance,
       CASE WHEN var >= 0.5 THEN round((m3 - 3 * m1 * var - m1 ** 3) / var ** 1.5, 4) END AS fft_skew,
       CASE WHEN var >= 0.5 THEN round((m4 - 4 * m1 * m3 + 6 * m2 * m1 ** 2 - 3 * m1 ** 4) / var ** 2, 4) END AS fft_kurtosis,
       CASE WHEN n <= 3 THEN 0.0 ELSE round(apen, 6) END AS approximate_entropy,
       CASE WHEN n > 3 AND near2 > 0 AND near3 > 0 THEN round(-ln(near3 / near2), 6) END AS sample_entropy
FROM g LEFT JOIN f USING (l_suppkey, segment) LEFT JOIN e USING (l_suppkey, segment)"""


@query("features_segments", _SEGMENTS)
def features_segments(spark, d):
    """Spectral moments and entropies of each supplier's price series, in segments of 256 rows."""
    df = with_position(lines(spark, d), ["l_suppkey"], LINE_ORDER)
    out = spectral.segment_features(df, ["l_suppkey"], "l_extendedprice", 256)
    digits = {c: 4 for c in ("fft_centroid", "fft_variance", "fft_skew", "fft_kurtosis")}
    digits |= {"approximate_entropy": 6, "sample_entropy": 6}
    known = {c: F.round(F.when(~F.isnan(c), F.col(c)), n) for c, n in digits.items()}
    return out.select("l_suppkey", "segment", "n_rows", *[e.alias(c) for c, e in known.items()])
