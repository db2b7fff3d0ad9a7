"""Normalising, smoothing and lag windows."""

from pyspark.sql import functions as F

from ..operators.normalize import apply_scaler, fit_scaler, znorm
from ..operators.smooth import lag_windows, moving_average, rolling_mean, smoothed_windows
from ..plans import with_position
from ..plans.scratch import scratch_path
from ..sources.models import load_parameters, save_parameters
from ..sources.series import read_series, write_series
from .registry import event_block, events, query, table, with_day


def positioned(spark, d, *columns):
    df = events(spark, d).select("event_id", "user_id", *columns)
    return with_position(df, ["user_id"], ["event_id"], "pos", event_block())


LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
_LINE_KEY = "l_suppkey, l_orderkey, l_linenumber, l_partkey"
_LINE_OVER = "PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey"


def lines(spark, d):
    cols = ["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice"]
    return table(spark, d, "lineitem").select(*cols)


@query(
    "znorm_global",
    """SELECT event_id, round((value - avg(value) OVER ()) / stddev_samp(value) OVER (), 6) AS zscale FROM events""",
)
def znorm_global(spark, d):
    return znorm(events(spark, d).select("event_id", "value"), "value").drop("value")


@query(
    "znorm_pop",
    """SELECT event_id, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) AS zscale FROM events""",
)
def znorm_pop(spark, d):
    return znorm(events(spark, d).select("event_id", "value"), "value", ddof=0).drop("value")


@query(
    "znorm_by_device",
    """SELECT event_id, user_id, round((value - avg(value) OVER (PARTITION BY user_id))
              / stddev_samp(value) OVER (PARTITION BY user_id), 6) AS zscale FROM events""",
)
def znorm_by_device(spark, d):
    return znorm(events(spark, d).select("event_id", "user_id", "value"), "value", ["user_id"]).drop("value")


@query(
    "znorm_lineitem",
    f"""SELECT {_LINE_KEY}, round((l_extendedprice - avg(l_extendedprice) OVER (PARTITION BY l_suppkey))
              / stddev_pop(l_extendedprice) OVER (PARTITION BY l_suppkey), 6) AS zscale FROM lineitem""",
)
def znorm_lineitem(spark, d):
    df = lines(spark, d).drop("l_shipdate")
    return znorm(df, "l_extendedprice", ["l_suppkey"], ddof=0).drop("l_extendedprice")


@query(
    "scaler_reuse",
    """WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM events
                  WHERE ts < TIMESTAMP '2024-01-15 00:00:00')
       SELECT event_id, round((value - m) / sd, 6) AS zscale FROM events, s""",
)
def scaler_reuse(spark, d):
    """Statistics of the first half of the period, applied to all of it."""
    df = events(spark, d)
    stats = fit_scaler(df.filter(F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")), "value")
    return apply_scaler(df.select("event_id", "value"), stats, "value").drop("value")


@query(
    "saved_scaler",
    """SELECT event_id, round((value - avg(value) OVER ()) / stddev_samp(value) OVER (), 6) AS zscale FROM events""",
)
def saved_scaler(spark, d):
    """Statistics fitted, saved, loaded and applied."""
    df, path = events(spark, d).select("event_id", "value"), scratch_path(spark, "scaler")
    save_parameters(fit_scaler(df, "value"), path)
    return apply_scaler(df, load_parameters(spark, path), "value").drop("value")


@query(
    "znorm_null_device",
    """WITH e AS (SELECT event_id, nullif(user_id % 5, 0) AS device, value FROM events)
       SELECT event_id, device, round((value - avg(value) OVER w) / stddev_samp(value) OVER w, 6) AS zscale
       FROM e WINDOW w AS (PARTITION BY device)""",
)
def znorm_null_device(spark, d):
    """Readings without a device are a series of their own."""
    df = events(spark, d).select("event_id", F.expr("nullif(user_id % 5, 0)").alias("device"), "value")
    return znorm(df, "value", ["device"]).select("event_id", "device", "zscale")


def _centred_sql(k):
    return f"""SELECT event_id, user_id, round(avg(value) OVER (PARTITION BY user_id, CAST(ts AS DATE)
               ORDER BY event_id ROWS BETWEEN {k} PRECEDING AND {k} FOLLOWING), 6) AS moving_average FROM events"""


def _centred(k):
    def run(spark, d):
        df = with_day(positioned(spark, d, "ts", "value"))
        out = moving_average(df, "value", ["user_id"], "day", k)
        return out.select("event_id", "user_id", F.round("moving_average", 6).alias("moving_average"))

    return run


for _k, _name in ((1, "moving_avg_reach_1"), (3, "moving_avg_centered"), (5, "moving_avg_reach_5")):
    query(_name, _centred_sql(_k))(_centred(_k))


@query(
    "rolling_mean_3",
    """SELECT event_id, user_id, CASE WHEN count(value) OVER w >= 3 THEN round(avg(value) OVER w, 6) END AS rolling_mean
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def rolling_mean_3(spark, d):
    out = rolling_mean(positioned(spark, d, "value"), "value", ["user_id"], 3)
    return out.select("event_id", "user_id", F.round("rolling_mean", 6).alias("rolling_mean"))


@query(
    "rolling_mean_partial",
    """SELECT event_id, user_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY event_id
              ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS rolling_mean FROM events""",
)
def rolling_mean_partial(spark, d):
    out = rolling_mean(positioned(spark, d, "value"), "value", ["user_id"], 5, min_periods=1)
    return out.select("event_id", "user_id", F.round("rolling_mean", 6).alias("rolling_mean"))


@query(
    "rolling_mean_halo",
    """SELECT event_id, user_id, CASE WHEN count(value) OVER w >= 4 THEN round(avg(value) OVER w, 6) END AS rolling_mean
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
)
def rolling_mean_halo(spark, d):
    """Chunks of eight rows, so that every series here is cut and relies on its halo rows."""
    out = rolling_mean(positioned(spark, d, "value"), "value", ["user_id"], 4, chunk_rows=8)
    return out.select("event_id", "user_id", F.round("rolling_mean", 6).alias("rolling_mean"))


@query(
    "smoothed_windows",
    """WITH m AS (SELECT event_id, user_id, value, CASE WHEN count(*) OVER w >= 3 THEN avg(value) OVER w END AS m FROM events
          WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
       SELECT event_id, user_id, round(w0, 6) AS w0, round(w1, 6) AS w1, round(w2, 6) AS w2, round(w3, 6) AS w3, round(w4, 6) AS w4
       FROM (SELECT event_id, user_id, lag(m, 5) OVER v AS w0, lag(m, 4) OVER v AS w1, lag(m, 3) OVER v AS w2,
                    lag(m, 2) OVER v AS w3, lag(m, 1) OVER v AS w4 FROM m
             WINDOW v AS (PARTITION BY user_id ORDER BY event_id)) WHERE w0 IS NOT NULL""",
)
def smoothed_lag_windows(spark, d):
    out = smoothed_windows(positioned(spark, d, "value"), "value", ["user_id"], 3, 5, chunk_rows=16)
    places = [F.round(F.get("window", F.lit(i)), 6).alias(f"w{i}") for i in range(5)]
    return out.select("event_id", "user_id", *places)


@query(
    "stored_series",
    """SELECT event_id, user_id, pos FROM (
         SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos FROM events)
       WHERE pos BETWEEN 10 AND 36""",
)
def stored_series(spark, d):
    """Series written once in their order, then a page of each by position."""
    path = scratch_path(spark, "series")
    write_series(events(spark, d).select("event_id", "user_id", "value"), path, ["user_id"], ["event_id"], block=event_block())
    return read_series(spark, path).filter(F.col("pos").between(10, 36)).select("event_id", "user_id", "pos")


@query(
    "rolling_mean_lineitem",
    f"""SELECT {_LINE_KEY}, CASE WHEN count(*) OVER w >= 3 THEN round(avg(l_extendedprice) OVER w, 4) END AS rolling_mean
        FROM lineitem WINDOW w AS ({_LINE_OVER} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def rolling_mean_lineitem(spark, d):
    """No index here: the series are laid out by a sort on the whole order."""
    df = with_position(lines(spark, d), ["l_suppkey"], LINE_ORDER)
    out = rolling_mean(df, "l_extendedprice", ["l_suppkey"], 3)
    return out.select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.round("rolling_mean", 4).alias("rolling_mean")
    )


@query(
    "row_number_series",
    f"SELECT {_LINE_KEY}, row_number() OVER ({_LINE_OVER}) - 1 AS pos FROM lineitem",
)
def row_number_series(spark, d):
    df = with_position(lines(spark, d), ["l_suppkey"], LINE_ORDER)
    return df.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "pos")


_LAGS = ", ".join(
    f"lag(value, {5 - i}) OVER (PARTITION BY user_id ORDER BY event_id) AS w{i}" for i in range(5)
)


@query(
    "lag_windows_5",
    f"SELECT * FROM (SELECT event_id, user_id, {_LAGS}, value AS next_value FROM events) WHERE w0 IS NOT NULL",
)
def lag_windows_5(spark, d):
    out = lag_windows(positioned(spark, d, "value"), "value", ["user_id"], 5)
    return out.select(
        "event_id",
        "user_id",
        *[F.get("window", F.lit(i)).alias(f"w{i}") for i in range(5)],
        F.col("value").alias("next_value"),
    )
