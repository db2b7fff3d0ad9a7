"""Rule-based detectors."""

from pyspark.sql import functions as F

from ..operators import sigma
from ..operators.clean import in_bucket
from ..operators.kmeans import cluster_rarity
from ..operators.keyed import anomaly_overlay
from ..operators.slices import in_slices
from ..plans import asof_join, merge_intervals
from ..streaming.scoring import Scorer, flat_loss, score_batch
from ..operators.normalize import fit_scaler
from .registry import event_block, events, query, with_day

_DISTANCE = """SELECT event_id, user_id, value, strftime(ts, '%Y-%m-%d') AS day,
                      (value - avg(value) OVER ()) / stddev_samp(value) OVER () AS distance FROM events"""
_EPISODES = f"""SELECT day, count(*) AS n_outliers FROM ({_DISTANCE})
                WHERE distance > 3 OR distance < -3 GROUP BY day HAVING count(*) > 5"""


@query(
    "sigma_outliers",
    f"""SELECT event_id, round(distance, 6) AS distance FROM ({_DISTANCE}) WHERE distance > 4 OR distance < -4""",
)
def sigma_outliers(spark, d):
    out = sigma.sigma_outliers(events(spark, d).select("event_id", "value"), "value")
    return out.select("event_id", F.round("distance", 6).alias("distance"))


@query(
    "sigma_outliers_by_device",
    """SELECT event_id, user_id, round(distance, 6) AS distance FROM (
         SELECT event_id, user_id, (value - avg(value) OVER (PARTITION BY user_id))
                / stddev_samp(value) OVER (PARTITION BY user_id) AS distance FROM events)
       WHERE distance > 3 OR distance < -3""",
)
def sigma_outliers_by_device(spark, d):
    df = events(spark, d).select("event_id", "user_id", "value")
    out = sigma.sigma_outliers(df, "value", 3.0, ["user_id"])
    return out.select("event_id", "user_id", F.round("distance", 6).alias("distance"))


def episodes(spark, d, k=3.0, min_count=5):
    df = with_day(events(spark, d).select("event_id", "ts", "value"))
    return sigma.outlier_episodes(sigma.sigma_outliers(df, "value", k), "day", min_count)


@query("sigma_episodes", _EPISODES)
def sigma_episodes(spark, d):
    return episodes(spark, d)


@query(
    "sigma_episodes_by_device",
    """SELECT user_id, day, count(*) AS n_outliers FROM (
         SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, (value - avg(value) OVER (PARTITION BY user_id))
                / stddev_samp(value) OVER (PARTITION BY user_id) AS distance FROM events)
       WHERE distance > 1.5 OR distance < -1.5 GROUP BY ALL HAVING count(*) > 1""",
)
def sigma_episodes_by_device(spark, d):
    df = with_day(events(spark, d).select("event_id", "user_id", "ts", "value"))
    out = sigma.sigma_outliers(df, "value", 1.5, ["user_id"])
    return sigma.outlier_episodes(out, "day", 1, ["user_id"])


@query(
    "sigma_labels",
    f"""SELECT event_id, CAST(day IN (SELECT day FROM ({_EPISODES})) AS INTEGER) AS anomaly FROM ({_DISTANCE})""",
)
def sigma_labels(spark, d):
    df = with_day(events(spark, d).select("event_id", "ts"))
    return sigma.label_episodes(df, episodes(spark, d), "day").select("event_id", "anomaly")


@query(
    "cluster_rarity",
    """WITH c AS (SELECT CAST(round(value / 50, 0) AS INTEGER) AS cluster, count(*) AS n FROM events GROUP BY 1),
            e AS (SELECT min(n) AS lo, max(n) AS hi FROM c)
       SELECT event_id, CAST(round(value / 50, 0) AS INTEGER) AS cluster,
              round((hi - n) / (hi - lo), 6) AS score,
              coalesce(CAST((hi - n) / (hi - lo) > 0.9999 AS INTEGER), 0) AS anomaly
       FROM events JOIN c ON c.cluster = CAST(round(value / 50, 0) AS INTEGER), e""",
)
def rarity(spark, d):
    df = events(spark, d).select("event_id", F.round(F.col("value") / 50, 0).cast("int").alias("cluster"))
    return cluster_rarity(df, "cluster").select("event_id", "cluster", F.round("score", 6).alias("score"), "anomaly")


@query(
    "normal_slices",
    """SELECT event_id, value FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-02 06:15:00' AND TIMESTAMP '2024-01-02 21:45:00'
       OR ts BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-04 00:00:00'
       OR ts BETWEEN TIMESTAMP '2024-01-17 03:30:00' AND TIMESTAMP '2024-01-19 15:00:00'""",
)
def normal_slices(spark, d):
    slices = spark.createDataFrame(
        [
            ("2024-01-02 06:15:00", "2024-01-02 21:45:00"),
            ("2024-01-03 00:00:00", "2024-01-04 00:00:00"),
            ("2024-01-17 03:30:00", "2024-01-19 15:00:00"),
        ],
        "slice_start string, slice_end string",
    )
    return in_slices(events(spark, d), slices, "ts").select("event_id", "value")


@query(
    "normal_slices_by_device",
    """SELECT e.event_id, e.user_id, e.value FROM events e
       WHERE EXISTS (SELECT 1 FROM (SELECT user_id, min(ts) AS a, min(ts) + INTERVAL 5 DAY AS b FROM events GROUP BY 1) s
                     WHERE s.user_id = e.user_id AND e.ts BETWEEN s.a AND s.b)""",
)
def normal_slices_by_device(spark, d):
    """The first five days of each device as its slice of normal operation."""
    df = events(spark, d).select("event_id", "user_id", "ts", "value")
    first = df.groupBy("user_id").agg(F.min("ts").alias("slice_start"))
    slices = first.withColumn("slice_end", F.col("slice_start") + F.expr("interval 5 days"))
    return in_slices(df, slices, "ts", "user_id").select("event_id", "user_id", "value")


_INCIDENTS = """SELECT user_id, ts - INTERVAL 20 MINUTE AS slice_start, ts + to_minutes(CAST(5 + event_id % 90 AS INTEGER)) AS slice_end
                FROM events WHERE event_type = 'error'"""
_IN_INCIDENT = f"""SELECT e.event_id, e.user_id, e.value FROM events e
                   WHERE EXISTS (SELECT 1 FROM ({_INCIDENTS}) s
                                 WHERE s.user_id = e.user_id AND e.ts BETWEEN s.slice_start AND s.slice_end)"""


def incidents(spark, d):
    """Many short, overlapping slices a day: from 20 minutes before each error to some time after it."""
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), (5 + F.col("event_id") % 90).cast("int"))
    return events(spark, d).filter("event_type = 'error'").select(
        "user_id", (F.col("ts") - F.expr("interval 20 minutes")).alias("slice_start"), (F.col("ts") + minutes).alias("slice_end")
    )


@query("incident_slices", _IN_INCIDENT)
def incident_slices(spark, d):
    """Readings of a device around its errors; the merged slices are broadcast."""
    df = events(spark, d).select("event_id", "user_id", "ts", "value")
    return in_slices(df, incidents(spark, d), "ts", "user_id").select("event_id", "user_id", "value")


@query("incident_slices_sorted", _IN_INCIDENT)
def incident_slices_sorted(spark, d):
    """The same with slices too many to broadcast, sorted together with the readings."""
    df = events(spark, d).select("event_id", "user_id", "ts", "value")
    return in_slices(df, incidents(spark, d), "ts", "user_id", limit=0).select("event_id", "user_id", "value")


@query(
    "merged_slices",
    f"""WITH s AS ({_INCIDENTS}),
        r AS (SELECT *, max(slice_end) OVER (PARTITION BY user_id ORDER BY slice_start, slice_end
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
        i AS (SELECT *, sum(CASE WHEN reach IS NULL OR reach < slice_start THEN 1 ELSE 0 END)
                        OVER (PARTITION BY user_id ORDER BY slice_start, slice_end ROWS UNBOUNDED PRECEDING) AS island FROM r)
        SELECT user_id, epoch_us(min(slice_start)) AS slice_start, epoch_us(max(slice_end)) AS slice_end
        FROM i GROUP BY user_id, island""",
)
def merged_slices(spark, d):
    merged = merge_intervals(incidents(spark, d), ["user_id"], "slice_start", "slice_end")
    micros = [F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in ("slice_start", "slice_end")]
    return merged.select("user_id", *micros)


_LAST_ERROR = """SELECT a.event_id, a.user_id, b.event_id AS error_id, b.value AS error_value
                 FROM events a ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id, arg_max(value, event_id) AS value
                                               FROM events WHERE event_type = 'error' GROUP BY ALL) b
                 ON a.user_id = b.user_id AND a.ts >= b.ts"""


def last_error(spark, d, **options):
    df = events(spark, d)
    errors = df.filter("event_type = 'error'").select(
        "user_id", F.col("ts").alias("error_ts"), F.col("event_id").alias("error_id"), F.col("value").alias("error_value")
    )
    rows = df.select("event_id", "user_id", "ts")
    return asof_join(rows, errors, ["user_id"], "ts", "error_ts", ["error_id", "error_value"], **options).drop("ts")


@query("last_error", _LAST_ERROR)
def last_error_broadcast(spark, d):
    """Each reading with the last error of its device up to then."""
    return last_error(spark, d)


@query("last_error_sorted", _LAST_ERROR)
def last_error_sorted(spark, d):
    return last_error(spark, d, limit=0)


@query(
    "normal_bucket",
    "SELECT event_id, user_id, value FROM events WHERE CAST(round(value, 0) AS BIGINT) = 7",
)
def normal_bucket(spark, d):
    return in_bucket(events(spark, d), "value", 7.0).select("event_id", "user_id", "value")


SCORES_SQL = """
    WITH z AS (SELECT event_id, user_id, (value - avg(value) OVER ()) / stddev_samp(value) OVER () AS z FROM events),
    m AS (SELECT event_id, user_id, CASE WHEN count(*) OVER w >= 3 THEN avg(z) OVER w END AS m FROM z
          WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
    l AS (SELECT event_id, user_id, count(m) OVER w AS n, list(m) OVER w AS ms FROM m
          WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
    s AS (SELECT event_id, user_id, list_avg(list_transform(ms, lambda x: abs(x - list_avg(ms)))) AS loss FROM l WHERE n = 5)
    SELECT event_id, user_id, round(loss, 6) AS loss, CAST(loss > 0.5 AS INTEGER) AS label FROM s
"""


def event_scorer(spark, d, **options):
    return Scorer(
        scaler=fit_scaler(events(spark, d), "value"),
        loss=flat_loss(),
        threshold=0.5,
        device="user_id",
        index="event_id",
        by_device=False,
        **options,
    )


@query("series_scores", SCORES_SQL)
def series_scores(spark, d):
    df = events(spark, d).select("event_id", "user_id", "value")
    out = score_batch(df, event_scorer(spark, d), block=event_block())
    return out.select("event_id", "user_id", F.round("loss", 6).alias("loss"), "label")


@query(
    "anomaly_overlay",
    f"SELECT event_id, user_id, loss FROM ({SCORES_SQL}) WHERE label > 0",
)
def overlay(spark, d):
    df = events(spark, d).select("event_id", "user_id", "value")
    out = anomaly_overlay(score_batch(df, event_scorer(spark, d), block=event_block()))
    return out.select("event_id", "user_id", F.round("loss", 6).alias("loss"))


@query(
    "gated_scores",
    f"""SELECT event_id, user_id, CASE WHEN sum(label) OVER (PARTITION BY user_id) >= 7 THEN label ELSE 0 END AS label
        FROM ({SCORES_SQL})""",
)
def gated_scores(spark, d):
    df = events(spark, d).select("event_id", "user_id", "value")
    out = score_batch(df, event_scorer(spark, d, gate=7), block=event_block())
    return out.select("event_id", "user_id", "label")
