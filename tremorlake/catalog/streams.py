"""Streaming queries over the events table as a file stream, run until the data is used up."""

import numpy as np
from pyspark.sql import functions as F

from ..operators.keyed import read_keyed
from ..operators.normalize import apply_scaler, fit_scaler
from ..plans import write_scratch
from ..plans.scratch import scratch_path
from ..streaming.episodes import anomaly_counts, anomaly_sessions
from ..streaming.ingest import accepted, decode, deduplicated, keyed_sink, start
from ..streaming.scoring import incremental_scorer, read_scored
from ..streaming.stateful import ROCKSDB, score_ordered
from .detection import SCORES_SQL, event_scorer
from .readings import messages
from .registry import events, query


def is_folder(spark, path):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def event_stream(spark, d):
    """The table as a stream of files, whether it is one file or a folder of them."""
    path = f"{d}/events.parquet"
    reader = spark.readStream.schema(events(spark, d).schema)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(d)


def run_to_table(spark, stream, name):
    """Write an append stream to files until its input is used up, and read the result."""
    out, ck = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    q = (
        stream.writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", ck).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query(
    "stream_ingest",
    """SELECT CAST(1 + user_id % 15 AS INTEGER) AS device_id, event_id AS index, value AS x
       FROM events WHERE event_type <> 'error'""",
)
def stream_ingest(spark, d):
    """Messages, each delivered twice, decoded, deduplicated and stored by key."""
    lines, out, ck = (scratch_path(spark, n) for n in ("messages", "keyed", "keyed-checkpoint"))
    m = messages(spark, d)
    m.unionByName(m).write.text(lines)
    readings = deduplicated(accepted(decode(spark.readStream.text(lines))), "40 days")
    start(readings, keyed_sink(out), ck).awaitTermination()
    stored = read_keyed(spark, out, ["device_id", "index"])
    return stored.select("device_id", "index", F.round(F.col("X").cast("double"), 6).alias("x"))


def outlier_stream(spark, d, k=1.5):
    # Written once, so that no batch reads the readings again for them.
    stats = write_scratch(fit_scaler(events(spark, d), "value"), "scaler")
    rows = event_stream(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    z = apply_scaler(rows, stats, "value", out="distance", digits=None)
    return z.filter((F.col("distance") > k) | (F.col("distance") < -k))


_OUT = """SELECT user_id, ts, (SELECT max(ts) FROM outliers) - INTERVAL 1 DAY AS mark FROM outliers"""
_OUTLIERS = """WITH outliers AS (SELECT * FROM (SELECT user_id, ts,
                 (value - avg(value) OVER ()) / stddev_samp(value) OVER () AS d FROM events) WHERE d > 1.5 OR d < -1.5)"""


@query(
    "stream_episodes",
    f"""{_OUTLIERS}
        SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n_outliers FROM ({_OUT})
        WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= date_trunc('millisecond', mark)
        GROUP BY ALL HAVING count(*) > 1""",
)
def stream_episodes(spark, d):
    """Days of a device with more than one outlier that the watermark has closed."""
    out = run_to_table(spark, anomaly_counts(outlier_stream(spark, d), "user_id", "ts", "1 day", delay="1 day", min_count=1), "episodes")
    return out.select("user_id", F.date_format("window_start", "yyyy-MM-dd").alias("day"), "n_outliers")


@query(
    "stream_episodes_sliding",
    f"""{_OUTLIERS}
        SELECT user_id, strftime(w, '%Y-%m-%d') AS day, count(*) AS n_outliers FROM (
          SELECT user_id, mark, unnest([date_trunc('day', ts) - INTERVAL 1 DAY, date_trunc('day', ts)]) AS w FROM ({_OUT}))
        WHERE w + INTERVAL 2 DAY <= date_trunc('millisecond', mark) GROUP BY ALL HAVING count(*) > 2""",
)
def stream_episodes_sliding(spark, d):
    counts = anomaly_counts(outlier_stream(spark, d), "user_id", "ts", "2 days", "1 day", delay="1 day", min_count=2)
    out = run_to_table(spark, counts, "sliding")
    return out.select("user_id", F.date_format("window_start", "yyyy-MM-dd").alias("day"), "n_outliers")


@query(
    "stream_sessions",
    f"""{_OUTLIERS}
        SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS n_outliers FROM (
          SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (
            SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS new
            FROM ({_OUT})))
        GROUP BY user_id, s HAVING count(*) > 1 AND max(ts) + INTERVAL 12 HOUR <= date_trunc('millisecond', any_value(mark))""",
)
def stream_sessions(spark, d):
    counts = anomaly_sessions(outlier_stream(spark, d), "user_id", "ts", "12 hours", delay="1 day", min_count=1)
    out = run_to_table(spark, counts, "sessions")
    return out.select(
        "user_id", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "n_outliers"
    )


@query("stream_scores", SCORES_SQL)
def stream_scores(spark, d):
    """The stream form of ``series_scores``, with the context of each device carried along."""
    state, out, ck = (scratch_path(spark, n) for n in ("state", "scores", "scores-checkpoint"))
    rows = event_stream(spark, d).select("event_id", "user_id", "value")
    start(rows, incremental_scorer(event_scorer(spark, d), state, out), ck).awaitTermination()
    got = read_scored(spark, out)
    return got.select("event_id", "user_id", F.round("loss", 6).alias("loss"), "label")


class MeanReconstructor:
    """A window rebuilt from its own mean, as in ``flat_loss``."""

    def reconstruct(self, x):
        return np.repeat(x.mean(axis=1, keepdims=True), x.shape[1], axis=1)


@query(
    "stream_scores_stateful",
    f"""SELECT s.* FROM ({SCORES_SQL}) s JOIN events e ON e.event_id = s.event_id
        WHERE epoch_ms(e.ts) <= (SELECT max(epoch_ms(ts)) - 86400000 FROM events)""",
)
def stream_scores_stateful(spark, d):
    """The same scores from keyed state: readings are held until the watermark has passed them."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        rows = event_stream(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
        stats = write_scratch(fit_scaler(events(spark, d), "value"), "scaler")
        z = apply_scaler(rows, stats, "value", out="z", digits=None)
        scored = score_ordered(
            z, MeanReconstructor(), "user_id", "event_id", "ts", "z", "1 day", threshold=0.5, bucket_seconds=86_400
        )
        out = run_to_table(spark, scored, "stateful")
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
    return out.select(F.col("index").alias("event_id"), "user_id", F.round("loss", 6).alias("loss"), "label")
