"""Distributions, extremes, thresholds, counts and keyed tables."""

from pyspark.sql import functions as F

from ..operators import keyed, stats
from ..operators.clean import time_range
from ..plans import attach_scalar
from ..plans.scratch import scratch_path
from ..sources.bucketed import BucketedTable
from .registry import events, query, table


@query("value_histogram", "SELECT round(value / 10, 0) AS bucket, count(*) AS n_rows FROM events GROUP BY 1")
def value_histogram(spark, d):
    return stats.value_histogram(events(spark, d).select((F.col("value") / 10).alias("v")), "v")


@query(
    "value_histogram_by_device",
    """SELECT user_id, CAST(round(value / 10, 0) AS INTEGER) AS bucket, count(*) AS n_rows FROM events
       GROUP BY ALL""",
)
def value_histogram_by_device(spark, d):
    df = events(spark, d).select("user_id", (F.col("value") / 10).alias("v"))
    return stats.value_histogram(df, "v", by=["user_id"], kind="int")


_GAPS = "SELECT CASE WHEN value <= 100 THEN value / 10 END AS v FROM events"


@query("histogram_null_uncounted", f"SELECT round(v, 0) AS bucket, count(v) AS n_rows FROM ({_GAPS}) GROUP BY 1")
def histogram_null_uncounted(spark, d):
    df = events(spark, d).select(F.when(F.col("value") <= 100, F.col("value") / 10).alias("v"))
    return stats.value_histogram(df, "v")


@query("histogram_null_counted", f"SELECT round(v, 0) AS bucket, count(*) AS n_rows FROM ({_GAPS}) GROUP BY 1")
def histogram_null_counted(spark, d):
    df = events(spark, d).select(F.when(F.col("value") <= 100, F.col("value") / 10).alias("v"))
    return stats.value_histogram(df, "v", count_nulls=True)


@query(
    "mode_buckets",
    """SELECT round(value, 0) AS bucket, count(*) AS n_rows FROM events GROUP BY 1
       ORDER BY n_rows DESC, bucket LIMIT 5""",
)
def mode_buckets(spark, d):
    return stats.mode_buckets(events(spark, d), "value", 5)


@query(
    "mode_buckets_by_type",
    """SELECT event_type, bucket, n_rows FROM (
         SELECT event_type, bucket, n_rows,
                row_number() OVER (PARTITION BY event_type ORDER BY n_rows DESC, bucket) AS r
         FROM (SELECT event_type, round(value, 0) AS bucket, count(*) AS n_rows FROM events GROUP BY 1, 2))
       WHERE r <= 3""",
)
def mode_buckets_by_type(spark, d):
    return stats.mode_buckets(events(spark, d), "value", 3, by=["event_type"])


@query("top_k_high", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 100")
def top_k_high(spark, d):
    return stats.extremes(events(spark, d).select("event_id", "value"), "value", 100, ["event_id"])


@query("top_k_low", "SELECT event_id, value FROM events ORDER BY value, event_id LIMIT 50")
def top_k_low(spark, d):
    return stats.extremes(events(spark, d).select("event_id", "value"), "value", 50, ["event_id"], ascending=True)


@query(
    "top_k_per_device",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, rank FROM (
         SELECT *, row_number() OVER (PARTITION BY l_suppkey
                ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_shipdate) AS rank FROM lineitem)
       WHERE rank <= 20""",
)
def top_k_per_device(spark, d):
    cols = ["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice"]
    tie = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]
    df = table(spark, d, "lineitem").select(*cols)
    return stats.extremes(df, "l_extendedprice", 20, tie, by=["l_suppkey"], rank="rank").drop("l_shipdate")


@query(
    "top_5000_per_device",
    """SELECT user_id, event_id, value, rank FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) AS rank FROM events)
       WHERE rank <= 5000""",
)
def top_5000_per_device(spark, d):
    df = events(spark, d).select("user_id", "event_id", "value")
    return stats.extremes(df, "value", 5000, ["event_id"], by=["user_id"], rank="rank")


@query(
    "top_5000_per_flag",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, rank FROM (
         SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
                                      l_partkey, l_shipdate) AS rank FROM lineitem) WHERE rank <= 5000""",
)
def top_5000_per_flag(spark, d):
    """Three groups, the largest of which holds half of all rows."""
    cols = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice"]
    tie = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]
    df = table(spark, d, "lineitem").select(*cols)
    out = stats.extremes(df, "l_extendedprice", 5000, tie, by=["l_returnflag"], rank="rank")
    return out.drop("l_partkey", "l_shipdate")


@query(
    "lowest_2000",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_quantity, l_orderkey, l_linenumber, l_partkey LIMIT 2000",
)
def lowest_2000(spark, d):
    """Ties at the border: a 25th of all rows has the smallest quantity."""
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return stats.extremes(df, "l_quantity", 2000, ["l_orderkey", "l_linenumber", "l_partkey"], ascending=True).drop("l_partkey")


@query(
    "mean_and_deviation",
    """SELECT event_type, round(avg(value), 6) AS mean_value, round(stddev_samp(value), 6) AS sd_value,
              count(*) AS n_rows FROM events GROUP BY event_type""",
)
def mean_and_deviation(spark, d):
    out = stats.mean_and_deviation(events(spark, d), "value", ["event_type"])
    return out.select(
        "event_type", F.round("mean_value", 6).alias("mean_value"), F.round("sd_value", 6).alias("sd_value"), "n_rows"
    )


@query("group_counts", "SELECT user_id, event_type, count(*) AS n_rows FROM events GROUP BY ALL")
def group_counts(spark, d):
    return stats.group_counts(events(spark, d), ["user_id", "event_type"])


@query(
    "count_range",
    """SELECT min(n) AS min_count, max(n) AS max_count FROM (SELECT count(*) AS n FROM events GROUP BY user_id)""",
)
def count_range(spark, d):
    return stats.count_range(stats.group_counts(events(spark, d), ["user_id"]))


@query("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, d):
    return stats.group_counts(table(spark, d, "lineitem"), [])


@query("loss_threshold_p95", "SELECT round(quantile_cont(value, 0.95), 6) AS threshold FROM events")
def loss_threshold_p95(spark, d):
    return stats.percentile_threshold(events(spark, d), "value").select(F.round("threshold", 6).alias("threshold"))


@query(
    "loss_threshold_p95_by_type",
    """SELECT event_type, round(quantile_cont(value, 0.95), 6) AS threshold FROM events GROUP BY event_type""",
)
def loss_threshold_p95_by_type(spark, d):
    out = stats.percentile_threshold(events(spark, d), "value", by=["event_type"])
    return out.select("event_type", F.round("threshold", 6).alias("threshold"))


@query(
    "price_threshold_p95",
    "SELECT round(quantile_cont(l_extendedprice, 0.95), 4) AS threshold FROM lineitem",
)
def price_threshold_p95(spark, d):
    out = stats.percentile_threshold(table(spark, d, "lineitem"), "l_extendedprice")
    return out.select(F.round("threshold", 4).alias("threshold"))


@query(
    "approx_threshold_p95",
    """SELECT count(*) AS n_rows, count(*) FILTER (l_extendedprice < q) <= 0.9501 * count(*) + 1
              AND count(*) FILTER (l_extendedprice <= q) >= 0.9499 * count(*) - 1 AS within_bound
       FROM lineitem, (SELECT quantile_disc(l_extendedprice, 0.95) AS q FROM lineitem)""",
)
def approx_threshold_p95(spark, d):
    """The one-pass threshold, and whether its rank is as close as promised: 1/10000 of the rows,
    and a row for the rank being a whole number."""
    df = table(spark, d, "lineitem").select("l_extendedprice")
    joined = attach_scalar(df, stats.approx_percentile_threshold(df, "l_extendedprice"))
    below = F.count_if(F.col("l_extendedprice") < F.col("threshold"))
    upto = F.count_if(F.col("l_extendedprice") <= F.col("threshold"))
    n = F.count(F.lit(1))
    return joined.agg(n.alias("n_rows"), ((below <= 0.9501 * n + 1) & (upto >= 0.9499 * n - 1)).alias("within_bound"))


@query(
    "count_gate",
    """SELECT event_id, CASE WHEN sum(label) OVER (PARTITION BY user_id, week) >= 3 THEN label ELSE 0 END AS label
       FROM (SELECT event_id, user_id, CAST(floor((epoch(ts) - 1704067200) / 604800) AS INTEGER) AS week,
                    CAST(value > 90 AS INTEGER) AS label FROM events)""",
)
def count_gate(spark, d):
    # unix_seconds of the local date: weeks counted from 2024-01-01.
    days = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    df = events(spark, d).select(
        "event_id", "user_id", F.floor(days / 7).alias("week"), (F.col("value") > 90).cast("int").alias("label")
    )
    return stats.count_gate(df, "label", ["user_id", "week"], 3).select("event_id", "label")


@query("time_order", "SELECT event_id, value FROM events WHERE value > 150 ORDER BY ts")
def time_order(spark, d):
    df = events(spark, d).filter(F.col("value") > 150)
    return stats.sorted_by(df, "ts").select("event_id", "value")


@query(
    "upsert_latest",
    """SELECT user_id, day, value, event_id FROM (
         SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, value, event_id,
                row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) AS r FROM events)
       WHERE r = 1""",
)
def upsert_latest(spark, d):
    """Later readings of a (device, day) overwrite earlier ones."""
    df = events(spark, d).select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "value", "event_id", "ts")
    base = time_range(df, "ts", "2024-01-01 00:00:00", "2024-01-16 11:59:59.999999").drop("ts")
    updates = df.filter(F.col("ts") > F.lit("2024-01-16 11:59:59.999999").cast("timestamp_ntz")).drop("ts")
    return keyed.upsert(base, updates, ["user_id", "day"], ["event_id"])


@query(
    "upsert_partitions",
    """SELECT event_type, event_id, CASE WHEN value > 100 THEN value * 2 ELSE value END AS value,
              CASE WHEN value > 100 THEN 2 ELSE 1 END AS version FROM events""",
)
def upsert_partitions(spark, d):
    """A stored table, partitioned by event type, with the large values written again."""
    path = scratch_path(spark, "table")
    df = events(spark, d).select("event_type", "event_id", "value", F.lit(1).alias("version"))
    df.write.partitionBy("event_type").parquet(path)
    again = df.filter("value > 100").withColumns({"value": F.col("value") * 2, "version": F.lit(2)})
    keyed.upsert_partitions(spark, path, again, ["event_type", "event_id"], ["version"], "event_type")
    return spark.read.parquet(path).select("event_type", "event_id", "value", "version")


@query(
    "keyed_log",
    """SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id""",
)
def keyed_log(spark, d):
    """Two batches appended by key, the second written twice, and read as the current state."""
    path = scratch_path(spark, "log")
    df = events(spark, d).select("user_id", "event_id", "value", "ts")
    early = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for batch, part in ((0, df.filter(early)), (1, df.filter(~early)), (1, df.filter(~early))):
        keyed.append_batch(part.drop("ts"), path, batch)
    state = keyed.read_keyed(spark, path, ["user_id"], ["batch_id", "event_id"])
    return state.select("user_id", "event_id", "value")


@query(
    "bucketed_upserts",
    """SELECT user_id, day, arg_max(value, event_id) AS value, max(event_id) AS event_id
       FROM (SELECT *, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day FROM events) GROUP BY user_id, day""",
)
def bucketed_upserts(spark, d):
    """The newest reading per device and day from a bucketed table: four batches, the second made the base, the third
    replayed, and the last delivered before it."""
    df = events(spark, d).select("user_id", F.date_format("ts", "yyyyMMdd").cast("int").alias("day"), "value", "event_id")
    store = BucketedTable(spark, scratch_path(spark, "bucketed"), df.schema, ["user_id", "day"], "event_id", buckets=8)
    parts = [df.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == i) for i in range(4)]
    store.append(parts[3], 0)
    store.append(parts[1], 1)
    store.compact()
    for batch, part in ((2, parts[0]), (2, parts[2]), (3, parts[0]), (1, parts[3])):
        store.append(part, batch)
    return store.read()


@query(
    "latest_n",
    """SELECT user_id, event_id, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r <= 27""",
)
def latest_n(spark, d):
    return keyed.latest_n(events(spark, d).select("user_id", "event_id", "value"), "user_id", "event_id", 27)


@query(
    "latest_n_of_device",
    "SELECT user_id, event_id, value FROM events WHERE user_id = 8 ORDER BY event_id DESC LIMIT 500",
)
def latest_n_of_device(spark, d):
    return keyed.latest_n(events(spark, d).select("user_id", "event_id", "value"), "user_id", "event_id", 500, 8)


@query("point_lookup", "SELECT user_id, event_id, value FROM events WHERE user_id = 8 AND event_id = 0")
def point_lookup(spark, d):
    return keyed.point_lookup(events(spark, d).select("user_id", "event_id", "value"), "user_id", 8, "event_id", 0)


@query("range_lookup", "SELECT event_id, value FROM events WHERE user_id = 8 AND event_id BETWEEN 100 AND 3140")
def range_lookup(spark, d):
    return keyed.range_lookup(events(spark, d), "user_id", 8, "event_id", 100, 3140).select("event_id", "value")


_CURSOR = """(SELECT user_id, max(event_id) + 1 AS next_index FROM events
              WHERE ts < TIMESTAMP '2024-01-10 00:00:00' GROUP BY user_id)"""


def cursor_at_tenth(spark, d):
    df = events(spark, d).filter(F.col("ts") < F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
    none = df.sparkSession.createDataFrame([], "user_id bigint, next_index bigint")
    return keyed.advance_cursor(df, none, "user_id", "event_id")


@query(
    "incremental_slice",
    f"""SELECT e.event_id, e.user_id FROM events e LEFT JOIN {_CURSOR} c USING (user_id)
        WHERE e.event_id BETWEEN greatest(coalesce(next_index, 0) - 5, 0) AND greatest(coalesce(next_index, 0) - 5, 0) + 3040""",
)
def incremental_slice(spark, d):
    df = events(spark, d).select("event_id", "user_id")
    return keyed.incremental_slice(df, cursor_at_tenth(spark, d), "user_id", "event_id", 3040, rewind=5)


@query(
    "advance_cursor",
    f"""SELECT user_id, coalesce(max(e.event_id) FILTER (e.ts < TIMESTAMP '2024-01-20 00:00:00') + 1,
               any_value(next_index)) AS next_index
        FROM events e JOIN {_CURSOR} c USING (user_id) GROUP BY user_id""",
)
def advance_cursor(spark, d):
    start = cursor_at_tenth(spark, d)
    df = events(spark, d).join(start.select("user_id"), "user_id", "left_semi")
    run = df.filter(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return keyed.advance_cursor(run, start, "user_id", "event_id")
