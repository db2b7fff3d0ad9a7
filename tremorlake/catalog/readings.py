"""Reading, filtering and typing."""

from pyspark.sql import functions as F

from ..functions import iso_seconds_text, label_above, label_outside, parse_seconds, to_decimal, vector_element
from ..operators import clean
from ..operators.kmeans import assemble
from ..plans import with_position
from ..plans.scratch import scratch_path
from ..sources.csv import export_csv, normalise_columns, read_header_csv, read_sensor_csv, write_sorted_csv
from ..streaming.ingest import accepted, decode, quarantined
from .registry import event_block, events, query

_AXES = """
    SELECT event_id, 1 + user_id % 15 AS device_id, value AS x,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y,
           value - CAST(json_extract_string(props, '$.k') AS DOUBLE) AS z
    FROM events
"""


def three_axes(spark, d, *more):
    k = F.get_json_object("props", "$.k").cast("double")
    return events(spark, d).select(
        "event_id",
        (1 + F.col("user_id") % 15).alias("device_id"),
        F.col("value").alias("X"),
        k.alias("Y"),
        (F.col("value") - k).alias("Z"),
        *more,
    )


@query(
    "time_range_filter",
    """SELECT event_id, user_id, value FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'""",
)
def time_range_filter(spark, d):
    df = clean.time_range(events(spark, d), "ts", "2024-01-05 00:00:00", "2024-01-12 12:00:00")
    return df.select("event_id", "user_id", "value")


@query("projection_alias", "SELECT event_id AS index, user_id AS device_id, -value AS z FROM events")
def projection_alias(spark, d):
    return events(spark, d).select(
        F.col("event_id").alias("index"), F.col("user_id").alias("device_id"), (-F.col("value")).alias("z")
    )


@query("value_band", "SELECT event_id, value FROM events WHERE value > 20 AND value < 60.5")
def value_band(spark, d):
    return clean.value_band(events(spark, d).select("event_id", "value"), "value", 20.0, 60.5)


@query("value_band_closed", "SELECT event_id, value FROM events WHERE value >= 20 AND value <= 60.5")
def value_band_closed(spark, d):
    return clean.value_band(events(spark, d).select("event_id", "value"), "value", 20.0, 60.5, closed=True)


@query("tails", "SELECT event_id, value FROM events WHERE value > 150 OR value < 1")
def tails(spark, d):
    return clean.tails(events(spark, d).select("event_id", "value"), "value", 1.0, 150.0)


@query(
    "bucket_equality",
    "SELECT event_id, value FROM events WHERE CAST(round(value * 10, 0) AS BIGINT) = 927",
)
def bucket_equality(spark, d):
    return clean.in_bucket(events(spark, d).select("event_id", "value"), "value", 92.7, digits=1)


@query(
    "axis_canonical",
    f"""SELECT event_id, device_id, round(CASE
            WHEN device_id IN (1, 2, 7, 15) THEN z
            WHEN device_id IN (3, 5, 11) THEN x
            WHEN device_id IN (4, 6, 9, 10, 13) THEN -z
            WHEN device_id IN (8, 14) THEN -x
            WHEN device_id = 12 THEN -y END, 6) AS value
        FROM ({_AXES})""",
)
def axis_canonical(spark, d):
    df = clean.canonical_axis(three_axes(spark, d), clean.default_axis_map(spark))
    return df.select("event_id", "device_id", F.round("value", 6).alias("value"))


@query(
    "unmapped_devices",
    """SELECT user_id AS device_id, count(*) AS n_rows FROM events
       WHERE user_id NOT BETWEEN 1 AND 15 GROUP BY user_id""",
)
def unmapped_devices(spark, d):
    df = events(spark, d).select(F.col("user_id").alias("device_id"))
    return clean.unmapped_devices(df, clean.default_axis_map(spark))


_GAPS = "SELECT event_id, user_id, CASE WHEN value <= 100 THEN value END AS reading FROM events"


def with_gaps(spark, d):
    reading = F.when(F.col("value") <= 100, F.col("value"))
    return events(spark, d).select("event_id", "user_id", reading.alias("reading"))


@query("drop_null_readings", f"SELECT event_id, reading FROM ({_GAPS}) WHERE reading IS NOT NULL")
def drop_null_readings(spark, d):
    return clean.drop_nulls(with_gaps(spark, d).select("event_id", "reading"), ["reading"])


@query("fill_constant", f"SELECT event_id, coalesce(reading, 0) AS reading FROM ({_GAPS})")
def fill_constant(spark, d):
    return clean.fill_constant(with_gaps(spark, d).select("event_id", "reading"), {"reading": 0.0})


@query(
    "fill_mean",
    f"SELECT event_id, round(coalesce(reading, avg(reading) OVER ()), 6) AS reading FROM ({_GAPS})",
)
def fill_mean(spark, d):
    df = clean.fill_mean(with_gaps(spark, d), "reading")
    return df.select("event_id", F.round("reading", 6).alias("reading"))


@query(
    "fill_mean_by_device",
    f"""SELECT event_id, user_id,
               round(coalesce(reading, avg(reading) OVER (PARTITION BY user_id)), 6) AS reading FROM ({_GAPS})""",
)
def fill_mean_by_device(spark, d):
    df = clean.fill_mean(with_gaps(spark, d), "reading", ["user_id"])
    return df.select("event_id", "user_id", F.round("reading", 6).alias("reading"))


@query(
    "timestamp_seconds",
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS parsed,
              split_part(CAST(ts AS VARCHAR), '.', 1) AS stripped FROM events""",
)
def timestamp_seconds(spark, d):
    text = F.col("ts").cast("string")
    return events(spark, d).select(
        "event_id",
        F.date_format(parse_seconds(text), "yyyy-MM-dd HH:mm:ss").alias("parsed"),
        iso_seconds_text(text).alias("stripped"),
    )


@query(
    "rounding_casts",
    """SELECT event_id, round(value, 0) AS r0, round(value / 7, 6) AS r6,
              CAST(round(value, 0) AS INTEGER) AS as_int,
              CAST(CAST(round(value, 0) AS DECIMAL(10,0)) AS VARCHAR) AS as_decimal,
              CAST(CAST(round(value, 0) AS BIGINT) AS VARCHAR) AS as_text FROM events""",
)
def rounding_casts(spark, d):
    df = events(spark, d).select("event_id", "value", (F.col("value") / 7).alias("seventh"))
    df = clean.rounded(df, "value", "r0")
    df = clean.rounded(df, "seventh", "r6", 6)
    df = clean.rounded(df, "value", "as_int", kind="int")
    df = df.withColumn("as_decimal", to_decimal(F.round("value", 0), 10, 0).cast("string"))
    df = df.withColumn("as_text", F.round("value", 0).cast("bigint").cast("string"))
    return df.drop("value", "seventh")


@query(
    "threshold_labels",
    """SELECT event_id, CAST(value > 100 AS INTEGER) AS above,
              CAST(value < 5 OR value > 150 AS INTEGER) AS outside, 100.0 :: DOUBLE AS threshold FROM events""",
)
def threshold_labels(spark, d):
    df = events(spark, d).select(
        "event_id", label_above("value", 100.0).alias("above"), label_outside("value", 5.0, 150.0).alias("outside")
    )
    return clean.with_constant(df, "threshold", 100.0)


@query(
    "offset_slice",
    """SELECT event_id, user_id, pos FROM (
         SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos FROM events)
       WHERE pos >= 20""",
)
def offset_slice(spark, d):
    df = with_position(events(spark, d).select("event_id", "user_id"), ["user_id"], ["event_id"], "pos", event_block())
    return clean.skip_first(df, 20)


@query("distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(spark, d):
    return clean.distinct_rows(events(spark, d), ["user_id", "event_type"])


@query("union_devices", "SELECT event_id, user_id, value FROM events")
def union_devices(spark, d):
    df = events(spark, d).select("event_id", "user_id", "value")
    cut = F.col("user_id") < 8
    return clean.union_devices(df.filter(cut), df.filter(~cut).select("value", "user_id", "event_id"))


@query(
    "sensor_csv",
    f"""SELECT device_id, count(*) AS n_rows, round(sum(x), 4) AS sum_x, round(sum(y), 4) AS sum_y,
               round(sum(z), 4) AS sum_z, min(split_part(CAST(ts AS VARCHAR), '.', 1)) AS first_ts
        FROM (SELECT a.*, e.ts FROM ({_AXES}) a JOIN events e USING (event_id)) GROUP BY device_id""",
)
def sensor_csv(spark, d):
    """One folder of headerless CSV per device, read back as one table with the device from the path."""
    path = scratch_path(spark, "csv")
    axes = three_axes(spark, d, F.col("ts").cast("string").alias("ts"))
    axes.select("ts", "X", "Y", "Z", F.col("device_id").alias("EDS")).write.partitionBy("EDS").csv(path)
    df = read_sensor_csv(spark, f"{path}/*", device_pattern=r"EDS=(\d+)")
    return df.groupBy(F.col("device_id").cast("bigint").alias("device_id")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.round(F.sum(a), 4).alias(f"sum_{a.lower()}") for a in "XYZ"],
        F.min(iso_seconds_text("timestamp")).alias("first_ts"),
    )


@query("header_csv", "SELECT event_id, user_id, value FROM events")
def header_csv(spark, d):
    path = scratch_path(spark, "header-csv")
    export_csv(events(spark, d).select("event_id", "user_id", "value", "event_type"), path)
    return read_header_csv(spark, path, {"event_id": "bigint", "user_id": "bigint", "value": "double"})


def messages(spark, d):
    """The message format of the stream, with numbers as text; error events carry a broken message."""
    axes = three_axes(spark, d, "event_type", F.col("ts").cast("string").alias("timestamp"))
    good = F.to_json(
        F.struct(
            "timestamp",
            *[F.col(a).cast("string").alias(a) for a in "XYZ"],
            F.col("device_id").cast("int").alias("id"),
            F.col("event_id").alias("index"),
        )
    )
    broken = F.concat(F.lit("{broken "), F.col("event_id").cast("string"))
    return axes.select(F.when(F.col("event_type") == "error", broken).otherwise(good).alias("value"))


@query(
    "message_decode",
    f"""SELECT CAST(device_id AS INTEGER) AS device_id, event_id AS index, round(x, 6) AS x, round(y, 6) AS y,
               round(z, 6) AS z FROM ({_AXES}) JOIN events USING (event_id) WHERE event_type <> 'error'""",
)
def message_decode(spark, d):
    ok = accepted(decode(messages(spark, d)))
    return ok.select(
        "device_id", "index", *[F.round(F.col(a).cast("double"), 6).alias(a.lower()) for a in "XYZ"]
    )


@query(
    "message_quarantine",
    "SELECT '{broken ' || CAST(event_id AS VARCHAR) AS raw FROM events WHERE event_type = 'error'",
)
def message_quarantine(spark, d):
    return quarantined(decode(messages(spark, d)))


@query("column_variants", f"SELECT event_id, device_id, x, y, z FROM ({_AXES})")
def column_variants(spark, d):
    """The other naming of delivered files, brought to the one of this library."""
    other = three_axes(spark, d).withColumnsRenamed({a: f"Acceleration{a}" for a in "XYZ"})
    axes = normalise_columns(other)
    return axes.select("event_id", "device_id", *[F.col(a).alias(a.lower()) for a in "XYZ"])


@query("ordered_csv", "SELECT event_id, round(value, 4) AS value FROM events WHERE value > 100")
def ordered_csv(spark, d):
    """Readings above 100 in one ordered file, read back."""
    path = scratch_path(spark, "ordered-csv")
    rows = events(spark, d).filter("value > 100").select("event_id", "value")
    write_sorted_csv(rows, path, ["value", "event_id"], header=True, single_file=True)
    back = read_header_csv(spark, path, {"event_id": "bigint", "value": "double"})
    return back.select("event_id", F.round("value", 4).alias("value"))


@query("vector_elements", f"SELECT event_id, x AS first, y AS second, CAST(NULL AS DOUBLE) AS third FROM ({_AXES})")
def vector_elements(spark, d):
    """Two readings as an ML vector and back; there is no third element."""
    vectors = assemble(three_axes(spark, d).fillna(0.0, ["Y"]), ["X", "Y"], "vec")
    return vectors.select("event_id", *[vector_element("vec", i).alias(n) for i, n in enumerate(("first", "second", "third"))])
