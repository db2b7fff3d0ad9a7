"""Reading, decoding and storing the message stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import to_decimal
from ..operators.keyed import append_batch

# Fixed value: the message format. The readings are quoted numbers.
MESSAGE = "timestamp string, X string, Y string, Z string, id int, index bigint"


def kafka_messages(spark: SparkSession, servers: str, pattern: str = "lift.*", **options) -> DataFrame:
    """One stream over the topics of all devices (needs the Kafka connector on the class path)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", pattern)
        .option("startingOffsets", "earliest")
    )
    return reader.options(**options).load().select(F.col("value").cast("string").alias("value"))


def file_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of text files with one message per line."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Typed readings, with the raw text and whether it was a usable message.

    Numbers are read as text first: a quoted number read as a double would be NULL.
    """
    # Generating the fields keeps the parser to one call per message, whatever is asked of them.
    rows = messages.select(F.col(value).alias("raw"), F.inline(F.array(F.from_json(F.col(value), MESSAGE))))
    rows = rows.select(
        "raw",
        F.col("id").alias("device_id"),
        "index",
        F.try_to_timestamp("timestamp").alias("ts"),
        *[to_decimal(a, 38, 18).alias(a) for a in ("X", "Y", "Z")],
    )
    needed = [F.col(c).isNotNull() for c in ("device_id", "index", "ts", "X", "Y", "Z")]
    valid = needed[0]
    for c in needed[1:]:
        valid = valid & c
    return rows.withColumn("valid", valid)


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter("valid").drop("raw", "valid")


def quarantined(decoded: DataFrame) -> DataFrame:
    """Messages that could not be read, as they came."""
    return decoded.filter("not valid").select("raw")


def deduplicated(
    readings: DataFrame, delay: str = "10 minutes", ts: str = "ts", keys: Sequence[str] = ("device_id", "index")
) -> DataFrame:
    """One reading per key among those that arrive within ``delay`` of each other."""
    return readings.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def keyed_sink(path: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: a replayed batch replaces itself, and readers keep the newest row of
    a key (``operators.keyed.read_keyed``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, path, batch_id)

    return write


def start(
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
):
    """Run a sink on a cadence such as ``5 minutes``, or once over all that is there."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
