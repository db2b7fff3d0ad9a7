"""The three runs people do: offline clustering, evaluation of the sigma rule, live scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import parse_seconds
from .operators import clean, evaluate, kmeans, normalize, sigma, smooth
from .plans import with_position, write_scratch
from .sources import csv, models
from .streaming.ingest import accepted, decode, deduplicated, start
from .streaming.scoring import Scorer, incremental_scorer


def load_signal(
    spark: SparkSession,
    path: str | list[str],
    device_pattern: str,
    start_time: str | None = None,
    end_time: str | None = None,
    columns: Sequence[str] = ("timestamp", "X", "Y", "Z"),
    axis_map: DataFrame | None = None,
) -> DataFrame:
    """Readings of all files as (device_id, timestamp, ts, value), along each device's own axis."""
    raw = csv.normalise_columns(csv.read_sensor_csv(spark, path, columns, device_pattern=device_pattern))
    df = raw.withColumn("ts", F.try_to_timestamp("timestamp"))
    if start_time:
        df = df.filter(F.col("ts") >= F.lit(start_time).cast("timestamp"))
    if end_time:
        df = df.filter(F.col("ts") <= F.lit(end_time).cast("timestamp"))
    df = clean.canonical_axis(df, axis_map if axis_map is not None else clean.default_axis_map(spark))
    return df.select("device_id", "timestamp", "ts", "value")


def cluster_anomalies(
    signal: DataFrame,
    k: int = 5,
    seed: int = 1,
    reach: int = 3,
    threshold: float = 0.9999,
    model_path: str | None = None,
) -> DataFrame:
    """Standardise per device, smooth within the second, cluster, and keep the rare clusters."""
    df = signal.withColumn("times", parse_seconds("ts"))
    df = with_position(df, ["device_id"], ["ts", "timestamp", "value"])
    df = normalize.znorm(df, "value", ["device_id"])
    df = smooth.moving_average(df, "zscale", ["device_id"], "times", reach)
    df = df.withColumn("zround", F.round("moving_average", 0))
    df = write_scratch(df.select("device_id", "times", "zscale", "zround"), "features")
    model = kmeans.fit_kmeans(df, ["zscale", "zround"], k, seed)
    if model_path:
        models.save_model(model, model_path)
    scored = kmeans.cluster_rarity(kmeans.assign_clusters(df, model, ["zscale", "zround"]), threshold=threshold)
    return scored.filter("anomaly = 1").select("device_id", "times", "zscale", "zround", "prediction", "score")


def evaluate_sigma(
    signal: DataFrame, truth: DataFrame, keys: Sequence[str], actual: str = "anomaly", k: float = 4.0, min_count: int = 5
) -> DataFrame:
    """Confusion matrix, precision, recall and F1 of the episode labels against ``truth``."""
    df = normalize.znorm(signal, "value", ["device_id"]).withColumn("second", parse_seconds("ts"))
    outliers = sigma.sigma_outliers(df, "zscale", k, ["device_id"])
    episodes = sigma.outlier_episodes(outliers, "second", min_count, ["device_id"])
    labels = sigma.label_episodes(df, episodes, "second", ["device_id"], out="predicted")
    both = evaluate.align(labels, truth, keys, "predicted", actual)
    return evaluate.quality(evaluate.confusion(both, actual, "predicted"))


def live_scores(
    messages: DataFrame,
    scorer: Scorer,
    paths: str,
    axis_map: DataFrame,
    every: str | None = None,
    delay: str = "10 minutes",
):
    """Decode, deduplicate and orient a message stream and score it as it comes.

    Output, state and checkpoint go below ``paths``; ``every`` is the cadence, such as ``5 minutes``.
    """
    readings = deduplicated(accepted(decode(messages)), delay)
    numbers = readings.select(
        "device_id", "index", "ts", *[F.col(a).cast("double").alias(a) for a in ("X", "Y", "Z")]
    )
    signal = clean.canonical_axis(numbers, axis_map).select("device_id", "index", "ts", "value")
    run = incremental_scorer(scorer, f"{paths}/state", paths)
    return start(signal, run, f"{paths}/checkpoint", every)
