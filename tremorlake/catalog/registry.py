from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.frames import chunk_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

INDEX_BLOCK = 1 << 20


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is its equivalent over the same tables."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def event_block() -> Column:
    """``event_id`` is unique and follows the time, so a block holds a bounded number of rows."""
    return chunk_of("event_id", INDEX_BLOCK)


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
