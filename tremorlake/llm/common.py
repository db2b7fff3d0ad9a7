"""Helpers shared by the corpus operators."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: ASCII characters that are neither digit nor letter, as they separate words in some operators.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x20\x09-\x0D]+"


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


def text_of(column: str = "text") -> Column:
    """The text, where null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fold_of(column: str, folds: int) -> Column:
    """crc32 of the value as text, modulo ``folds``; a null value is in fold 1."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds)), F.lit(1)).cast("int")


def ascii_words(text: Column) -> Column:
    """Words of ASCII digits, letters lower-cased A-Z, and any characters beyond ASCII."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    plain = F.trim(F.regexp_replace(lower, SEPARATORS, " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def count_words(text: Column) -> Column:
    """Number of runs without white space (space and 0x09 to 0x0D)."""
    spaces = "\t\n\x0b\x0c\r"
    plain = F.concat(F.lit(" "), F.translate(text, spaces, " " * len(spaces)))
    # A word starts wherever a space is followed by something else.
    starts = F.regexp_replace(plain, " (?=[^ ])", "")
    return (F.length(plain) - F.length(starts)).cast("bigint")
