"""Exact deduplication by sorting the content.

Rows are range-partitioned on the text: Spark samples the splitters, for which the first ``HEAD`` characters
and a hash of the whole stand, as whole texts would not fit the driver. Each partition is sorted externally
by the whole text, and rows of equal text lie side by side: a window over them compares each row with its
neighbour in full and keeps the largest identifier.

One text may be a third of all rows. A first pass counts rows by a 64-bit hash of the text, combined in
the map tasks. Hashes with more rows than both ``HOT_ROWS`` and a ``1 / HOT_SHARE`` part of the table are
hot: there are at most ``HOT_SHARE`` of them, so their list is broadcast. Their rows get a salt from the
identifier and are sorted as several runs; the runs of a text are merged by its SHA-256.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans import write_scratch
from .common import query, table, text_of

HOT_ROWS = 500
HOT_SHARE = 100_000
SALTS = 256
HEAD = 32


def _sorted_runs(docs: DataFrame, text: str, key: str, hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows with their rank, best key and size in their run; the second frame has the salted hot texts."""
    rows = docs.select(
        F.col(key).alias("_key"),
        text_of(text).alias("_text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("_row"),
        F.col(text).isNull().alias("_null"),
    ).withColumns({"_hash": F.xxhash64("_text"), "_head": F.substring("_text", 1, HEAD)})
    least = max(hot_rows, docs.count() // HOT_SHARE)
    counts = rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    hot = write_scratch(counts.filter(F.col("_n") > least).select("_hash"), "hot-texts")

    def ranked(part: DataFrame, by: list[str]) -> DataFrame:
        # Equal texts have equal heads and hashes, so they lie in one partition; the sort compares whole texts.
        by = ["_head", "_hash", *by]
        down = Window.partitionBy(*by, "_text").orderBy(F.desc_nulls_last("_key"))
        whole = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return part.repartitionByRange(*by).withColumns(
            {
                "_rank": F.row_number().over(down),
                "_best": F.first("_key").over(whole),
                "_size": F.count(F.lit(1)).over(whole),
            }
        )

    if hot.isEmpty():
        return ranked(rows, []), None
    cold = rows.join(F.broadcast(hot), "_hash", "left_anti")
    salted = rows.join(F.broadcast(hot), "_hash", "left_semi").withColumn(
        "_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int")
    )
    return ranked(cold, []), ranked(salted, ["_salt"])


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``key``, keep_id, group_size, kept and text_sha256.

    Null text counts as empty. Of equal texts the row with the largest key stays; null keys sort below all
    others, and of rows that share text and key exactly one is kept. keep_id is null only if every key of
    the group is. An empty table gives an empty result; other columns of ``docs`` change nothing.
    """
    cold, hot = _sorted_runs(docs, text, key, hot_rows)
    slim = ["_key", "_best", "_size", "_rank", F.sha2("_text", 256).alias("_sha")]
    result = cold.select(*slim)
    if hot is not None:
        runs = write_scratch(hot.select(*slim, "_salt"), "runs")
        merged = runs.filter("_rank = 1").groupBy("_sha").agg(
            F.sum("_size").alias("_all"),
            F.max("_best").alias("_top"),
            # The run of the best key; every row with that key has the same salt.
            F.max_by("_salt", F.struct(F.col("_best").isNotNull(), "_best", "_salt")).alias("_home"),
        )
        # At most HOT_SHARE texts are hot.
        joined = runs.join(F.broadcast(merged), "_sha")
        result = result.unionByName(
            joined.select(
                "_key",
                F.col("_top").alias("_best"),
                F.col("_all").alias("_size"),
                F.when(F.col("_salt") == F.col("_home"), F.col("_rank")).otherwise(F.lit(0)).alias("_rank"),
                "_sha",
            )
        )
    return result.select(
        F.col("_key").alias(key),
        F.col("_best").alias("keep_id"),
        F.col("_size").cast("bigint").alias("group_size"),
        (F.col("_rank") == 1).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns."""
    cold, hot = _sorted_runs(docs, text, key, hot_rows)
    best = cold.filter("_rank = 1").drop("_rank", "_best", "_size")
    if hot is not None:
        winners = hot.filter("_rank = 1").withColumn("_sha", F.sha2("_text", 256))
        among = Window.partitionBy("_sha").orderBy(F.desc_nulls_last("_key"), F.desc("_salt"))
        winners = winners.withColumn("_place", F.row_number().over(among)).filter("_place = 1")
        best = best.unionByName(winners.select(*best.columns))
    whole = F.when(~F.col("_null"), F.col("_text"))
    return best.select(
        *[whole.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in docs.columns]
    )


SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


@query("op4_exact_dedup", SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))
