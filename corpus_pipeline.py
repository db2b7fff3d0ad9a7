"""A corpus pipeline: toxicity, exact copies, near copies, benchmark passages, mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet and
reads it again as the next stage's documents. All stages but the last return the columns of documents.
Stages work on all rows that their predecessor kept, by the defaults of the operators in ``tremorlake.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.llm.common import table
from tremorlake.llm.decontaminate import decontaminate
from tremorlake.llm.exact_dedup import drop_copies
from tremorlake.llm.mixture import fair_mixture
from tremorlake.llm.near_dedup import near_duplicates
from tremorlake.llm.toxicity import fit_toxicity
from tremorlake.plans import scratch_scope, write_scratch
from tremorlake.plans.scratch import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not call toxic.

    All documents, where the labels do not suffice for a classifier.
    """
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    if not model.weights:
        return docs
    return docs.filter(model.score(model.counts(F.col("text"))) < 0.5)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, the one with the smallest doc_id (null last).

    Rows are told apart by a number of their own, so a doc_id may be null or repeat.
    """
    rows = write_scratch(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(rows, key="_row").select("_row", "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    found = write_scratch(found.join(rows.select("_row", "doc_id"), "_row"), "found")
    first = found.groupBy("component_id").agg(F.min(order).alias("_first")).select("_first._row")
    gone = found.select("_row").join(first, "_row", "left_anti")
    return rows.join(gone, "_row", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; rows are told apart by doc_id and text."""
    rows = docs.withColumn("_row", F.struct("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("h")))
    found = decontaminate(rows, table(spark, sf_dir, "benchmark"), key="_row").filter("contaminated")
    ids = found.select(F.col("_row").alias("_k")).distinct()
    return rows.join(ids, rows["_row"].eqNullSafe(ids["_k"]), "left_anti").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return fair_mixture(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixture", mixture),
]

#: Compression distances and hash-banded components have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):  # what the stage wrote for itself goes with it
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
