"""Detectors against labelled data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import f1_expr, precision_expr, recall_expr
from ..plans import attach, attach_scalar, running_totals


def align(
    predicted: DataFrame, truth: DataFrame, keys: Sequence[str], prediction: str, actual: str
) -> DataFrame:
    """Predictions and truth of the same reading side by side, by key and never by position."""
    return predicted.select(*keys, prediction).join(truth.select(*keys, actual), list(keys))


def unmatched(
    predicted: DataFrame, truth: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """How many readings each side has that the other lacks."""
    keys = list(keys)
    p = predicted.select(*keys).withColumn("_p", F.lit(1))
    t = truth.select(*keys).withColumn("_t", F.lit(1))
    both = p.join(t, keys, "full_outer")
    return both.agg(
        F.count_if(F.col("_t").isNull()).alias("only_predicted"),
        F.count_if(F.col("_p").isNull()).alias("only_truth"),
        F.count_if(F.col("_p").isNotNull() & F.col("_t").isNotNull()).alias("matched"),
    )


def confusion(df: DataFrame, actual: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn and tp in one aggregate; they add up to the rows.

    A NULL truth or prediction belongs in no cell and is an error: drop or fill such rows first.
    """
    missing = F.raise_error(F.lit("truth and prediction must not be NULL")).cast("boolean")
    a, p = (F.when(F.col(c).isNull(), missing).otherwise(F.col(c) == 1) for c in (actual, prediction))
    return df.groupBy(*by).agg(
        F.count_if(~a & ~p).alias("tn"),
        F.count_if(~a & p).alias("fp"),
        F.count_if(a & ~p).alias("fn"),
        F.count_if(a & p).alias("tp"),
    )


def quality(matrix: DataFrame) -> DataFrame:
    """Add precision, recall and F1; NULL where a denominator is 0."""
    return matrix.withColumns(
        {
            "precision": precision_expr("tp", "fp"),
            "recall": recall_expr("tp", "fn"),
            "f1": f1_expr("tp", "fp", "fn"),
        }
    )


def compare_detectors(df: DataFrame, actual: str, predictions: Sequence[str]) -> DataFrame:
    """One row per detector, best F1 first. ``df`` is read once for all detectors."""
    pairs = F.inline(
        F.array(*[F.struct(F.lit(p).alias("detector"), F.col(p).alias("_p")) for p in predictions])
    )
    matrix = confusion(df.select(F.col(actual).alias("_a"), pairs), "_a", "_p", ["detector"])
    return quality(matrix).orderBy(F.desc_nulls_last("f1"), "detector")


def threshold_sweep(df: DataFrame, actual: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """For every score of a detector: tn, fp, fn and tp if all rows with at least that score are flagged.

    Rows are counted by score first; tp and fp are then running totals from the highest score down, so neither a
    detector nor a frequent score is gathered in one task. A row without a score is never flagged, a row without
    truth is an error.
    """
    keys = list(by)
    missing = F.raise_error(F.lit("truth must not be NULL")).cast("boolean")
    truth = F.when(F.col(actual).isNull(), missing).otherwise(F.col(actual) == 1)
    rows = df.select(*keys, F.col(score).cast("double").alias("threshold"), truth.alias("_a"))
    counts = rows.groupBy(*keys, "threshold").agg(F.count_if("_a").alias("_p"), F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_down", -F.col("threshold"))
    whole = rows.groupBy(*keys).agg(F.count_if("_a").alias("_all_p"), F.count(F.lit(1)).alias("_all"))
    scored = counts.filter(F.col("threshold").isNotNull())
    swept = running_totals(scored, keys, ["_down"], {"_tp": F.col("_p"), "_flagged": F.col("_n")})
    met = attach(swept, whole, keys, rows="_all") if keys else attach_scalar(swept, whole)
    tp, flagged = F.col("_tp") + F.col("_p"), F.col("_flagged") + F.col("_n")
    return met.select(
        *keys,
        "threshold",
        (F.col("_all") - F.col("_all_p") - flagged + tp).alias("tn"),
        (flagged - tp).alias("fp"),
        (F.col("_all_p") - tp).alias("fn"),
        tp.alias("tp"),
    )


def best_thresholds(df: DataFrame, actual: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """The threshold with the highest F1 (the highest such threshold) per detector, with its matrix and quality."""
    swept = quality(threshold_sweep(df, actual, score, by))
    names = [c for c in swept.columns if c not in by]
    best = F.max_by(F.struct(*names), F.struct(F.coalesce("f1", F.lit(-1.0)), "threshold"))
    return swept.groupBy(*by).agg(best.alias("_best")).select(*by, *[F.col(f"_best.{n}").alias(n) for n in names])


def long_scores(df: DataFrame, keep: Sequence[str], scores: Sequence[str]) -> DataFrame:
    """One row per row and detector (detector, score), from one score column per detector."""
    pairs = [F.struct(F.lit(s).alias("detector"), F.col(s).cast("double").alias("score")) for s in scores]
    return df.select(*keep, F.inline(F.array(*pairs)))
