"""Reconstruction error of lag windows, and the linear (principal component) reconstructor."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.models import load_parameters, save_parameters

# Thresholds used in operation and in evaluation.
THRESHOLDS = {"deployed_window": 1.5, "evaluated_window": 1.3338202437285336, "point": 0.0064460794447717355}

#: Products in a reconstruction that is compiled into one native expression.
COMPILED_PRODUCTS = 1024


def mean_abs_loss(actual: Column | str, predicted: Column | str) -> Column:
    """Mean absolute difference of two arrays of one length."""
    a = F.col(actual) if isinstance(actual, str) else actual
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    gaps = F.zip_with(a, p, lambda x, y: F.abs(x - y))
    return F.try_divide(F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g), F.size(a).cast("double"))


@dataclass(frozen=True)
class LinearReconstructor:
    """Mean and leading principal components: its size depends on the window length only."""

    mean: np.ndarray
    components: np.ndarray

    def reconstruct(self, x: np.ndarray) -> np.ndarray:
        centred = x - self.mean
        return self.mean + centred @ self.components @ self.components.T


def _moments(df: DataFrame, window: str, width: int, centre: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, sum and Gram matrix of the windows less ``centre``, in one pass: a partition sends one row."""
    half = np.triu_indices(width)

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, gram = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width) - centre
            n, total, gram = n + len(x), total + x.sum(axis=0), gram + x.T @ x
        sums = pa.array([[float(n), *total, *gram[half]]], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([sums], ["sums"])

    rows = df.select(F.col(window).alias("x")).filter(F.col("x").isNotNull() & (F.size("x") == width))
    parts = rows.mapInArrow(add_up, "sums array<double>").select(F.posexplode("sums").alias("i", "s"))
    sums = np.zeros(1 + width + len(half[0]))
    for r in parts.groupBy("i").agg(F.sum("s").alias("s")).collect():  # as many as the matrix has cells
        sums[r["i"]] = r["s"]
    gram = np.zeros((width, width))
    gram[half] = sums[1 + width :]
    return int(sums[0]), sums[1 : 1 + width], gram + np.triu(gram, 1).T


def fit_linear(df: DataFrame, window: str, k: int) -> LinearReconstructor:
    """Mean and the ``k`` leading components of the windows (arrays of one length; others are left out).

    Sums are taken about the first window, so that a large common level costs no digits.
    """
    first = df.select(F.transform(window, lambda x: x.cast("double")).alias("x")).filter("x is not null").head()
    if first is None:
        raise ValueError("there is no window to fit")
    centre = np.array(first["x"], float)
    n, total, gram = _moments(df, window, len(centre), centre)
    shift = total / n
    covariance = gram / n - np.outer(shift, shift)
    _, vectors = np.linalg.eigh(covariance)
    return LinearReconstructor(centre + shift, vectors[:, ::-1][:, :k])


def save_linear(spark: SparkSession, model: LinearReconstructor, path: str) -> None:
    """The model as a table with one row per place of the window."""
    rows = [(i, float(m), [float(x) for x in c]) for i, (m, c) in enumerate(zip(model.mean, model.components))]
    save_parameters(spark.createDataFrame(rows, "place int, mean double, components array<double>").coalesce(1), path)


def load_linear(spark: SparkSession, path: str) -> LinearReconstructor:
    rows = load_parameters(spark, path).orderBy("place").collect()  # one row per place of the window
    return LinearReconstructor(np.array([r["mean"] for r in rows]), np.array([r["components"] for r in rows]))


def linear_loss(model: LinearReconstructor, window: str = "window", out: str = "loss") -> Callable[[DataFrame], DataFrame]:
    """Mean absolute error of the reconstruction as one native expression, as a step for a scorer."""
    width = len(model.mean)
    product = model.components @ model.components.T
    gap = [f"(double(get(`{window}`, {i})) - {float(m)!r}D)" for i, m in enumerate(model.mean)]
    errors = []
    for i in range(width):
        weights = np.eye(width)[i] - product[i]
        errors.append("abs(" + " + ".join(f"{float(w)!r}D * {g}" for w, g in zip(weights, gap)) + ")")
    text = f"({' + '.join(errors)}) / {float(width)!r}D"
    return lambda df: df.withColumn(out, F.expr(text))


def reconstruction_loss(df: DataFrame, model, window: str, out: str = "loss") -> DataFrame:
    """Add the mean absolute error of a model that has ``reconstruct(matrix) -> matrix``.

    A linear model of short windows is compiled; others run in Arrow batches.
    """
    if isinstance(model, LinearReconstructor) and len(model.mean) ** 2 <= COMPILED_PRODUCTS:
        return linear_loss(model, window, out)(df)

    @F.pandas_udf("double")
    def loss(x: pd.Series) -> pd.Series:
        known = x.notna()
        result = pd.Series(np.nan, index=x.index, dtype=float)
        if known.any():
            m = np.stack(x[known].to_numpy()).astype(float)
            result[known] = np.abs(model.reconstruct(m) - m).mean(axis=1)
        return result

    return df.withColumn(out, loss(F.col(window)))


def label_losses(
    df: DataFrame, threshold: float | str | Column, loss: str = "loss", label: str = "anomaly"
) -> DataFrame:
    """The loss of a window labels the row that follows it: 1 strictly above the threshold.

    A text names one of the ``THRESHOLDS``.
    """
    if isinstance(threshold, str):
        threshold = THRESHOLDS[threshold]
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return df.withColumn("threshold", limit).withColumn(label, (F.col(loss) > F.col("threshold")).cast("int"))


def anomalies(df: DataFrame, label: str = "anomaly", columns: list[str] | None = None) -> DataFrame:
    found = df.filter(F.col(label) == 1)
    return found.select(*columns) if columns else found
