"""K-means on the signal and its smoothed bucket; small clusters are anomalies."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import attach, attach_scalar, exact_quantiles, write_scratch
from .stats import count_range, group_counts


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector of columns; rows with a NULL among them are skipped."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="skip").transform(df)


@dataclass(frozen=True)
class Centres:
    """Cluster centres, one row each; the model of ``fit_lloyd``."""

    coordinates: np.ndarray

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.coordinates)


def nearest_centre(vector: str, coordinates: np.ndarray) -> Column:
    """Number of the centre that is nearest to an array column, the lower one at equal distances: one native expression."""
    distances = []
    for c in coordinates:
        terms = [f"(get(`{vector}`, {j}) - {float(x)!r}D) * (get(`{vector}`, {j}) - {float(x)!r}D)" for j, x in enumerate(c)]
        distances.append(" + ".join(terms))
    return F.expr(f"array_min(transform(array({', '.join(distances)}), (d, i) -> struct(d, i))).i")


def _vectors(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Rows without a NULL among the columns, with these as one array."""
    vectors = df.withColumn(out, F.array(*[F.col(c).cast("double") for c in columns]))
    return vectors.filter(F.forall(out, lambda x: x.isNotNull()))


def first_rows(df: DataFrame, columns: Sequence[str], key: Sequence[str], k: int) -> np.ndarray:
    """Start centres: the rows with the ``k`` smallest keys."""
    known = df.select(*[F.col(c).cast("double").alias(c) for c in columns], *[F.col(x).alias(f"_k{i}") for i, x in enumerate(key)])
    rows = known.dropna(subset=list(columns)).orderBy(*[f"_k{i}" for i in range(len(key))]).limit(k).collect()
    return np.array([[r[c] for c in columns] for r in rows], float).reshape(-1, len(columns))


def quantile_rows(df: DataFrame, columns: Sequence[str], k: int) -> np.ndarray:
    """Start centres: the (i + 1/2) / k quantiles of every column, i from 0 to k - 1."""
    at = {f"q{i}": (i + 0.5) / k for i in range(k)}
    known = df.dropna(subset=list(columns))
    found = [exact_quantiles(known, c, at, linear=False).first() for c in columns]
    if any(r is None or r["q0"] is None for r in found):
        return np.zeros((0, len(columns)))
    return np.array([[r[name] for r in found] for name in at], float)


def fit_lloyd(df: DataFrame, columns: Sequence[str], start: np.ndarray, steps: int = 20) -> Centres:
    """Lloyd's algorithm from given centres, up to ``steps`` steps or until no centre moves.

    A step is one aggregate with map-side sums; the driver holds the centres only. A cluster without rows keeps
    its centre. Unlike a random start this depends on nothing but the rows.
    """
    centres = np.asarray(start, float)
    if not len(centres):
        return Centres(centres)
    # Written once: the steps read the coordinates alone.
    rows = write_scratch(_vectors(df, columns, "_x").select("_x"), "coordinates")
    means = [F.avg(F.get("_x", F.lit(j))).alias(f"m{j}") for j in range(len(columns))]
    for _ in range(steps):
        moved = centres.copy()
        for r in rows.groupBy(nearest_centre("_x", centres).alias("_c")).agg(*means).collect():  # one row per centre
            moved[r["_c"]] = r[1:]
        if np.array_equal(moved, centres):
            break
        centres = moved
    return Centres(centres)


def fit_kmeans(df: DataFrame, columns: Sequence[str], k: int = 5, seed: int = 1) -> KMeansModel:
    """Spark's own k-means, from a random start that the seed fixes."""
    return KMeans(k=k, seed=seed).fit(assemble(df, columns).select("features"))


def assign_clusters(
    df: DataFrame, model: KMeansModel | Centres, columns: Sequence[str], out: str = "prediction"
) -> DataFrame:
    """Add the cluster of each row; rows with a NULL among the columns are skipped."""
    if isinstance(model, Centres):
        near = nearest_centre("_x", model.coordinates) if len(model.coordinates) else F.lit(None).cast("int")
        return _vectors(df, columns, "_x").withColumn(out, near).drop("_x")
    moved = model.transform(assemble(df, columns))
    return moved.withColumnRenamed("prediction", out).drop("features")


def centres(df: DataFrame, model: KMeansModel | Centres) -> DataFrame:
    """Cluster centres as (cluster, dimension, coordinate)."""
    rows = [
        (i, j, float(x)) for i, c in enumerate(model.clusterCenters()) for j, x in enumerate(c)
    ]
    return df.sparkSession.createDataFrame(rows, "cluster int, dimension int, coordinate double")


def silhouette(df: DataFrame, model: KMeansModel | Centres, columns: Sequence[str]) -> float:
    """Mean silhouette with squared Euclidean distance."""
    return ClusteringEvaluator().evaluate(assemble(assign_clusters(df, model, columns), columns))


def cluster_rarity(
    df: DataFrame,
    cluster: str = "prediction",
    by: Sequence[str] = (),
    threshold: float = 0.9999,
    score: str = "score",
    label: str = "anomaly",
) -> DataFrame:
    """Score (max - count) / (max - min) of the row's cluster; label 1 above ``threshold``.

    Clusters of one size have no score and label 0.
    """
    counts = group_counts(df, [*by, cluster], "_n")
    extent = count_range(counts, "_n", by)
    if by:
        extent = extent.withColumnRenamed("max_count", "_max").withColumnRenamed("min_count", "_min")
        counts = counts.join(extent, list(by))
    else:
        counts = attach_scalar(
            counts, extent.select(F.col("max_count").alias("_max"), F.col("min_count").alias("_min"))
        )
    rarity = F.try_divide((F.col("_max") - F.col("_n")).cast("double"), (F.col("_max") - F.col("_min")).cast("double"))
    scored = counts.select(*by, cluster, rarity.alias(score), "_n")
    return (
        attach(df, scored, [*by, cluster], rows="_n")
        .withColumn(label, F.coalesce((F.col(score) > threshold).cast("int"), F.lit(0)))
        .drop("_n")
    )


def kmeans_anomalies(
    df: DataFrame,
    columns: Sequence[str],
    k: int = 5,
    seed: int = 1,
    threshold: float = 0.9999,
    start: np.ndarray | None = None,
) -> DataFrame:
    """Fit, assign, score by rarity and keep the anomalies; with ``start`` by Lloyd's steps from there."""
    model = fit_kmeans(df, columns, k, seed) if start is None else fit_lloyd(df, columns, start)
    scored = cluster_rarity(assign_clusters(df, model, columns), threshold=threshold)
    return scored.filter(F.col("anomaly") == 1)
