"""Quality classification by co-training.

Two views of a document: its text (how it is written) and its metadata (language, source, length). A
logistic classifier per view starts from the labelled documents. In every round each classifier gives its
confident predictions on unlabelled documents to the other as pseudo-labels, and both are fitted again, over
all documents. Both views are then calibrated on labelled documents that took no part in the fits, and a
logistic combination of the calibrated views scores every document.

A Newton step needs sums over all documents only: tasks add up gradients and curvatures, Spark sums them by
cell, and the driver solves a system as small as a view. Calibration uses at most ``SAMPLE`` labelled rows,
those with the smallest hash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import write_scratch
from .common import fold_of, query, table

FOLDS = 5
ROUNDS = 3
STEPS = (5, 3)
CONFIDENT = 0.95
PSEUDO_WEIGHT = 0.3
SAMPLE = 20_000
RIDGE = 1.0
SOURCE_BUCKETS, LANG_BUCKETS = 24, 8
_UPPER, _LOWER, _DIGIT = re.compile(r"[A-Z]"), re.compile(r"[a-z]"), re.compile(r"[0-9]")
_MARK, _SHOUT = re.compile(r"[#$%&*|<>={}\[\]^~\\]"), re.compile(r"[!?]")
TEXT_WIDTH = 13
META_WIDTH = 4 + SOURCE_BUCKETS + LANG_BUCKETS


def text_features(text: str | None) -> list[float]:
    """Features of the text view, bias first; an empty text has only the bias and its emptiness."""
    text = text or ""
    words = text.split()
    if not words:
        return [1.0, 1.0] + [0.0] * (TEXT_WIDTH - 2)
    lines = [line.strip() for line in text.splitlines() if line.strip()]
    n, w = len(text), len(words)
    upper, lower = len(_UPPER.findall(text)), len(_LOWER.findall(text))
    return [
        1.0,
        0.0,
        float(np.log1p(w)) / 10,
        sum(map(len, words)) / w / 10,
        upper / (upper + lower + 1),
        len(_DIGIT.findall(text)) / n * 5,
        len(_MARK.findall(text)) / n * 5,
        len(_SHOUT.findall(text)) / n * 5,
        len(set(words)) / w,
        len(set(lines)) / len(lines),
        float(np.log1p(w / len(lines))) / 5,
        sum(len(x) > 20 for x in words) / w,
        sum(x[-1] in ".,;:" for x in words) / w,
    ]


def meta_features(lang: str | None, source: str | None, n_chars: float | None) -> list[float]:
    """Features of the metadata view, bias first; a missing value has no bucket."""
    size = 0.0 if n_chars is None or n_chars != n_chars else float(max(n_chars, 0))
    out = [1.0, float(np.log1p(size)) / 10, float(size < 100), float(size > 20_000)]
    for value, buckets in ((source, SOURCE_BUCKETS), (lang, LANG_BUCKETS)):
        cells = [0.0] * buckets
        if value is not None:
            cells[xxhash.xxh3_64_intdigest(value.encode()) % buckets] = 1.0
        out += cells
    return out


def _views(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame(
            {
                "_id": batch["_id"],
                "t": [text_features(x) for x in batch["_text"]],
                "m": [meta_features(*x) for x in zip(batch["_lang"], batch["_source"], batch["_chars"])],
            }
        )


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _step(rows: DataFrame, weights: list[np.ndarray], givers: list[np.ndarray] | None) -> list[np.ndarray]:
    """One Newton step of both views over all rows (t, m, y, fit).

    ``givers`` are the classifiers whose confident predictions label the rows without label.
    """
    widths = [len(w) for w in weights]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grads = [np.zeros(n) for n in widths]
        curves = [np.zeros((n, n)) for n in widths]
        for batch in batches:
            if not len(batch):
                continue
            xs = [np.array(batch[c].tolist(), float) for c in "tm"]
            y, fit = batch["y"].to_numpy(float), batch["fit"].to_numpy(bool)
            for v in (0, 1):
                target, weight = np.where(fit, np.nan_to_num(y), 0.0), fit.astype(float)
                if givers is not None:
                    other = 1 - v
                    p = _sigmoid(xs[other] @ givers[other])
                    free = np.isnan(y) & ((p >= CONFIDENT) | (p <= 1 - CONFIDENT))
                    target, weight = np.where(free, p >= 0.5, target), np.where(free, PSEUDO_WEIGHT, weight)
                p = _sigmoid(xs[v] @ weights[v])
                grads[v] += xs[v].T @ (weight * (target - p))
                curves[v] += xs[v].T @ (xs[v] * (weight * p * (1 - p))[:, None])
        parts = [
            pd.DataFrame({"v": v, "at": np.arange(a.size, dtype=np.int32), "s": a.ravel()})
            for v, a in enumerate((grads[0], curves[0], grads[1], curves[1]))
        ]
        yield pd.concat(parts).astype({"v": "int32"})

    got = rows.mapInPandas(sums, "v int, at int, s double").groupBy("v", "at").agg(F.sum("s").alias("s")).collect()
    cells = [np.zeros(n) for n in (widths[0], widths[0] ** 2, widths[1], widths[1] ** 2)]
    for r in got:
        cells[r["v"]][r["at"]] = r["s"]
    out = []
    for v, w in enumerate(weights):
        keep = RIDGE * np.eye(len(w))
        curve = cells[2 * v + 1].reshape(len(w), len(w)) + keep
        out.append(w + np.linalg.solve(curve, cells[2 * v] - keep @ w))
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ w)
        w = w + np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(len(w)), x.T @ (y - p) - 1e-3 * w)
    return w


def cotrain(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    metadata: tuple[str, str, str] = ("lang", "source", "n_chars"),
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, held_out, text_score, meta_score, score and predicted.

    Labels of fold 0 are never used, those of fold 1 only calibrate. Null text is empty, null metadata has
    no value, and a key with several labels counts by the largest. Without both classes among the labels of
    a part that needs them, scores are the share of label 1 among the labels (0.5 without any).
    """
    lang, source, chars = metadata
    slim = docs.select(
        F.col(key).alias("_id"), F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang"),
        F.col(source).cast("string").alias("_source"), F.col(chars).cast("double").alias("_chars"),
    )
    kind = dict(slim.dtypes)["_id"]
    viewed = slim.mapInPandas(_views, f"_id {kind}, t array<float>, m array<float>")
    marked = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("_lid")).agg(F.max(label).cast("double").alias("_y"))
    fold = fold_of("_id", FOLDS)
    rows = viewed.join(marked, F.col("_id") == F.col("_lid"), "left").select("_id", "t", "m", fold.alias("fold"), "_y")
    rows = rows.withColumn("y", F.when(F.col("fold") != 0, F.col("_y"))).withColumn("fit", F.col("y").isNotNull() & (F.col("fold") != 1))
    rows = write_scratch(rows.drop("_y"), "views")

    held = (F.col("fold") == 0).alias("held_out")
    known = rows.groupBy("fit").agg(F.count("y").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("s")).collect()
    counts = {r["fit"]: (r["n"], r["s"]) for r in known}
    n, s = counts.get(True, (0, 0.0))
    sample = rows.filter("fold = 1 and y is not null").orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE).select("t", "m", "y").collect()
    y = np.array([r["y"] for r in sample], float)
    if not 0 < s < n or not 0 < y.sum() < len(y):
        total, ones = (sum(c[i] for c in counts.values()) for i in (0, 1))
        flat = F.lit(float(ones / total) if total else 0.5)
        return rows.select(
            F.col("_id").alias(key), held, flat.alias("text_score"), flat.alias("meta_score"), flat.alias("score"), (flat >= 0.5).cast("int").alias("predicted")
        )
    slim_rows = rows.select("t", "m", "y", "fit")
    weights = [np.zeros(TEXT_WIDTH), np.zeros(META_WIDTH)]
    for _ in range(STEPS[0]):
        weights = _step(slim_rows.filter("fit"), weights, None)
    for _ in range(rounds):
        givers = weights
        for _ in range(STEPS[1]):
            weights = _step(slim_rows, weights, givers)

    x = [np.array([r[c] for r in sample], float) @ w for c, w in zip("tm", weights)]
    one = np.ones(len(y))
    scale = [_logistic(np.column_stack((one, z)), y) for z in x]
    calibrated = [np.column_stack((one, z)) @ w for z, w in zip(x, scale)]
    joint = _logistic(np.column_stack((one, *calibrated)), y)

    def linear(column: str, w: np.ndarray):
        return F.aggregate(
            F.zip_with(column, F.array(*[F.lit(float(v)) for v in w]), lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v
        )

    def chance(z):
        return 1 / (1 + F.exp(-z))

    parts = [float(a) + float(b) * linear(c, w) for c, w, (a, b) in zip("tm", weights, scale)]
    scored = rows.select("_id", held, parts[0].alias("zt"), parts[1].alias("zm"))
    whole = chance(float(joint[0]) + float(joint[1]) * F.col("zt") + float(joint[2]) * F.col("zm"))
    return scored.select(
        F.col("_id").alias(key), "held_out", chance(F.col("zt")).alias("text_score"), chance(F.col("zm")).alias("meta_score"),
        whole.alias("score"), (whole >= 0.5).cast("int").alias("predicted"),
    )


@query("op5_cotraining")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
