"""Isolation forest (Liu, Ting and Zhou, 2008) on Spark.

The trees need only small samples, which come from one hash per row; they grow in parallel, one bounded group per tree.
All draws are digests of the seed and of what they are drawn for, so a forest depends on nothing but its rows.

A stored forest is a table of nodes. A small one is compiled into one native expression; for deep trees, of
which an expression would hold tens of thousands of nodes, an Arrow-batched pass walks the node table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans import exact_quantiles, write_scratch

EULER_GAMMA = 0.5772156649015329
#: Nodes of a forest that is compiled.
COMPILED_NODES = 1500
_NODE = "tree int, node int, feature int, threshold double, lower int, upper int, depth int, size int"
_DIGITS = 12


@dataclass(frozen=True)
class Forest:
    nodes: DataFrame
    threshold: float
    sample_rows: int


def mean_path(n):
    """Average path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    long = 2.0 * (np.log(safe - 1.0) + EULER_GAMMA) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def unit(*of) -> float:
    """A number in [0, 1): the first digits of a digest of the values, as ``unit_column``."""
    return int(hashlib.md5(":".join(map(str, of)).encode()).hexdigest()[:_DIGITS], 16) / 16**_DIGITS


def unit_column(*of: Column | str) -> Column:
    text = F.concat_ws(":", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in of])
    digits = F.substring(F.md5(text.cast("binary")), 1, _DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**_DIGITS))


def grow_tree(x: np.ndarray, max_depth: int, *seed) -> list[tuple]:
    """Nodes (node, feature, threshold, lower, upper, depth, size); feature -1 marks a leaf.

    The root is 1, and node i has the children 2i and 2i + 1. The feature is drawn among those that differ in the
    node, the threshold between their extremes.
    """
    nodes = []
    todo = [(np.arange(len(x)), 0, 1)]
    while todo:
        rows, depth, node = todo.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        usable = np.flatnonzero(high > low)
        leaf = (node, -1, 0.0, -1, -1, depth, len(rows))
        if depth >= max_depth or len(rows) < 2 or len(usable) == 0:
            nodes.append(leaf)
            continue
        f = int(usable[int(unit(*seed, node, "feature") * len(usable))])
        cut = float(low[f] + unit(*seed, node, "cut") * (high[f] - low[f]))
        below = x[rows, f] < cut
        if not below.any():
            nodes.append(leaf)
            continue
        nodes.append((node, f, cut, 2 * node, 2 * node + 1, depth, len(rows)))
        todo += [(rows[~below], depth + 1, 2 * node + 1), (rows[below], depth + 1, 2 * node)]
    return sorted(nodes)


def draw_samples(
    df: DataFrame, row_key: Sequence[str], trees: int, rows: int, seed: int
) -> DataFrame:
    """For every tree ``rows`` rows of ``df``, ranked in ``_r``.

    Each row has one hash. The rows with the smallest, as many as all trees need, are dealt out in turn, so no two trees
    share a row and no row is hashed once per tree. A table with fewer rows than that is small: there each tree
    takes the rows with the smallest of its own hashes. No repartitioning changes what is drawn.
    """
    n, need = df.count(), trees * rows
    key = [F.col(k) for k in row_key]
    if n <= need:
        drawn = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
        drawn = drawn.withColumn("_t", unit_column(F.lit(seed), "tree", *key))
        w = Window.partitionBy("tree").orderBy("_t", *row_key)
        return write_scratch(drawn.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= rows), "samples")
    # Only rows below a bound are sorted; too few of them raise it.
    bound = (need + 6.0 * need**0.5 + 64) / n
    hashed = df.withColumn("_t", unit_column(F.lit(seed), *key))
    while True:
        pool = write_scratch(hashed.filter(F.col("_t") < bound), "pool")
        if pool.count() >= need or bound > 1:
            break
        bound *= 2
    turn = F.row_number().over(Window.orderBy("_t", *row_key)) - 1
    pool = pool.orderBy("_t", *row_key).limit(need).withColumn("_turn", turn)
    dealt = pool.withColumns({"tree": F.col("_turn") % trees, "_r": F.expr(f"int(_turn div {trees})") + 1})
    return write_scratch(dealt.drop("_turn"), "samples")


def grow_forest(
    df: DataFrame,
    features: str,
    row_key: Sequence[str],
    trees: int = 100,
    sample_rows: int = 256,
    max_depth: int = 2,
    seed: int = 43,
) -> DataFrame:
    """The nodes of all trees, over the rows with ``features`` (an array column)."""
    rows = df.select(*row_key, features).filter(F.col(features).isNotNull())
    drawn = draw_samples(rows, row_key, trees, sample_rows, seed)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = np.stack(pdf.sort_values("_r")[features].to_numpy()).astype(float)
        nodes = grow_tree(x, max_depth, seed, tree)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "lower", "upper", "depth", "size"])
        out.insert(0, "tree", tree)
        return out

    grown = drawn.select("tree", "_r", features).groupBy("tree").applyInPandas(grow, _NODE)
    return write_scratch(grown, "forest")


def sample_size(nodes: DataFrame) -> int:
    return nodes.agg(F.max("size")).first()[0] or 1


def _threshold(scored: DataFrame, score: str, contamination: float) -> float:
    cut = exact_quantiles(scored, score, {"cut": 1.0 - contamination}, linear=False).first()["cut"]
    return float("inf") if cut is None else float(cut)


def fit_forest(
    df: DataFrame,
    features: str,
    row_key: Sequence[str],
    contamination: float = 0.015,
    **options,
) -> Forest:
    """A forest for later use (options as in ``grow_forest``). The threshold is the (1 - contamination) quantile of the
    training scores."""
    nodes = grow_forest(df, features, row_key, **options)
    psi = sample_size(nodes)
    rows = df.select(features).filter(F.col(features).isNotNull())
    scored = write_scratch(score_forest(rows, nodes, features, psi).select("score"), "scores")
    return Forest(nodes, _threshold(scored, "score", contamination), psi)


def fit_predict_forest(
    df: DataFrame,
    features: str,
    row_key: Sequence[str],
    contamination: float = 0.015,
    score: str = "score",
    label: str = "prediction",
    **options,
) -> tuple[DataFrame, Forest]:
    """Scores and labels of the training rows themselves, and the forest; every row is scored once."""
    nodes = grow_forest(df, features, row_key, **options)
    psi = sample_size(nodes)
    rows = df.filter(F.col(features).isNotNull())
    scored = write_scratch(score_forest(rows, nodes, features, psi, score), "scored")
    forest = Forest(nodes, _threshold(scored, score, contamination), psi)
    return _labelled(scored, forest, score, label), forest


def _trees(nodes: DataFrame) -> list[pd.DataFrame]:
    table = nodes.orderBy("tree", "node").toPandas()
    return [t.set_index("node") for _, t in table.groupby("tree")]


def _compiled(tree: pd.DataFrame, features: str, node: int = 1) -> str:
    """Path length of a row in a tree, as nested conditions: SQL text, which is parsed once for all trees."""
    n = tree.loc[node]
    if n["feature"] < 0:
        return f"{float(n['depth'] + mean_path(n['size']))!r}D"
    lower, upper = (_compiled(tree, features, int(n[c])) for c in ("lower", "upper"))
    return f"IF(double(get(`{features}`, {int(n['feature'])})) < {float(n['threshold'])!r}D, {lower}, {upper})"


def _walker(trees: list[pd.DataFrame]):
    """Total path length over the trees, for batches of feature arrays."""
    forest = []
    for tree in trees:
        place = {node: i for i, node in enumerate(tree.index)}
        lower, upper = (np.array([place.get(c, 0) for c in tree[side]]) for side in ("lower", "upper"))
        length = tree["depth"].to_numpy() + mean_path(tree["size"].to_numpy())
        forest.append((tree["feature"].to_numpy(), tree["threshold"].to_numpy(), lower, upper, length, int(tree["depth"].max())))

    @F.pandas_udf("double")
    def total(x: pd.Series) -> pd.Series:
        if len(x) == 0:
            return pd.Series([], dtype=float)
        m = np.stack(x.to_numpy()).astype(float)
        every = np.arange(len(m))
        out = np.zeros(len(m))
        for feature, threshold, lower, upper, length, depth in forest:
            at = np.zeros(len(m), dtype=int)
            for _ in range(depth):
                f = feature[at]
                step = np.where(m[every, np.maximum(f, 0)] < threshold[at], lower[at], upper[at])
                at = np.where(f < 0, at, step)
            out += length[at]
        return pd.Series(out)

    return total


def score_forest(
    df: DataFrame,
    nodes: DataFrame,
    features: str,
    sample_rows: int,
    out: str = "score",
    compiled_nodes: int = COMPILED_NODES,
) -> DataFrame:
    """Add the anomaly score 2^(-E[h(x)] / c(sample))."""
    trees = _trees(nodes)
    scale = float(max(mean_path(sample_rows), 1e-12))
    if sum(map(len, trees)) <= compiled_nodes:
        total = F.expr(" + ".join(["0.0D", *[_compiled(tree, features) for tree in trees]]))
    else:
        total = _walker(trees)(F.col(features))
    return df.withColumn(out, F.pow(F.lit(2.0), -(total / max(len(trees), 1)) / scale))


def _labelled(scored: DataFrame, forest: Forest, score: str, label: str) -> DataFrame:
    return scored.withColumn(label, (F.col(score) > forest.threshold).cast("double"))


def predict_forest(
    df: DataFrame, forest: Forest, features: str, score: str = "score", label: str = "prediction"
) -> DataFrame:
    """Score and label: 1.0 strictly above the threshold fixed at fit time."""
    rows = df.filter(F.col(features).isNotNull())
    scored = score_forest(rows, forest.nodes, features, forest.sample_rows, score)
    return _labelled(scored, forest, score, label)


def save_forest(forest: Forest, path: str) -> None:
    forest.nodes.withColumn("cut", F.lit(forest.threshold)).withColumn(
        "sample_rows", F.lit(forest.sample_rows)
    ).write.mode("overwrite").parquet(path)


def load_forest(spark: SparkSession, path: str) -> Forest:
    table = spark.read.parquet(path)
    head = table.select("cut", "sample_rows").first()
    return Forest(table.drop("cut", "sample_rows"), head["cut"], head["sample_rows"])
