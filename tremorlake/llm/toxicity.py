"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text. A window of text that
resembles the toxic text compresses better with the first; the window's gain is the difference between
its two compressed lengths. How many windows reach each threshold, and how dense they are, is calibrated
to a probability on labelled documents that no dictionary has seen.

A dictionary's content is chosen by document frequency, the criterion of zstandard's own trainer, but in
whole words, since that trainer cuts its segments across words. The ordinary dictionary is larger, so that
a common word is never a gain. Windows start with a header that both dictionaries hold, so that every
window is stored compressed, and end with a tail, since zstandard starts no match in the last eight bytes.

What is bounded: the labelled rows the fit uses (``SAMPLE`` per class, those with the smallest hash) and
the dictionaries. Sampled rows weigh as many as all labelled rows of their class, so that a bounded class
keeps its share. Every document is scored over its whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_of, query, table, text_of

SAMPLE = 6_000
TOXIC_BYTES = 16_384
ORDINARY_BYTES = 262_144
LEAST_DOCS = 3
FOLDS = 5
GAINS = (3, 4, 5, 6)
_HEADER, _TAIL = bytes(range(1, 25)), bytes(range(200, 208))
_LETTERS = r"[^a-z\x{80}-\x{10FFFF}]+"
_SPLIT = re.compile(r"[^a-z\x80-\U0010FFFF]+")
_LONGEST = 32
_CACHE_WORDS = 300_000


def _words(text: str) -> Iterator[str]:
    """Runs of letters in lower case; long runs are cut into pieces."""
    for word in _SPLIT.split(text.lower()):
        for at in range(0, len(word), _LONGEST):
            yield word[at : at + _LONGEST]


class Windows:
    """Gain of a window of one word: bytes that the toxic dictionary saves over the ordinary one."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self._toxic, self._ordinary = self._compressor(toxic), self._compressor(ordinary)
        self._known: dict[str, int] = {}

    @staticmethod
    def _compressor(content: bytes):
        content += _HEADER
        bits = max(17, len(content).bit_length() + 1)
        how = zstandard.ZstdCompressionParameters(
            window_log=bits, hash_log=17, chain_log=17, search_log=8, min_match=5, target_length=32,
            strategy=zstandard.STRATEGY_BTOPT, write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(dict_data=made, compression_params=how)

    def gain(self, word: str) -> int:
        known = self._known.get(word)
        if known is None:
            window = _HEADER + b" " + word.encode() + b" " + _TAIL
            known = len(self._ordinary.compress(window)) - len(self._toxic.compress(window))
            if len(self._known) >= _CACHE_WORDS:
                self._known.clear()
            self._known[word] = known
        return known

    def counts(self, text: str | None) -> list[int]:
        """Windows of the text, and how many of them have each gain in ``GAINS`` (the last: or more)."""
        out = [0] * (len(GAINS) + 1)
        gain, least, most = self.gain, GAINS[0], GAINS[-1]
        for word in _words(text or ""):
            if len(word) < 3:
                continue
            out[0] += 1
            g = gain(word)
            if g >= least:
                out[min(g, most) - least + 1] += 1
        return out


@lru_cache(maxsize=2)
def _windows(toxic: bytes, ordinary: bytes) -> Windows:
    return Windows(toxic, ordinary)


@dataclass(frozen=True)
class Toxicity:
    """Dictionaries and weights; ``weights`` is empty when there was nothing to learn from."""

    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    prior: float = 0.0

    def counts(self, text: Column) -> Column:
        """Array: windows of the text, then windows by gain."""
        if not self.weights and not self.toxic:
            return F.array().cast("array<int>")
        toxic, ordinary = self.toxic, self.ordinary

        @F.pandas_udf("array<int>")
        def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            windows = _windows(toxic, ordinary)
            for texts in batches:
                yield texts.map(windows.counts)

        return count(text)

    def score(self, counts: Column) -> Column:
        if not self.weights:
            return F.lit(self.prior)  # no counts are made then
        total = F.lit(self.weights[0])
        for weight, value in zip(self.weights[1:], _features([F.get(counts, F.lit(i)) for i in range(len(GAINS) + 1)], F)):
            total = total + F.lit(weight) * value
        return 1 / (1 + F.exp(-total))


def _features(counts, lib):
    """Logarithms of the counts, and the share of windows with a gain beyond the least."""
    windows, hits = counts[0], counts[1:]
    strong = sum(hits[1:], start=hits[0] * 0)
    return [*[lib.log1p(h.astype(float) if lib is np else h) for h in hits], 100 * strong / (windows + 20)]


def _fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 0.5) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps; the cut at 0.5 is moved to the best F1. Rows count ``weight`` times."""
    weight = np.ones(len(y)) if weight is None else weight
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    keep = np.diag([1e-6] + [ridge] * (len(w) - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + keep, x.T @ (weight * (y - p)) - keep @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    z = np.sort(np.unique(x @ w))
    cuts = (z[1:] + z[:-1]) / 2
    if len(cuts) > 400:
        cuts = cuts[np.linspace(0, len(cuts) - 1, 400).astype(int)]
    s = x @ w
    toxic = weight * y
    f1 = [(2 * toxic[s >= c].sum() / max(1.0, weight[s >= c].sum() + toxic.sum()), -abs(c)) for c in cuts]
    if f1:
        w[0] -= cuts[max(range(len(cuts)), key=f1.__getitem__)]
    return tuple(map(float, w))


def _dictionary(rows: list, size: int) -> bytes:
    """Words by falling document frequency, the most frequent nearest to the window."""
    out, used = [], 1
    for row in rows:
        used += len(row["w"].encode()) + 1
        if used > size:
            break
        out.append(row["w"])
    return b" " + " ".join(reversed(out)).encode() + b" " if out else b""


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> Toxicity:
    """Learn from labelled rows outside fold 0; two thirds of them train the dictionaries.

    At most ``sample`` rows per class are read; they stand for all labelled rows of their class.
    """
    marked = (
        labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & (fold_of(key, FOLDS) != 0))
        .groupBy(key)
        .agg(F.max(label).cast("int").alias("_y"))
        .withColumnRenamed(key, "_id")
        .withColumn("_order", F.xxhash64("_id"))
    )
    each = [marked.filter(F.col("_y") == y).orderBy("_order", "_id").limit(sample) for y in (0, 1)]
    picked = each[0].unionByName(each[1]).withColumn("_part", F.pmod(F.col("_order"), F.lit(3)))
    rows = docs.join(F.broadcast(picked), docs[key] == picked["_id"]).select(
        "_id", "_y", "_part", text_of(text).alias("_t")
    )
    # DF over whole words of the dictionary documents, counted where they lie.
    whole = rows.filter("_part > 0").select(
        "_y", F.explode(F.array_distinct(F.split(F.lower("_t"), _LETTERS))).alias("w")
    )
    df = whole.filter(F.length("w").between(4, _LONGEST)).groupBy("w").agg(
        F.sum("_y").alias("n1"), F.sum(1 - F.col("_y")).alias("n0")
    )
    found = []
    for n, size in (("n1", TOXIC_BYTES), ("n0", ORDINARY_BYTES)):
        top = df.filter(F.col(n) >= LEAST_DOCS).orderBy(F.desc(n), "w").limit(size // 5)
        found.append(_dictionary(top.select("w").collect(), size))
    # Labelled rows of each class, all and sampled.
    copies = docs.groupBy(F.col(key).alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    whole_n = {r["_y"]: r["n"] for r in copies.join(marked, "_id").groupBy("_y").agg(F.sum("_n").alias("n")).collect()}
    part_n = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = whole_n.get(1, 0) / max(1, sum(whole_n.values()))
    if not found[0] or not found[1]:
        return Toxicity(b"", b"", (), prior)
    model = Toxicity(found[0], found[1], ())
    seen = rows.filter("_part = 0").select("_y", model.counts(F.col("_t")).alias("_c"))
    pairs = sorted(seen.collect())  # so that sums do not depend on the partitioning
    y = np.array([r["_y"] for r in pairs], float)
    if not 0 < y.sum() < len(y):
        return Toxicity(b"", b"", (), prior)
    counts = np.array([r["_c"] for r in pairs], float).T
    weight = np.where(y == 1, whole_n[1] / part_n[1], whole_n[0] / part_n[0])
    return Toxicity(found[0], found[1], _fit_logistic(np.column_stack(_features(list(counts), np)), y, weight))


def score_toxicity(docs: DataFrame, model: Toxicity, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with score and predicted.

    Null text counts as empty and gets the score of a text without windows. Columns of ``docs`` named
    score or predicted are replaced; repeated rows get equal scores.
    """
    counted = docs.withColumn("_counts", model.counts(F.col(text)))
    scored = counted.withColumn("score", model.score(F.col("_counts")).cast("double")).drop("_counts")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    held = (fold_of("doc_id", FOLDS) == 0).alias("held_out")
    return score_toxicity(docs, model).select("doc_id", held, "score", "predicted")
