"""Language-model scoring with Brown word classes.

A word is emitted by its class, and classes follow each other: P(word | previous) = P(class | previous
class) * P(word | class), both smoothed. Exchange clustering finds the classes: a word moves to the class
in which the training text is likeliest, given all other words' classes.

* Word counts are taken over all training documents, combined in the tasks and summed by Spark.
* The ``UNITS`` most frequent words are clustered one by one. All others are clustered too, in ``BUNDLES``
  bundles of words with a common ending. The table of neighbouring units is counted over all training
  text and has at most (UNITS + BUNDLES + 1) squared rows, whatever the size of the corpus.
* A round of exchange reads that table in parallel, one row per unit, against the class counts of the round
  before; a hashed half of the units moves at once, and a smaller part after a round that gained nothing.
* Documents are scored where they lie with the counts of the ``KNOWN`` most frequent words, a table of
  bounded size; a document's other words meet their counts in a shuffle join.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import write_scratch
from .common import fold_of, query, table

UNITS = 4_096
BUNDLES = 1_024
CLASSES = 64
ROUNDS = 14
KNOWN = 120_000
FOLDS = 10
ADD = 0.1
_FLUSH = 300_000
_CODES = 2_000_000
END = ""


def _tokens(text: str | None) -> list[bytes]:
    """White-space words with A-Z in lower case, without the end token."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """Rows (word, c) over the column _text; every text ends with the empty word."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["_text"]:
                seen.update(_tokens(text))
                seen[b""] += 1
                if len(seen) > _FLUSH:
                    yield pd.DataFrame({"word": list(seen.keys()), "n": list(seen.values())})
                    seen.clear()
        if seen:
            yield pd.DataFrame({"word": list(seen.keys()), "n": list(seen.values())})

    counted = texts.mapInPandas(count, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("c"))


class _Units(dict):
    """Unit of a word: 0 for the end, then the frequent words, then the bundles."""

    def __init__(self, words: list[bytes]):
        super().__init__((w, i + 1) for i, w in enumerate(words))
        self[b""] = 0
        self.base = len(words) + 1
        self.room = 200_000

    def __missing__(self, word: bytes) -> int:
        unit = self.base + zlib.crc32(word[-3:]) % BUNDLES
        if self.room > 0:
            self.room -= 1
            self[word] = unit
        return unit


def _unit_ids(text: str | None, units: _Units) -> np.ndarray:
    words = _tokens(text)
    out = np.zeros(len(words) + 1, np.int64)
    out[:-1] = np.fromiter(map(units.__getitem__, words), np.int64, len(words))
    return out


@dataclass
class ClassModel:
    """What scoring needs. ``words`` are the ``KNOWN`` most frequent, ``n_units`` of them single units."""

    words: list[bytes]
    counts: np.ndarray
    n_units: int
    tokens: int
    distinct: int
    classes: np.ndarray
    follow: np.ndarray
    class_tokens: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES))
    class_words: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES))

    def units(self) -> _Units:
        return _Units(self.words[: self.n_units])

    def log_follow(self) -> np.ndarray:
        """log10 P(class | class before): bigram counts backed by the class shares."""
        share = (self.class_tokens + ADD) / (self.class_tokens.sum() + ADD * CLASSES)
        weight = 5.0
        return np.log10((self.follow + weight * share) / (self.follow.sum(axis=1, keepdims=True) + weight))

    def log_word(self, count, cls):
        """log10 P(word | class); a count of 0 is the class's share for unseen words."""
        return np.log10((count + ADD) / (self.class_tokens[cls] + ADD * (self.class_words[cls] + 1)))

    def log_base(self, count):
        return np.log10((count + ADD) / (self.tokens + ADD * (self.distinct + 1)))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_class(right: np.ndarray, left: np.ndarray, own: float, now: int, follow: np.ndarray) -> int:
    """Class in which a unit makes the training text likeliest.

    ``right`` and ``left`` count the unit's neighbours by class, ``own`` its pairs with itself, and
    ``follow`` the class pairs including this unit in class ``now``.
    """
    m = follow.astype(float).copy()
    m[now, :] -= right
    m[:, now] -= left
    m[now, now] += own
    r, l = right.astype(float).copy(), left.astype(float).copy()
    r[now] -= own
    l[now] -= own
    # Wherever the unit goes, the other classes keep their pairs with it.
    rows, cols = m.sum(axis=1) + l, m.sum(axis=0) + r
    gain = (_xlogx(m + r) - _xlogx(m)).sum(axis=1) + (_xlogx(m + l[:, None]) - _xlogx(m)).sum(axis=0)
    d = np.diag(m)
    gain -= _xlogx(d + r) + _xlogx(d + l) - 2 * _xlogx(d)
    gain += _xlogx(d + r + l + own) - _xlogx(d)
    gain -= _xlogx(rows + right.sum()) - _xlogx(rows) + _xlogx(cols + left.sum()) - _xlogx(cols)
    gain[0] = -np.inf  # the class of the end alone
    top = int(gain.argmax())
    return top if gain[top] > gain[now] + 1e-9 else now


def neighbour_table(texts: DataFrame, words: list[bytes]) -> DataFrame:
    """One row per unit: u, and arrays of (unit, count) that follow it and that precede it."""
    total = len(words) + 1 + BUNDLES

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units, codes, held = _Units(words), [], 0

        def flush() -> pd.DataFrame:
            code, n = np.unique(np.concatenate(codes), return_counts=True)
            return pd.DataFrame({"u": (code // total).astype(np.int32), "v": (code % total).astype(np.int32), "n": n})

        for batch in batches:
            for text in batch["_text"]:
                ids = _unit_ids(text, units)
                codes.append(np.concatenate(([0], ids[:-1])) * total + ids)
                held += len(ids)
                if held > _CODES:
                    yield flush()
                    codes, held = [], 0
        if codes:
            yield flush()

    counted = texts.mapInPandas(pairs, "u int, v int, n bigint").groupBy("u", "v").agg(F.sum("n").alias("n"))
    counted = write_scratch(counted, "pairs")
    # A unit has at most UNITS + BUNDLES + 1 neighbours on either side.
    after = counted.groupBy("u").agg(F.collect_list("v").alias("rv"), F.collect_list("n").alias("rn"))
    turned = counted.select(F.col("v").alias("u"), F.col("u").alias("_p"), "n")
    before = turned.groupBy("u").agg(F.collect_list("_p").alias("lv"), F.collect_list("n").alias("ln"))
    return write_scratch(after.join(before, "u", "full"), "units")


def information(follow: np.ndarray) -> float:
    """The part of the training likelihood that depends on the classes."""
    return float(_xlogx(follow).sum() - _xlogx(follow.sum(axis=1)).sum() - _xlogx(follow.sum(axis=0)).sum())


def exchange(units: DataFrame, n_units: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the units and counts of class pairs."""
    total = n_units + 1 + BUNDLES
    classes = 1 + np.arange(total) % (CLASSES - 1)
    classes[0] = 0

    def follow_counts(cls: np.ndarray) -> np.ndarray:
        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            whole = np.zeros(CLASSES * CLASSES, np.int64)
            for batch in batches:
                for u, rv, rn in zip(batch["u"], batch["rv"], batch["rn"]):
                    if rv is not None:
                        row = np.bincount(cls[np.asarray(rv)], weights=rn, minlength=CLASSES).astype(np.int64)
                        whole[cls[u] * CLASSES : (cls[u] + 1) * CLASSES] += row
            used = np.flatnonzero(whole)
            yield pd.DataFrame({"at": used.astype(np.int32), "n": whole[used]})

        got = units.select("u", "rv", "rn").mapInPandas(count, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
        out = np.zeros(CLASSES * CLASSES)
        for row in got.collect():  # at most CLASSES squared
            out[row["at"]] = row["n"]
        return out.reshape(CLASSES, CLASSES)

    follow, parts = follow_counts(classes), 2
    for turn in range(rounds):
        cls, now, part = classes.copy(), follow, parts

        def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                got = []
                for u, rv, rn, lv, ln in zip(batch["u"], batch["rv"], batch["rn"], batch["lv"], batch["ln"]):
                    if u == 0 or zlib.crc32(b"%d/%d" % (u, turn)) % part:
                        continue
                    rv, rn = (np.asarray(x if x is not None else [], np.int64) for x in (rv, rn))
                    lv, ln = (np.asarray(x if x is not None else [], np.int64) for x in (lv, ln))
                    right = np.bincount(cls[rv], weights=rn, minlength=CLASSES)
                    left = np.bincount(cls[lv], weights=ln, minlength=CLASSES)
                    to = best_class(right, left, float(rn[rv == u].sum()), int(cls[u]), now)
                    if to != cls[u]:
                        got.append((u, to))
                yield pd.DataFrame(got, columns=["u", "c"]).astype("int32")

        moved = units.mapInPandas(move, "u int, c int").collect()  # at most one row per unit
        tried = classes.copy()
        for row in moved:
            tried[row["u"]] = row["c"]
        counts = follow_counts(tried)
        # Units that moved at once may spoil each other's gain: such a round is undone, the next is smaller.
        if information(counts) > information(follow):
            classes, follow = tried, counts
        else:
            parts *= 2
    return classes, follow


def fit_classes(texts: DataFrame) -> tuple[ClassModel, DataFrame]:
    """The model and the written counts of all words, from the column _text."""
    vocabulary = write_scratch(word_counts(texts), "vocabulary")
    size = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = vocabulary.filter(F.octet_length("word") > 0).orderBy(F.desc("c"), "word").limit(KNOWN).collect()
    words = [bytes(r["word"]) for r in top]
    n_units = min(UNITS, len(words))
    units = neighbour_table(texts, words[:n_units])
    classes, follow = exchange(units, n_units)
    model = ClassModel(words, np.array([r["c"] for r in top], np.int64), n_units, size[0], size[1], classes, follow)
    frequent = words[:n_units]

    def per_class(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units_, tokens, distinct = _Units(frequent), np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            cls = classes[np.fromiter(map(units_.__getitem__, map(bytes, batch["word"])), np.int64, len(batch))]
            tokens += np.bincount(cls, weights=batch["c"], minlength=CLASSES).astype(np.int64)
            distinct += np.bincount(cls, minlength=CLASSES)
        yield pd.DataFrame({"k": np.arange(CLASSES, dtype=np.int32), "t": tokens, "d": distinct})

    sums = vocabulary.mapInPandas(per_class, "k int, t bigint, d bigint").groupBy("k").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
    for row in sums.collect():
        model.class_tokens[row["k"]], model.class_words[row["k"]] = row["t"], row["d"]
    return model, vocabulary


@lru_cache(maxsize=1)
def _tables(shared: Broadcast):
    """Per worker: units, the known words' logarithms, class transitions."""
    model: ClassModel = shared.value
    units = model.units()
    of = model.classes[np.fromiter(map(units.__getitem__, model.words), np.int64, len(model.words))]
    base, word = model.log_base(model.counts), model.log_word(model.counts, of)
    known = dict(zip(model.words, zip(base.tolist(), word.tolist())))
    return units, known, model.log_follow(), model


def score_texts(docs: DataFrame, model: ClassModel, vocabulary: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with n_tokens, n_known, train_tokens, base_score and score (log10 probabilities).

    Null text is the end token alone. Rows equal in ``keep`` and text get equal results, one row each.
    Without training text every token has probability 1 under the base model.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units, known, log_follow, model_ = _tables(shared)
        classes = model_.classes
        ends = int(model_.class_tokens[0])
        end_base, end_word = float(model_.log_base(ends)), float(model_.log_word(ends, 0))
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                where, hashed, n_tok, n_known, base, score, word, cls, tf = ([] for _ in range(9))
                for i, raw in enumerate(part["_text"]):
                    words = _tokens(raw)
                    mark = xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)
                    ids = np.zeros(len(words) + 1, np.int64)
                    ids[:-1] = np.fromiter(map(units.__getitem__, words), np.int64, len(words))
                    c = classes[ids]
                    total = float(log_follow[np.concatenate(([0], c[:-1])), c].sum()) + end_word
                    plain, seen = end_base, int(ends > 0)
                    for w, k in Counter(words).items():
                        found = known.get(w)
                        if found is None:
                            where.append(i), hashed.append(mark), word.append(w), tf.append(k)
                            cls.append(int(classes[units[w]]))
                            n_tok.append(None), n_known.append(0), base.append(0.0), score.append(0.0)
                        else:
                            plain += k * found[0]
                            total += k * found[1]
                            seen += k
                    where.append(i), hashed.append(mark), word.append(None), tf.append(None), cls.append(None)
                    n_tok.append(len(words) + 1), n_known.append(seen), base.append(plain), score.append(total)
                out = part.drop(columns="_text").iloc[where].reset_index(drop=True)
                yield out.assign(
                    _h=np.array(hashed, np.int64), _tok=pd.array(n_tok, "Int64"), _known=np.array(n_known, np.int64), _base=base, _score=score,
                    _word=word, _cls=pd.array(cls, "Int32"), _tf=pd.array(tf, "Int64"),
                )

    split = rows.mapInPandas(
        parts, f"{kinds}, _h bigint, _tok bigint, _known bigint, _base double, _score double, _word binary, _cls int, _tf bigint"
    )
    split = write_scratch(split, "scores")
    rare = split.filter(F.col("_word").isNotNull())
    met = rare.join(vocabulary.withColumnRenamed("word", "_word"), "_word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    add = F.lit(ADD)
    emit = F.element_at(
        F.array(*[F.lit(float(t + ADD * (w + 1))) for t, w in zip(model.class_tokens, model.class_words)]), F.col("_cls") + 1
    )
    plain = F.lit(float(model.tokens + ADD * (model.distinct + 1)))
    met = met.select(
        *keep, "_h", F.lit(None).cast("bigint").alias("_tok"),
        F.when(F.col("c") > 0, F.col("_tf")).otherwise(F.lit(0)).alias("_known"),
        (F.col("_tf") * F.log10((F.col("c") + add) / plain)).alias("_base"),
        (F.col("_tf") * F.log10((F.col("c") + add) / emit)).alias("_score"),
    )
    whole = split.filter(F.col("_word").isNull()).select(met.columns)
    summed = whole.unionByName(met).groupBy(*keep, "_h").agg(
        F.count("_tok").alias("_rows"), F.max("_tok").alias("n_tokens"),
        *[F.sum(c).alias(c) for c in ("_known", "_base", "_score")],
    )
    each = summed.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_rows"))))
    return each.select(
        *keep,
        "n_tokens",
        (F.col("_known") / F.col("_rows")).cast("bigint").alias("n_known"),
        F.lit(int(model.tokens)).cast("bigint").alias("train_tokens"),
        (F.col("_base") / F.col("_rows")).alias("base_score"),
        (F.col("_score") / F.col("_rows")).alias("score"),
    )


@query("op3_class_lm")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold_of("doc_id", FOLDS) == 0)
    model, vocabulary = fit_classes(docs.filter(~F.col("held_out")).select(F.col("text").alias("_text")))
    return score_texts(docs, model, vocabulary, keep=("doc_id", "held_out"))
