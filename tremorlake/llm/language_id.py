"""Language identification of mixed-language text.

The script of a word, from code point ranges, narrows its candidates to the languages seen in that script.
A word's score in a language is the log-likelihood of its byte trigrams. The Viterbi algorithm labels the
words of a text with languages, where each change of language costs ``PENALTY``; runs of one label are
spans, and the language of the text is the one whose spans hold the most characters.

Trigram counts are taken over all training texts in the tasks and summed by Spark; the model is a table of
``TRIGRAMS`` hash buckets by language. A text is labelled as one sequence, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_of, query, table, text_of

TRIGRAMS = 1 << 14
PENALTY = 12.0
FOLDS, HELD_OUT = 3, 1
#: First code point of a block, and its script (0: no letters).
SCRIPTS = (
    (0x0, 1), (0x80, 0), (0xC0, 1), (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5), (0x600, 6), (0x700, 7),
    (0x900, 8), (0x980, 9), (0xE00, 10), (0xE80, 11), (0x10A0, 12), (0x1100, 13), (0x1200, 14), (0x1E00, 1),
    (0x1F00, 2), (0x2000, 0), (0x2C60, 1), (0x2D00, 15), (0x3040, 16), (0x3100, 17), (0xAC00, 13), (0xD7B0, 15),
)
_STARTS = np.array([s for s, _ in SCRIPTS])
_NAMES = np.array([n for _, n in SCRIPTS])
N_SCRIPTS = 18
_PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
#: Beyond ASCII a word consists of letters and the marks on them; quotes, dashes and the like part words.
_BETWEEN = regex.compile(r"[^\p{L}\p{M}\x00-\x7F]+")
_PIECE = 1 << 20


def _words(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigram bucket of every byte (-1 at a space), start of every word, its characters and script."""
    b = np.frombuffer(b" " + block + b" ", np.uint8)
    inner = b[1:-1]
    space = inner == 32
    code = (b[:-2].astype(np.uint32) << 16) | (inner.astype(np.uint32) << 8) | b[2:]
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int32)
    starts = np.flatnonzero(~space & (b[:-2] == 32))
    bucket[space] = -1
    if not len(starts):
        return bucket, starts, starts, starts
    chars = np.add.reduceat((~space & ((inner & 0xC0) != 0x80)).astype(np.int64), starts)
    pad = np.concatenate((inner, np.zeros(3, np.uint8))).astype(np.int64)
    lead, one, two = pad[starts], pad[starts + 1] & 63, pad[starts + 2] & 63
    point = np.where(lead < 0x80, lead, np.where(lead < 0xE0, (lead & 31) << 6 | one, (lead & 15) << 12 | one << 6 | two))
    point = np.where(lead >= 0xF0, 0x3100, point)
    return bucket, starts, chars, _NAMES[np.searchsorted(_STARTS, point, "right") - 1]


def _pieces(text: str) -> Iterator[bytes]:
    """Lower-case bytes of the text, everything but letters as spaces, cut at spaces."""
    data = _BETWEEN.sub(" ", text.lower()).encode("utf-8", "replace").translate(_PLAIN)
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > _PIECE:
            end = data.rfind(b" ", at, at + _PIECE)
            end = at + _PIECE if end <= at else end
        yield data[at:end]
        at = end


@dataclass(frozen=True)
class Languages:
    names: tuple[str, ...]
    log_p: np.ndarray  # trigram bucket x language
    allowed: np.ndarray  # script x language, 0 or 1


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang") -> Languages:
    """Learn from the rows of ``docs`` with text and language."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text")
    )

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for name, part in zip(batch["lang"], batch["text"]):
                if name not in seen:
                    seen[name] = np.zeros(TRIGRAMS, np.int64), np.zeros(N_SCRIPTS, np.int64)
                for block in _pieces(part):
                    bucket, starts, chars, script = _words(block)
                    seen[name][0][:] += np.bincount(bucket[bucket >= 0], minlength=TRIGRAMS)
                    if len(starts):
                        seen[name][1][:] += np.bincount(script, weights=chars, minlength=N_SCRIPTS).astype(np.int64)
        for name, (grams, scripts) in seen.items():
            whole = np.concatenate((scripts, grams))
            used = np.flatnonzero(whole)
            yield pd.DataFrame({"lang": name, "slot": used.astype(np.int32), "n": whole[used]})

    table_ = rows.mapInPandas(counts, "lang string, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    # At most TRIGRAMS + N_SCRIPTS rows per language.
    got = table_.collect()
    names = tuple(sorted({r["lang"] for r in got}))
    where = {name: i for i, name in enumerate(names)}
    whole = np.zeros((N_SCRIPTS + TRIGRAMS, len(names)))
    for r in got:
        whole[r["slot"], where[r["lang"]]] = r["n"]
    scripts, grams = whole[:N_SCRIPTS], whole[N_SCRIPTS:]
    log_p = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * TRIGRAMS)).astype(np.float32)
    # Every language seen in a script may label its words; how likely that is, the trigrams say.
    allowed = scripts > 0
    allowed[0] = False
    return Languages(names, log_p, allowed)


def viterbi(scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Best label of every row of ``scores``, by sequence; all sequences move one word a step."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    languages = scores.shape[1]
    own = np.arange(languages, dtype=np.int16)
    back = np.zeros(scores.shape, np.int16)
    active = np.searchsorted(-sizes, -np.arange(1, int(sizes[0]) + 1), "right") if len(sizes) else np.empty(0, int)
    best = scores[starts].astype(np.float64) if len(starts) else np.empty((0, languages))
    for t in range(1, len(active)):
        a = active[t]
        now = best[:a]
        top = now.argmax(axis=1)
        jump = now[np.arange(a), top][:, None] - penalty
        switch = jump > now
        at = starts[:a] + t
        back[at] = np.where(switch, top[:, None].astype(np.int16), own)
        best[:a] = np.where(switch, jump, now) + scores[at]
    label = np.zeros(len(scores), np.int16)
    state = best.argmax(axis=1) if len(best) else np.empty(0, int)
    for t in range(len(active) - 1, -1, -1):
        a = active[t]
        at = starts[:a] + t
        label[at] = state[:a]
        state[:a] = back[at, state[:a]] if t else state[:a]
    return label


def _label(texts: list[str | None], model: Languages) -> list[tuple[str, float, list[dict]]]:
    """Language, share of its characters and spans (word numbers, both ends included) of each text."""
    n = len(model.names)
    if not n:
        return [("und", 0.0, [])] * len(texts)
    scores, chars, doc = [], [], []
    for i, text in enumerate(texts):
        for block in _pieces(text or ""):
            bucket, starts, size, script = _words(block)
            if not len(starts):
                continue
            each = model.log_p[bucket]
            each[bucket < 0] = 0
            score = np.add.reduceat(each, starts, axis=0)
            can = model.allowed[script]
            known = can.any(axis=1)
            # Words in a script of no language fit all alike and count for none.
            scores.append(np.where(known[:, None], np.where(can, score, score.min(axis=1, keepdims=True) - 4 * PENALTY), 0))
            chars.append(np.where(known, size, 0))
            doc.append(np.full(len(starts), i))
    out: list[tuple[str, float, list[dict]]] = []
    if scores:
        score, char, of = np.concatenate(scores), np.concatenate(chars), np.concatenate(doc)
        edge = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        lengths = np.diff(np.append(edge, len(of)))
        label = viterbi(score, edge, lengths)
        held = np.bincount(of * n + label, weights=char, minlength=len(texts) * n).reshape(len(texts), n)
        first = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (label[1:] != label[:-1]))))
        last = np.append(first[1:], len(of)) - 1
        base = np.zeros(len(texts), np.int64)
        base[of[edge]] = edge
        spans: list[list[dict]] = [[] for _ in texts]
        for f, e in zip(first.tolist(), last.tolist()):
            d = of[f]
            spans[d].append({"lang": model.names[label[f]], "first": int(f - base[d]), "last": int(e - base[d])})
    else:
        held, spans = np.zeros((len(texts), n)), [[] for _ in texts]
    for i, text in enumerate(texts):
        if text is None or not n or not any(map(str.isalpha, text)):
            out.append(("und", 0.0, []))
        else:
            total = held[i].sum()
            top = int(held[i].argmax())
            out.append((model.names[top], float(held[i, top] / total) if total else 0.0, spans[i]))
    return out


def identify_languages(docs: DataFrame, model: Languages, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with lang_pred, score and spans.

    Null text, text without a letter (Unicode category L) and a model without languages give und, score 0 and no
    span; a text only in unknown scripts gets the first language with score 0. A very long text is one sequence, and
    takes memory in proportion. Repeated rows get equal results, other columns are not read, and an empty table
    gives an empty result.
    """
    rows = docs.select(*keep, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                found = _label(list(part["_text"]), model)
                out = part.drop(columns="_text").copy()
                out["lang_pred"], out["score"], out["spans"] = (list(x) for x in zip(*found))
                yield out

    return rows.mapInPandas(
        label, f"{kinds}, lang_pred string, score double, spans array<struct<lang:string,first:bigint,last:bigint>>"
    )


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold_of("doc_id", FOLDS) == HELD_OUT)
    model = fit_languages(docs.filter(~F.col("held_out")))
    return identify_languages(docs, model, keep=("doc_id", "held_out"))
