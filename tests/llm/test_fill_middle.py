"""Fill-in-the-middle: borders against a regular expression, and exact round trips."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from tremorlake.llm import fill_middle as fm

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, n string, form string, output string, _key string"
ALPHABET = " \t\n\x0b\x0c\r\x08\x0e\x1f\x21\x7f\xa0ab\xa9é世😀 \x89\x8d"


def some_texts(seed, count=300):
    random.seed(seed)
    texts = ["", " ", "\n\t ", "a", " a", "a ", "x" * 5000, " " * 1000, "a b " * 3000, "é" * 9, "😀 \r\n"]
    return texts + ["".join(random.choices(ALPHABET, k=random.randint(0, 40))) for _ in range(count)]


@pytest.mark.parametrize("view", [1, 64, 1 << 24])
def test_cuts_equal_the_regular_expression(monkeypatch, view):
    monkeypatch.setattr(fm, "VIEW_BYTES", view)
    texts = some_texts(view)
    h1, h2 = ([random.getrandbits(32) for _ in texts] for _ in range(2))
    # A slice of a larger array has an offset of its own.
    whole = pa.array(["before".encode(), *[t.encode() for t in texts], b"behind"], pa.binary())
    got = fm.cuts(whole.slice(1, len(texts)), pa.array(h1), pa.array(h2)).to_pylist()
    for text, a, b, row in zip(texts, h1, h2, got):
        units = UNITS.findall(text)
        ends = sorted((a % (len(units) + 1), b % (len(units) + 1)))
        assert row == {
            "n": len(units),
            "first": len("".join(units[: ends[0]]).encode()),
            "second": len("".join(units[: ends[1]]).encode()),
        }


def test_every_border_of_a_text():
    text = "".join(random.Random(7).choices(ALPHABET, k=500))
    units = UNITS.findall(text)
    n = len(units) + 1
    got = fm.cuts(pa.array([text.encode()] * n, pa.binary()), pa.array(range(n)), pa.array([n - 1] * n)).to_pylist()
    assert [r["first"] for r in got] == [len("".join(units[:k]).encode()) for k in range(n)]


def test_select_in_word_finds_each_mark():
    for pattern in range(1, 256):
        at = [i for i in range(8) if pattern >> i & 1]
        word = np.array([sum(0x80 << 8 * i for i in at)] * len(at), np.uint64)
        assert list(fm.select_in_word(word, np.arange(1, len(at) + 1))) == at


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNITS.findall(text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", text, None, None
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return doc_id, len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def test_outputs_and_round_trips(spark):
    texts = [None, "<P> a", "a <M>b <S", "<<P", "S> <", *some_texts(3)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b c"), (None, None), (7, "again and again"), (7, "again and again")]
    docs = spark.createDataFrame([(*r, "x", "y", "z", "k") for r in rows], SCHEMA)
    made = fm.fill_in_middle(docs)
    got = made.withColumn("back", fm.restored(F.col("output"), F.col("form"))).join(
        docs.select(F.col("doc_id").alias("d"), F.coalesce("text", F.lit("")).alias("t")).distinct(),
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("back") == F.col("t")),
        "left",
    )
    assert got.filter("t is null").count() == 0  # every output gives its text back
    columns = ["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"]
    assert made.columns == columns
    assert sorted(map(tuple, made.collect()), key=str) == sorted((brute(*r) for r in rows), key=str)
    assert {r.form for r in made.collect()} == {"plain", "psm", "spm"}


def test_nothing(spark):
    assert fm.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0
