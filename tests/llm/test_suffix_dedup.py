"""Repeated passages against a plain set of windows."""

import random
from collections import Counter

import numpy as np
import pytest

from tremorlake.llm import suffix_dedup as sd
from tremorlake.plans import write_scratch

SCHEMA = "doc_id bigint, text string, n string, kept string, gram string, _row string"


def brute(texts, size):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[s : s + size] for d in data for s in range(len(d) - size + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for s in range(len(d) - size + 1):
            if seen[d[s : s + size]] > 1:
                gone[s : s + size] = [True] * size
        runs = sum(g and not before for g, before in zip(gone, [False, *gone]))
        out.append((len(d), sum(gone), runs, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def words(rng, count, vocabulary=5000):
    return " ".join(f"w{rng.randrange(vocabulary)}é" for _ in range(count))


def planted(seed, size):
    """Texts with copies, near copies, passages around the threshold, periods and short texts."""
    rng = random.Random(seed)
    long = [words(rng, 8 * size // 5) for _ in range(6)]
    passage = words(rng, size)[: 2 * size]
    texts = [None, "", "ab", "x" * (5 * size), "x" * size, "x" * (size - 1), "xyz" * size, *long, long[0], long[1]]
    for cut in (size - 1, size, size + 1, size + 7, 2 * size):
        texts += [f"{words(rng, 9)}{passage[:cut]}{words(rng, 7)}" for _ in range(2)]
    for base in long[2:5]:
        for _ in range(3):
            place = rng.randrange(len(base))
            texts.append(base[:place] + rng.choice("#$%") + base[place + 1 :])
    line = words(rng, 5) + "\n"
    texts += [line * 12 + words(rng, 20), words(rng, 20) + line * 7, long[5][: len(long[5]) // 2] * 2]
    texts += ["".join(rng.choice("ab") for _ in range(6 * size)) for _ in range(3)]
    return texts


@pytest.mark.parametrize("size, group_rows", [(200, 4096), (200, 2), (32, 4096), (32, 1), (20, 3), (9, 50)])
def test_removed_bytes_equal_brute_force(spark, size, group_rows):
    texts = planted(size, size)
    docs = spark.createDataFrame([(i % 30 or None, t, "x", "y", "z", "r") for i, t in enumerate(texts)], SCHEMA)
    left = sd.remove_repeats(docs, threshold=size, group_rows=group_rows)
    assert left.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in left.collect())
    want = sorted(brute(texts, size))
    assert got == want
    assert any(0 < r[1] < r[0] for r in want) and any(r[2] > 1 for r in want)


def test_a_hot_passage_between_different_words(spark):
    rng = random.Random(1)
    passage = words(rng, 50)
    texts = [words(rng, 30) + passage + words(rng, 30) for _ in range(300)] + [words(rng, 100) for _ in range(50)]
    docs = spark.createDataFrame([(i, t, "x", "y", "z", "r") for i, t in enumerate(texts)], SCHEMA).repartition(4)
    left = sd.remove_repeats(docs, group_rows=16).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in left) == sorted(brute(texts, 200))


def test_windows_belong_to_one_anchor(monkeypatch):
    rng = random.Random(2)
    for size in (8, 20, 64, 200):
        for text in ("a" * 500, words(rng, 200), "ab" * 300):
            data = np.frombuffer(text.encode(), np.uint8)
            for stretch in (1 << 20, 100):
                monkeypatch.setattr(sd, "_STRETCH", stretch)
                first, last, anchor, gram = sd.anchors_of(data, size)
                covered = [s for a, b in zip(first, last) for s in range(a, b + 1)]
                assert covered == list(range(len(data) - size + 1))
                inside = sd.gram_bytes(size)
                assert all(b <= p and p + inside <= a + size for a, b, p in zip(first, last, anchor))
                assert (gram == sd.gram_hashes(data, inside)[anchor].view(np.int64)).all()
    assert len(sd.anchors_of(np.zeros(5, np.uint8), 8)[0]) == 0


def test_equal_suffixes():
    rng = np.random.default_rng(3)
    data = np.append(rng.integers(97, 99, 3000).astype(np.uint8), np.zeros(8, np.uint8))
    for depth in (8, 13, 16):
        at = np.arange(2980)
        group = at % 2
        keys = [(int(g), data[a : a + depth].tobytes()) for a, g in zip(at, group)]
        count = Counter(keys)
        found = sd.equal_suffixes(data, at, group, depth)
        assert sorted(found.tolist()) == [i for i, k in enumerate(keys) if count[k] > 1]


def test_each_window_is_in_one_span(spark):
    texts = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(["a b " * 100, "c" * 300, "d"])], "_row bigint, _bytes binary")
    spans = sd.repeated_windows(write_scratch(texts, "texts")).collect()
    assert sorted((r._row, s) for r in spans for s in range(r.lo, r.hi + 1)) == [(0, s) for s in range(201)] + [(1, s) for s in range(101)]


def test_nothing(spark):
    assert sd.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [r.n_removed for r in sd.remove_repeats(spark.createDataFrame([(None, None, "", "", "", "")] * 2, SCHEMA)).collect()] == [0, 0]
