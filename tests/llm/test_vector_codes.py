"""Vector codes against a plain computation in Python integers."""

import math
import random

import numpy as np
import pytest

from tremorlake.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error string, _v string"


def brute(rows, parts, entries, rounds):
    """Codes and codebooks by comparing every part with every entry."""
    kept = [(k, label, [math.floor(256 * x) for x in v]) for k, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return [], []
    width = len(kept[0][2]) // parts
    cut = lambda v: [tuple(v[p * width : (p + 1) * width]) for p in range(parts)]
    vectors = [cut(v) for _, _, v in kept]
    book = [[v[p] for v in vectors[:entries]] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda part, p: min((apart(part, e), i) for i, e in enumerate(book[p]))
    for _ in range(rounds):
        groups = {}
        for v in vectors:
            for p, part in enumerate(v):
                groups.setdefault((p, nearest(part, p)[1]), []).append(part)
        book = [
            [tuple(sum(c) // len(g) for c in zip(*g)) if (g := groups.get((p, i))) else e for i, e in enumerate(book[p])]
            for p in range(parts)
        ]
    out, by_label = [], {}
    for (k, label, _), v in zip(kept, vectors):
        found = [nearest(part, p) for p, part in enumerate(v)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((k, "".join(f"{i:02x}" for _, i in found), error, label))
    return sorted(((k, c, e, by_label[lab]) for k, c, e, lab in out), key=str), book


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def some_rows(seed, count, dim, spread=1.0):
    random.seed(seed)
    value = lambda: random.choice([random.gauss(0, spread), random.randint(-3, 3) / 256, -1e-9, 0.0])
    rows = [(random.randint(0, count), [float(np.float32(value())) for _ in range(dim)], random.choice([None, 1, 1, 2])) for _ in range(count)]
    rows += rows[:5]  # repeated rows
    rows += [(1, None, 1), (2, [math.nan] * dim, 1), (3, [math.inf] + [0.0] * (dim - 1), 2), (4, [None] * dim, None)]
    return [*rows, (None, [0.5] * dim, 1), (None, [0.25] * dim, None)]


@pytest.mark.parametrize("count, dim, parts, entries", [(200, 8, 4, 16), (30, 6, 2, 64), (1, 4, 4, 3), (90, 4, 1, 1)])
def test_codes_equal_brute_force(spark, count, dim, parts, entries):
    rows = some_rows(count, count, dim)
    codes, book = vc.vector_codes(frame(spark, rows), parts=parts, entries=entries)
    want, want_book = brute(rows, parts, entries, vc.ROUNDS)
    assert codes.columns == ["vec_id", "code", "error", "label_error"]
    assert sorted(map(tuple, codes.collect()), key=str) == want
    assert book.tolist() == [[list(e) for e in p] for p in want_book]


def test_many_labels_take_the_shuffled_join(spark, monkeypatch):
    rows = some_rows(3, 60, 4)
    attach = vc.attach
    monkeypatch.setattr(vc, "attach", lambda *a, **k: attach(*a, **k, limit=40))
    codes, _ = vc.vector_codes(frame(spark, rows), parts=2, entries=8)
    assert sorted(map(tuple, codes.collect()), key=str) == brute(rows, 2, 8, vc.ROUNDS)[0]


@pytest.mark.parametrize("spread", [0, 1, 30, 1 << 25])
@pytest.mark.parametrize("pivots", [1, 4])
def test_pruning_leaves_no_nearer_entry_out(spread, pivots):
    rng = np.random.default_rng(spread + pivots)
    entries = rng.integers(-spread, spread + 1, (3, 40, 4))
    vectors = rng.integers(-spread, spread + 1, (500, 3, 4))
    fixed = vc.choose_pivots(entries, pivots)
    distances = np.stack([vc._lengths(vectors[:, p, None] - fixed[p][None]) for p in range(3)], 1)
    index, error = vc.Assigner(entries, fixed).nearest(vectors, distances)
    every = ((vectors[:, :, None] - entries[None]) ** 2).sum(-1)
    assert (index == every.argmin(2)).all() and (error == every.min(2)).all()


def test_pruning_saves_evaluations(monkeypatch):
    rng = np.random.default_rng(5)
    entries = rng.integers(-1000, 1000, (1, 64, 4))
    vectors = entries[0][rng.integers(0, 64, 1000)][:, None] + rng.integers(-20, 20, (1000, 1, 4))
    fixed = vc.choose_pivots(entries, 4)
    tried = []
    sums = vc.Assigner(entries, fixed)
    inner = np.ndarray.argmin
    distances = vc._lengths(vectors - fixed)[:, None]

    class Counted(np.ndarray):
        def argmin(self, axis):
            tried.append(len(self))
            return inner(np.asarray(self), axis)

    zeros = np.zeros
    monkeypatch.setattr(vc.np, "zeros", lambda *a, **k: zeros(*a, **k).view(Counted))
    sums._part(0, vectors[:, 0], distances[:, 0])
    assert sum(tried) < 1000 * 64 / 8


def test_rows_that_cannot_be_coded(spark):
    rows = [(1, [1.0, 2.0], 1), (2, [1.0, 2.0, 3.0, 4.0], 1), (3, [1e9, 0.0], 1), (4, [], None), (5, [1.0, 2.5], 1)]
    codes, _ = vc.vector_codes(frame(spark, rows), parts=2, entries=1, rounds=0)
    got = {r.vec_id: (r.code, r.error, r.label_error) for r in codes.collect()}
    assert got == {1: ("0000", 0, 16384), 2: (None, None, 16384), 3: (None, None, 16384), 4: (None, None, None), 5: ("0000", 16384, 16384)}
    with pytest.raises(ValueError):
        vc.vector_codes(frame(spark, rows), parts=3)


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, [math.nan], 2)], [(7, [], 1)]])
def test_nothing(spark, rows):
    codes, book = vc.vector_codes(frame(spark, rows))
    assert [r.vec_id for r in codes.collect()] == ([7] if rows == [(7, [], 1)] else [])
    assert len(vc.book_digest(book)) == 64
