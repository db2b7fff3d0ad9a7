"""Exact operators against brute force on small, awkward tables, and registered queries against their SQL."""

import hashlib
import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest
from oracle import compare, connect

from tremorlake.llm import decontaminate as dc
from tremorlake.llm import near_dedup as nd
from tremorlake.llm.catalog import ORACLE, QUERIES
from tremorlake.llm.exact_dedup import drop_copies, exact_dedup
from tremorlake.llm.mixture import fair_mixture

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, None)[:4] + (None, "x", "y") if len(r) < 5 else r for r in rows], SCHEMA)


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", "y") for i, t in pairs], SCHEMA)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, name, QUERIES[name], ORACLE[name], SF, con) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_have_one_row_per_input(spark, name):
    table = "pages" if name.startswith("op2") else "documents"
    got = QUERIES[name](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


AWKWARD = [(1, "a b c"), (2, "a b c"), (3, None), (4, ""), (5, "a b c "), (2, "a b c"), (None, "a b c"), (None, "z"), (9, "x" * 50_000)]


@pytest.mark.parametrize("hot_rows", [0, 2, 500])
def test_exact_dedup(spark, rows, hot_rows):
    got = rows(exact_dedup(docs(spark, AWKWARD), hot_rows=hot_rows).select("doc_id", "keep_id", "group_size", "kept"))
    want = [
        (None, 2, 4, False), (None, None, 1, True), (1, 2, 4, False), (2, 2, 4, False), (2, 2, 4, True),
        (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True), (9, 9, 1, True),
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    left = drop_copies(docs(spark, AWKWARD), hot_rows=hot_rows)
    assert left.columns == SCHEMA.replace(",", "").split()[::2]
    assert sorted((r.doc_id, r.text) for r in left.collect() if r.doc_id) == [(2, "a b c"), (4, ""), (5, "a b c "), (9, "x" * 50_000)]


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup(docs(spark, AWKWARD).limit(0)).count() == 0
    assert drop_copies(docs(spark, AWKWARD).limit(0)).count() == 0


def test_mixture_reaches_targets(spark):
    random.seed(3)
    rows_ = [(i, " ".join(["w"] * random.randint(0, 30)), "en", random.choice(["a", "a", "a", "b", None]), 1, "x", "y") for i in range(400)]
    rows_ += [rows_[0], (None, "q r", "en", "b", 1, "x", "y"), (777, None, "en", None, 1, "x", "y")]
    got = fair_mixture(spark.createDataFrame(rows_, SCHEMA)).collect()
    assert len(got) == len(rows_)
    total = sum(r.size for r in got)
    assert sum(r.taken for r in got) == total
    by = defaultdict(lambda: [0, 0.0])
    for r in got:
        assert r.taken <= 3 * r["size"]
        by[r.source_size][0] += r.taken
        by[r.source_size][1] = r.target
    assert all(abs(taken - target) <= 31 for taken, target in by.values())
    again = fair_mixture(spark.createDataFrame(rows_[::-1], SCHEMA)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixture_of_nothing(spark):
    assert fair_mixture(docs(spark, AWKWARD).limit(0)).count() == 0
    assert [r.taken for r in fair_mixture(docs(spark, [(1, None), (2, "")])).collect()] == [0, 0]


def brute_decontaminate(pairs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
    out = []
    for i, t in pairs:
        w, hit, found = words(t), set(), set()
        for name, text in items:
            v = words(text)
            n = min(10, len(v))
            if not n or name is None:
                continue
            windows = {tuple(v[s : s + n]) for s in range(len(v) - n + 1)}
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    found.add(str(name))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_a_word_over_and_over_costs_its_length(spark):
    """Thousands of equal words on both sides, a period of three, and the same inside other words."""
    same, period = "spam " * 5000, "a b c " * 1500
    pairs = [(1, same), (2, f"x y {period} z"), (3, f"{'u v w ' * 9} {'spam ' * 12}"), (4, "spam " * 9), (5, None)]
    items = [(1, same), (2, period), (3, "spam " * 11)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    begin = time.monotonic()
    got = [tuple(r) for r in dc.decontaminate(docs(spark, pairs), benchmark).collect()]
    assert time.monotonic() - begin < 60
    assert [(r[0], r[1], r[2], r[3]) for r in sorted(got)] == [(1, 5000, 5000, 2), (2, 4503, 4500, 1), (3, 39, 12, 2), (4, 9, 0, 0), (5, 0, 0, 0)]


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_decontaminate(spark, limit):
    random.seed(5)
    vocabulary = ["é", "a", "B", "c3", "dd", "e", "f"]
    some = lambda n: " ".join(random.choice(vocabulary) for _ in range(n))
    long_item, short_item = some(25), "zeta eta theta"
    items = [(1, long_item), (2, some(14)), (3, short_item), (4, None), (5, "..."), (None, some(12)), (6, "ZETA"), (1, long_item)]
    pairs = [(i, some(random.randint(0, 60))) for i in range(30)]
    pairs += [(40, f"{some(8)}, {long_item.upper()}! {some(3)}"), (41, " ".join(long_item.split()[4:15])), (42, short_item)]
    pairs += [(43, None), (44, ""), (41, pairs[-2][1]), (None, long_item), (45, f"x {short_item} y {short_item}"), (46, some(3_000))]
    bench = spark.createDataFrame([(i, t, "extra") for i, t in items], "item_id bigint, text string, lang string")
    got = [tuple(r) for r in dc.decontaminate(docs(spark, pairs), bench, limit=limit).collect()]
    assert sorted(got, key=str) == brute_decontaminate(pairs, items)


def test_decontaminate_without_rows(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert [r.n_hit for r in dc.decontaminate(docs(spark, [(1, "a b")]), bench).collect()] == [0]
    full = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert dc.decontaminate(docs(spark, AWKWARD).limit(0), full).count() == 0


def brute_components(pairs):
    sets = {}
    for i, t in pairs:
        w = (t or "").encode().lower().split()
        if w and i is not None:
            sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))}
    comp = {i: i for i, _ in pairs}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                comp[max(x, y)] = min(x, y)
    return sorted((i, len(sets.get(i, ())), root(i), root(i) == i) for i in comp)


@pytest.mark.parametrize("length", [8, 30, 60, 200])
def test_near_duplicates(spark, length):
    random.seed(length)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(4))
    base, pairs = [word() for _ in range(length)], []
    for i in range(80):  # a group of near copies, some beyond the threshold
        w = list(base)
        for _ in range(random.randint(0, max(1, length // 25))):
            w[random.randrange(length)] = word()
        pairs.append((i, " ".join(w)))
    passage = [word() for _ in range(length // 2)]
    pairs += [(100 + i, " ".join(passage + [word() for _ in range(length)])) for i in range(30)]
    pairs += [(200 + i, " ".join(word() for _ in range(length))) for i in range(20)]
    pairs += [(300, pairs[0][1].upper()), (301, None), (302, " "), (303, "a b"), (304, "A  b"), (305, "a b c")]
    got = [tuple(r) for r in nd.near_duplicates(docs(spark, pairs)).collect()]
    assert sorted(got) == brute_components(pairs)


def test_parities_bound_the_symmetric_difference():
    rng = np.random.default_rng(4)
    for n in (1, 30, 300, 5000):
        for gone in (0, 1, n // 10, n // 2):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64))
            b = np.unique(np.concatenate((a[gone:], rng.integers(0, 1 << 63, gone, dtype=np.int64).astype(np.uint64))))
            apart = int(np.bitwise_count((nd.parities(a) ^ nd.parities(b)).view(np.uint64)).sum())
            both = len(np.intersect1d(a, b))
            differ = len(a) + len(b) - 2 * both
            assert apart <= differ and (differ < 60) <= (apart >= 0.8 * differ)
            if 100 * both >= 75 * (len(a) + len(b) - both):
                assert 7 * apart <= len(a) + len(b)


def test_near_duplicates_without_keys(spark, rows):
    got = rows(nd.near_duplicates(docs(spark, [(None, "a b c"), (7, "a b c"), (7, "a b c"), (None, "q"), (None, None)])))
    assert got == [(None, 0, None, False), (None, 1, None, False), (None, 1, 7, False), (7, 1, 7, True), (7, 1, 7, True)]
    assert nd.near_duplicates(docs(spark, AWKWARD).limit(0)).count() == 0


def test_components_of_a_long_path(spark, rows):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = rows(nd.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")))
    assert {c for i, c in got if i < 50} == {0} and {c for i, c in got if i > 50} == {90}


def test_registers_estimate_similarity(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    pool = np.unique(rng.integers(0, 1 << 63, 6_000, dtype=np.uint64) * np.uint64(2))
    a, b = np.sort(pool[:4_000]), np.sort(pool[1_000:5_000])
    regs = [pd.Series([nd.registers(x).tobytes()]) for x in (a, b)]
    n = pd.Series([4_000])
    assert abs(nd.estimate.func(*regs, n, n)[0] - 0.6) < 0.15
    assert nd.estimate.func(regs[0], regs[0], n, n)[0] == 1.0
