"""Every stage of the pipeline against a brute-force version of it on the smallest table."""

import random

import corpus_pipeline as cp
from test_exact import SCHEMA, brute_components, brute_decontaminate

from tremorlake.plans import write_scratch

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    for name, stage in cp.STAGES[:-1]:
        before, out = rows_of(docs), stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = write_scratch(out, f"test-{name}")
        after = rows_of(docs)
        assert all(before[i] == t for i, t in after.items()) and docs.count() == len(after)
        gone = set(before) - set(after)
        if name == "toxicity":
            assert gone and len(gone & toxic) >= 0.5 * len(gone) and len(gone) < 0.2 * len(before)
        elif name == "exact_dedup":
            last = {t: i for i, t in sorted(before.items())}
            assert set(after) == set(last.values())
        elif name == "near_dedup":
            assert set(after) == {r[0] for r in brute_components(list(before.items())) if r[3]}
        else:
            assert gone == {r[0] for r in brute_decontaminate(list(before.items()), bench) if r[5]}
    mixed = cp.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in mixed} == set(rows_of(docs))
    assert sum(r["taken"] for r in mixed) == sum(r["size"] for r in mixed)


def test_stages_keep_columns_of_awkward_rows(spark):
    random.seed(1)
    text = " ".join(random.choice("abcdefghij") * 3 for _ in range(60))
    rows = [(1, None, None, None, None, "s", "k"), (2, "", "en", "a", 0, None, "k"), (3, text, "en", "a", 1, "s", None)]
    rows += [(4, text + " tail", "en", "a", 1, "s", "k"), (None, "odd one", None, None, None, None, None), (3, text, "en", "a", 1, "s", None)]
    for docs in (spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], SCHEMA)):
        for _, stage in cp.STAGES[:-1]:
            docs = write_scratch(stage(spark, docs, SF), "test-awkward")
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        left = {(r["doc_id"], r["score"]) for r in docs.collect()}
        assert left in (set(), {(2, None), (3, "s"), (None, None)})
        cp.STAGES[-1][1](spark, docs, SF).count()


def test_toxicity_stage_keeps_all_rows_without_a_classifier(spark, tmp_path):
    docs = spark.createDataFrame([(i, chr(97 + i % 26) * (5 + i // 26)) for i in range(30)], "doc_id bigint, text string")
    spark.createDataFrame([(i, int(i < 28)) for i in range(30)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.toxicity(spark, docs, str(tmp_path)).count() == 30


def test_stages_tell_rows_of_equal_or_null_key_apart(spark, tmp_path):
    rng = random.Random(5)

    def prose(n):
        return [rng.choice("abcdefghijklmnop") * 2 + rng.choice("qrstuvwxyz") + rng.choice("qrstuvwxyz") for _ in range(n)]

    near, passage, clean = prose(120), prose(40), [" ".join(prose(60)) for _ in range(4)]
    copies = [" ".join([*near, extra]) for extra in ("one", "two", "three", "four")]
    leaked = " ".join([*prose(30), *passage])
    # Near copies with a doc_id, without one (one of them with the same shingles), and other rows of the same keys.
    rows = [(9, copies[0]), (None, copies[1]), (None, copies[2]), (None, copies[0].upper()), (None, clean[0]), (None, clean[1]), (9, clean[2])]
    got = [(r["doc_id"], r["text"]) for r in cp.near_dedup(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "").collect()]
    assert sorted(got, key=str) == sorted([rows[0], *rows[4:]], key=str)
    only = [r for r in rows if r[0] is None and r[1] in copies]
    assert cp.near_dedup(spark, spark.createDataFrame(only, "doc_id bigint, text string"), "").count() == 1

    spark.createDataFrame([(1, " ".join(passage))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, leaked), (None, clean[0]), (7, leaked + " more"), (7, clean[1]), (8, None), (None, None)]
    out = cp.decontamination(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path))
    assert sorted([tuple(r) for r in out.collect()], key=str) == sorted([rows[1], *rows[3:]], key=str)
