"""The bucketed keyed table against a dictionary, its plans, and replays."""

import random
import re

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorlake.operators import keyed
from tremorlake.plans.scratch import delete_path, list_folders
from tremorlake.sources.bucketed import BucketedTable

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("dev", T.StringType()), ("idx", T.LongType()), ("ver", T.LongType()), ("val", T.DoubleType()))])


def plan_of(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


def batch(seed, count=300):
    random.seed(seed)
    return [(random.choice("aab"), random.randint(0, 60), random.randint(0, 50), float(seed * 1000 + i)) for i in range(count)]


def apply(state, rows):
    newest = {}
    for r in rows:
        if r[2] > newest.get(r[:2], (0, 0, -1))[2]:
            newest[r[:2]] = r
    for k, r in newest.items():
        if k not in state or r[2] >= state[k][2]:
            state[k] = r


def distinct_versions(rows):
    """Of equal versions of a key in one batch either may be kept, so tests leave one."""
    return list({r[:3]: r for r in rows}.values())


@pytest.fixture
def store(spark, tmp_path):
    return BucketedTable(spark, str(tmp_path / "keyed"), SCHEMA, ["dev", "idx"], "ver", buckets=4)


def state_of(store):
    return {tuple(r)[:2]: tuple(r) for r in store.read().collect()}


def test_batches_replays_and_compaction(spark, store):
    assert store.read().count() == 0 and store.read().columns == SCHEMA.names
    want = {}
    frames = {i: distinct_versions(batch(i)) for i in range(6)}
    for i in range(6):
        df = spark.createDataFrame(frames[i], SCHEMA)
        store.append(df, i)
        apply(want, frames[i])
        assert state_of(store) == want
        if i in (1, 3):
            store.compact()
            assert state_of(store) == want
        if i in (2, 3, 5):
            store.append(df, i)  # a replay, also of a batch that is in the base by now
            assert state_of(store) == want
    store.compact()
    store.compact()
    assert state_of(store) == want and len(list_folders(spark, store.path)) == 1
    # Another session knows the files, not the table names.
    again = BucketedTable(spark.newSession(), store.path, SCHEMA, ["dev", "idx"], "ver", buckets=4)
    assert state_of(again) == want


def test_an_unfinished_batch_does_not_count(spark, store):
    rows = distinct_versions(batch(1))
    store.append(spark.createDataFrame(rows, SCHEMA), 0)
    before = state_of(store)
    store.append(spark.createDataFrame(batch(2), SCHEMA), 1)
    delete_path(spark, f"{store.path}/delta-{1:012d}/_SUCCESS")
    assert state_of(store) == before
    store.append(spark.createDataFrame(rows, SCHEMA), 1)
    assert state_of(store) == before


def test_the_base_is_neither_shuffled_nor_sorted(spark, store):
    frames = [spark.createDataFrame(distinct_versions(batch(i)), SCHEMA) for i in range(4)]
    store.append(frames[0], 0)
    store.compact()
    store.append(frames[1], 1)
    plan = plan_of(store.read())
    assert "Exchange" not in plan and "Sort" not in plan and plan.count("Bucketed: true") == 2
    store.append(frames[2], 2)
    plan = plan_of(store.read())
    base = plan.split("ShuffledHashJoin")[1].split("Exchange")[0]
    # The left side is the base; the two deltas, merged, are dealt out once.
    assert base.count("Bucketed: true") == 1 and plan.count("Exchange ") == 1 and "Sort" not in plan


def test_missing_keys_are_an_error(spark, store):
    for row in ((None, 1, 1, 1.0), ("a", None, 1, 1.0), ("a", 1, None, 1.0)):
        with pytest.raises(Exception, match="never NULL"):
            store.append(spark.createDataFrame([row], SCHEMA), 0)
    assert store.read().count() == 0


def test_newest_row_by_a_hash_aggregate(spark):
    rows = [("a", 1, 5, 1.0), ("a", 1, 7, None), ("a", 1, None, 3.0), ("b", 1, None, 4.0), (None, 2, -9, 5.0), (None, 2, -(2**62), 6.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    newest = keyed.latest_version(df, ["dev", "idx"], ["ver"])
    plan = plan_of(newest)
    assert "SortAggregate" not in plan and "Sort " not in plan and "HashAggregate" in plan
    want = [("a", 1, 7, None), ("b", 1, None, 4.0), (None, 2, -9, 5.0)]
    assert sorted(map(tuple, newest.collect()), key=str) == sorted(want, key=str)
    two = keyed.latest_version(df.withColumn("flag", (F.col("val") > 2).cast("int")), ["dev", "idx"], ["flag", "ver"]).drop("flag")
    assert "SortAggregate" not in plan_of(two)
    want = [("a", 1, None, 3.0), ("b", 1, None, 4.0), (None, 2, -9, 5.0)]
    assert sorted(map(tuple, two.collect()), key=str) == sorted(want, key=str)
    # Text has no fixed width and takes the general form.
    text = keyed.latest_version(df.withColumn("val", F.col("val").cast("string")), ["dev", "idx"], ["ver"])
    assert sorted((r.dev or "", r.val or "") for r in text.collect()) == [("", "5.0"), ("a", ""), ("b", "4.0")]
