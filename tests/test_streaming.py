import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tremorlake.operators.keyed import read_keyed
from tremorlake.operators.normalize import apply_scaler, fit_scaler
from tremorlake.streaming.episodes import anomaly_counts, anomaly_sessions, late_rows
from tremorlake.streaming.ingest import (
    accepted,
    decode,
    deduplicated,
    file_messages,
    keyed_sink,
    quarantined,
    start,
)
from tremorlake.streaming.scoring import (
    Scorer,
    cursors,
    flat_loss,
    incremental_scorer,
    read_late,
    read_scored,
    score_batch,
)
from tremorlake.streaming.stateful import OrderedScorer, score_ordered, use_rocksdb


def message(device, index, x="1.5", ts="2018-07-09 12:00:00"):
    return json.dumps({"timestamp": ts, "X": x, "Y": "-2", "Z": "9.81", "id": device, "index": index})


def test_live_run_with_a_processing_time_trigger(spark, tmp_path):
    """Files that come while the query runs, taken every half second, until it is stopped."""
    write_in_order(tmp_path / "in", [[message(1, 0), message(1, 1)]])
    out = str(tmp_path / "out")
    stream = deduplicated(accepted(decode(file_messages(spark, str(tmp_path / "in"), 1))))
    run = start(stream, keyed_sink(out), str(tmp_path / "ck"), "500 milliseconds")
    try:
        run.processAllAvailable()
        first = spark.read.parquet(out).count()
        (tmp_path / "in" / "part-900.json").write_text(message(1, 2) + "\n")
        run.processAllAvailable()
    finally:
        run.stop()
    assert first == 2 and read_keyed(spark, out, ["device_id", "index"]).count() == 3


def write_in_order(path, names_and_lines):
    """Files whose modification times follow their order, as the file source reads them."""
    path.mkdir(exist_ok=True)
    for i, lines in enumerate(names_and_lines):
        f = path / f"part-{i:03d}.json"
        f.write_text("\n".join(lines) + "\n")
        os.utime(f, (1_600_000_000 + i * 10, 1_600_000_000 + i * 10))


def test_decode_accepts_and_quarantines(spark):
    lines = [message(1, 0), message(1, 1, x="oops"), "{broken", json.dumps({"id": 1})]
    d = decode(spark.createDataFrame([(x,) for x in lines], "value string"))
    ok = accepted(d).collect()
    assert len(ok) == 1 and float(ok[0]["X"]) == 1.5 and dict(d.dtypes)["X"] == "decimal(38,18)"
    assert sorted(r["raw"] for r in quarantined(d).collect()) == sorted(lines[1:])


def test_ingest_drops_duplicates_and_stores_by_key(spark, tmp_path):
    write_in_order(tmp_path / "in", [[message(1, 0), message(2, 0), message(1, 0)], [message(1, 0), message(1, 1), "junk"]])
    stream = deduplicated(accepted(decode(file_messages(spark, str(tmp_path / "in"), 1))))
    out = str(tmp_path / "out")
    start(stream, keyed_sink(out), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    assert read_keyed(spark, out, ["device_id", "index"]).count() == 3


def series(n=60, devices=3, seed=5):
    rng = np.random.default_rng(seed)
    return [(d, i, float(rng.normal())) for i in range(n) for d in range(1, devices + 1)]


SCHEMA = "device_id int, index bigint, value double"


def run_batches(spark, tmp_path, scorer, batches, tag=""):
    files = [[json.dumps(dict(zip(("device_id", "index", "value"), r))) for r in b] for b in batches]
    write_in_order(tmp_path / f"in{tag}", files)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / f"in{tag}"))
    state, out = str(tmp_path / f"state{tag}"), str(tmp_path / f"out{tag}")
    start(stream, incremental_scorer(scorer, state, out), str(tmp_path / f"ck{tag}")).awaitTermination()
    return state, out


def rounded(df):
    return sorted((r["device_id"], r["index"], round(r["loss"], 9), r["label"]) for r in df.collect())


@pytest.mark.parametrize("chunk", [8, 65536])
def test_micro_batches_equal_one_batch(spark, tmp_path, chunk):
    data = series()
    df = spark.createDataFrame(data, SCHEMA)
    scorer = Scorer(fit_scaler(df, "value", ["device_id"], 0), flat_loss(), threshold=0.6, chunk_rows=chunk)
    want = rounded(score_batch(df, scorer))
    assert len(want) == 3 * (60 - scorer.context)
    # Uneven batches, one of them shorter than the context, rows within a batch shuffled.
    cuts = [0, 30, 36, 100, 103, 180]
    rng = np.random.default_rng(0)
    batches = [[data[i] for i in rng.permutation(range(a, b))] for a, b in zip(cuts, cuts[1:])]
    state, out = run_batches(spark, tmp_path, scorer, batches)
    assert rounded(read_scored(spark, out)) == want
    assert read_late(spark, out).count() == 0
    last = max(int(p.split("=")[1]) for p in os.listdir(state) if p.startswith("batch_id"))
    assert {r["next_index"] for r in cursors(spark.read.parquet(f"{state}/batch_id={last}"), "device_id", "index").collect()} == {60}


def test_late_and_duplicate_rows(spark, tmp_path):
    data = series(30, 1)
    df = spark.createDataFrame(data, SCHEMA)
    scorer = Scorer(fit_scaler(df, "value", ["device_id"], 0), flat_loss())
    held = data[5]
    kept = [r for r in data if r != held]
    batches = [kept[:12] + kept[:3], kept[12:20] + [held] + kept[18:20], kept[20:]]
    _, out = run_batches(spark, tmp_path, scorer, batches)
    assert rounded(read_scored(spark, out)) == rounded(score_batch(spark.createDataFrame(kept, SCHEMA), scorer))
    assert [r["index"] for r in read_late(spark, out).collect()] == [held[1]]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    data = series(40, 2)
    df = spark.createDataFrame(data, SCHEMA)
    scorer = Scorer(fit_scaler(df, "value", ["device_id"], 0), flat_loss())
    state, out = str(tmp_path / "s"), str(tmp_path / "o")
    run = incremental_scorer(scorer, state, out)
    first, second = df.filter("index < 20"), df.filter("index >= 20")
    run(first, 0)
    run(second, 1)
    once = rounded(read_scored(spark, out))
    run(second, 1)
    assert rounded(read_scored(spark, out)) == once == rounded(score_batch(df, scorer))


def test_gate_and_batch_scaler(spark):
    df = spark.createDataFrame(series(50, 2), SCHEMA)
    base = Scorer(None, flat_loss(), threshold=0.4)
    labels = score_batch(df, base).groupBy("device_id").agg(F.sum("label").alias("n")).collect()
    most = max(r["n"] for r in labels)
    gated = score_batch(df, Scorer(None, flat_loss(), threshold=0.4, gate=most + 1))
    assert most > 0 and gated.agg(F.sum("label")).first()[0] == 0


def outlier_files(tmp_path, batches):
    write_in_order(
        tmp_path / "ev",
        [[json.dumps({"d": d, "ts": f"2024-01-01 00:00:{s:02d}"}) for d, s in b] for b in batches],
    )
    return str(tmp_path / "ev")


def finish(df, spark, tmp_path, name):
    q = (
        df.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return q, spark.table(name)


def test_event_time_counts_and_late_rows(spark, tmp_path):
    path = outlier_files(tmp_path, [[(1, 1)] * 6 + [(2, 1)] * 5, [(1, 30)], [(1, 31)], [(1, 1)] * 3, [(1, 50)]])
    stream = spark.readStream.schema("d int, ts timestamp").option("maxFilesPerTrigger", 1).json(path)
    q, got = finish(anomaly_counts(stream, "d", "ts", "1 second", delay="2 seconds"), spark, tmp_path, "episodes")
    # Rows are late once a batch has started with the watermark past their window.
    assert [(r["d"], r["n_outliers"]) for r in got.collect()] == [(1, 6)]
    assert late_rows(q) >= 1


def test_sliding_and_session_windows(spark, tmp_path):
    path = outlier_files(tmp_path, [[(1, s) for s in (1, 2, 3, 4, 5, 6, 20)], [(1, 55)]])
    stream = spark.readStream.schema("d int, ts timestamp").option("maxFilesPerTrigger", 1).json(path)
    _, got = finish(anomaly_counts(stream, "d", "ts", "4 seconds", "2 seconds", "1 second", 3), spark, tmp_path, "sliding")
    # Of [0,4), [2,6) and [4,8) only the second holds more than three.
    assert [r["n_outliers"] for r in got.collect()] == [4]
    _, got = finish(anomaly_sessions(stream, "d", "ts", "5 seconds", "1 second", 5), spark, tmp_path, "sessions")
    assert [r["n_outliers"] for r in got.collect()] == [6]


def test_stateful_scoring_in_index_order(spark, tmp_path):
    class MeanModel:
        def reconstruct(self, x):
            return np.repeat(x.mean(axis=1, keepdims=True), x.shape[1], axis=1)

    use_rocksdb(spark)
    data = series(50, 2)
    df = spark.createDataFrame(data, SCHEMA)
    stats = fit_scaler(df, "value", ["device_id"], 0)
    want = rounded(score_batch(df, Scorer(stats, flat_loss(), threshold=0.6)))
    z = apply_scaler(df, stats, "value", ["device_id"], "z", digits=None)
    values = {(r["device_id"], r["index"]): r["z"] for r in z.collect()}
    lines = [
        json.dumps({"device_id": d, "index": i, "z": values[d, i], "ts": f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}"})
        for d, i, _ in data
    ]
    # Neighbouring rows swapped across file borders: late, but within the delay.
    order = list(range(100))
    for border in (28, 56, 84):
        order[border - 2 : border], order[border : border + 2] = order[border : border + 2], order[border - 2 : border]
    flush = [json.dumps({"device_id": 9, "index": 0, "z": 0.0, "ts": "2024-01-01 01:00:00"})]
    write_in_order(tmp_path / "z", [[lines[i] for i in order[a : a + 28]] for a in range(0, 100, 28)] + [flush])
    stream = (
        spark.readStream.schema("device_id int, index bigint, z double, ts timestamp")
        .option("maxFilesPerTrigger", 1).json(str(tmp_path / "z"))
    )
    scored = score_ordered(stream, MeanModel(), "device_id", "index", "ts", "z", "5 seconds", threshold=0.6)
    _, got = finish(scored, spark, tmp_path, "stateful")
    assert rounded(got) == want


class FakeState:
    """The state of one device in memory, counting what is written."""

    def __init__(self):
        self.map, self.value, self.timers, self.writes = {}, None, set(), []

    def getValueState(self, name, schema):
        return self

    def getMapState(self, name, key, value):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def keys(self):
        return iter(list(self.map))

    def getValue(self, key):
        return self.map[key]

    def updateValue(self, key, value):
        self.writes.append(key[0])
        self.map[key] = value

    def removeKey(self, key):
        del self.map[key]

    def registerTimer(self, at):
        assert at not in self.timers
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


@pytest.mark.parametrize("bucket", [1, 7, 1000])
def test_only_changed_buckets_are_written(bucket):
    class Mean:
        def reconstruct(self, x):
            return np.repeat(x.mean(axis=1, keepdims=True), x.shape[1], axis=1)

    class Clock:
        mark = 0

        def getCurrentWatermarkInMs(self):
            return self.mark

    import pandas as pd

    rng = np.random.default_rng(bucket)
    values = rng.normal(size=400)
    state, clock = FakeState(), Clock()
    scorer = OrderedScorer(Mean(), "d", 0.5, 3, 5, bucket)
    scorer.init(state)
    got = []
    for start in range(0, 400, 40):
        rows = np.arange(start, start + 40)
        rng.shuffle(rows)
        before, state.writes = dict(state.map), []
        got += list(scorer.handleInputRows(("x",), iter([pd.DataFrame({"idx": rows, "at": rows * 3, "val": values[rows]})]), clock))
        brought = {r * 3 // bucket for r in rows}
        border = {clock.mark // bucket}
        assert set(state.writes) <= brought | border
        assert all(state.map[k] is v for k, v in before.items() if k in state.map and k[0] not in brought | border)
        assert state.timers == {v[0] + 1 for v in state.map.values()}  # one timer per bucket
        clock.mark = start * 3
        for timer in sorted(t for t in state.timers if t <= clock.mark):
            got += list(scorer.handleExpiredTimer(("x",), clock, timer))
    clock.mark = 10_000
    got += list(scorer.handleExpiredTimer(("x",), clock, 0))
    assert not state.map and not state.timers
    out = pd.concat(got)
    mean = np.convolve(values, np.ones(3) / 3, "valid")
    windows = np.lib.stride_tricks.sliding_window_view(mean, 5)[:-1]
    assert out["index"].tolist() == list(range(7, 400))
    assert np.allclose(out["loss"], np.abs(windows - windows.mean(axis=1, keepdims=True)).mean(axis=1))


class Times:
    """Watermark and state of one device as Spark runs them: a timer is a set member and goes once it has fired."""

    def __init__(self, scorer):
        self.mark, self.calls, self.state, self.scorer, self.out = 0, 0, self, scorer, []
        self.map, self.value, self.timers = {}, None, set()
        scorer.init(self)

    def getCurrentWatermarkInMs(self):
        return self.mark

    def getValueState(self, name, schema):
        return self

    def getMapState(self, name, key, value):
        return self

    def counted(name):  # noqa: N805
        def call(self, *a):
            self.calls += 1
            return {
                "exists": lambda: self.value is not None, "get": lambda: self.value, "keys": lambda: iter(list(self.map)),
                "update": lambda v: setattr(self, "value", v), "getValue": lambda k: self.map[k],
                "updateValue": lambda k, v: self.map.update({k: v}), "removeKey": lambda k: self.map.pop(k),
                "registerTimer": lambda t: self.timers.add(t), "deleteTimer": lambda t: self.timers.discard(t),
            }[name](*a)

        return call

    exists, get, keys, update, getValue = map(counted, ("exists", "get", "keys", "update", "getValue"))
    updateValue, removeKey, registerTimer, deleteTimer = map(counted, ("updateValue", "removeKey", "registerTimer", "deleteTimer"))

    def batch(self, idx, at, val):
        import pandas as pd

        self.out += list(self.scorer.handleInputRows(("x",), iter([pd.DataFrame({"idx": idx, "at": at, "val": val})]), self))

    def advance(self, mark):
        self.mark = mark
        for timer in sorted(t for t in self.timers if t < mark):
            self.out += list(self.scorer.handleExpiredTimer(("x",), self, None))
            self.timers.discard(timer)


class Mean5:
    def reconstruct(self, x):
        return np.repeat(x.mean(axis=1, keepdims=True), x.shape[1], axis=1)


def test_sparse_readings_cost_few_state_calls():
    """Thirty buckets of two readings: not some calls per bucket, and no frame without rows."""
    day = 86_400_000
    at = day + np.arange(60) * day // 2
    times = Times(OrderedScorer(Mean5(), "d", 0.5, 3, 5, day))
    times.batch(np.arange(60), at, np.random.default_rng(3).normal(size=60))
    assert times.calls <= 6 and not times.out
    assert len(times.map) == 1 and times.timers == {day + 1}
    times.advance(32 * day)
    assert times.calls <= 14 and [len(p) for p in times.out] == [53]
    assert not times.map and not times.timers


@pytest.mark.parametrize("most", [1, 5, 1024])
@pytest.mark.parametrize("bucket", [1, 7, 50, 100_000])
def test_runs_release_all_that_is_due(monkeypatch, bucket, most):
    """Readings out of order and with equal times, runs cut by the watermark: each is released once it is due."""
    import pandas as pd

    from tremorlake.streaming import stateful

    monkeypatch.setattr(stateful, "RUN_READINGS", most, raising=False)
    rng = np.random.default_rng(bucket + most)
    n, values = 300, rng.normal(size=300)
    at = np.arange(n) // 2 * 3
    come = np.argsort(np.arange(n) + rng.uniform(0, 24, n))
    times, seen = Times(OrderedScorer(Mean5(), "d", 0.5, 3, 5, bucket)), 0
    for rows in np.split(come, sorted(rng.choice(np.arange(1, n), 25, replace=False))):
        times.batch(rows, at[rows], values[rows])
        seen = max(seen, at[rows].max())
        times.advance(seen - 40)
        assert all(v[0] + 1 in times.timers and v[0] == min(v[2]) for v in times.map.values())
        assert all(v[0] + 1 >= times.mark for v in times.map.values())
    assert times.out
    times.advance(10_000)
    assert not times.map and not times.timers
    out = pd.concat(times.out)
    windows = np.lib.stride_tricks.sliding_window_view(np.convolve(values, np.ones(3) / 3, "valid"), 5)[:-1]
    assert out["index"].tolist() == list(range(7, n))
    assert np.allclose(out["loss"], np.abs(windows - windows.mean(axis=1, keepdims=True)).mean(axis=1))
