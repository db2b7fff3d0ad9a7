"""Per-device scoring with keyed state and event-time ordering.

The low-latency form of ``streaming.scoring``: the context of a device lives in the state store
instead of a table. Readings wait until the watermark passes them and are then scored in index
order; a reading that comes later still is dropped by the watermark. All readings of a device in a
micro-batch meet in one task, so limit the batch at the source (``maxOffsetsPerTrigger``,
``maxFilesPerTrigger``); for devices too hot for that use ``incremental_scorer``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.reconstruct import THRESHOLDS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that this operator needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


#: A run of readings that lie in the state together takes further buckets up to this many readings.
RUN_READINGS = 1024

_FIELDS = ("idx", "at", "val")
_KINDS = (np.int64, np.int64, np.float64)


class OrderedScorer(StatefulProcessor):
    """Waiting readings lie in a map of runs, each under the time bucket of its earliest reading, with a timer for it.

    A run holds the readings of a batch from whole buckets, of as many as it takes for ``RUN_READINGS``: a sparse
    device costs a few calls to the state store per batch, not some per bucket. A bucket that is a run's key
    already is added to that run, and nothing else is.

    A batch rewrites the runs whose buckets it brings readings for, and a release takes those that the watermark has
    reached; no other run is written, however many wait. What a release leaves of a run stays under its key.
    """

    def __init__(self, model, device: str, threshold: float, smooth: int, steps: int, bucket_ms: int):
        self.model, self.device, self.threshold = model, device, threshold
        self.smooth, self.steps, self.bucket_ms = smooth, steps, bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tail = handle.getValueState("tail", "last bigint, vals array<double>")
        self.waiting = handle.getMapState(
            "waiting", "bucket bigint", "first bigint, idx array<bigint>, at array<bigint>, val array<double>"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        come = self._come(rows)
        known = {k[0] for k in self.waiting.keys()}
        for bucket, run in self._runs(come, known):
            self._put(bucket, self.waiting.getValue((bucket,)) if bucket in known else None, run)
            known.add(bucket)
        yield from self._release(key, timerValues, known)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._release(key, timerValues, {k[0] for k in self.waiting.keys()})

    @staticmethod
    def _come(rows: Iterator[pd.DataFrame]) -> list[np.ndarray]:
        """The columns of the readings that have a time, in its order."""
        parts = [[p[c].to_numpy() for c in _FIELDS] for p in rows]
        idx, at, val = (np.concatenate(c) for c in zip(*parts))
        timed = ~pd.isna(at)
        if pd.isna(idx[timed]).any():
            raise ValueError("a reading has no index")
        columns = [c[timed].astype(kind) for c, kind in zip((idx, at, val), _KINDS)]
        order = np.argsort(columns[1], kind="stable")
        return [c[order] for c in columns]

    def _runs(self, come: list[np.ndarray], known: set[int]) -> list[tuple[int, list[np.ndarray]]]:
        """Readings in the order of time, cut at buckets, by the first bucket of each run."""
        keys, cuts = [], []
        for bucket, at in zip(*(x.tolist() for x in np.unique(come[1] // self.bucket_ms, return_index=True))):
            if not keys or bucket in known or keys[-1] in known or at - cuts[-1] >= RUN_READINGS:
                keys.append(bucket)
                cuts.append(at)
        return [(k, [c[a:b] for c in come]) for k, a, b in zip(keys, cuts, [*cuts[1:], len(come[1])])]

    def _put(self, bucket: int, held, run: list[np.ndarray]) -> None:
        """Add readings to what a bucket holds; its timer is that of its first reading.

        A later timer stays when an earlier reading comes, since what is left of another run may wait for it too.
        """
        if held:
            run = [np.concatenate((np.asarray(h, kind), c)) for h, c, kind in zip(held[1:], run, _KINDS)]
        first = int(run[1].min())
        if not held or first != held[0]:
            self.handle.registerTimer(first + 1)
        self.waiting.updateValue((bucket,), (first, *(c.tolist() for c in run)))

    def _release(self, key, timerValues, known: set[int]) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        ready = []
        for bucket in sorted(b for b in known if b * self.bucket_ms <= mark):
            held = self.waiting.getValue((bucket,))
            if held[0] > mark:
                continue
            run = [np.asarray(h, kind) for h, kind in zip(held[1:], _KINDS)]
            due = run[1] <= mark
            ready.append([c[due] for c in run])
            self.handle.deleteTimer(held[0] + 1)
            if due.all():
                self.waiting.removeKey((bucket,))
            else:  # only a run that the watermark lies in
                self._put(bucket, None, [c[~due] for c in run])
        if ready:
            idx, at, val = (np.concatenate(c) for c in zip(*ready))
            order = np.lexsort((val, at, idx))
            yield from self._score(key, idx[order], val[order])

    def _score(self, key, idx: np.ndarray, val: np.ndarray) -> Iterator[pd.DataFrame]:
        """Losses of the readings that continue the series, of the first one for each index."""
        context = self.smooth - 1 + self.steps
        last, tail = self.tail.get() if self.tail.exists() else (-1, [])
        new = (idx > last) & np.append(True, idx[1:] != idx[:-1])
        ids, x = idx[new], np.concatenate((np.asarray(tail, float), val[new]))
        if not len(ids):
            return
        self.tail.update((int(ids[-1]), x[-context:].tolist()))
        if len(x) <= context:
            return
        mean = np.lib.stride_tricks.sliding_window_view(x, self.smooth).mean(axis=1)
        windows = np.lib.stride_tricks.sliding_window_view(mean, self.steps)[:-1]
        loss = np.abs(self.model.reconstruct(windows) - windows).mean(axis=1)[-len(ids) :]
        yield pd.DataFrame({
            self.device: [key[0]] * len(loss),
            "index": ids[-len(loss) :],
            "loss": loss,
            "label": (loss > self.threshold).astype("int32"),
        })

    def close(self) -> None:
        pass


def score_ordered(
    stream: DataFrame,
    model,
    device: str,
    index: str,
    ts: str,
    value: str,
    delay: str = "10 minutes",
    threshold: float = THRESHOLDS["deployed_window"],
    smooth: int = 3,
    steps: int = 5,
    bucket_seconds: float = 30.0,
) -> DataFrame:
    """Losses and labels of a stream of standardised readings, in index order per device.

    ``model`` has ``reconstruct(matrix) -> matrix`` over windows of ``steps`` values. Readings wait in buckets of
    ``bucket_seconds``; about as long as what a batch brings per device is a good size, and buckets that are too
    short for the readings of a batch are joined to runs. It changes no result.
    """
    kind = stream.schema[device].dataType.simpleString()
    rows = stream.withWatermark(ts, delay).selectExpr(
        f"`{device}`", f"`{ts}`", f"`{index}` as idx", f"unix_millis(`{ts}`) as at", f"`{value}` as val"
    )
    return rows.groupBy(device).transformWithStateInPandas(
        statefulProcessor=OrderedScorer(model, device, threshold, smooth, steps, int(bucket_seconds * 1000)),
        outputStructType=f"`{device}` {kind}, index bigint, loss double, label int",
        outputMode="Append",
        timeMode="EventTime",
    )
