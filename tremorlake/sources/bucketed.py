"""A keyed table in buckets: updates merge bucket by bucket, and the base is never shuffled.

The folder holds a *base* with one row per key and *deltas*, one per batch, all dealt by a hash of the key into the
same number of bucketed files. A batch costs what it brings: its newest rows are dealt out and written as a delta. Reading
joins base and deltas where they lie. ``compact`` writes the current state as the next base, again in place.

Every folder is named by its batch and counts only once it is complete, so a batch that failed or is replayed
replaces its own folder and nothing else. One writer at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyed import latest_version, merge_newer
from ..plans.scratch import delete_path, list_folders, path_exists

_BASE, _DELTA = "base", "delta"


@dataclass(frozen=True)
class BucketedTable:
    """``version`` is a number or time, never NULL; at equal versions the later batch counts."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    version: str
    buckets: int = 64

    def _folder(self, kind: str, batch: int) -> str:
        return f"{self.path.rstrip('/')}/{kind}-{batch:012d}"

    def _table(self, folder: str) -> str:
        """Name of the folder in the session's catalogue; the files themselves carry their bucket."""
        return f"tremorlake_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"

    def _batches(self, kind: str) -> list[int]:
        names = [n for n in list_folders(self.spark, self.path) if n.startswith(f"{kind}-")]
        whole = [n for n in names if path_exists(self.spark, f"{self.path.rstrip('/')}/{n}/_SUCCESS")]
        return sorted(int(n.split("-")[1]) for n in whole)

    def _write(self, rows: DataFrame, kind: str, batch: int) -> None:
        folder = self._folder(kind, batch)
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(folder)}")
        delete_path(self.spark, folder)
        writer = rows.select(*self.schema.names).write.format("parquet").bucketBy(self.buckets, *self.keys)
        writer.option("path", folder).saveAsTable(self._table(folder))

    def _read(self, kind: str, batch: int) -> DataFrame:
        folder = self._folder(kind, batch)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        by = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._table(folder)} ({columns}) USING parquet "
            f"CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{folder}'"
        )
        self.spark.catalog.refreshTable(self._table(folder))
        return self.spark.table(self._table(folder))

    def append(self, updates: DataFrame, batch: int) -> None:
        """Store the newest row per key of a batch; a replay of the batch replaces it.

        A batch that is part of the base already changes nothing.
        """
        if batch <= max(self._batches(_BASE), default=-1):
            return
        missing = F.raise_error(F.lit("the key and the version of a keyed table are never NULL"))
        rows = updates.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        for c in [*self.keys, self.version]:
            rows = rows.withColumn(c, F.coalesce(c, missing.cast(self.schema[c].dataType)))
        newest = latest_version(rows, self.keys, [self.version])
        self._write(newest.repartition(self.buckets, *self.keys), _DELTA, batch)

    def read(self) -> DataFrame:
        """The current state: one row per key.

        Several deltas are merged among themselves first, so the base takes part in one join and stays where it is.
        """
        base = max(self._batches(_BASE), default=None)
        state = None
        for batch in self._batches(_DELTA):
            if base is None or batch > base:
                delta = self._read(_DELTA, batch)
                state = delta if state is None else merge_newer(state, delta, self.keys, self.version)
        if base is None:
            return self.spark.createDataFrame([], self.schema) if state is None else state
        whole = self._read(_BASE, base)
        return whole if state is None else merge_newer(whole, state, self.keys, self.version)

    def compact(self) -> None:
        """Make the current state the base, and remove what it replaces."""
        deltas, bases = self._batches(_DELTA), self._batches(_BASE)
        if not deltas or deltas[-1] <= max(bases, default=-1):
            return
        self._write(self.read(), _BASE, deltas[-1])
        for kind, batches in ((_DELTA, deltas), (_BASE, bases)):
            for batch in batches:
                folder = self._folder(kind, batch)
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(folder)}")
                delete_path(self.spark, folder)
