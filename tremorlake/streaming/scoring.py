"""Scoring of new readings with carried context, in batch and in micro-batches.

A reading is scored from the smoothed values before it: with a mean over ``smooth`` rows and
windows of ``steps`` values, a reading needs the ``smooth - 1 + steps`` raw readings before it.
Exactly these are carried per device, so batch borders change nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import latest_version
from ..operators.normalize import apply_scaler, fit_scaler
from ..operators.reconstruct import THRESHOLDS
from ..operators.smooth import smoothed_windows
from ..operators.stats import count_gate
from ..plans import attach, scratch_scope, top_k, with_position, write_scratch
from ..plans.frames import CHUNK_ROWS, chunk_of
from ..plans.scratch import delete_path, path_exists


def flat_loss(window: str = "window", out: str = "loss") -> Callable[[DataFrame], DataFrame]:
    """Reconstruction of a window by its own mean: the simplest loss, native to Spark."""

    def add(df: DataFrame) -> DataFrame:
        mean = F.aggregate(window, F.lit(0.0), lambda s, x: s + x) / F.size(window)
        gap = F.aggregate(
            F.transform(window, lambda x: F.abs(x - F.col("_mean"))), F.lit(0.0), lambda s, x: s + x
        )
        return df.withColumn("_mean", mean).withColumn(out, gap / F.size(window)).drop("_mean")

    return add


@dataclass(frozen=True)
class Scorer:
    """What turns positioned readings into scored readings.

    ``scaler`` is a fitted statistics table (``fit_scaler``), or None to fit on the rows of the
    batch at hand, in which case labels depend on the batch borders. ``gate`` sets all labels of a
    (device, batch) to 0 below that many anomalies; 0 switches it off.
    """

    scaler: DataFrame | None
    loss: Callable[[DataFrame], DataFrame]
    threshold: float = THRESHOLDS["deployed_window"]
    smooth: int = 3
    steps: int = 5
    gate: int = 0
    device: str = "device_id"
    index: str = "index"
    value: str = "value"
    by_device: bool = True
    chunk_rows: int = CHUNK_ROWS

    @property
    def context(self) -> int:
        return self.smooth - 1 + self.steps

    def score(self, rows: DataFrame, pos: str = "pos") -> DataFrame:
        """Scored readings, for every row with a full context in ``rows``."""
        keys = [self.device]
        by = keys if self.by_device else []
        stats = self.scaler if self.scaler is not None else fit_scaler(rows, self.value, by, ddof=0)
        z = apply_scaler(rows, stats, self.value, by, "zscale", digits=None)
        w = smoothed_windows(z, "zscale", keys, self.smooth, self.steps, pos, chunk_rows=self.chunk_rows)
        return self.loss(w).withColumn("label", (F.col("loss") > self.threshold).cast("int")).drop("window")

    def gated(self, scored: DataFrame, by: Sequence[str]) -> DataFrame:
        return count_gate(scored, "label", by, self.gate) if self.gate else scored


def score_batch(df: DataFrame, scorer: Scorer, order: Sequence[str] | None = None, block=None) -> DataFrame:
    """Score whole series at once."""
    rows = with_position(df, [scorer.device], order or [scorer.index], "pos", block)
    return scorer.gated(scorer.score(rows), [scorer.device]).drop("pos")


def incremental_scorer(
    scorer: Scorer, state_path: str, output_path: str, index_block: int = 1 << 20
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: score the new readings of all devices and carry their context.

    State and output are written per batch, output first. Batch N reads the state that batch N-1
    wrote, so a batch that is run again after a crash writes the same folders again. Readings at
    or below the highest index seen of their device are late: they go to ``late`` under the output
    path instead of being scored out of turn. A device's readings within a batch may be in any
    order. The batch is scored with the windows of ``score_batch``, so one hot device is split
    over many tasks.
    """
    out, late_out = f"{output_path}/scored", f"{output_path}/late"
    device, index = scorer.device, scorer.index

    # Stored once here rather than in every batch.
    if scorer.scaler is not None:
        scorer = replace(scorer, scaler=write_scratch(scorer.scaler, "scaler"))

    def process(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            score(batch, batch_id)

    def score(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = f"{state_path}/batch_id={batch_id - 1}"
        rest = [c for c in batch.columns if c not in (device, index)]
        fresh = latest_version(batch, [device, index], rest)
        if path_exists(spark, before):
            tail = spark.read.schema(_fields_with_position(batch)).parquet(before)
        elif batch_id == 0:
            tail = spark.createDataFrame([], _fields_with_position(batch))
        else:
            raise RuntimeError(f"the state of batch {batch_id - 1} is missing under {state_path}")
        marks = tail.groupBy(device).agg(
            F.max(index).alias("_last"), (F.max("pos") + 1).alias("_next"), F.count(F.lit(1)).alias("_n")
        )
        seen = write_scratch(attach(fresh, marks, [device], rows="_n").drop("_n"), "batch")
        late = seen.filter(F.col(index) <= F.col("_last"))
        new = seen.filter(F.col("_last").isNull() | (F.col(index) > F.col("_last")))
        new = with_position(new, [device], [index], "pos", chunk_of(index, index_block))
        new = new.withColumn("pos", F.col("pos") + F.coalesce("_next", F.lit(0))).drop("_last", "_next")
        both = tail.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
        both = write_scratch(both, "context")
        scored = scorer.gated(scorer.score(both).filter("_new").drop("_new"), [device])
        scored.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        late.drop("_last", "_next").write.mode("overwrite").parquet(f"{late_out}/batch_id={batch_id}")
        kept = top_k(both.drop("_new"), scorer.context, [F.desc("pos")], [device])
        kept.write.mode("overwrite").parquet(f"{state_path}/batch_id={batch_id}")
        delete_path(spark, f"{state_path}/batch_id={batch_id - 2}")

    return process


def _fields_with_position(batch: DataFrame) -> str:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields]
    return ", ".join([*fields, "pos bigint"])


def read_scored(spark: SparkSession, output_path: str) -> DataFrame:
    return spark.read.parquet(f"{output_path}/scored").drop("pos")


def read_late(spark: SparkSession, output_path: str) -> DataFrame:
    return spark.read.parquet(f"{output_path}/late")


def cursors(state: DataFrame, device: str, index: str) -> DataFrame:
    """Next index to read per device, from the carried context."""
    return state.groupBy(device).agg((F.max(index) + 1).alias("next_index"))
