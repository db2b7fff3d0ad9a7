"""Dense and LSTM autoencoders, trained data-parallel.

A step is one Spark job: every partition computes the gradient of its own rows with numpy,
the gradients are summed on the executors, and the driver, which only ever holds arrays of
the model's size, makes one Adam step. A step therefore uses all training rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import write_scratch

_FAN_IN = 64


def _glorot(rng: np.random.Generator, rows: int, cols: int) -> np.ndarray:
    limit = np.sqrt(6.0 / (rows + cols))
    return rng.uniform(-limit, limit, (rows, cols))


@dataclass
class DenseAutoencoder:
    """ReLU layers with a linear output, mean absolute error, L2 on the hidden kernels."""

    sizes: tuple[int, ...] = (1, 10, 5, 5, 10, 1)
    l2: float = 0.01
    params: list[np.ndarray] = field(default_factory=list)

    def initialise(self, rng: np.random.Generator) -> None:
        self.params = []
        for a, b in zip(self.sizes, self.sizes[1:]):
            self.params += [_glorot(rng, a, b), np.zeros(b)]

    def _layers(self, x: np.ndarray) -> list[np.ndarray]:
        out = [x]
        last = len(self.sizes) - 2
        for i in range(last + 1):
            z = out[-1] @ self.params[2 * i] + self.params[2 * i + 1]
            out.append(z if i == last else np.maximum(z, 0.0))
        return out

    def reconstruct(self, x: np.ndarray) -> np.ndarray:
        return self._layers(x)[-1]

    def gradient(self, x: np.ndarray, rng: np.random.Generator) -> tuple[float, list[np.ndarray]]:
        """Summed loss over the rows and its gradient, without the L2 term."""
        acts = self._layers(x)
        gap = acts[-1] - x
        delta = np.sign(gap) / x.shape[1]
        grads: list[np.ndarray] = [np.zeros(0)] * len(self.params)
        for i in reversed(range(len(self.sizes) - 1)):
            grads[2 * i] = acts[i].T @ delta
            grads[2 * i + 1] = delta.sum(axis=0)
            if i:
                delta = (delta @ self.params[2 * i].T) * (acts[i] > 0)
        return float(np.abs(gap).mean(axis=1).sum()), grads

    def penalty_gradient(self) -> list[np.ndarray]:
        last = len(self.params) - 2
        return [
            2.0 * self.l2 * p if i % 2 == 0 and i < last else np.zeros_like(p)
            for i, p in enumerate(self.params)
        ]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60.0, 60.0)))


def _lstm_forward(x, w, u, b):
    n, steps, _ = x.shape
    units = u.shape[0]
    h, c = np.zeros((n, units)), np.zeros((n, units))
    trace, hidden = [], np.empty((n, steps, units))
    for t in range(steps):
        z = x[:, t] @ w + h @ u + b
        i, f = _sigmoid(z[:, :units]), _sigmoid(z[:, units : 2 * units])
        g, o = np.tanh(z[:, 2 * units : 3 * units]), _sigmoid(z[:, 3 * units :])
        c_new = f * c + i * g
        tc = np.tanh(c_new)
        trace.append((h, c, i, f, g, o, tc))
        h, c = o * tc, c_new
        hidden[:, t] = h
    return hidden, trace


def _lstm_backward(x, w, u, trace, d_hidden):
    dw, du, db = np.zeros_like(w), np.zeros_like(u), np.zeros(w.shape[1])
    dx = np.empty_like(x)
    dh_next = np.zeros((x.shape[0], u.shape[0]))
    dc_next = np.zeros_like(dh_next)
    for t in reversed(range(x.shape[1])):
        h, c, i, f, g, o, tc = trace[t]
        dh = d_hidden[:, t] + dh_next
        dc = dc_next + dh * o * (1.0 - tc**2)
        dz = np.concatenate(
            [dc * g * i * (1 - i), dc * c * f * (1 - f), dc * i * (1 - g**2), dh * tc * o * (1 - o)], axis=1
        )
        dw += x[:, t].T @ dz
        du += h.T @ dz
        db += dz.sum(axis=0)
        dx[:, t] = dz @ w.T
        dh_next = dz @ u.T
        dc_next = dc * f
    return dx, dw, du, db


@dataclass
class LstmAutoencoder:
    """LSTM encoder, repeated code, LSTM decoder, one dense output per step; mean absolute error."""

    units: int = 64
    dropout: float = 0.2
    params: list[np.ndarray] = field(default_factory=list)

    def initialise(self, rng: np.random.Generator) -> None:
        u = self.units
        self.params = []
        for inputs in (1, u):
            bias = np.zeros(4 * u)
            bias[u : 2 * u] = 1.0
            recurrent = np.concatenate(
                [np.linalg.qr(rng.normal(size=(u, u)))[0] for _ in range(4)], axis=1
            )
            self.params += [_glorot(rng, inputs, 4 * u), recurrent, bias]
        self.params += [_glorot(rng, u, 1), np.zeros(1)]

    def _mask(self, rng, shape):
        if rng is None or self.dropout == 0.0:
            return 1.0
        return (rng.random(shape) >= self.dropout) / (1.0 - self.dropout)

    def _forward(self, x, rng):
        w1, u1, b1, w2, u2, b2, w3, b3 = self.params
        seq = x[:, :, None]
        h1, trace1 = _lstm_forward(seq, w1, u1, b1)
        mask1 = self._mask(rng, h1[:, -1].shape)
        code = np.repeat((h1[:, -1] * mask1)[:, None, :], x.shape[1], axis=1)
        h2, trace2 = _lstm_forward(code, w2, u2, b2)
        mask2 = self._mask(rng, h2.shape)
        top = h2 * mask2
        return (top @ w3 + b3)[:, :, 0], (seq, h1, trace1, mask1, code, trace2, mask2, top)

    def reconstruct(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x, None)[0]

    def gradient(self, x: np.ndarray, rng: np.random.Generator) -> tuple[float, list[np.ndarray]]:
        w1, u1, _, w2, u2, _, w3, _ = self.params
        y, (seq, h1, trace1, mask1, code, trace2, mask2, top) = self._forward(x, rng)
        gap = y - x
        dy = (np.sign(gap) / x.shape[1])[:, :, None]
        dw3 = np.einsum("ntu,ntk->uk", top, dy)
        db3 = dy.sum(axis=(0, 1))
        dcode, dw2, du2, db2 = _lstm_backward(code, w2, u2, trace2, (dy @ w3.T) * mask2)
        dh1 = np.zeros_like(h1)
        dh1[:, -1] = dcode.sum(axis=1) * mask1
        _, dw1, du1, db1 = _lstm_backward(seq, w1, u1, trace1, dh1)
        return float(np.abs(gap).mean(axis=1).sum()), [dw1, du1, db1, dw2, du2, db2, dw3, db3]

    def penalty_gradient(self) -> list[np.ndarray]:
        return [np.zeros_like(p) for p in self.params]


def _flat(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([a.ravel() for a in arrays])


def _shaped(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    out, at = [], 0
    for a in like:
        out.append(flat[at : at + a.size].reshape(a.shape))
        at += a.size
    return out


_PART = "n bigint, loss double, n_val bigint, loss_val double, grad array<double>"


def _gradients(rows: DataFrame, model, step: int, seed: int, batch: int) -> DataFrame:
    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng([seed, step, TaskContext.get().partitionId()])
        n = n_val = 0
        loss = loss_val = 0.0
        total = None
        for pdf in parts:
            held = pdf["held"].to_numpy()
            x = np.stack(pdf["x"].to_numpy()).astype(float)
            val = x[held]
            if len(val):
                n_val += len(val)
                loss_val += float(np.abs(model.reconstruct(val) - val).mean(axis=1).sum())
            x = x[~held]
            for at in range(0, len(x), batch):
                piece = x[at : at + batch]
                piece_loss, grads = model.gradient(piece, rng)
                flat = _flat(grads)
                total = flat if total is None else total + flat
                loss += piece_loss
                n += len(piece)
        grad = [] if total is None else total
        yield pd.DataFrame({"n": [n], "loss": [loss], "n_val": [n_val], "loss_val": [loss_val], "grad": [grad]})

    return rows.mapInPandas(work, _PART)


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    grads = [np.asarray(g) for g in pdf["grad"] if len(g)]
    total = np.sum(grads, axis=0) if grads else []
    out = {c: [pdf[c].sum()] for c in ("n", "loss", "n_val", "loss_val")}
    return pd.DataFrame({**out, "grad": [total]})


@dataclass
class Trained:
    model: object
    history: list[tuple[float, float]]


def train(
    df: DataFrame,
    column: str,
    model: DenseAutoencoder | LstmAutoencoder,
    steps: int = 50,
    rate: float = 0.01,
    seed: int = 1,
    validation: int = 10,
    batch: int = 4096,
) -> Trained:
    """Train ``model`` to reconstruct the arrays in ``column``.

    Every ``validation``-th row (by hash) is held out. ``history`` has the (training, validation)
    loss before each step.
    """
    spark = df.sparkSession
    held = F.pmod(F.xxhash64("x"), F.lit(validation)) == 0
    rows = df.select(F.transform(column, lambda v: v.cast("double")).alias("x")).filter("x is not null")
    # Spread evenly once; every step then reads its own part files without a shuffle.
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(parts)
    rows = write_scratch(rows.withColumn("held", held), "training")
    model.initialise(np.random.default_rng(seed))
    tree_sum = rows.rdd.getNumPartitions() > _FAN_IN
    m = [np.zeros_like(p) for p in model.params]
    v = [np.zeros_like(p) for p in model.params]
    history = []
    for step in range(1, steps + 1):
        grads_by_part = _gradients(rows, model, step, seed, batch)
        if tree_sum:
            grads_by_part = grads_by_part.withColumn("_g", F.pmod(F.spark_partition_id(), F.lit(_FAN_IN)))
            grads_by_part = grads_by_part.groupBy("_g").applyInPandas(lambda pdf: _added(pdf), _PART)
        got = _added(grads_by_part.toPandas())
        n = max(int(got["n"].iloc[0]), 1)
        n_val = max(int(got["n_val"].iloc[0]), 1)
        history.append((float(got["loss"].iloc[0]) / n, float(got["loss_val"].iloc[0]) / n_val))
        flat = np.asarray(got["grad"].iloc[0])
        if flat.size == 0:
            break
        grads = [g / n + p for g, p in zip(_shaped(flat, model.params), model.penalty_gradient())]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g**2
            m_hat, v_hat = m[i] / (1 - 0.9**step), v[i] / (1 - 0.999**step)
            model.params[i] = model.params[i] - rate * m_hat / (np.sqrt(v_hat) + 1e-7)
    return Trained(model, history)
