"""A small network for tables of features: three hidden layers, trained by gradients that tasks sum over their rows.

Each step is one pass over a batch: tasks work out the gradient of their rows, Spark adds the tasks' sums, and the driver, which holds
some thousand weights whatever the number of rows, takes a step of Adam. Sums are whole numbers (gradients in units of 2^-30), so
they don't depend on the order in which tasks end, and one seed gives one network.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stats import percentile_row
from ..session import written

#: Sizes of the hidden layers, what follows each, and the settings of training.
HIDDEN = (16, 16, 16)
KINDS = ("relu", "tanh", "relu")
DROPOUT, RATE, DECAY, EPOCHS = 0.3, 1e-3, 1e-5, 250
_UNIT = float(1 << 30)


def _shapes(width: int) -> list[tuple[int, ...]]:
    sizes = (width, *HIDDEN, 1)
    return [s for a, b in zip(sizes, sizes[1:], strict=False) for s in ((a, b), (b,))]


def _split(flat: np.ndarray, width: int) -> list[np.ndarray]:
    out, at = [], 0
    for s in _shapes(width):
        n = int(np.prod(s))
        out.append(flat[at : at + n].reshape(s))
        at += n
    return out


def started(width: int, seed: int) -> np.ndarray:
    """Weights drawn evenly within one over the root of a layer's inputs."""
    r = np.random.default_rng(seed)
    sizes = (width, *HIDDEN, 1)
    return np.concatenate([r.uniform(-1, 1, int(np.prod(s))) / np.sqrt(sizes[i // 2]) for i, s in enumerate(_shapes(width))])


def forward(x: np.ndarray, parts: list[np.ndarray], masks: list[np.ndarray] | None = None) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Probabilities, and each hidden layer's input and derivative for the way back."""
    kept = []
    for i, kind in enumerate(KINDS):
        z = x @ parts[2 * i] + parts[2 * i + 1]
        a, slope = (np.maximum(z, 0), (z > 0).astype(float)) if kind == "relu" else (np.tanh(z), 1 - np.tanh(z) ** 2)
        if masks is not None:
            a, slope = a * masks[i], slope * masks[i]
        kept.append((x, slope))
        x = a
    kept.append((x, np.ones((len(x), 1))))
    return 1 / (1 + np.exp(-(x @ parts[-2] + parts[-1])[:, 0])), kept


def gradient(x: np.ndarray, y: np.ndarray, w: np.ndarray, flat: np.ndarray, masks: list[np.ndarray] | None) -> tuple[np.ndarray, float]:
    """The sum over rows of the weighted log loss's gradient, and of the loss."""
    parts = _split(flat, x.shape[1])
    p, kept = forward(x, parts, masks)
    back, out = ((p - y) * w)[:, None], []
    for i in range(len(kept) - 1, -1, -1):
        given, slope = kept[i]
        back = back * slope if i < len(kept) - 1 else back
        out = [(given.T @ back).ravel(), back.sum(axis=0), *out]
        if i:
            back = back @ parts[2 * i].T
    q = np.clip(p, 1e-12, 1 - 1e-12)
    return np.concatenate(out), float(-(w * (y * np.log(q) + (1 - y) * np.log(1 - q))).sum())


def _sums(flat: np.ndarray, width: int, dropout: float, seed: int, step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = np.random.default_rng([seed, step, TaskContext.get().partitionId()])
        total, loss, n = np.zeros(len(flat)), 0.0, 0
        for batch in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[: width + 1]]) if batch.num_rows else np.zeros((0, width + 1))
            masks = [(r.random((len(rows), h)) >= dropout) / (1 - dropout) for h in HIDDEN] if dropout else None
            g, part = gradient(rows[:, :width], rows[:, width], np.ones(len(rows)), flat, masks)
            total, loss, n = total + g, loss + part, n + len(rows)
        if n:
            values = np.rint(np.concatenate([total, [loss, n]]) * _UNIT).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["place", "value"])

    return run


@dataclass(frozen=True)
class Network:
    features: tuple[str, ...]
    fill: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]

    def predict(self, rows: DataFrame, threshold: float = 0.5) -> DataFrame:
        """rows with score and prediction; a missing feature as the median of the training rows."""
        if lost := [f for f in self.features if f not in rows.columns]:
            raise ValueError(f"missing features: {', '.join(lost)}")
        parts = _split(np.array(self.weights), len(self.features))

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            return pd.Series(forward(np.column_stack([c.to_numpy() for c in columns]), parts)[0])

        out = rows.withColumn("score", score(*_inputs(self.features, self.fill, self.scale)))
        return out.withColumn("prediction", (F.col("score") >= threshold).cast("int"))

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "fill": self.fill, "scale": self.scale, "weights": self.weights})

    @staticmethod
    def of_json(text: str) -> Network:
        return Network(**{k: tuple(v) for k, v in json.loads(text).items()})


def _inputs(features, fill, scale) -> list:
    return [(F.coalesce(F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None)), F.lit(m)) - F.lit(m)) / F.lit(s) for f, m, s in zip(features, fill, scale, strict=True)]


def fit(rows: DataFrame, features: list[str], epochs: int = EPOCHS, batches: int = 1, rate: float = RATE, decay: float = DECAY, dropout: float = DROPOUT, seed: int = 42) -> tuple[Network, list[float]]:
    """A network for rows (label 0 or 1, the features) and the mean loss of each epoch. Features are centred at the median and
    scaled by the interquartile range. With batches, an epoch takes that many steps, each over the rows of one class of hashes."""
    at = percentile_row(rows, features, [0.25, 0.5, 0.75]).head()
    quarters = [at[f"_{f}"] or [0.0, 0.0, 0.0] for f in features]
    fill, scale = [float(q[1]) for q in quarters], [float(q[2] - q[0]) or 1.0 for q in quarters]
    names = [f"x{i}" for i in range(len(features))]
    of = rows.select(*(c.alias(n) for c, n in zip(_inputs(features, fill, scale), names, strict=True)), F.col("label").cast("double").alias("label"))
    of = written(of.withColumn("batch", F.pmod(F.xxhash64(*of.columns), F.lit(batches))), "training")
    flat, losses = started(len(features), seed), []
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    step = 0
    for _ in range(epochs):
        loss = n = 0.0
        for k in range(batches):
            step += 1
            sums = of.filter(F.col("batch") == k).mapInArrow(_sums(flat, len(features), dropout, seed, step), "place int, value long").groupBy("place").agg(F.sum("value").alias("value"))
            got = np.zeros(len(flat) + 2)
            for r in sums.collect():  # a row a weight
                got[r["place"]] = r["value"] / _UNIT
            if not got[-1]:
                continue
            g = got[:-2] / got[-1] + decay * flat
            first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g**2
            flat = flat - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            loss, n = loss + got[-2], n + got[-1]
        losses.append(loss / n if n else float("nan"))
    return Network(tuple(features), tuple(fill), tuple(scale), tuple(map(float, flat))), losses
