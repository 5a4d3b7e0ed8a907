"""Choosing features from one pass over the rows: sums of products by fold, from which everything else follows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMS = "fold int, label int, i int, j int, value double"


def _products(names: list[str]):
    """Sums of products of a task's rows by fold and label: of 1, the features and the label, place by place with j >= i."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x = np.column_stack([np.ones(batch.num_rows), *(batch.column(n).to_numpy(zero_copy_only=False) for n in (*names, "label"))]) if batch.num_rows else np.zeros((0, len(names) + 2))
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            for k in np.unique(fold):
                for y in np.unique(x[fold == k, -1]):
                    own = x[(fold == k) & (x[:, -1] == y)]
                    held[int(k), int(y)] = held.get((int(k), int(y)), 0) + own.T @ own
        i, j = np.triu_indices(len(names) + 2)
        for (k, y), m in held.items():
            n = len(i)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, k, np.int32)), pa.array(np.full(n, y, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(m[i, j])], names=[f.split()[0] for f in SUMS.split(", ")])

    return run


def products(rows: DataFrame, features: list[str], fold: str | None = None) -> DataFrame:
    """SUMS for rows (label 0 or 1, the features, and perhaps a fold): i and j are places in (1, the features, the label). Rows
    with a missing feature don't count; fill them before, as stats.median_filled() does."""
    of = rows.select(*(F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(features)), F.col("label").cast("double").alias("label"), (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"))
    of = of.dropna().mapInArrow(_products([f"x{i}" for i in range(len(features))]), SUMS)
    return of.groupBy("fold", "label", "i", "j").agg(F.sum("value").alias("value"))


class Gram:
    """The sums on the driver: (features + 2)^2 numbers for each fold and label, whatever the number of rows."""

    def __init__(self, rows: DataFrame, features: list[str], fold: str | None = None):
        self.features, size = list(features), len(features) + 2
        self.by: dict[tuple[int, int], np.ndarray] = {}
        for r in products(rows, features, fold).collect():  # folds * 2 * (features + 2)^2 / 2 rows
            m = self.by.setdefault((r["fold"], r["label"]), np.zeros((size, size)))
            m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["value"]
        self.folds = sorted({k for k, _ in self.by})
        self.size = size

    def of(self, keep=lambda fold: True) -> np.ndarray:
        return sum((m for (k, _), m in self.by.items() if keep(k)), np.zeros((self.size, self.size)))

    def f_values(self) -> dict[str, float]:
        """Of each feature the variance between the two classes over that within them; infinite where there is none within."""
        by = [sum((m for (_, label), m in self.by.items() if label == y), np.zeros((self.size, self.size))) for y in (0, 1)]
        out = {}
        for i, f in enumerate(self.features, 1):
            n, s, q = (np.array([m[a, b] for m in by]) for a, b in ((0, 0), (0, i), (i, i)))
            if (n == 0).any():
                raise ValueError("a class without rows")
            between = (s**2 / n).sum() - s.sum() ** 2 / n.sum()
            within = q.sum() - (s**2 / n).sum()
            out[f] = float(between / (within / (n.sum() - 2))) if within > 0 else float("inf") if between > 0 else float("nan")
        return out

    def best(self, n: int) -> list[str]:
        """The n features with the largest F values, ties in their order; those without one last."""
        f = self.f_values()
        return sorted(self.features, key=lambda x: (-(f[x] if f[x] == f[x] else -1.0), self.features.index(x)))[:n]

    def _fit(self, m: np.ndarray, columns: list[int], alpha: float) -> tuple[np.ndarray, float]:
        """Coefficients and intercept of ridge regression on centred columns."""
        n, y = m[0, 0], self.size - 1
        mean = m[0] / n
        c = m - n * np.outer(mean, mean)
        a = c[np.ix_(columns, columns)] + alpha * np.eye(len(columns))
        w = np.linalg.lstsq(a, c[columns, y], rcond=None)[0] if columns else np.zeros(0)
        return w, float(mean[y] - mean[columns] @ w)

    def _error(self, m: np.ndarray, columns: list[int], w: np.ndarray, b: float) -> float:
        """The sum of squared errors on the rows behind m."""
        full = np.zeros(self.size)
        full[columns], full[0], full[-1] = w, b, -1.0
        return float(full @ m @ full)

    def _cross(self, columns: list[int], alpha: float) -> float:
        """The mean over folds of the coefficient of determination on the fold, fitted on the others."""
        out = []
        for k in self.folds:
            w, b = self._fit(self.of(lambda f, k=k: f != k), columns, alpha)
            held = self.of(lambda f, k=k: f == k)
            total = held[-1, -1] - held[0, -1] ** 2 / held[0, 0]
            out.append(1 - self._error(held, columns, w, b) / total if total > 0 else 0.0)
        return float(np.mean(out))

    def ridge(self, alphas: tuple[float, ...] = (0.1, 1.0, 10.0)) -> tuple[float, dict[str, float], float]:
        """The penalty with the best mean over folds, and coefficients and intercept with it on all rows."""
        all_ = list(range(1, self.size - 1))
        alpha = max(alphas, key=lambda a: (self._cross(all_, a), -a)) if len(self.folds) > 1 else alphas[0]
        w, b = self._fit(self.of(), all_, alpha)
        return alpha, dict(zip(self.features, map(float, w), strict=True)), b

    def forward(self, n: int, alpha: float = 1e-9) -> list[str]:
        """Features added one by one, each time the one with the best mean over folds; the first in order among equals."""
        had: list[int] = []
        while len(had) < min(n, len(self.features)):
            had.append(max((i for i in range(1, self.size - 1) if i not in had), key=lambda i: (round(self._cross([*had, i], alpha), 12), -i)))
        return [self.features[i - 1] for i in had]

    def backward(self, n: int, alpha: float = 1e-9) -> list[str]:
        """What is left when, one by one, the feature goes that the rest does best without."""
        had = list(range(1, self.size - 1))
        while len(had) > n:
            had.remove(max(had, key=lambda i: (round(self._cross([x for x in had if x != i], alpha), 12), i)))
        return [self.features[i - 1] for i in had]

    def eliminated(self, n: int, alpha: float = 1.0) -> list[str]:
        """What is left when, one by one, the feature with the least coefficient on standardised columns goes."""
        had, m = list(range(1, self.size - 1)), self.of()
        scale = np.sqrt(np.maximum(np.diag(m) / m[0, 0] - (m[0] / m[0, 0]) ** 2, 0))
        while len(had) > n:
            w, _ = self._fit(m, had, alpha)
            weight = np.abs(w) * scale[had]
            had.pop(int(np.flatnonzero(weight == weight.min())[-1]))
        return [self.features[i - 1] for i in had]
