"""Probabilities from margins: a sigmoid fitted to margins of rows that the classifier hasn't seen."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import workflow
from .linear import of_pipeline


def sums(margins: DataFrame, slope: float = 0.0, shift: float = 0.0) -> DataFrame:
    """One row: gradient and second derivatives of the log loss of 1 / (1 + exp(-(slope * margin + shift))) for margins (margin,
    label), against targets (n1 + 1) / (n1 + 2) and 1 / (n0 + 2), which keep a sigmoid finite where classes part."""
    n = margins.agg(F.sum("label").alias("_n1"), F.count("*").alias("_n"))
    m = F.col("margin")
    target = F.when(F.col("label") == 1, (F.col("_n1") + 1) / (F.col("_n1") + 2)).otherwise(1 / (F.col("_n") - F.col("_n1") + 2))
    p = 1 / (1 + F.exp(-(F.lit(slope) * m + F.lit(shift))))
    of = margins.crossJoin(F.broadcast(n)).select(m, p.alias("p"), (p - target).alias("g")).withColumn("h", F.col("p") * (1 - F.col("p")))
    g, h = F.col("g"), F.col("h")
    return of.agg(F.sum(m * g).alias("g_slope"), F.sum(g).alias("g_shift"), F.sum(m * m * h).alias("h_slope"), F.sum(m * h).alias("h_both"), F.sum(h).alias("h_shift"))


def sigmoid(margins: DataFrame, steps: int = 25, ridge: float = 1e-10) -> tuple[float, float]:
    """slope, shift by Newton's method; each step is one aggregation. Ends where a step is below 1e-10."""
    at = np.zeros(2)
    for _ in range(steps):
        r = sums(margins, *map(float, at)).head()
        if r["g_shift"] is None:
            return 1.0, 0.0
        gradient = np.array([r["g_slope"], r["g_shift"]])
        step = np.linalg.solve(np.array([[r["h_slope"], r["h_both"]], [r["h_both"], r["h_shift"]]]) + ridge * np.eye(2), gradient)
        at -= step * min(1.0, 10 / max(1e-300, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-10:
            break
    return float(at[0]), float(at[1])


def _margin(model: PipelineModel) -> Column:
    return vector_to_array("rawPrediction")[1]


def _margins(model: PipelineModel, rows: DataFrame, features: list[str]) -> DataFrame:
    return model.transform(workflow._prepared(rows, features)).select(_margin(model).alias("margin"), F.col("label").cast("int").alias("label"))


@dataclass(frozen=True)
class Calibrated:
    """Fitted pipelines with the slope and shift of each; the score is the mean of their probabilities."""

    models: tuple[tuple[PipelineModel, float, float], ...]
    features: tuple[str, ...]

    def predict(self, rows: DataFrame, threshold: float = 0.5) -> DataFrame:
        """rows with score and prediction. Linear pipelines are column expressions; others transform one after another."""
        if lost := [f for f in self.features if f not in rows.columns]:
            raise ValueError(f"missing features: {', '.join(lost)}")
        n = len(self.models)
        if all(hasattr(m.stages[-1], "coefficients") and len(m.stages) == 4 for m, _, _ in self.models):
            parts = [replace(of_pipeline(m, list(self.features)), slope=a, shift=b).score() for m, a, b in self.models]
            out = rows.withColumn("score", reduce(Column.__add__, parts) / n)
        else:
            out, extra = workflow._prepared(rows, list(self.features)), []
            for i, (m, a, b) in enumerate(self.models):
                scored = m.transform(out).withColumn(f"_p{i}", 1 / (1 + F.exp(-(F.lit(a) * _margin(m) + F.lit(b)))))
                extra.append(f"_p{i}")
                out = scored.select(*out.columns, f"_p{i}")
            out = out.withColumn("score", reduce(Column.__add__, map(F.col, extra)) / n).drop(*extra)
        return out.select(*rows.columns, "score", (F.col("score") >= threshold).cast("int").alias("prediction"))


def fit(rows: DataFrame, name: str, features: list[str], params: dict | None = None, fold: str = "fold", ensemble: bool = True) -> Calibrated:
    """rows: label, the features, and the number of a fold. For each fold a classifier of the other folds and a sigmoid of its
    margins in that fold; with ensemble, these are the result. Without, one classifier of all rows with a
    sigmoid of the margins that all folds' classifiers gave to rows that they had not seen."""
    made, seen = [], []
    of = written(rows, "folds")
    for k in sorted(r[0] for r in of.select(fold).distinct().collect()):
        model = workflow.fit(of.filter(F.col(fold) != k).drop(fold), name, features, params)
        held = written(_margins(model, of.filter(F.col(fold) == k), features), "margins")
        if ensemble:
            made.append((model, *sigmoid(held)))
        seen.append(held)
    if not ensemble:
        made = [(workflow.fit(of.drop(fold), name, features, params), *sigmoid(reduce(DataFrame.unionByName, seen)))]
    return Calibrated(tuple(made), tuple(features))
