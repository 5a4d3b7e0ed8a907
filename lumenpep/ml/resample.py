"""Bootstrap by Poisson weights that follow from a hash of the row, all resamples in one pass; nested validation."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import labels
from ..operators.running import ranged
from ..session import written
from . import workflow

#: A row is drawn as often as there are of these at most its number in [0, 1): the Poisson distribution of mean 1.
LIMITS = [round(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)), 9) for k in range(10)]


def weight(key: Column, resample: Column, seed: int = 42) -> Column:
    """How often a resample has the row: 32 bits of md5 of key, seed and resample, which SQL engines share."""
    u = F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(seed), resample.cast("string")).cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    return reduce(Column.__add__, ((u >= x).cast("long") for x in LIMITS))


def auroc(scored: DataFrame, resamples: int = 200, seed: int = 42) -> DataFrame:
    """resample, auroc for scored (id, score, label): ties count a half; null where a resample lacks a class. Rows are counted by
    resample and score, and the counts added up in ranges of the score, so no resample is one task's."""
    of = scored.filter("score IS NOT NULL").withColumn("resample", F.explode(F.sequence(F.lit(1), F.lit(resamples))))
    of = of.withColumn("_w", weight(F.col("id"), F.col("resample"), seed))
    by = of.filter("_w > 0").groupBy("resample", "score").agg(F.sum(F.col("_w") * F.col("label")).cast("double").alias("p"), F.sum(F.col("_w") * (1 - F.col("label"))).cast("double").alias("q"))
    by = ranged(written(by, "resamples"), "score", "_range")
    earlier = Window.partitionBy("resample").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = by.groupBy("resample", "_range").agg(F.sum("q").alias("_q")).withColumn("_below", F.coalesce(F.sum("_q").over(earlier), F.lit(0.0))).drop("_q")
    inner = Window.partitionBy("resample", "_range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_below") + F.coalesce(F.sum("q").over(inner), F.lit(0.0))
    won = by.join(totals, ["resample", "_range"]).withColumn("_won", F.col("p") * (below + F.col("q") / 2))
    return won.groupBy("resample").agg(F.round(F.try_divide(F.sum("_won"), F.sum("p") * F.sum("q")), 6).alias("auroc"))


def interval(values: DataFrame, column: str = "auroc", level: float = 0.95) -> DataFrame:
    """low, median, high and n of a column over resamples, by interpolated percentiles."""
    rest = (1 - level) / 2
    q = F.percentile(F.col(column), F.array(F.lit(rest), F.lit(0.5), F.lit(1 - rest)))
    return values.agg(q.alias("q"), F.count(column).alias("n")).select(*(F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(("low", "median", "high"))), "n")


def nested(rows: DataFrame, name: str, features: list[str], params: list[dict], key: str, outer: int = 5, inner: int = 5, metric: str = "precision", seed: int = 42) -> DataFrame:
    """fold, params, metric, value: for each outer fold the parameters that do best over inner folds of the other rows, and what a
    classifier with them scores on the fold."""
    of, out = written(labels.folds(rows.drop("fold"), ["label"], key, outer, seed=seed), "outer"), []
    for k in range(outer):
        train, test = of.filter(F.col("fold") != k).drop("fold"), of.filter(F.col("fold") == k).drop("fold")
        found = workflow.validate(labels.folds(train, ["label"], key, inner, repeat=k + 1, seed=seed), name, features, params)
        _, best = workflow.best(found, metric)
        scored = workflow.metrics(workflow.predict(workflow.fit(train, name, features, best), test, features))
        out.append(scored.select(F.lit(k).alias("fold"), F.lit(str(sorted(best.items()))).alias("params"), "metric", "value"))
    return reduce(DataFrame.unionByName, out)
