"""Ranked evaluation of scores (id, score, label 0/1), as windows over one order and aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import percentile_row, positions, running


def topk(scored: DataFrame, percents=(10, 25, 50, 70), lower_is_better: bool = False) -> DataFrame:
    """percent, capture, precision of the first ceil(n * percent / 100) rows, at least one, by score and then id; rows
    without a score come last. Without positives the capture is 0."""
    of = positions(scored, lower_is_better).withColumn("percent", F.explode(F.array(*(F.lit(p) for p in percents))))
    of = of.withColumn("k", F.greatest(F.lit(1), F.ceil(F.col("n") * F.col("percent") / 100)))
    out = of.groupBy("percent").agg(F.sum(F.when(F.col("at") <= F.col("k"), F.col("label"))).alias("p"), F.sum("label").alias("all"), F.max("k").alias("k"))
    return out.select("percent", F.round(F.coalesce(100 * F.try_divide("p", "all"), F.lit(0.0)), 6).alias("capture"), F.round(F.col("p") / F.col("k"), 6).alias("precision"))


def capture_curve(scored: DataFrame, lower_is_better: bool = False) -> DataFrame:
    """x, y: percent of rows and of positives at each place of the order, and the origin; the origin alone where there are no
    positives."""
    of = running(positions(scored, lower_is_better).select(F.col("at"), "n", F.col("label").cast("long").alias("p")), "at", ["p"])
    all_ = F.broadcast(scored.agg(F.sum("label").alias("all")))
    points = of.crossJoin(all_).filter("all > 0").select(F.round(100 * F.col("at") / F.col("n"), 6).alias("x"), F.round(100 * F.col("p_upto") / F.col("all"), 6).alias("y"))
    return points.union(scored.sparkSession.range(1).select(F.lit(0.0), F.lit(0.0)))


def prevalence(scored: DataFrame) -> DataFrame:
    """What precision a random order has at any k."""
    return scored.agg(F.round(F.avg("label"), 6).alias("prevalence"))


def predicted_positive(value: Column) -> Column:
    """Whether a prediction, of any type, says positive: 1, true or positive; a null says no."""
    text = F.lower(F.trim(value.cast("string")))
    return F.coalesce(text.isin("1", "true", "positive") | (text.try_cast("double") == 1), F.lit(False))


def confusion(scored: DataFrame, threshold: float, lower_is_better: bool = False) -> DataFrame:
    p, y = F.col("score") <= threshold if lower_is_better else F.col("score") >= threshold, F.col("label") == 1
    p = F.coalesce(p, F.lit(False))
    c = scored.agg(F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"), F.count_if(~p & y).alias("fn"), F.count_if(~p & ~y).alias("tn"))
    rate = lambda a, b: F.round(F.try_divide(F.col(a), F.col(a) + F.col(b)), 6)
    return c.select("tp", "fp", "fn", "tn", rate("tp", "fn").alias("recall"), rate("tn", "fp").alias("specificity"), rate("tp", "fp").alias("precision"), F.round(F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")), 6).alias("accuracy"))


def balanced(cells: DataFrame) -> DataFrame:
    """From tp, fp, fn, tn: precision and recall as means over both classes, and the balanced accuracy, which is the latter."""
    rate = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(a) + F.col(b)), F.lit(0.0))
    recall = (rate("tp", "fn") + rate("tn", "fp")) / 2
    return cells.select(F.round((rate("tp", "fp") + rate("tn", "fn")) / 2, 6).alias("balanced_precision"), F.round(recall, 6).alias("balanced_recall"), F.round(recall, 6).alias("balanced_accuracy"))


def _by_score(scored: DataFrame, lower_is_better: bool) -> DataFrame:
    """score, p, q (positives and others there), and their sums from the better scores on; rows without a score don't count."""
    by = scored.filter("score IS NOT NULL").groupBy("score").agg(F.sum("label").cast("double").alias("p"), F.sum(1 - F.col("label")).cast("double").alias("q"))
    return running(by, "score", ["p", "q"], descending=not lower_is_better)


def roc(scored: DataFrame, lower_is_better: bool = False) -> DataFrame:
    """score, tpr, fpr at each distinct score, and the origin, whose score is null."""
    of = _by_score(scored, lower_is_better)
    all_ = F.broadcast(scored.filter("score IS NOT NULL").agg(F.sum("label").alias("_p"), F.sum(1 - F.col("label")).alias("_q")))
    points = of.crossJoin(all_).select("score", F.round(F.try_divide("p_upto", "_p"), 6).alias("tpr"), F.round(F.try_divide("q_upto", "_q"), 6).alias("fpr"))
    return points.union(scored.sparkSession.range(1).select(F.lit(None).cast(scored.schema["score"].dataType), F.lit(0.0), F.lit(0.0)))


def auroc(scored: DataFrame, lower_is_better: bool = False) -> DataFrame:
    """Mann-Whitney over distinct scores, ties half."""
    of = _by_score(scored, lower_is_better)
    u = F.sum(F.col("q") * (F.col("p_upto") - F.col("p") / 2))
    return of.agg(F.round(F.try_divide(u, F.sum("p") * F.sum("q")), 6).alias("auroc"))


def brier_ece(scored: DataFrame, bins: int = 10) -> DataFrame:
    b = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1))
    by = scored.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg("score").alias("p"), F.avg("label").alias("y"), F.sum((F.col("score") - F.col("label")) ** 2).alias("e"))
    return by.agg(F.round(F.sum("e") / F.sum("n"), 6).alias("brier"), F.round(F.sum(F.col("n") * F.abs(F.col("p") - F.col("y"))) / F.sum("n"), 6).alias("ece"))


def histogram(scored: DataFrame, width: float = 0.1) -> DataFrame:
    """bin, total, positive: bins of this width between multiples of it, from below the least score to above the largest; the
    last bin takes its upper edge as well."""
    ends = scored.agg(F.floor(F.min("score") / width + 1e-9).alias("_low"), F.ceil(F.max("score") / width - 1e-9).alias("_high"))
    last = F.greatest(F.col("_high") - F.col("_low"), F.lit(1)) - 1
    at = F.least(F.floor(F.col("score") / width + 1e-9) - F.col("_low"), last)
    return scored.filter("score IS NOT NULL").crossJoin(F.broadcast(ends)).groupBy(at.alias("bin")).agg(F.count("*").alias("total"), F.sum("label").alias("positive"))


def average_precision(scored: DataFrame, lower_is_better: bool = False) -> DataFrame:
    """Sum over distinct scores, better ones first, of the recall each adds times the precision there."""
    of = _by_score(scored, lower_is_better)
    return of.agg(F.round(F.try_divide(F.sum(F.col("p") * F.col("p_upto") / (F.col("p_upto") + F.col("q_upto"))), F.sum("p")), 6).alias("average_precision"))


def calibration_uniform(scored: DataFrame, bins: int = 10) -> DataFrame:
    """The same as calibration() with bins of equal width over 0 to 1, closed on the right; scores of 0 or outside are in none."""
    at = F.ceil(F.round(F.col("score") * bins, 9)) - 1
    return scored.filter("score > 0 AND score <= 1").groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean"), F.round(F.avg("label"), 6).alias("observed"))


def by_fold(scored: DataFrame, group: list[str], threshold: float = 0.5) -> DataFrame:
    """For each group, such as fold and length: n, precision, recall, accuracy."""
    p, y = F.col("score") >= threshold, F.col("label") == 1
    of = scored.groupBy(*group).agg(F.count("*").alias("n"), F.count_if(p & y).alias("tp"), F.count_if(p).alias("said"), F.count_if(y).alias("all"), F.count_if(p == y).alias("right"))
    return of.select(*group, "n", F.round(F.try_divide("tp", "said"), 6).alias("precision"), F.round(F.try_divide("tp", "all"), 6).alias("recall"), F.round(F.col("right") / F.col("n"), 6).alias("accuracy"))


def calibration(scored: DataFrame, bins: int = 10) -> DataFrame:
    """bin, n, mean, observed: bins between quantiles of the score, closed on the right, the first one on both sides; equal
    edges are one. The edges are bins + 1 numbers."""
    edges = F.array_sort(F.array_distinct("_score"))
    inner = percentile_row(scored, ["score"], [i / bins for i in range(bins + 1)]).select(F.slice(edges, F.lit(2), F.greatest(F.size(edges) - 2, F.lit(0))).alias("_inner"))
    of = scored.filter("score IS NOT NULL").crossJoin(F.broadcast(inner))
    at = F.size(F.filter("_inner", lambda e: F.col("score") > e)).cast("long")
    return of.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean"), F.round(F.avg("label"), 6).alias("observed"))


def class_report(scored: DataFrame, threshold: float) -> DataFrame:
    """class, n, precision, recall of both classes and of their unweighted mean (class -1)."""
    guess = (F.col("score") >= threshold).cast("int")
    cells = scored.groupBy("label", guess.alias("guess")).agg(F.count("*").alias("m"))
    rates = [F.struct(F.lit(c).alias("class"), F.sum(F.when(F.col("label") == c, F.col("m"))).alias("n"), F.try_divide(F.sum(F.when((F.col("label") == c) & (F.col("guess") == c), F.col("m"))), F.sum(F.when(F.col("guess") == c, F.col("m")))).alias("precision"), F.try_divide(F.sum(F.when((F.col("label") == c) & (F.col("guess") == c), F.col("m"))), F.sum(F.when(F.col("label") == c, F.col("m")))).alias("recall")) for c in (0, 1)]
    one = cells.agg(F.array(*rates).alias("r")).select(F.inline("r"))
    mean = one.agg(F.lit(-1).alias("class"), F.sum("n").alias("n"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"))
    return one.union(mean).select("class", "n", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


def positive_capture(scored: DataFrame, threshold: float) -> DataFrame:
    """Percent of positives at or above the threshold, and the percent of rows there."""
    up = F.col("score") >= threshold
    return scored.agg(F.round(100 * F.try_divide(F.sum(F.when(up, F.col("label"))), F.sum("label")), 6).alias("captured"), F.round(100 * F.avg(up.cast("int")), 6).alias("selected"))
