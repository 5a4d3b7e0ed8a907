"""Feature statistics: effect sizes, imputation, limits for scaling, missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import percentile_row, percentiles, running


def effect_sizes(rows: DataFrame) -> DataFrame:
    """cliffs_delta, ks, wasserstein of x in rows (x, side 1/0), from counts by distinct value."""
    by = rows.filter("x IS NOT NULL").groupBy("x").agg(F.sum("side").cast("double").alias("a"), F.sum(1 - F.col("side")).cast("double").alias("b"))
    all_ = F.broadcast(rows.filter("x IS NOT NULL").agg(F.sum("side").alias("na"), F.sum(1 - F.col("side")).alias("nb")))
    of = running(by, "x", ["a", "b"]).crossJoin(all_)
    d = F.abs(F.col("a_upto") / F.col("na") - F.col("b_upto") / F.col("nb"))
    u = F.sum(F.col("a") * (F.col("b_upto") - F.col("b") / 2))
    return of.agg(F.round(2 * u / (F.first("na") * F.first("nb")) - 1, 6).alias("cliffs_delta"), F.round(F.max(d), 6).alias("ks"), F.round(F.sum(d * (F.col("_next") - F.col("x"))), 4).alias("wasserstein"))


def robust_limits(df: DataFrame, columns: list[str]) -> DataFrame:
    """feature, median, iqr, missing (percent)."""
    missing = df.agg(*((100 * F.avg(F.col(f"`{c}`").isNull().cast("int"))).alias(c) for c in columns)).select(F.inline(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("missing")) for c in columns))))
    of = missing.filter("missing IS NOT NULL").join(percentiles(df, columns, [0.25, 0.5, 0.75]), "feature", "left")
    return of.select("feature", F.round(F.col("q")[1], 6).alias("median"), F.round(F.col("q")[2] - F.col("q")[0], 6).alias("iqr"), F.round("missing", 6).alias("missing"))


def clip(column: str, low: float, high: float):
    c = F.col(column)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def median_filled(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """key and the columns, nulls filled with the column's median; <column>_missing is 1 there. The medians are one row."""
    of = df.select(key, *columns).crossJoin(F.broadcast(percentile_row(df, columns, [0.5])))
    return of.select(key, *(F.coalesce(F.col(c).cast("double"), F.col(f"_{c}")[0]).alias(c) for c in columns), *(F.col(c).isNull().cast("int").alias(f"{c}_missing") for c in columns))


def scaled(df: DataFrame, columns: list[str], kind: str = "robust", fit: DataFrame | None = None) -> DataFrame:
    """df with the columns scaled by limits of fit (df itself, if none is given): less the median over the interquartile range
    (robust), or less the mean over the population's deviation (standard). A spread of 0 counts as 1e-7. The limits are one
    row."""
    of = fit if fit is not None else df
    if kind == "robust":
        row, of_row = percentile_row(of, columns, [0.25, 0.5, 0.75]), lambda c: (F.col(f"_{c}")[1], F.col(f"_{c}")[2] - F.col(f"_{c}")[0])
    else:
        row, of_row = of.agg(*(F.struct(F.avg(c).alias("mid"), F.stddev_pop(c).alias("spread")).alias(f"_{c}") for c in columns)), lambda c: (F.col(f"_{c}.mid"), F.col(f"_{c}.spread"))
    limits = row.select(*(F.struct(of_row(c)[0].alias("mid"), F.greatest(of_row(c)[1], F.lit(1e-7)).alias("spread")).alias(f"_{c}") for c in columns))
    out = df.crossJoin(F.broadcast(limits))
    return out.select(*(((F.col(c) - F.col(f"_{c}.mid")) / F.col(f"_{c}.spread")).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns))


def varying(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns with more than one value: one row of variances."""
    row = df.agg(*(F.var_pop(c).alias(c) for c in columns)).head()
    return [c for c in columns if row[c]]


def spearman(df: DataFrame, columns: list[str]) -> DataFrame:
    """a, b, rho for every pair of columns: correlation of middle ranks, nulls filled with the median. Ranks come from
    counts by value along the order, so no task sorts a whole column."""
    df = df.select(*(F.col(c).cast("double").alias(c) for c in columns))
    medians = percentile_row(df, columns, [0.5]).head()  # one row, read first as every rank needs it
    filled = of = df.select(*(F.coalesce(F.col(c), F.lit((medians[f"_{c}"] or [None])[0]).cast("double")).alias(c) for c in columns))
    for c in columns:
        by = running(filled.groupBy(c).agg(F.count("*").alias("m")), c, ["m"])
        by = by.select(F.col(c).alias("_x"), (F.col("m_upto") - (F.col("m") - 1) / 2).alias(f"_r_{c}"))
        of = of.join(by, F.col(c) == F.col("_x")).drop("_x")
    pairs = [(a, b) for a in columns for b in columns]
    one = of.agg(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.corr(f"_r_{a}", f"_r_{b}"), 6).alias("rho")) for a, b in pairs)).alias("r"))
    return one.select(F.inline("r"))


def uncorrelated(rho: dict[tuple[str, str], float], columns: list[str], distance: float = 0.5) -> list[str]:
    """The first column of each cluster: clusters merge by Ward's rule on 1 - |rho| while their distance is at most this. A
    table of columns by columns, on the driver."""
    at = [[i] for i in range(len(columns))]
    d = {(i, j): 1 - abs(rho[columns[i], columns[j]]) for i in range(len(columns)) for j in range(i)}
    sets = dict(enumerate(at))
    while d and min(d.values()) <= distance:
        (i, j), near = min(d.items(), key=lambda x: (x[1], x[0]))
        a, b = len(sets[i]), len(sets[j])
        for k in sets:
            if k not in (i, j):
                c = len(sets[k])
                ik, jk = d[max(i, k), min(i, k)], d[max(j, k), min(j, k)]
                d[max(j, k), min(j, k)] = (((a + c) * ik**2 + (b + c) * jk**2 - c * near**2) / (a + b + c)) ** 0.5
        sets[j] += sets.pop(i)
        d = {pair: v for pair, v in d.items() if i not in pair}
    return [columns[min(s)] for s in sorted(sets.values(), key=min)]
