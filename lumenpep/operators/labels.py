"""Labels: two lists of immunogenic and other peptides, joined with features; strata and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def labelled(features: DataFrame, yes: DataFrame, no: DataFrame, key: str = "peptide", order: str | None = None) -> DataFrame:
    """Features with label 1 or 0; keys of both lists are in neither class. Of rows with the same key the first by order
    counts; where none is given, the least by all columns, so that reruns agree."""
    lists = yes.select(key, F.lit(1).alias("one")).distinct().union(no.select(key, F.lit(0)).distinct())
    one = lists.groupBy(key).agg(F.min("one").alias("label"), F.count("*").alias("n")).filter("n = 1").drop("n")
    rest = [c for c in features.columns if c != key]
    first = features.groupBy(key).agg(F.min_by(F.struct(*rest), order) if order else F.min(F.struct(*rest))).toDF(key, "_row")
    return first.select(key, "_row.*").select(*features.columns).join(one, key)


def annotated(scored: DataFrame, yes: DataFrame, no: DataFrame, key: str = "peptide") -> DataFrame:
    a, b = yes.select(key, F.lit(1).alias("y")).distinct(), no.select(key, F.lit(1).alias("z")).distinct()
    return scored.join(a, key, "left").join(b, key, "left").withColumn("label", F.when(F.col("y").isNotNull() & F.col("z").isNull(), 1).when(F.col("y").isNull() & F.col("z").isNotNull(), 0)).drop("y", "z")


def winning(yes: DataFrame, no: DataFrame, winner: int = 1, key: str = "peptide") -> DataFrame:
    """key, label: of keys in both lists the winner's label stands."""
    lists = yes.select(key, F.lit(1).alias("label")).union(no.select(key, F.lit(0)))
    return lists.groupBy(key).agg((F.max if winner else F.min)("label").alias("label"))


def _place(rows: DataFrame, strata: list[str], key: str, seed: int, repeat: int) -> DataFrame:
    """rows with _at, a row's place from 0 in its stratum by hash, and _n, the stratum's size. Places are counted in 256 ranges
    of the hash, so a common stratum isn't one task's."""
    of = rows.withColumn("_h", _hash(F.col(key), seed, repeat)).withColumn("_range", F.floor(F.col("_h") / (1 << 24)).cast("int"))
    parts = of.groupBy(*strata, "_range").agg(F.count("*").alias("_m"))
    by = Window.partitionBy(*strata)
    parts = parts.select(*(F.col(c).alias(f"_s{i}") for i, c in enumerate(strata)), F.col("_range").alias("_r"), F.coalesce(F.sum("_m").over(by.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_m").over(by).alias("_n"))
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(strata):
        same = same & F.col(c).eqNullSafe(F.col(f"_s{i}"))
    inner = F.row_number().over(Window.partitionBy(*strata, "_range").orderBy("_h", key))
    return of.join(parts, same).withColumn("_at", F.col("_before") + inner - 1)


def _hash(key: Column, seed: int, repeat: int) -> Column:
    """32 bits of md5, which SQL engines share."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(seed), F.lit(repeat)).cast("binary")), 1, 8), 16, 10).cast("long")


def folds(rows: DataFrame, strata: list[str], key: str, k: int = 5, repeat: int = 0, seed: int = 42) -> DataFrame:
    """rows with fold, 0 to k - 1: each stratum is dealt evenly, in an order by hash."""
    return _place(rows, strata, key, seed, repeat).select(*rows.columns, (F.col("_at") % k).cast("int").alias("fold"))


def holdout(rows: DataFrame, strata: list[str], key: str, share: float = 0.2, seed: int = 42) -> DataFrame:
    """rows with held_out: of each stratum the first rows by hash, this share of it, rounded up."""
    return _place(rows, strata, key, seed, 0).select(*rows.columns, (F.col("_at") < F.ceil(F.col("_n") * share)).alias("held_out"))


def upsampled(rows: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """The smaller class drawn again until it is as large as the other: each row as often as the sizes' ratio says, the rest of
    the ratio by hash."""
    n = rows.groupBy(label).agg(F.count("*").alias("_n"))
    most = rows.groupBy(label).count().agg(F.max("count").alias("_most"))
    ratio = F.col("_most") / F.col("_n")
    u = _hash(F.col(key), seed, 0) / float(1 << 32)
    of = rows.join(F.broadcast(n), label).crossJoin(F.broadcast(most))
    of = of.withColumn("_times", (F.floor(ratio) + (u < ratio - F.floor(ratio)).cast("int")).cast("int"))
    return of.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*rows.columns)
