"""Mixing sources to target weights by Pareto order sampling.

Targets in words are water-filled over the sources. Within a source a document is taken lambda = min(cap, c * propensity)
times on average, with c such that the expected words are the target. The whole part of lambda is taken for certain; the
rest is an inclusion probability p, and documents are ranked by their random odds over their inclusion odds,
(u / (1 - u)) / (p / (1 - p)), and taken from the lowest rank on until the source has its words.

A document of over 1/1000 of its source's words would make the last step coarse. A source has fewer than 1000 of these, so
they are ranked and filled in one bounded array per source; for all others the cut is found by a histogram of ranks, and
exactly among the documents of the one bin that the cut falls in. No source, however large, is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, only, stage

LARGE = 1000  # a large document has over 1/LARGE of its source's words
BINS = 4096
_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def default_propensity(size: Column) -> Column:
    """Fragments of under 16 words are taken half as readily."""
    return F.when(size < 16, 0.5).otherwise(1.0)


def source_targets(sizes: DataFrame, cap: float = 3.0) -> DataFrame:
    """sizes: source, source_size, a row for each source. Adds target: sources by code point, null last, weigh 1, 2, 3,
    repeating, and share the sum of all sizes; none gets more than cap times its size, and what is left is shared again by
    weight. The windows run over one row for each source."""
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("weight", ((F.row_number().over(ordered) - 1) % 3 + 1).cast("double")).withColumn("most", cap * F.col("source_size"))
    by = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    w = w.withColumn("full", F.coalesce(F.sum("most").over(by.rowsBetween(*_BEFORE)), F.lit(0.0)))
    w = w.withColumn("open", F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)))
    w = w.withColumn("all", F.sum("source_size").over(Window.partitionBy()))
    w = w.withColumn("level", (F.col("all") - F.col("full")) / F.col("open"))
    # the first source, in this order, whose share at the level it would set is below its cap, sets the level
    w = w.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct((F.col("most") / F.col("weight")).alias("at"), F.col("level").alias("level")))).over(Window.partitionBy())["level"])
    return w.select("source", "source_size", F.coalesce(F.least("most", F.col("level") * F.col("weight")), "most").alias("target"))


def _ranked(rows: DataFrame) -> DataFrame:
    """Adds sure (whole copies), p and q (the rank; null where nothing is left to chance) from `lambda`."""
    sure = F.floor(F.col("lambda") + 1e-9)
    p = F.greatest(F.col("lambda") - sure, F.lit(0.0))
    rows = rows.withColumn("sure", sure.cast("long")).withColumn("p", F.when(p > 1e-9, p).otherwise(0.0))
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    return rows.withColumn("q", F.when(F.col("p") > 0, odds / (1 + odds)))


def _sized(docs: DataFrame, propensity, seed: int) -> DataFrame:
    """u depends on doc_id, size and seed alone: reruns agree, and rows that share both are taken or left together."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "size"), 12).cast("double") + 0.5) / float(1 << 52)
    of = docs.withColumn("size", words()).withColumn("u", u)
    return of.withColumn("level", F.round(F.least(F.greatest(propensity(F.col("size")), F.lit(0.01)), F.lit(1.0)), 2))


def plan(docs: DataFrame, cap: float = 3.0, seed: int = 1, propensity=default_propensity) -> DataFrame:
    """A row for each source and level of propensity (at most 100): source, level, source_size, target, lambda, cut (rank
    up to which small documents are taken) and chosen (ranks of the large ones that are)."""
    narrow = stage(_sized(only(docs, "doc_id", "source", "text"), propensity, seed).select("source", "size", "u", "level"), "sizes")
    by_level = narrow.groupBy("source", "level").agg(F.sum("size").alias("words"))
    sizes = by_level.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, cap).withColumnRenamed("source", "_s")
    levels = by_level.join(targets, by_level["source"].eqNullSafe(F.col("_s"))).drop("_s")
    by = Window.partitionBy("source").orderBy(F.desc("level"))
    levels = levels.withColumn("full", F.coalesce(F.sum("words").over(by.rowsBetween(*_BEFORE)), F.lit(0)) * cap)
    levels = levels.withColumn("open", F.sum(F.col("words") * F.col("level")).over(by.rowsBetween(0, Window.unboundedFollowing)))
    levels = levels.withColumn("c", F.try_divide(F.col("target") - F.col("full"), "open"))
    fits = F.when(F.col("c") * F.col("level") <= cap * (1 + 1e-9), F.struct((-F.col("level")).alias("at"), F.col("c").alias("c")))
    levels = levels.withColumn("c", F.min(fits).over(Window.partitionBy("source"))["c"])
    levels = levels.withColumn("lambda", F.coalesce(F.least(F.lit(cap), F.greatest(F.col("c") * F.col("level"), F.lit(0.0))), F.lit(cap)))
    levels = stage(levels.select("source", "level", "source_size", "target", "lambda"), "levels")

    of = levels.withColumnRenamed("source", "_s").withColumnRenamed("level", "_l")
    rows = _ranked(narrow.filter("size > 0").join(of, narrow["source"].eqNullSafe(F.col("_s")) & (narrow["level"] == F.col("_l"))).drop("_s", "_l"))
    rows = rows.withColumn("large", F.col("size") * LARGE > F.col("source_size"))
    wanted = rows.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("size") * F.col("sure")).alias("sure_words"), F.sum(F.when(F.col("large"), F.col("p") * F.col("size"))).alias("large_words"))
    some = rows.filter(F.col("q").isNotNull())

    # large documents: fewer than LARGE of each source
    arrays = some.filter("large").groupBy("source").agg(F.sort_array(F.collect_list(F.struct("q", "size"))).alias("rows")).withColumnRenamed("source", "_s")
    filled = wanted.join(arrays, wanted["source"].eqNullSafe(F.col("_s")), "left").drop("_s")
    start = F.struct(F.coalesce("large_words", F.lit(0.0)).alias("left"), F.array().cast("array<double>").alias("qs"))
    filled = filled.withColumn("got", F.aggregate(F.coalesce("rows", F.array().cast("array<struct<q:double,size:bigint>>")), start, lambda a, r: F.when(r["size"] <= a["left"], F.struct((a["left"] - r["size"]).alias("left"), F.concat(a["qs"], F.array(r["q"])).alias("qs"))).otherwise(a)))
    nearest = F.array_min(F.transform(F.filter("rows", lambda r: ~F.array_contains(F.col("got.qs"), r["q"]) & (r["size"] < 2 * F.col("got.left"))), lambda r: F.struct(F.abs(r["size"] - F.col("got.left")).alias("off"), r["q"].alias("q"), r["size"].alias("size"))))
    filled = filled.withColumn("last", nearest)
    left = F.col("got.left") - F.coalesce("last.size", F.lit(0))
    filled = filled.select("source", F.when(F.col("last").isNull(), F.col("got.qs")).otherwise(F.concat("got.qs", F.array("last.q"))).alias("chosen"), (F.col("target") - F.col("sure_words") - F.coalesce("large_words", F.lit(0.0)) + left).alias("small_words"))
    filled = stage(filled, "filled")

    # small documents: the bin that the cut falls in, then the cut
    small = some.filter("NOT large").withColumn("bin", F.floor(F.col("q") * BINS))
    bins = small.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    bins = bins.withColumn("before", F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("bin").rowsBetween(*_BEFORE)), F.lit(0)))
    need = filled.select(F.col("source").alias("_s"), "small_words")
    edge = bins.join(need, bins["source"].eqNullSafe(F.col("_s"))).filter((F.col("before") <= F.col("small_words")) & (F.col("small_words") < F.col("before") + F.col("words"))).select("_s", F.col("bin").alias("_b"), "before", "small_words")
    cut = small.join(edge, small["source"].eqNullSafe(F.col("_s")) & (F.col("bin") == F.col("_b"))).groupBy("source", "q", "before", "small_words", "_b").agg(F.sum("size").alias("size"))
    cut = cut.withColumn("after", F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("q").rowsBetween(*_SO_FAR)))
    # a row is taken if the words with it are nearer to the target than without it
    cut = cut.groupBy("source").agg(F.max(F.when(F.col("after") - F.col("size") / 2 <= F.col("small_words"), F.col("q"))).alias("q"), (F.first("_b") / BINS).alias("low")).select(F.col("source").alias("_c"), F.coalesce("q", "low").alias("cut"))
    # without an edge, the words wanted are none, or more than there are
    ends = filled.join(cut, filled["source"].eqNullSafe(F.col("_c")), "left").select(F.col("source").alias("_s"), "chosen", F.coalesce("cut", F.when(F.col("small_words") > 0, 1.0).otherwise(-1.0)).alias("cut"))
    return stage(levels.join(ends, levels["source"].eqNullSafe(F.col("_s")), "left").drop("_s"), "mix")


def mix(docs: DataFrame, cap: float = 3.0, seed: int = 1, propensity=default_propensity) -> DataFrame:
    """The rows of docs (doc_id, source, text, and any others) with size, source_size, target, copies and taken =
    copies * size.

    A null text has size 0; a document of size 0 has no copies. A null source is a source of its own. Rows of one source
    that share doc_id and size share their fate. An empty table gives no rows. A source's taken words miss its target by at
    most half of its smallest document outside the sample, or by 1/2000 of its words where it has documents that small.
    """
    made = plan(docs, cap, seed, propensity).select(*(F.col(c).alias(f"_{c}") for c in ("source", "level", "source_size", "target", "lambda", "cut", "chosen")))
    given = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "doc_id", "source", "text")
    of = _sized(given, propensity, seed).drop("text")
    of = of.join(made, of["source"].eqNullSafe(F.col("_source")) & (of["level"] == F.col("_level"))).withColumn("lambda", F.col("_lambda"))
    of = _ranked(of)
    large = F.col("size") * LARGE > F.col("_source_size")
    more = F.coalesce(F.when(large, F.array_contains("_chosen", F.col("q"))).otherwise(F.col("q") <= F.col("_cut")), F.lit(False))
    of = of.withColumn("copies", F.when(F.col("size") > 0, F.col("sure") + more.cast("long")).otherwise(F.lit(0).cast("long")))
    own = ("size", "source_size", "target", "copies", "taken")
    kept = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c.lower() not in own]
    return of.select(*kept, "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, each as often as the mix takes it."""
    given = docs.select("doc_id", "source", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_given"))
    copies = mix(given, **options).filter("copies > 0")
    return copies.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_given.*")
