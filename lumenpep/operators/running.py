"""Sums along an order, spread over tasks: rows fall into ranges of the order, and only the ranges' totals meet in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

RANGES = 200
#: How many values the edges of a column without numbers are taken from at most.
SAMPLE = 20_000
_BEFORE = (Window.unboundedPreceding, -1)
#: Edges are looked up in blocks of this many.
_STEP = 14


def _ends(edges: DataFrame) -> DataFrame:
    """edges with _ends, the last edge of each block."""
    return edges.withColumn("_ends", F.filter("_edges", lambda e, i: i % _STEP == _STEP - 1))


def _below(x: Column) -> Column:
    """How many of _edges are below x: whole blocks, then edges of one block."""
    whole = F.size(F.filter("_ends", lambda e: e < x)) * _STEP
    return whole + F.size(F.filter(F.slice("_edges", whole + 1, F.lit(_STEP)), lambda e: e < x))


def ranged(rows: DataFrame, column: str, to: str, null_range: int = RANGES + 1) -> DataFrame:
    """rows with the number of the range, 0 to RANGES, that the column falls in; nulls are a range of their own. Edges are
    approximate quantiles, one row of RANGES values: of numbers by a sketch of all rows, of any other type that has an order
    from one value of each of SAMPLE classes of hashes, so a repeated value counts once and every use of the edges agrees."""
    if isinstance(rows.schema[column].dataType, NumericType):
        x = F.col(column).cast("double")
        found = F.percentile_approx(x, F.array(*(F.lit(i / RANGES) for i in range(1, RANGES))), 10_000)
        edges = rows.agg(F.array_distinct(F.coalesce(found, F.array().cast("array<double>"))).alias("_edges"))
    else:
        x = F.col(column)
        some = rows.select(x.alias("_x")).filter("_x IS NOT NULL").groupBy(F.pmod(F.xxhash64("_x"), F.lit(SAMPLE))).agg(F.min_by("_x", F.xxhash64("_x", F.lit(1))).alias("_x"))
        every = lambda a: F.filter(a, lambda _, i: F.floor((i + 1) * RANGES / F.size(a)) > F.floor(i * RANGES / F.size(a)))
        edges = some.agg(F.sort_array(F.collect_list("_x")).alias("_a")).select(F.array_distinct(every(F.col("_a"))).alias("_edges"))
    return rows.crossJoin(F.broadcast(_ends(edges))).withColumn(to, F.when(F.col(column).isNull(), null_range).otherwise(_below(x))).drop("_edges", "_ends")


def running(rows: DataFrame, column: str, sums: list[str], descending: bool = False) -> DataFrame:
    """rows, one for each value of the column, with <sum>_upto for each of sums: over all rows up to this one, nulls last;
    and _next, the column's next value."""
    of = ranged(rows, column, "_range").withColumn("_range", F.when(F.col(column).isNull(), RANGES + 1).otherwise(-F.col("_range") if descending else F.col("_range")))
    order = F.desc_nulls_last(column) if descending else F.asc_nulls_last(column)
    by = Window.orderBy("_range")
    edge = F.max if descending else F.min
    totals = of.groupBy("_range").agg(*(F.sum(s).alias(s) for s in sums), edge(column).alias("_edge"))
    totals = totals.select(F.col("_range").alias("_at"), F.lead("_edge").over(by).alias("_later"), *(F.coalesce(F.sum(s).over(by.rowsBetween(*_BEFORE)), F.lit(0)).alias(f"_{s}") for s in sums))
    inner = Window.partitionBy("_range").orderBy(order)
    out = of.join(F.broadcast(totals), F.col("_range") == F.col("_at"))  # RANGES + 2 rows
    out = out.select(*rows.columns, *((F.col(f"_{s}") + F.sum(s).over(inner)).alias(f"{s}_upto") for s in sums), F.coalesce(F.lead(column).over(inner), "_later").alias("_next"))
    return out


def positions(scored: DataFrame, lower_is_better: bool = False) -> DataFrame:
    """scored (id, score, and others) with at, counted from 1 by score and then id, nulls last, and n. Rows of equal scores
    are numbered in ranges of their ids, so a score that a third of the rows have isn't one task's."""
    by = running(scored.groupBy("score").agg(F.count("*").alias("m")), "score", ["m"], descending=not lower_is_better)
    by = by.select(F.col("score").alias("_s"), (F.col("m_upto") - F.col("m")).alias("_above"))
    of = ranged(scored, "id", "_part")
    parts = of.groupBy("score", "_part").agg(F.count("*").alias("m"))
    parts = parts.select(F.col("score").alias("_t"), F.col("_part").alias("_p"), F.coalesce(F.sum("m").over(Window.partitionBy("score").orderBy("_part").rowsBetween(*_BEFORE)), F.lit(0)).alias("_earlier"))
    parts = parts.join(by, F.col("_t").eqNullSafe(F.col("_s"))).select("_t", "_p", (F.col("_above") + F.col("_earlier")).alias("_before"))
    out = of.join(parts, F.col("score").eqNullSafe(F.col("_t")) & (F.col("_part") == F.col("_p")))
    at: Column = F.col("_before") + F.row_number().over(Window.partitionBy("score", "_part").orderBy("id"))
    n = scored.agg(F.count("*").alias("n"))
    return out.select(*scored.columns, at.alias("at")).crossJoin(F.broadcast(n))


def percentiles(df: DataFrame, columns: list[str], fractions: list[float]) -> DataFrame:
    """feature, q: for each column that has a value, its exact percentiles, between two values in proportion; nulls don't
    count. Values are counted, and only the ranges of values that hold a wanted place are put in order, each in a task of its
    own; edges and totals are RANGES numbers a column."""
    cells = F.inline(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("x")) for c in columns)))
    by = df.select(cells).filter("x IS NOT NULL").groupBy("feature", "x").agg(F.count("*").alias("m")).filter("m > 0")  # all uses need m, so they share one exchange
    cuts = F.percentile_approx("x", F.array(*(F.lit(i / RANGES) for i in range(1, RANGES))), 10_000)
    edges = by.groupBy("feature").agg(F.array_distinct(cuts).alias("_edges"))
    of = by.join(F.broadcast(_ends(edges)), "feature").select("feature", "x", "m", _below(F.col("x")).alias("range"))
    each = Window.partitionBy("feature")
    totals = of.groupBy("feature", "range").agg(F.sum("m").alias("total"))
    before = F.coalesce(F.sum("total").over(each.orderBy("range").rowsBetween(*_BEFORE)), F.lit(0))
    totals = totals.select("feature", "range", before.alias("low"), (before + F.col("total")).alias("high"), F.sum("total").over(each).alias("n"))
    place = lambda f, n: f * (n - 1)
    within = lambda at: (F.col("low") <= at) & (at < F.col("high"))
    wanted = reduce(Column.__or__, (within(end(place(f, F.col("n")))) for f in fractions for end in (F.floor, F.ceil)))
    upto = F.col("low") + F.sum("m").over(Window.partitionBy("feature", "range").orderBy("x"))
    found = of.join(F.broadcast(totals.filter(wanted)), ["feature", "range"]).select("feature", "x", "n", (upto - F.col("m")).alias("low"), upto.alias("high"))
    value = lambda at: F.max(F.when(within(at), F.col("x")))

    def percentile(f: float) -> Column:
        at = place(f, F.col("n"))
        low, high = value(F.floor(at)), value(F.ceil(at))
        return F.when(low == high, low).otherwise(low + (place(f, F.max("n")) - F.floor(place(f, F.max("n")))) * (high - low))

    return found.groupBy("feature").agg(F.array(*(percentile(f) for f in fractions)).alias("q"))


def percentile_row(df: DataFrame, columns: list[str], fractions: list[float]) -> DataFrame:
    """One row: percentiles() as an array under each column's name after `_`, null where a column has no value."""
    return percentiles(df, columns, fractions).agg(*(F.max(F.when(F.col("feature") == c, F.col("q"))).alias(f"_{c}") for c in columns))
