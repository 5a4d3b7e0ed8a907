"""Curation of epitope tables: sources, classes, top n with the rest as one, shared alleles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.alleles import state, valid


def class_counts(rows: DataFrame, group: str, groups: tuple[str, str], cls: str) -> DataFrame:
    """class, and for both groups the count and percent; classes of either group."""
    one = rows.filter(F.col(group).isin(*groups)).groupBy(F.col(cls).alias("class")).agg(*(F.count_if(F.col(group) == g).alias(f"n_{i}") for i, g in enumerate(groups)))
    all_ = Window.partitionBy()
    return one.select("class", "n_0", "n_1", *(F.round(100 * F.try_divide(F.col(f"n_{i}"), F.sum(f"n_{i}").over(all_)), 6).alias(f"pct_{i}") for i in (0, 1)))


def top_other(rows: DataFrame, column: str, n: int) -> DataFrame:
    counts = rows.groupBy(F.col(column).alias("class")).count()
    ranked = counts.withColumn("rn", F.row_number().over(Window.orderBy(F.desc("count"), "class")))
    return ranked.groupBy(F.when(F.col("rn") <= n, F.col("class")).otherwise("Other").alias("class")).agg(F.sum("count").alias("n"))


def overlap(rows: DataFrame, value: str, side: str) -> DataFrame:
    """value, shared or the one side it is on."""
    return rows.groupBy(value).agg(F.when(F.count_distinct(side) > 1, "shared").otherwise(F.max(side).cast("string")).alias("where"))


def multi(rows: DataFrame, key: str, value: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count_distinct(value).alias("n")).filter("n > 1")


def origins(rows: DataFrame, organism: str, mutation: str, relation: str, human: str) -> DataFrame:
    """rows with origin: self, neoantigen, viral or null."""
    own = F.coalesce(F.col(organism).contains(human), F.lit(False))
    changed = F.col(organism).isNull() | (own & F.col(mutation).isNotNull())
    return rows.withColumn("origin", F.when(own & F.col(mutation).isNull(), "self").when(changed & F.col(relation).isNotNull(), "neoantigen").when(F.col(organism).isNotNull() & ~own, "viral"))


def unsupported(alleles: DataFrame, supported: DataFrame, column: str) -> DataFrame:
    """Alleles that a list of supported ones lacks, both without prefix, star and colon."""
    plain = lambda c: F.regexp_replace(c, r"^HLA-|[*:]", "")
    known = supported.select(plain(F.col(column)).alias("plain")).distinct()
    return alleles.select(column, plain(F.col(column)).alias("plain")).distinct().join(known, "plain", "left_anti").select(column)


def presence(wanted: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """Of the wanted values, how many there are, and how many were found and are missing."""
    both = wanted.select(column).distinct().join(found.select(column, F.lit(1).alias("hit")).distinct(), column, "left")
    return both.agg(F.count("*").alias("wanted"), F.count("hit").alias("found"), F.count_if(F.col("hit").isNull()).alias("missing"))


def metric_summary(results: DataFrame, group: list[str], score: str) -> DataFrame:
    """Mean and deviation of scores per group, and the group's rank by mean, ties sharing the smaller rank. There is one
    row a group of models and metrics: a small window."""
    by = results.groupBy(*group).agg(F.avg(score).alias("m"), F.stddev(score).alias("s"))
    return by.select(*group, F.round("m", 6).alias("mean"), F.round("s", 6).alias("deviation"), F.rank().over(Window.orderBy(F.desc(F.round("m", 6)))).cast("long").alias("place"))


def epitopes(rows: DataFrame, name: str = "peptide") -> DataFrame:
    """Distinct epitopes of standard residues, one row each; names with blanks go."""
    return rows.filter(~F.contains(F.col(name), F.lit(" ")) & valid(F.col(name))).select(name).distinct()


def restricted(rows: DataFrame, assay: str, good: list[str], key: str = "peptide") -> DataFrame:
    """Distinct keys of rows from one of the good assays."""
    return rows.filter(F.col(assay).isin(good)).select(key).distinct()


def mended(alleles: DataFrame, common: DataFrame) -> DataFrame:
    """allele, whole: for each broken allele (no colon, but a hyphen) the common alleles that contain it, null where none does.
    A common allele is cut into its own parts of an allele's form, so the join is one of equal strings."""
    broken = alleles.filter(state(F.col("allele")) == "broken").select("allele").distinct()
    n = F.length("allele")
    parts = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(i, n), lambda j: F.substring(F.col("allele"), i, j - i + 1))))
    parts = common.filter(n > 0).select(F.col("allele").alias("whole"), F.explode(F.array_distinct(parts)).alias("allele"))
    return broken.join(parts, "allele", "left")


def lengths(rows: DataFrame, group: str, name: str = "peptide") -> DataFrame:
    return rows.groupBy(group, F.length(name).alias("length")).agg(F.count("*").alias("n"))


def quality(rows: DataFrame, columns: list[str], word: str) -> DataFrame:
    """feature, with, filled, different: how many values contain a word, aren't null, and are different."""
    each = [F.struct(F.lit(c).alias("feature"), F.count_if(F.contains(F.col(c).cast("string"), F.lit(word))).alias("with"), F.count(c).alias("filled"), F.count_distinct(c).alias("different")) for c in columns]
    return rows.agg(F.array(*each).alias("r")).select(F.inline("r"))


def shares(rows: DataFrame, column: str, words: dict[str, str]) -> DataFrame:
    """name, n, percent of the rows whose column contains a word, for each (name -> word)."""
    each = [F.struct(F.lit(k).alias("name"), F.count_if(F.contains(F.col(column), F.lit(w))).alias("n"), F.count("*").alias("all")) for k, w in words.items()]
    return rows.agg(F.array(*each).alias("r")).select(F.inline("r")).select("name", "n", F.round(100 * F.try_divide("n", "all"), 6).alias("percent"))


def broken_report(alleles: DataFrame, common: DataFrame) -> DataFrame:
    """label, allele, status, replacements for the alleles of each set (label, allele) without a colon: `dropped` where there is no
    hyphen either, `replaced` with the common alleles that contain it, sorted, or `still_broken`."""
    of = alleles.select("label", "allele").distinct().withColumn("_state", state(F.col("allele"))).filter("_state <> 'whole'")
    found = mended(of, common).groupBy(F.col("allele").alias("_allele")).agg(F.sort_array(F.collect_set("whole")).alias("_found"))
    of = of.join(found, F.col("allele") == F.col("_allele"), "left").withColumn("replacements", F.coalesce("_found", F.array().cast("array<string>")))
    status = F.when(F.col("_state") == "dropped", "dropped").when(F.size("replacements") > 0, "replaced").otherwise("still_broken")
    return of.select("label", "allele", status.alias("status"), "replacements")


def against_common(alleles: DataFrame, common: DataFrame) -> DataFrame:
    """label, allele, where: of each set's alleles, with its broken ones replaced, which are common (`matching`), which aren't
    (`extra`), and which common ones it lacks (`missing`). Dropped and still broken alleles count nowhere."""
    whole = alleles.select("label", "allele").filter(state(F.col("allele")) == "whole")
    mended_ = broken_report(alleles, common).select("label", F.explode("replacements").alias("allele"))
    own = whole.union(mended_).distinct().withColumn("_own", F.lit(True))
    every = alleles.select("label").distinct().crossJoin(F.broadcast(common.select("allele").distinct())).withColumn("_common", F.lit(True))
    where = F.when(F.col("_own") & F.col("_common"), "matching").when(F.col("_own"), "extra").otherwise("missing")
    return own.join(every, ["label", "allele"], "full").select("label", "allele", where.alias("where"))


def subset_sources(rows: DataFrame, subset: DataFrame, name: str, source: str, own: str) -> DataFrame:
    """kind, n: how many different (name, source) of the names in subset are Viral (another source), Neoantigen (none) and Self (a
    source that contains the word `own`)."""
    pairs = rows.join(subset.select(name).distinct(), name, "left_semi").select(name, source).distinct()
    has, self_ = F.col(source).isNotNull(), F.coalesce(F.contains(F.col(source), F.lit(own)), F.lit(False))
    counts = pairs.agg(F.count_if(has & ~self_).alias("Viral"), F.count_if(~has).alias("Neoantigen"), F.count_if(self_).alias("Self"))
    return counts.select(F.inline(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in ("Viral", "Neoantigen", "Self")))))


def top_starred(rows: DataFrame, column: str, n: int) -> DataFrame:
    """The n most common values with a star, with their counts, ties by name; sort where written."""
    return rows.filter(F.contains(F.col(column), F.lit("*"))).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(n)
