"""Consolidation of binding ranks: (peptide, allele, tool, col_ord, rank) -> a row for each peptide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.alleles import gene

#: Names of the columns that count tools, and their levels; names of tools' columns.
LEVELS = {"Num_Tools_0_01": 0.01, "Num_Tools_0_02": 0.02, "Num_Tools_0_03": 0.03, "Num_Tools_0_04": 0.04, "Num_Tools_0_05": 0.05, "Num_Tools_0_10": 0.1, "Num_Tools_0_50": 0.5, "Num_Tools_1": 1.0, "Num_Tools_2": 2.0}
TOOLS = ("NetMHCpan", "MixMHCpred", "MHCFlurry")
NAMES = {"NetMHCpan": "netmhc", "MixMHCpred": "mixmhc", "MHCFlurry": "mhcflurry", "MHCnuggets": "mhcnuggets"}


def batches(*frames: DataFrame) -> DataFrame:
    """Union of long batches; an (allele, tool) pair in two of them is an error when the result is read."""
    out, pairs = frames[0], frames[0].select("allele", "tool", F.lit(0).alias("batch"))
    for i, f in enumerate(frames[1:], 1):
        out, pairs = out.unionByName(f), pairs.union(f.select("allele", "tool", F.lit(i)))
    said = F.concat(F.lit("in two batches: "), F.coalesce("allele", F.lit("")), F.lit(" "), F.coalesce("tool", F.lit("")))
    fine = pairs.groupBy("allele", "tool").agg(F.count_distinct("batch").alias("n")).agg(F.count_if(F.when(F.col("n") > 1, F.raise_error(said)).otherwise(F.lit(True)).cast("boolean")).alias("_pairs"))
    return out.crossJoin(F.broadcast(fine)).filter("_pairs >= 0").drop("_pairs")


def chosen(ranks: DataFrame, alleles: list[str] | None = None, tools: tuple[str, ...] | None = TOOLS) -> DataFrame:
    """The ranks of these alleles and tools; None stands for all. Peptides with ranks of others alone stay, with null ranks."""
    fits = (F.col("allele").isin(alleles) if alleles is not None else F.lit(True)) & (F.col("tool").isin(*tools) if tools is not None else F.lit(True))
    return ranks.withColumn("rank", F.when(fits, F.col("rank"))).withColumn("tool", F.when(fits, F.col("tool"))).withColumn("allele", F.when(fits, F.col("allele")))


def consolidate(ranks: DataFrame, common: list[str], strong: float = 0.5, weak: float = 2.0, tools: list[str] = ()) -> DataFrame:
    """Two aggregations: by peptide and tool, then by peptide. A null rank counts nowhere. For each of tools, its best rank and
    allele, as by_tool() names them."""
    r, near = F.col("rank"), F.col("allele").isin(common)
    sure = F.when(r.isNotNull(), F.struct(r.alias("rank"), F.col("col_ord").alias("ord"), F.col("allele").alias("allele")))
    names = lambda t: F.collect_set(F.when(r < t, F.col("allele")))
    by_tool = ranks.groupBy("peptide", "tool").agg(F.min("rank").alias("best"), F.min(sure).alias("arg"), names(strong).alias("s"), names(weak).alias("w"), F.count_if(near & (r < strong)).alias("ns"), F.count_if(near & (r < weak)).alias("nw"), F.min(F.when(near, r)).alias("near"))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), ";")
    return by_tool.groupBy("peptide").agg(
        F.min("best").alias("best_rank"), F.round(F.avg("best"), 6).alias("avg_rank"), F.min("arg")["allele"].alias("best_allele"), F.sum("ns").alias("strong_binders_count"), F.sum("nw").alias("weak_binders_count"),
        joined("s").alias("all_strong_binders"), joined("w").alias("all_weak_binders"), *(F.count_if(F.col("near") < t).alias(c) for c, t in LEVELS.items()),
        *(c for t in tools for c in (F.max(F.when(F.col("tool") == t, F.col("arg")["rank"])).alias(f"best_{_short(t)}_r"), F.max(F.when(F.col("tool") == t, F.col("arg")["allele"])).alias(f"{_short(t)}_a"))),
    )


def _short(tool: str) -> str:
    return NAMES.get(tool, tool.lower())


def by_tool(ranks: DataFrame, tools: list[str]) -> DataFrame:
    """peptide, and for each tool its best rank and allele, under its short name where it has one."""
    of = lambda t: F.min(F.when((F.col("tool") == t) & F.col("rank").isNotNull(), F.struct("rank", "col_ord", "allele")))
    return ranks.groupBy("peptide").agg(*(c for t in tools for c in (of(t)["rank"].alias(f"best_{_short(t)}_r"), of(t)["allele"].alias(f"{_short(t)}_a"))))


def best_by_gene(scores: DataFrame, genes: str = "ABC") -> DataFrame:
    """parent, the best and mean score over its alleles (parent, allele, score), and over those of each gene."""
    of = scores.withColumn("gene", gene(F.col("allele")))
    one = lambda g: F.when(F.col("gene") == g, F.col("score"))
    each = [c for g in genes for c in (F.max(one(g)).alias(f"best_hla_{g.lower()}"), F.round(F.avg(one(g)), 6).alias(f"avg_hla_{g.lower()}"))]
    return of.groupBy("parent").agg(F.max("score").alias("best_immunogenicity"), F.round(F.avg("score"), 6).alias("avg_immunogenicity"), *each)
