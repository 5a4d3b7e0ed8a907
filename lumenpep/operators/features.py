"""The feature table: first-wins deduplication and the N-way full outer join on the peptide."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hla import NAMES


def first_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("_rn = 1").drop("_rn")


def feature_table(frames: list[DataFrame], key: str = "peptide") -> DataFrame:
    return reduce(lambda a, b: a.join(b, key, "full"), frames)


def scrub_headers(df: DataFrame, key: str = "peptide") -> DataFrame:
    return df.filter(~F.contains(F.col(key), F.lit("pep")))


def require(df: DataFrame, *columns: str) -> DataFrame:
    if lost := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(lost)}")
    return df


#: Columns of the tools' outputs and what the feature table calls them.
COLUMNS = {
    "mtec": {"peptide": "peptide", "total": "mtec_expression_count"},
    "pathogenicity": {"peptide": "peptide", "similarity_score": "pathogenicity"},
    "selfsimilarity": {"peptide": "peptide", "similarity_score": "selfsimilarity"},
    "deepimmuno": {
        "peptide": "peptide",
        "best_immunogenicity": "di_best_score",
        "avg_immunogenicity": "di_avg_score",
        "best_hla_a": "di_best_a_score",
        "avg_hla_a": "di_avg_a_score",
        "best_hla_b": "di_best_b_score",
        "avg_hla_b": "di_avg_b_score",
        "best_hla_c": "di_best_c_score",
        "avg_hla_c": "di_avg_c_score",
    },
    "prime": {"Peptide": "peptide", "%Rank_bestAllele": "PRIME_%Rank_bestAllele"},
    "tap": {"peptide": "peptide", "pred_score": "tap_score"},
}
#: What the feature table takes of consolidated ranks, as far as it is there.
RANK_COLUMNS = ("best_rank", "avg_rank", "strong_binders_count", "weak_binders_count", "Num_Tools_0_05", "Num_Tools_0_10", "Num_Tools_0_50", "all_strong_binders", "all_weak_binders")


def of_tool(df: DataFrame, tool: str, order: str | None = None) -> DataFrame:
    """A tool's output with the feature table's names; where order is given, the first row of each peptide."""
    names = COLUMNS[tool]
    of = require(df, *names).select(*(F.col(f"`{a}`").alias(b) for a, b in names.items()), *([F.col(order)] if order else []))
    return first_rows(of, "peptide", order).drop(order) if order else of


def of_ranks(df: DataFrame, order: str | None = None) -> DataFrame:
    """Consolidated ranks with the columns that the feature table takes: those of all tools, then each tool's best rank and allele."""
    tools = [c for short in NAMES.values() for c in (f"best_{short}_r", f"{short}_a")]
    of = require(df, "peptide").select("peptide", *(c for c in (*RANK_COLUMNS, *tools) if c in df.columns), *([order] if order else []))
    return first_rows(of, "peptide", order).drop(order) if order else of


def combined(frames: list[DataFrame], key: str = "peptide") -> DataFrame:
    """feature_table() in one shuffle: rows of all frames, which have a row a key and columns of their own, are added up by
    key, where a chain of outer joins would deal its rows anew for each frame. Rows without a key are one row."""
    names = [c for f in frames for c in f.columns if c != key]
    if len(set(names)) < len(names):
        raise ValueError(f"columns in two frames: {', '.join(sorted({c for c in names if names.count(c) > 1}))}")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.groupBy(key).agg(*(F.max(f"`{c}`").alias(c) for c in names))


def united(frames: list[DataFrame], key: str = "peptide") -> DataFrame:
    """Rows of all frames, columns by name; of a key the row of the first frame that has it. An order within a frame is
    column _ord, if it has one."""
    tagged = [f.withColumn("_frame", F.lit(i)) for i, f in enumerate(frames)]
    of = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    order = ["_frame", *(["_ord"] if "_ord" in of.columns else [])]
    return of.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_rn = 1").drop("_rn", "_frame", "_ord")


def with_scores(df: DataFrame, scores: DataFrame, order: str, key: str = "peptide") -> DataFrame:
    """Rows of df that have a row in scores, with its first one's columns."""
    return df.join(first_rows(scores, key, order).drop(order), key)


def grouped(df: DataFrame, groups: DataFrame, key: str = "peptide") -> DataFrame:
    """df with group by groups (key, group, place): where a key is in several groups, the last place counts."""
    return df.join(groups.groupBy(key).agg(F.max_by("group", "place").alias("group")), key, "left")


def ranked_without_last(df: DataFrame, score: str) -> DataFrame:
    """Rows by falling score, without the last column."""
    return df.orderBy(F.desc(score)).drop(df.columns[-1])


def scored_only(df: DataFrame, score: str) -> DataFrame:
    """Rows whose score is a number."""
    return df.withColumn(score, F.col(score).try_cast("double")).filter(F.col(score).isNotNull() & ~F.isnan(score))
