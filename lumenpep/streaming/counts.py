"""Occurrence counts over read files as they arrive (an addition to the batch operator)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.peptides import LENGTHS


def running_counts(spark: SparkSession, folder: str, peptides: DataFrame, lengths=LENGTHS) -> DataFrame:
    """A streaming frame peptide, count, for output mode update or complete."""
    reads = spark.readStream.text(folder).select(F.upper(F.trim("value")).alias("seq"))
    at = reads.select("seq", F.explode(F.array(*(F.lit(k) for k in lengths))).alias("k")).filter("length(seq) >= k")
    at = at.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("seq") - F.col("k") + 1), lambda i: F.substring(F.col("seq"), i, F.col("k")))).alias("peptide"))
    return at.join(peptides.select("peptide").distinct(), "peptide").groupBy("peptide").count()
