"""Readers and writers of the file formats that peptide tools exchange."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.alleles import RESIDUES, valid

RANK = re.compile(r"^(HLA-[^_]+)_(.+)_%Rank$")


def fasta(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """header, seq. strict drops blanks in sequences, and records without a sequence."""
    raw = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", r"^>|\r", "").alias("r")).filter(F.trim("r") != "")
    cut = F.split("r", "\n", 2)
    lines = F.transform(F.split(F.coalesce(F.get(cut, 1), F.lit("")), "\n"), F.trim)
    out = raw.select(F.trim(cut[0]).alias("header"), F.array_join(lines, "").alias("seq"))
    return out.withColumn("seq", F.regexp_replace("seq", r"\s", "")).filter("seq <> ''") if strict else out


def is_fasta(spark: SparkSession, path: str) -> bool:
    first = spark.read.text(path).filter(F.trim("value") != "").head()
    return bool(first) and first[0].lstrip().startswith(">")


def peptides(spark: SparkSession, path: str, upper: bool = False) -> DataFrame:
    out = spark.read.text(path).select(F.trim("value").alias("peptide")).filter("peptide <> ''")
    return out.withColumn("peptide", F.upper("peptide")) if upper else out


def reference(spark: SparkSession, path: str) -> DataFrame:
    """One sequence a line; lines with anything but standard residues go, headers among them."""
    return peptides(spark, path).filter(valid(F.col("peptide"))).withColumnRenamed("peptide", "seq")


def cut_sites(spark: SparkSession, path: str) -> DataFrame:
    """transcript, pos, p of the lines (position, residue, probability, flag, protein); one that begins with p is the header."""
    part = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).filter(~F.startswith(F.col("value"), F.lit("p")) & (F.trim("value") != ""))
    return rows.select(F.get(part, 4).alias("transcript"), F.get(part, 0).try_cast("int").alias("pos"), F.get(part, 2).try_cast("double").alias("p"))


def cleavage(spark: SparkSession, path: str, threshold: float) -> DataFrame:
    """transcript, pos of the sites that count as cut: above the threshold or exactly 0, which marks an end."""
    return cut_sites(spark, path).filter((F.col("p") > threshold) | (F.col("p") == 0)).select("transcript", "pos")


def ranks(spark: SparkSession, path: str) -> DataFrame:
    """Wide batch of rank columns -> peptide, allele, tool, col_ord, rank; missing and NaN ranks as null."""
    wide = spark.read.csv(path, sep="\t", header=True)
    if "peptide" not in wide.columns:
        raise ValueError("no column peptide")
    found = [(c, *RANK.match(c).groups()) for c in wide.columns if RANK.match(c)]
    cells = F.array(*(F.struct(F.lit(a).alias("allele"), F.lit(t).alias("tool"), F.lit(i).alias("col_ord"), F.nanvl(F.col(f"`{c}`").try_cast("double"), F.lit(None)).alias("rank")) for i, (c, a, t) in enumerate(found)))
    return wide.select("peptide", F.inline(cells))


def gff(spark: SparkSession, path: str) -> DataFrame:
    """name: attribute Name of column 9, a last `-number` off."""
    of = spark.read.csv(path, sep="\t", comment="#").select(F.str_to_map("_c8", F.lit(";"), F.lit("="))["Name"].alias("name"))
    return of.select(F.regexp_replace("name", r"-\d+$", "").alias("name")).filter("name IS NOT NULL")


def reads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.upper(F.trim("value")).alias("seq"), F.col("_metadata.file_name").alias("file")).filter("seq <> ''")


def table(spark: SparkSession, path: str, sep: str = ",", comment: str | None = None, schema: str | None = None) -> DataFrame:
    r = spark.read.schema(schema) if schema else spark.read
    return r.csv(path, sep=sep, header=True, **({"comment": comment} if comment else {}))


def tap(spark: SparkSession, path: str) -> DataFrame:
    """peptide, tap_score; cells that hold no number as null."""
    return table(spark, path).select("peptide", F.col("pred_score").try_cast("double").alias("tap_score"))


def prime(spark: SparkSession, path: str) -> DataFrame:
    """Peptide and %Rank_bestAllele, under these names."""
    return table(spark, path, "\t", "#").select("Peptide", F.col("`%Rank_bestAllele`").try_cast("double").alias("%Rank_bestAllele"))


def cnn(spark: SparkSession, path: str) -> DataFrame:
    """fragment, allele, score of the network's table (peptide, HLA, immunogenicity); rows without a number go."""
    of = table(spark, path, "\t").select(F.trim("peptide").alias("fragment"), F.trim("HLA").alias("allele"), F.col("immunogenicity").try_cast("double").alias("score"))
    return of.filter("fragment <> '' AND allele <> '' AND score IS NOT NULL")


def yaml_file(spark: SparkSession, path: str) -> dict:
    """A small YAML file of settings from any store that Spark reads; needs PyYAML."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML needs PyYAML; json_file reads the same settings as JSON") from e
    return yaml.safe_load("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())) or {}


def strict_reference(spark: SparkSession, path: str) -> DataFrame:
    """seq of FASTA records, upper case or not as written; records with anything but standard residues go."""
    return fasta(spark, path).select("seq").filter(valid(F.col("seq")))


def feature_list(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        out = [x for x in (line.split("#")[0].strip() for line in f) if x]
    if not out:
        raise ValueError(f"{path} lists no features")
    return out


def wrapped(seq: Column, width: int = 60) -> Column:
    return F.rtrim(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), F.lit("\n"))


def write_fasta(df: DataFrame, path: str) -> None:
    df.select(F.concat(F.lit(">"), "header", F.lit("\n"), wrapped(F.col("seq")))).write.text(path)


def write_lines(df: DataFrame, path: str, column: str = "peptide") -> None:
    """One value a line; rows without one get none."""
    df.filter(F.col(column).isNotNull()).select(F.col(column).cast("string")).write.text(path)


def common_alleles(pages: DataFrame, column: str = "html") -> DataFrame:
    """allele: the first label's text of each list item of class `common` (as a word of its own), in the first list of a
    stored page that has the attribute data-alleles-container."""
    lists = F.regexp_extract(F.col(column), r"(?is)<ul\b(?=[^>]*\sdata-alleles-container[\s=>])[^>]*>(.*?)</ul>", 1)
    item = r"(?is)<li\b(?=[^>]*\sclass\s*=\s*(?:\"(?:[^\">]*\s)?common(?:\s[^\">]*)?\"|'(?:[^'>]*\s)?common(?:\s[^'>]*)?'|common[\s>]))[^>]*>((?:(?!<li\b).)*?<label[^>]*>.*?)</label>"
    items = F.regexp_extract_all(lists, F.lit(item), F.lit(1))
    text = F.regexp_replace(F.regexp_replace("item", r"(?is)^.*<label[^>]*>", ""), r"(?s)<[^>]*>", "")
    return pages.select(F.explode(items).alias("item")).select(F.trim(text).alias("allele")).filter("allele <> ''")


def with_length_of_file(df: DataFrame) -> DataFrame:
    """df, read from files, with the length that a file's name tells (`9mers`)."""
    return df.withColumn("length", F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)mers", 1).try_cast("int"))


def folder_of(name: str) -> str:
    """Where a result goes: the file's name without ending, up to its first underscore."""
    return name.rsplit("/", 1)[-1].split(".", 1)[0].split("_", 1)[0]


def json_file(spark: SparkSession, path: str) -> dict:
    """A small JSON file from any store that Spark reads: metadata of a model, or settings."""
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def merged_settings(base: dict, over: dict) -> dict:
    """Settings of all, with those of one on top, level by level."""
    return base | {k: merged_settings(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in over.items()}


def write_by_length(df: DataFrame, path: str, column: str = "peptide") -> None:
    """One folder a length; lengths without rows get none, and no rows at all are an error."""
    if df.isEmpty():
        raise ValueError("nothing to write")
    df.withColumn("length", F.length(column)).write.partitionBy("length").csv(path)


__all__ = ["RESIDUES", "cleavage", "fasta", "feature_list", "gff", "is_fasta", "peptides", "ranks", "reads", "reference", "table", "wrapped", "write_by_length", "write_fasta"]
