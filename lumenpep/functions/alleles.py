"""HLA allele names and residue checks as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 20 standard residues, in alphabetical one-letter order.
RESIDUES = "ACDEFGHIKLMNPQRSTVWY"


#: What figures call a result whose name contains a feature's.
FIGURE_NAMES = {"avg_rank": "HLA Rank", "weak_binders_count": "HLA WBC", "mtec_expression_count": "mTEC Expr.", "pathogenicity": "Viral Similarity", "di_best_score": "DeepImmuno", "PRIME_%Rank_bestAllele": "PRIME Rank"}


def valid(peptide: Column) -> Column:
    return peptide.rlike(f"^[{RESIDUES}]+$")


def to_cnn(allele: Column) -> Column:
    """`HLA-C07:04` -> `HLA-C*0704`: letters of the gene, a star, and the rest from its first digit on without colons. Any other
    form is an error when the result is read; null stays null."""
    form = r"^(HLA-[A-Za-z]+)([0-9].*)$"
    said = F.concat(F.lit("not HLA-<gene><digits>: "), allele)
    made = F.concat(F.regexp_extract(allele, form, 1), F.lit("*"), F.replace(F.regexp_extract(allele, form, 2), F.lit(":")))
    return F.when(allele.isNull() | allele.rlike(form), made).otherwise(F.raise_error(said))


def to_prime(allele: Column) -> Column:
    """The text after the first hyphen, without colons."""
    return F.replace(F.split_part(allele, F.lit("-"), F.lit(2)), F.lit(":"))


def gene(allele: Column) -> Column:
    return F.upper(F.regexp_extract(allele, r"^HLA-?\*?([A-Za-z]+)", 1))


def of_column(name: Column) -> Column:
    """The allele in a rank column's name."""
    return F.regexp_extract(name, r"^(HLA-[^_]+)", 1)


def normalise(allele: Column) -> Column:
    """Cw to C, a single last digit after a letter padded, and the star between gene and number."""
    out = F.regexp_replace(allele, "Cw", "C")
    out = F.regexp_replace(out, r"(?<=[A-Za-z])([0-9])$", "0$1")
    return F.regexp_replace(out, r"(?<=-)([A-Za-z]+)([0-9])", "$1*$2")


def state(allele: Column) -> Column:
    """whole (has a colon), broken (none, but a hyphen) or dropped."""
    return F.when(F.contains(allele, F.lit(":")), "whole").when(F.contains(allele, F.lit("-")), "broken").otherwise("dropped")


def shown_name(name: Column, names: dict[str, str] | None = None) -> Column:
    """A result's name in a figure: that of the first feature that it contains, `HGB model` for one that contains hgb or full, and
    any other as it is."""
    out = F.when(F.lit(False), F.lit(""))
    for part, shown in (names or FIGURE_NAMES).items():
        out = out.when(F.contains(name, F.lit(part)), shown)
    return out.when(name.rlike("hgb|full"), "HGB model").otherwise(name)
