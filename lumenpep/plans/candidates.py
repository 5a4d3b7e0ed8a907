"""From proteins or listed peptides to ranked candidates: one plan, made of the parts that are switched on.

A source is asked for only by a part that is on, so what is off isn't read, and nothing runs before a result is written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, fields
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ml.linear import Linear
from ..ml.workflow import predict
from ..operators import features, hla, peptides, similarity
from ..operators.running import positions
from ..scorers import Program, Scorer
from ..sources import files
from .stages import Stages

#: What a source may be: a table, a scorer that makes it from peptides, or a function that gives either when it is asked for.
Source = DataFrame | Scorer | Program | Callable[[], Any]


@dataclass(frozen=True)
class Config:
    """Switches and settings. The switches' names and defaults, and the default lengths and limits, are fixed values."""

    use_generatePeptides: bool = False
    use_customPeptides: bool = True
    use_tap: bool = True
    use_hlapred: bool = True
    use_mtec: bool = True
    use_pathogenicity: bool = True
    use_selfsimilarity: bool = True
    use_prime: bool = True
    use_deepimmuno: bool = True
    create_feature_table: bool = True
    use_ml_model: bool = True
    use_mhcflurry: bool = True
    use_mhcnuggets: bool = False
    use_netmhcpan: bool = True
    use_mixmhcpred: bool = True
    pepsickleCleavageThreshold: float | None = None
    peptide_lengths: tuple[int, ...] = (8, 9, 10, 11)
    min_peptide_length: int = 8
    max_peptide_length: int = 11
    filter: str = "all"
    mtec_expression_threshold: int = 5

    @staticmethod
    def of(settings: Mapping[str, Any]) -> Config:
        """From settings by name, lengths as `8-9-10-11` and a threshold as 'null' too; unknown names are an error."""
        known = {f.name for f in fields(Config)}
        if lost := sorted(set(settings) - known):
            raise ValueError(f"unknown settings: {', '.join(lost)}")
        out = dict(settings)
        if "peptide_lengths" in out:
            given = out["peptide_lengths"]
            out["peptide_lengths"] = tuple(int(x) for x in (given.split("-") if isinstance(given, str) else given))
        if out.get("pepsickleCleavageThreshold") == "null":
            out["pepsickleCleavageThreshold"] = None
        return Config(**out)

    def tools(self) -> tuple[str, ...]:
        on = {"NetMHCpan": self.use_netmhcpan, "MixMHCpred": self.use_mixmhcpred, "MHCFlurry": self.use_mhcflurry, "MHCnuggets": self.use_mhcnuggets}
        return tuple(t for t, used in on.items() if used)


class _Plan:
    def __init__(self, config: Config, sources: Mapping[str, Source], stages: Stages | None):
        if config.filter not in ("all", "noRefPeps"):
            raise ValueError(f"filter is all or noRefPeps, not {config.filter}")
        self.config, self.sources, self.stages = config, sources, stages
        self.tables: dict[str, DataFrame] = {}

    def source(self, name: str) -> Any:
        if name not in self.sources:
            raise ValueError(f"no source: {name}")
        of = self.sources[name]
        return of() if callable(of) else of

    def scored(self, name: str, wanted: DataFrame) -> DataFrame:
        """A source as a table: a scorer's answer for the wanted rows, or the rows that are there already."""
        of = self.source(name)
        return of if isinstance(of, DataFrame) else of.apply(wanted)

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        self.tables[name] = self.stages.table(name.replace("-", "_"), lambda: df, asdict(self.config)) if self.stages else df
        return self.tables[name]

    def keep_similar(self, name: str, wanted: DataFrame, to: str) -> DataFrame:
        """As keep(), by the two tables compared: planning alone counts them, which a table that is found saves."""
        refs = self.source(to)
        make = lambda: similarity.similarity(wanted, refs).withColumnRenamed("similarity", "similarity_score")
        self.tables[name] = self.stages.table(name, make, "similarity", [wanted, refs]) if self.stages else make()
        return self.tables[name]

    def candidates(self) -> DataFrame:
        c, parts = self.config, []
        if c.use_generatePeptides:
            parts.append(self.keep("generated", self.generated()))
        if c.use_customPeptides:
            parts.append(peptides.of_length(self.source("customPeptides").select(F.trim("peptide").alias("peptide")), c.min_peptide_length, c.max_peptide_length))
        if not parts:
            raise ValueError("neither generated nor custom peptides are switched on")
        all_ = parts[0].select("peptide")
        for p in parts[1:]:
            all_ = all_.union(p.select("peptide"))
        return self.keep("peptides", all_.distinct())

    def generated(self) -> DataFrame:
        """peptide, transcripts, n."""
        c = self.config
        records = self.source("inputFasta").select(peptides.transcript_id(F.col("header"), "inputFasta").alias("transcript"), "seq")
        if c.pepsickleCleavageThreshold is None:
            made = peptides.windows(records, c.peptide_lengths)
        else:
            cuts = self.scored("cleavage", records)
            p = F.col("p")
            made = peptides.cleaved(records, cuts.filter((p > c.pepsickleCleavageThreshold) | (p == 0)).select("transcript", "pos"), c.peptide_lengths)
        if c.filter == "noRefPeps":
            known = self.source("refProteome").select(peptides.gene_name(F.col("header")).alias("gene"), F.lit("").alias("transcript"), "seq")
            gone = self.source("genesToRemoveFromRef").select("gene") if "genesToRemoveFromRef" in self.sources else known.select("gene").limit(0)
            made = peptides.novel(made, peptides.reference_set(known, gone, c.peptide_lengths))
        return peptides.transcripts(made)

    def alleles(self) -> DataFrame:
        """All alleles once: the common ones and those of the input."""
        out = self.source("commonAlleles").select("allele")
        return (out.union(self.source("inputAlleles").select("allele")) if "inputAlleles" in self.sources else out).select(F.trim("allele").alias("allele")).filter("allele <> ''").distinct()

    def ranks(self, wanted: DataFrame, most: int = 10_000) -> DataFrame:
        """Consolidated ranks with those of each tool. The common alleles are a list of `most` at most; more are an error."""
        common = [r[0] for r in self.source("commonAlleles").select("allele").distinct().limit(most + 1).collect()]
        if len(common) > most:
            raise ValueError(f"more than {most} common alleles")
        chosen = hla.chosen(self.scored("ranks", wanted), None, self.config.tools())
        tools = [t for t in hla.NAMES if t in self.config.tools()]
        return hla.consolidate(chosen, common, tools=tools)

    def immunogenicity(self, wanted: DataFrame) -> DataFrame:
        parts = peptides.fragments(wanted, self.alleles())
        scores = self.scored("deepimmuno", parts.select("fragment", "allele").distinct())
        of = parts.join(scores, ["fragment", "allele"]).select("parent", "fragment", "allele", "score")
        return hla.best_by_gene(peptides.regroup(of)).withColumnRenamed("parent", "peptide")

    def counts(self, wanted: DataFrame) -> DataFrame:
        return peptides.occurrences(wanted, self.source("mtec_files"), self.config.peptide_lengths).withColumnRenamed("count", "total")

    def features(self, wanted: DataFrame) -> DataFrame:
        """Every peptide with the columns of all parts that are on."""
        c, of = self.config, features.of_tool
        frames = [wanted.select("peptide")]
        if c.use_hlapred:
            frames.append(features.of_ranks(self.keep("hla", self.ranks(wanted))))
        if c.use_mtec:
            totals = self.keep("mtec", self.counts(wanted))
            self.tables["mtec_expression"] = peptides.expression_class(totals, c.mtec_expression_threshold)
            frames.append(of(totals, "mtec"))
        if c.use_pathogenicity:
            frames.append(of(self.keep_similar("pathogenicity", wanted, "iedb_peptides"), "pathogenicity"))
        if c.use_deepimmuno:
            frames.append(of(self.keep("deepimmuno", self.immunogenicity(wanted)), "deepimmuno"))
        if c.use_prime:
            found = self.scored("prime", wanted)
            frames.append(of(self.keep("prime", found.toDF("Peptide", "%Rank_bestAllele")), "prime"))
        if c.use_selfsimilarity:
            frames.append(of(self.keep_similar("selfsimilarity", wanted, "benign_self_peptides"), "selfsimilarity"))
        if c.use_tap:
            frames.append(of(self.keep("tap", self.scored("tap", wanted).toDF("peptide", "pred_score")), "tap"))
        return features.combined(frames)

    def ranking(self, table: DataFrame) -> DataFrame:
        """Feature rows with prediction, probability_immunogenic and rank, from 1 by falling probability and then peptide."""
        of = table if "length" in table.columns else table.withColumn("length", F.length("peptide"))
        model = self.source("model")
        names = list(model.features) if isinstance(model, Linear) else model[1]["features"]
        scored = model.predict(of) if isinstance(model, Linear) else predict(model[0], of, names)
        placed = positions(scored.withColumnRenamed("peptide", "id")).drop("n")
        allele = [F.col("best_allele").alias("best_binding_allele")] if "best_allele" in placed.columns else []
        return placed.select(F.col("id").alias("peptide"), "prediction", F.col("score").alias("probability_immunogenic"), *allele, *(F.col(f"`{c}`") for c in names if c != "peptide"), F.col("at").alias("rank"))


def pipeline(config: Config, sources: Mapping[str, Source], stages: Stages | None = None) -> dict[str, DataFrame]:
    """The tables of the parts that are on, by name: generated, peptides, hla, mtec, mtec_expression, pathogenicity,
    deepimmuno, prime, selfsimilarity, tap, feature_table and ranked.

    Sources by name: inputFasta (header, seq), cleavage (transcript, pos, p), refProteome (header, seq), genesToRemoveFromRef
    (gene), customPeptides (peptide), commonAlleles and inputAlleles (allele), ranks (peptide, allele, tool, col_ord, rank), tap
    (peptide, score), mtec_files (seq), iedb_peptides and benign_self_peptides (seq), deepimmuno (fragment, allele, score), prime
    (peptide, rank) and model (a Linear, or a fitted pipeline and its metadata). cleavage, ranks, tap, deepimmuno and prime may
    be scorers. With stages, each part's table is written as soon as it is planned, and found again by a rerun.
    """
    plan = _Plan(config, sources, stages)
    wanted = plan.candidates()
    if config.create_feature_table:
        table = plan.keep("feature_table", plan.features(wanted))
        if config.use_ml_model:
            plan.keep("ranked", plan.ranking(table))
    return plan.tables


def from_paths(spark, paths: Mapping[str, str], ready: Mapping[str, Source] | None = None) -> dict[str, Source]:
    """Sources that are opened when they are asked for, from files in the tools' formats; those of ready stand as they are."""
    read = {
        "inputFasta": files.fasta,
        "refProteome": files.fasta,
        "cleavage": lambda s, p: files.cut_sites(s, p),
        "genesToRemoveFromRef": lambda s, p: files.peptides(s, p).withColumnRenamed("peptide", "gene"),
        "customPeptides": files.peptides,
        "commonAlleles": lambda s, p: files.peptides(s, p).withColumnRenamed("peptide", "allele"),
        "inputAlleles": lambda s, p: files.peptides(s, p).withColumnRenamed("peptide", "allele"),
        "ranks": lambda s, p: hla.batches(*(files.ranks(s, x) for x in p.split(","))),
        "tap": files.tap,
        "mtec_files": files.reads,
        "iedb_peptides": files.reference,
        "benign_self_peptides": files.reference,
        "deepimmuno": files.cnn,
        "prime": files.prime,
        "model": lambda s, p: Linear.of(files.json_file(s, p)),
    }
    if lost := sorted(set(paths) - set(read)):
        raise ValueError(f"unknown sources: {', '.join(lost)}")
    return {n: (lambda n=n, p=p: read[n](spark, p)) for n, p in paths.items()} | dict(ready or {})


def publish(tables: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Writes each table as CSV under a folder named by its name up to the first underscore; gives the paths. Lists within
    cells are joined by semicolons."""
    out = []
    for name, df in tables.items():
        cells = [F.array_join(F.col(f"`{f.name}`").cast("array<string>"), ";").alias(f.name) if f.dataType.typeName() == "array" else F.col(f"`{f.name}`") for f in df.schema]
        out.append(f"{folder.rstrip('/')}/{files.folder_of(name)}/{name}")
        df.select(*cells).write.mode("overwrite").csv(out[-1], header=True)
    return out
