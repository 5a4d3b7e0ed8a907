"""Peptides from proteins: windows, cleavage, transcripts, reference filter, counts and fragments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.alleles import to_cnn, valid
from ..session import written
from .places import Shape, met, smallest
from .running import running
from .windows import cut, marks

LENGTHS = (8, 9, 10, 11)


def windows(proteins: DataFrame, lengths=LENGTHS, distinct: bool = True) -> DataFrame:
    """transcript, peptide for proteins (transcript, seq): all windows of standard residues, each once a protein where
    distinct. A sequence shorter than a length has none of it. Windows are made and made distinct within a row, without a
    shuffle, in time proportional to the sequence."""
    return cut(proteins.select("transcript", "seq"), lengths, distinct)


def cleaved(proteins: DataFrame, cuts: DataFrame, lengths=LENGTHS) -> DataFrame:
    """Windows that end right before a cut's position; for transcripts without cuts, all windows."""
    at = proteins.join(cuts, "transcript").select("transcript", "seq", "pos", F.explode(F.array(*(F.lit(k) for k in lengths))).alias("k"))
    ends = at.filter("pos - 1 - k >= 0 AND pos - 1 <= length(seq)").select("transcript", F.substring(F.col("seq"), F.col("pos") - F.col("k"), F.col("k")).alias("peptide"))
    ends = ends.filter(valid(F.col("peptide"))).distinct()
    return ends.union(windows(proteins.join(cuts.select("transcript").distinct(), "transcript", "left_anti"), lengths))


def transcript_id(header: Column, kind: str) -> Column:
    """kind: pepsickle (first token), inputFasta (before the first pipe), referenceProteome (second field, no version)."""
    if kind == "pepsickle":
        return F.split_part(F.trim(header), F.lit(" "), F.lit(1))
    if kind == "inputFasta":
        return F.when(F.instr(header, "|") > 0, F.split_part(header, F.lit("|"), F.lit(1))).otherwise(F.raise_error(F.lit("no pipe in header")))
    return F.split_part(F.split_part(header, F.lit("|"), F.lit(2)), F.lit("."), F.lit(1))


def gene_name(header: Column) -> Column:
    h = F.ltrim(header, F.lit(">"))
    return F.when(h.startswith("ENSP"), F.split_part(h, F.lit("|"), F.lit(7))).when(h.startswith("sp"), F.split_part(F.split_part(h, F.lit("="), F.lit(4)), F.lit(" "), F.lit(1))).otherwise(F.raise_error(F.lit("unknown header")))


def transcripts(peptides: DataFrame) -> DataFrame:
    """peptide, transcripts (sorted), n. For a peptide of very many transcripts, count without the list."""
    return peptides.groupBy("peptide").agg(F.sort_array(F.collect_list("transcript")).alias("transcripts"), F.count("*").alias("n"))


def transcript_counts(peptides: DataFrame) -> DataFrame:
    """peptide, n, first, last: transcripts() without the lists, so tasks add up before they meet."""
    return peptides.groupBy("peptide").agg(F.count("*").alias("n"), F.min("transcript").alias("first"), F.max("transcript").alias("last"))


def letters(texts: DataFrame) -> DataFrame:
    """Texts (seq) as sequences: their letters A to Z, in upper case."""
    return texts.withColumn("seq", F.upper(F.regexp_replace("seq", "[^A-Za-z]", "")))


def counted(proteins: DataFrame, lengths=LENGTHS, text: bool = False) -> DataFrame:
    """transcript_counts() of all windows of proteins (transcript, seq), which meet as numbers where transcripts are whole numbers; with
    text, of letters()."""
    if Shape(lengths).fits() and proteins.schema["transcript"].dataType.typeName() in ("byte", "short", "integer", "long"):
        kind = proteins.schema["transcript"].dataType
        found = met(proteins, lengths=lengths, names=("n", "first", "last"), text=text)
        return found.select("peptide", "n", F.col("first").cast(kind).alias("first"), F.col("last").cast(kind).alias("last"))
    return transcript_counts(windows(letters(proteins) if text else proteins, lengths))


def counted_novel(proteins: DataFrame, known: DataFrame, lengths=LENGTHS, text: bool = False) -> DataFrame:
    """peptide, n: how many of the proteins (transcript, seq) have each window that no known protein (seq) has."""
    if Shape(lengths).fits():
        return met(proteins, known, lengths, ("n",), without=True, text=text)
    proteins, known = (letters(x) if text else x for x in (proteins, known))
    found = windows(proteins, lengths).groupBy("peptide").agg(F.count("*").alias("n"))
    return novel(found, windows(known.select(F.lit(0).alias("transcript"), "seq"), lengths, distinct=False).select("peptide").distinct())


def occurrences_of_windows(proteins: DataFrame, reads: DataFrame, lengths=LENGTHS, text: bool = False) -> DataFrame:
    """occurrences() of all windows of proteins (seq) in the reads (seq)."""
    if Shape(lengths).fits():
        return met(proteins, reads, lengths, ("count",), text=text, per_row=False)
    proteins, reads = (letters(x) if text else x for x in (proteins, reads))
    return occurrences(windows(proteins.select(F.lit(0).alias("transcript"), "seq"), lengths).select("peptide"), reads, lengths, most=0)


def reference_set(proteins: DataFrame, excluded: DataFrame, lengths=LENGTHS) -> DataFrame:
    """Distinct windows of the proteins (transcript, seq, gene) whose gene isn't excluded."""
    return windows(proteins.join(excluded, "gene", "left_anti"), lengths, distinct=False).select("peptide").distinct()


def novel(peptides: DataFrame, known: DataFrame) -> DataFrame:
    return peptides.join(known.select("peptide"), "peptide", "left_anti")


def occurrences(peptides: DataFrame, reads: DataFrame, lengths=LENGTHS, by: list[str] | None = None, most: int = 1_000_000) -> DataFrame:
    """How often each peptide occurs in the reads (seq, and the columns of by), overlaps counted; zero where it doesn't.
    Reads turn into windows and meet the peptides by equality. Up to `most` peptides go to every task, which drops all other windows
    before any are shuffled, nearly all of them as soon as they are cut, where the peptides are of standard residues; more, or any number with a `most` of 0, which saves counting them, meet the windows in one shuffle."""
    few, standard = False, False
    if most:
        wanted = peptides.select("peptide").distinct()
        seen = wanted.limit(most + 1).agg(F.count("*").alias("n"), F.count_if(~valid(F.col("peptide"))).alias("other")).head()
        few, standard = seen["n"] <= most, seen["n"] <= most and not seen["other"]
    marked = marks(wanted.filter(valid(F.col("peptide"))).limit(most).toArrow().column(0).to_pylist()) if standard else None
    at = cut(reads.select(*(by or []), "seq"), lengths, distinct=False, standard=standard, marked=marked)
    if not few and not by:
        rows = peptides.select("peptide", F.lit(1).alias("wanted"), F.lit(0).cast("long").alias("n")).union(at.select("peptide", F.lit(0), F.lit(1).cast("long")))
        return rows.groupBy("peptide").agg(F.max("wanted").alias("wanted"), F.sum("n").alias("count")).filter("wanted = 1").select("peptide", "count")
    wanted = peptides.select("peptide").distinct()
    if few:
        counts = at.join(F.broadcast(wanted), "peptide", "left_semi").groupBy(*(by or []), "peptide").count()
    else:
        counts = at.groupBy(*(by or []), "peptide").count().join(wanted, "peptide", "left_semi")
    return wanted.join(counts, "peptide", "left") if by else wanted.join(counts, "peptide", "left").select("peptide", F.coalesce("count", F.lit(0)).alias("count"))


def merged(counts: DataFrame, files: list[str], file: str = "file") -> DataFrame:
    """peptide, a count for each file, total."""
    sums = [F.coalesce(F.sum(F.when(F.col(file) == f, F.col("count"))), F.lit(0)).alias(f"count_{f}") for f in files]
    return counts.groupBy("peptide").agg(*sums, F.coalesce(F.sum("count"), F.lit(0)).alias("total"))


def expression_class(totals: DataFrame, threshold: int = 5) -> DataFrame:
    return totals.select("peptide", (F.col("total") > threshold).cast("int").alias("mtec_expression"))


def fragments(peptides: DataFrame, alleles: DataFrame, most: int = 10_000) -> DataFrame:
    """parent, fragment, allele: peptides of 9 and 10 as they are, 11 as its two runs of 10, with each allele. The alleles
    are a list of `most` at most; more are an error."""
    if len(alleles.limit(most + 1).collect()) > most:
        raise ValueError(f"more than {most} alleles")
    p = F.col("peptide")
    parts = F.when(F.length(p) == 11, F.array(F.substring(p, 1, 10), F.substring(p, 2, 10))).when(F.length(p).isin(9, 10), F.array(p))
    return peptides.select(p.alias("parent"), F.explode(parts).alias("fragment")).crossJoin(F.broadcast(alleles.select(to_cnn(F.col("allele")).alias("allele"))))


def regroup(scores: DataFrame) -> DataFrame:
    """parent, allele, score for scores (parent, fragment, allele, score): the better of a parent's fragments."""
    return scores.groupBy("parent", "allele").agg(F.max("score").alias("score"))


def quotas(total: int, ratios: dict[int, float]) -> dict[int, int]:
    """Whole numbers that add up to total, by largest remainder."""
    share = {k: total * r / sum(ratios.values()) for k, r in ratios.items()}
    out = {k: int(v) for k, v in share.items()}
    for k in sorted(share, key=lambda k: (out[k] - share[k], k))[: total - sum(out.values())]:
        out[k] += 1
    return out


def sampled(peptides: DataFrame, total: int, ratios: dict[int, float], seed: int = 42) -> DataFrame:
    """Distinct peptides, as many of each length as its quota, or all there are: the first by a seeded hash. Only peptides of small
    hashes are made distinct and put in order: of each length those under a bound that about 16 times the quota stay under,
    or, where repeated rows leave fewer than the quota, under a larger one, up to all."""
    want = {k: n for k, n in quotas(total, ratios).items() if n}
    k, rank = F.length("peptide"), F.md5(F.concat_ws("|", "peptide", F.lit(seed)).cast("binary"))
    sizes = lambda df: {r["k"]: r["n"] for r in df.groupBy(k.alias("k")).agg(F.count("*").alias("n")).collect()}
    by_length = lambda values: reduce(lambda c, v: c.when(k == v[0], F.lit(v[1])), values.items(), F.when(F.lit(False), F.lit(None)))
    share = {x: 16 * want[x] / n for x, n in sizes(peptides.filter(k.isin(*want))).items()}
    while True:
        bound = by_length({x: f"{int(s * 2**52):013x}" if s < 1 else "g" for x, s in share.items()})
        near = written(peptides.select("peptide", rank.alias("rank")).filter(F.col("rank") < bound.cast("string")).distinct(), "sampled")
        have = sizes(near)
        short = [x for x, s in share.items() if s < 1 and have.get(x, 0) < want[x]]
        if not short:
            break
        share.update((x, 16 * share[x]) for x in short)
    return _first(near, want)


def _first(ranked: DataFrame, want: dict[int, int]) -> DataFrame:
    """Of each length so many peptides (peptide, rank), the first by rank and then by name."""
    k = F.length("peptide")
    most = reduce(lambda c, v: c.when(k == v[0], F.lit(v[1])), want.items(), F.when(F.lit(False), F.lit(None)))
    place = F.row_number().over(Window.partitionBy(k).orderBy("rank", "peptide"))
    return ranked.withColumn("place", place).filter(F.col("place") <= most).select("peptide")


def sampled_windows(proteins: DataFrame, total: int, ratios: dict[int, float], seed: int = 42, text: bool = False) -> DataFrame:
    """sampled() of all windows of proteins (seq), each read once: a task returns the first by hash of its own windows, as many of each
    length as the quota, and these are put in order. With text, of letters()."""
    want = {k: n for k, n in quotas(total, ratios).items() if n}
    if not Shape(want).fits() or len(f"|{seed}") > 31:
        of = letters(proteins) if text else proteins
        return sampled(windows(of.select(F.lit(0).alias("transcript"), "seq"), list(ratios)), total, ratios, seed)
    near = smallest(proteins, want, f"|{seed}", text).distinct()
    return _first(near.withColumn("rank", F.md5(F.concat_ws("|", "peptide", F.lit(seed)).cast("binary"))), want)


def of_length(peptides: DataFrame, low: int, high: int) -> DataFrame:
    return peptides.filter(F.length("peptide").between(low, high))


def chunks(proteins: DataFrame, k: int) -> DataFrame:
    """transcript, phase, peptide: a protein cut into whole runs of k from each of the first k places; none is made distinct."""
    seq = F.col("seq")
    cut = F.when(F.length(seq) >= k, F.sequence(F.lit(1), F.length(seq) - (k - 1))).otherwise(F.array().cast("array<int>"))
    return proteins.select("transcript", F.explode(cut).alias("_at"), "seq").select("transcript", ((F.col("_at") - 1) % k).alias("phase"), F.substring(seq, F.col("_at"), F.lit(k)).alias("peptide"))


def not_within(peptides: DataFrame, proteins: DataFrame) -> DataFrame:
    """Peptides that no protein (seq) contains: an anti-join with the proteins' windows of the peptides' lengths, which are a
    handful."""
    lengths = [r["k"] for r in peptides.select(F.length("peptide").alias("k")).distinct().collect()]
    known = windows(proteins.select(F.lit(0).alias("transcript"), "seq"), lengths) if lengths else None
    return novel(peptides, known) if lengths else peptides


def excluded_found(proteins: DataFrame, excluded: DataFrame) -> DataFrame:
    """The excluded genes that some protein has, for the log; sort where written."""
    return excluded.select("gene").distinct().join(proteins.select("gene").distinct(), "gene", "left_semi")


def naming(records: DataFrame, gene: str) -> DataFrame:
    """FASTA records (header, seq) whose header names a gene."""
    return records.filter(F.contains("header", F.lit(gene)))


def paired(rows: DataFrame, order: str) -> DataFrame:
    """mer11, allele, score of rows (fragment, allele, score), two by two in order: the first fragment and the second's last
    residue, with the better score. Pairs of two alleles and a last odd row drop out. Places are
    counted range by range; the order has no ties."""
    at = running(rows.withColumn("_one", F.lit(1)), order, ["_one"])
    of = at.withColumn("_pair", F.floor((F.col("_one_upto") - 1) / 2))
    both = of.groupBy("_pair").agg(F.sort_array(F.collect_list(F.struct(F.col("_one_upto").alias("at"), "fragment", "allele", "score"))).alias("r"))
    fits = both.filter((F.size("r") == 2) & (F.col("r")[0]["allele"] == F.col("r")[1]["allele"]))
    return fits.select(F.concat(F.col("r")[0]["fragment"], F.right(F.col("r")[1]["fragment"], F.lit(1))).alias("mer11"), F.col("r")[0]["allele"].alias("allele"), F.greatest(F.col("r")[0]["score"], F.col("r")[1]["score"]).alias("score"))
