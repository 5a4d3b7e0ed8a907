import numpy as np
import pytest

from lumenpep.operators import hla, peptides, similarity
from lumenpep.sources import files


def test_fasta_windows_and_transcripts(spark, tmp_path):
    f = tmp_path / "a.fasta"
    f.write_text(">T1|x\nMKTAY\nIAKQR\n>T2|y\nKTAYIAKQXA\n")
    of = files.fasta(spark, str(f)).withColumn("transcript", peptides.transcript_id(files.F.col("header"), "inputFasta"))
    got = {r["peptide"]: (r["transcripts"], r["n"]) for r in peptides.transcripts(peptides.windows(of)).collect()}
    assert got["KTAYIAKQ"] == (["T1", "T2"], 2) and len(got) == 6 and got["MKTAYIAKQR"] == (["T1"], 1)
    assert peptides.windows(spark.createDataFrame([("a", "MKT")], "transcript string, seq string")).count() == 0


def test_cleavage_ends_before_the_cut(spark):
    of = spark.createDataFrame([("T1", "MKTAYIAKQR")], "transcript string, seq string")
    cuts = spark.createDataFrame([("T1", 9), ("T1", 10)], "transcript string, pos int")
    assert {r["peptide"] for r in peptides.cleaved(of, cuts, (8, 9)).collect()} == {"MKTAYIAK", "KTAYIAKQ", "MKTAYIAKQ"}


def test_overlapping_occurrences_count(spark):
    of = spark.createDataFrame([("AAA",), ("CCC",)], "peptide string")
    reads = spark.createDataFrame([("AAAAA",)], "seq string")
    assert {r["peptide"]: r["count"] for r in peptides.occurrences(of, reads, (3,)).collect()} == {"AAA": 3, "CCC": 0}


def test_fragments(spark):
    of = spark.createDataFrame([("ABCDEFGHIJK",)], "peptide string")
    got = peptides.fragments(of, spark.createDataFrame([("HLA-C07:04",)], "allele string")).collect()
    assert {(r["fragment"], r["allele"]) for r in got} == {("ABCDEFGHIJ", "HLA-C*0704"), ("BCDEFGHIJK", "HLA-C*0704")}


def test_consolidated_ranks(spark):
    rows = [("P1", "HLA-A01:01", "NetMHCpan", 0, 0.4), ("P1", "HLA-A01:01", "MixMHCpred", 1, 0.6), ("P1", "HLA-B07:02", "NetMHCpan", 2, 1.5), ("P1", "HLA-B07:02", "MixMHCpred", 3, None)]
    r = hla.consolidate(spark.createDataFrame(rows, "peptide string, allele string, tool string, col_ord int, rank double"), ["HLA-B07:02"]).head()
    assert (r["best_rank"], r["avg_rank"], r["best_allele"], r["strong_binders_count"], r["weak_binders_count"]) == (0.4, 0.5, "HLA-A01:01", 0, 1)
    assert (r["all_strong_binders"], r["all_weak_binders"], r["Num_Tools_1"], r["Num_Tools_2"]) == ("HLA-A01:01", "HLA-A01:01;HLA-B07:02", 0, 1)


def test_similarity(spark):
    of = spark.createDataFrame([("AAAAAAAA",), ("AAAAAAAAA",)], "peptide string")
    refs = spark.createDataFrame([("AAAAAAAA",), ("SAAAAAAA",)], "seq string")
    for identity, at_once, want in ((True, 10, 0.985), (False, 1, 1.0)):
        got = {r["peptide"]: r["similarity"] for r in similarity.similarity(of, refs, identity, at_once=at_once).collect()}
        assert got == {"AAAAAAAA": want, "AAAAAAAAA": None}


def test_similarity_keeps_references_off_the_driver(spark, monkeypatch):
    r = np.random.default_rng(4)
    words = lambda n: sorted({"".join(r.choice(list("ACDS"), k)) for k in r.integers(8, 12, n)})
    few, many = words(60), words(300)
    of, refs = spark.createDataFrame([(x,) for x in few], "peptide string"), spark.createDataFrame([(x,) for x in many], "seq string")
    monkeypatch.setattr(type(refs), "toLocalIterator", None)
    b = similarity.matrix()
    score = lambda x, y: int((np.array(similarity.weights(len(x))) * b[similarity.encode([x]), similarity.encode([y])]).sum())
    for options in ({"at_once": 20}, {"at_once": 20, "share": 7}):
        got = {x["peptide"]: x["similarity"] for x in similarity.similarity(of, refs, normalised=False, **options).collect()}
        assert got == {x: max((s for y in many if len(y) == len(x) and (s := score(x, y)) < score(x, x)), default=None) for x in few}


def test_a_pair_in_two_batches_is_an_error(spark):
    a, b = (spark.createDataFrame([("P", x, "T", 0, 0.1)], "peptide string, allele string, tool string, col_ord int, rank double") for x in ("A", "B"))
    assert hla.batches(a, b).count() == 2 and hla.batches(a.union(a), b).count() == 3
    with pytest.raises(Exception, match="in two batches: A T"):
        hla.batches(a, b, a).collect()
    with pytest.raises(Exception, match="in two batches: A T"):
        hla.batches(a, b, a).count()


def test_weights():
    assert [similarity.weights(k) for k in (8, 9, 10, 11)] == [[1, 2, 9, 13, 13, 9, 2, 1], [1, 2, 3, 13, 17, 13, 3, 2, 1], [1, 2, 3, 13, 17, 17, 13, 3, 2, 1], [1, 2, 3, 13, 17, 21, 17, 13, 3, 2, 1]]


def test_a_bad_residue_is_an_error_and_order_keeps_repeats(spark):
    of = spark.createDataFrame([(1, "AAAAAA"), (2, "SAAAAA"), (3, "AAAAAA")], "at long, peptide string")
    refs = spark.createDataFrame([("SAAAAA",), ("AXAAAA",)], "seq string")
    got = similarity.in_order(of, similarity.similarity(of, refs, exclude_identity=False), "at").orderBy("at").collect()
    assert [r["peptide"] for r in got] == ["AAAAAA", "SAAAAA", "AAAAAA"] and got[1]["similarity"] == 1.0
    with pytest.raises(Exception, match="not a standard peptide: AXA"):
        similarity.similarity(spark.createDataFrame([("AXAAAA",)], "peptide string"), refs).collect()
