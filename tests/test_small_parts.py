"""Parts that no query of the driver's tables exercises."""

from lumenpep.operators import features, peptides, stats
from lumenpep.streaming import counts


def test_repeated_headers_go(spark):
    of = spark.createDataFrame([("AAAAAAAA", 1), ("peptide", 2), ("pep", 3)], "peptide string, n int")
    assert [r["peptide"] for r in features.scrub_headers(of).collect()] == ["AAAAAAAA"]


def test_clipping_keeps_nulls(spark):
    of = spark.createDataFrame([(-1.0,), (0.5,), (9.0,), (None,)], "x double")
    assert [r[0] for r in of.select(stats.clip("x", 0, 5)).collect()] == [0.0, 0.5, 5.0, None]


def test_records_that_name_a_gene(spark):
    of = spark.createDataFrame([(">sp GN=ABC1 x", "AC"), (">sp GN=XYZ", "DE")], "header string, seq string")
    assert [r["seq"] for r in peptides.naming(of, "ABC1").collect()] == ["AC"]


def test_few_and_many_peptides_are_counted_alike(spark):
    of = spark.createDataFrame([("AAAAAAAA",), ("AAAAAAAAA",), ("CDEFGHIK",), ("AAAAAAAA",)], "peptide string")
    reads = spark.createDataFrame([("AAAAAAAAAA", "x"), ("CDEFGHI", "y"), ("", "y"), ("AAAAAAAA", "y")], "seq string, file string")
    one, two = (sorted(map(tuple, peptides.occurrences(of, reads, most=m).collect())) for m in (1000, 1))
    assert one == two == [("AAAAAAAA", 4), ("AAAAAAAAA", 2), ("CDEFGHIK", 0)]
    by = [sorted(map(str, peptides.occurrences(of, reads, by=["file"], most=m).collect())) for m in (1000, 1)]
    assert by[0] == by[1]


def test_counts_grow_with_files_that_arrive(spark, tmp_path):
    (tmp_path / "in").mkdir()
    wanted = spark.createDataFrame([("AAAAAAAA",)], "peptide string")
    for n, text in enumerate(("AAAAAAAAA\nCCCCCCCC\n", "aaaaaaaa\n")):
        (tmp_path / "in" / f"{n}.txt").write_text(text)
        run = counts.running_counts(spark, str(tmp_path / "in"), wanted).writeStream.outputMode("complete").format("memory").queryName(f"counts{n}").option("checkpointLocation", str(tmp_path / f"state{n}")).trigger(availableNow=True).start()
        run.awaitTermination(120)
        assert [tuple(r) for r in spark.table(f"counts{n}").collect()] == [("AAAAAAAA", 2 + n)]
