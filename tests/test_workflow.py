import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenpep.functions import alleles
from lumenpep.ml import workflow
from lumenpep.operators import evaluate, features, hla, labels, peptides, running, stats
from lumenpep.sources import files


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(1)
    out = []
    for i in range(240):
        y = i % 3 == 0
        out.append((f"P{i:03}", int(y), float(r.normal(2.0 * y, 1)), None if i % 11 == 0 else float(r.normal(0, 1)), 3.0))
    return spark.createDataFrame(out, "peptide string, label int, good double, noise double, still double").cache()


@pytest.mark.parametrize("name", ["logreg", "svm_linear", "rf", "hgb"])
def test_models_rank_positives_first(rows, name):
    small = {"rf": {"numTrees": 10, "maxDepth": 4}, "hgb": {"maxIter": 5, "maxDepth": 3}}
    model = workflow.fit(rows, name, ["good", "noise"], small.get(name))
    scored = workflow.predict(model, rows, ["good", "noise"])
    assert scored.columns == [*rows.columns, "score", "prediction"] and evaluate.auroc(scored).head()[0] > 0.85
    with pytest.raises(ValueError, match="missing features: other"):
        workflow.predict(model, rows, ["good", "other"])


def test_validation_saving_and_importance(spark, rows, tmp_path):
    of = labels.folds(rows, ["label"], "peptide", k=2)
    found = workflow.validate(of, "logreg", ["good", "noise"], [{"regParam": 0.1}, {"regParam": 10.0}]).cache()
    assert found.count() == 2 * 2 * 5 and {r["metric"] for r in found.collect()} == set(workflow.SCORERS)
    name, params = workflow.best(found, "roc_auc")
    model = workflow.fit(rows, name, ["good", "noise"], params)
    workflow.save(model, str(tmp_path / "m"), ["good", "noise"], params, name)
    again, meta = workflow.load(spark, str(tmp_path / "m"))
    assert meta == {"features": ["good", "noise"], "best_params": params, "model": "logreg"}
    one, two = (sorted(map(tuple, workflow.predict(m, rows, meta["features"]).select("peptide", "score").collect())) for m in (model, again))
    assert one == two
    by = {r["feature"]: r["importance"] for r in workflow.permutation_importance(model, rows, ["good", "noise"], "peptide").collect()}
    assert by["good"] > 0.1 > by["noise"]
    alone = workflow.single_features(of, "logreg", ["good", "noise"], {"regParam": 0.1}).filter("metric = 'roc_auc'").groupBy("feature").agg(F.avg("value").alias("v")).collect()
    assert {r["feature"] for r in alone} == {"good", "noise", "all"} and max(alone, key=lambda r: r["v"])["feature"] != "noise"
    forest = workflow.fit(rows, "rf", ["good", "noise"], {"numTrees": 5, "maxDepth": 3})
    trees = {f: m for f, m, _ in workflow.tree_importance(forest, ["good", "noise"])}
    assert trees["good"] > trees["noise"]


def test_scaling_constant_features_and_clusters(spark, rows):
    assert stats.varying(rows, ["good", "noise", "still"]) == ["good", "noise"]
    got = np.array([r[0] for r in stats.scaled(rows, ["good"], "standard").select("good").collect()])
    assert abs(got.mean()) < 1e-9 and abs(got.std() - 1) < 1e-9
    assert stats.scaled(rows, ["still"]).agg(F.max(F.abs("still"))).head()[0] == 0
    rho = {(a, b): 1.0 if a == b else 0.95 if {a, b} == {"x", "y"} else 0.1 for a in "xyz" for b in "xyz"}
    assert stats.uncorrelated(rho, ["x", "y", "z"]) == ["x", "z"]


def test_running_sums_over_ranges(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("x"), F.lit(1).alias("one"))
    by = df.groupBy("x").agg(F.sum("one").alias("m")).union(spark.createDataFrame([(None, 4)], "x long, m long"))
    for descending in (False, True):
        got = {r["x"]: (r["m_upto"], r["_next"]) for r in running.running(by, "x", ["m"], descending).collect()}
        total = 0
        order = sorted((r for r in by.collect() if r["x"] is not None), key=lambda r: -r["x"] if descending else r["x"])
        for r, after in zip(order, [*order[1:], None], strict=True):
            total += r["m"]
            assert got[r["x"]] == (total, after["x"] if after else None)
        assert got[None][0] == total + 4


def test_positions_of_ties_go_by_id_and_nulls_are_last(spark):
    rows = [(i, 0.5 if i % 2 else None if i % 10 == 0 else 0.9, i % 3 == 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, score double, label boolean")
    for lower in (False, True):
        want = [i for i, s, _ in sorted(rows, key=lambda r: (r[1] is None, (r[1] if lower else -r[1]) if r[1] is not None else 0, r[0]))]
        got = running.positions(df, lower).orderBy("at").collect()
        assert [r["id"] for r in got] == want and [r["at"] for r in got] == list(range(1, 1001)) and got[0]["n"] == 1000
    none = spark.createDataFrame([(1, None, 0), (2, 0.5, 0)], "id long, score double, label int")
    assert [tuple(r) for r in evaluate.topk(none, (50,)).collect()] == [(50, 0.0, 0.0)]
    assert [tuple(r) for r in evaluate.capture_curve(none).collect()] == [(0.0, 0.0)]


def test_folds_split_and_upsampling(spark, rows):
    got = labels.folds(rows, ["label"], "peptide").groupBy("label", "fold").count().collect()
    for y, n in ((0, 160), (1, 80)):
        assert sorted(r["count"] for r in got if r["label"] == y) == [n // 5] * 5
    assert labels.holdout(rows, ["label"], "peptide").filter("held_out").groupBy("label").count().orderBy("label").collect() == [(0, 32), (1, 16)]
    up = {r["label"]: r["count"] for r in labels.upsampled(rows, "label", "peptide").groupBy("label").count().collect()}
    assert up == {0: 160, 1: 160}


def test_alleles(spark):
    cases = {"HLA-Cw7": "HLA-C*07", "HLA-A*02:1": "HLA-A*02:1", "HLA-A*1": "HLA-A*1", "HLA-A2": "HLA-A*02", "HLA-B27:05": "HLA-B*27:05"}
    df = spark.createDataFrame([(a,) for a in cases], "a string")
    assert {r[0]: r[1] for r in df.select("a", alleles.normalise(F.col("a"))).collect()} == cases
    assert [r[0] for r in spark.createDataFrame([("HLA-A01:01",), ("HLA-A1",), ("x",)], "a string").select(alleles.state(F.col("a"))).collect()] == ["whole", "broken", "dropped"]


def test_hla_of_chosen_alleles_keeps_peptides(spark):
    rows = [("P1", "A", "NetMHCpan", 0, 0.4), ("P1", "B", "Other", 1, 0.1), ("P2", "B", "NetMHCpan", 0, 0.2)]
    of = hla.chosen(spark.createDataFrame(rows, "peptide string, allele string, tool string, col_ord int, rank double"), ["A"])
    got = {r["peptide"]: (r["best_rank"], r["best_allele"], r["Num_Tools_1"]) for r in hla.consolidate(of, ["A"]).collect()}
    assert got == {"P1": (0.4, "A", 1), "P2": (None, None, 0)}


def test_tool_outputs(spark):
    df = spark.createDataFrame([("P", "0.5", 1), ("P", "0.7", 2), ("Q", "bad", 3)], "peptide string, total string, n int")
    assert sorted(map(tuple, features.of_tool(df, "mtec", "n").collect())) == [("P", "0.5"), ("Q", "bad")]
    with pytest.raises(ValueError, match="%Rank_bestAllele"):
        features.of_tool(df, "prime")
    assert [tuple(r) for r in features.ranked_without_last(df.select("peptide", "n", "total"), "n").collect()] == [("Q", 3), ("P", 2), ("P", 1)]


def test_readers(spark, tmp_path):
    put = lambda name, text: ((tmp_path / name).write_text(text), str(tmp_path / name))[1]
    strict = files.fasta(spark, put("s.fasta", ">A x\nAC D\n\n>B\n\n>C\nEF\n"), strict=True).collect()
    assert {(r["header"], r["seq"]) for r in strict} == {("A x", "ACD"), ("C", "EF")}
    assert files.is_fasta(spark, put("a.txt", "\n\n>x\nAC\n")) and not files.is_fasta(spark, put("b.txt", "AC\n"))
    assert [r[0] for r in files.peptides(spark, put("p.txt", " ac \n\nDE\n"), upper=True).collect()] == ["AC", "DE"]
    assert [r[0] for r in files.reference(spark, put("r.txt", ">head\nACD\nAXD\n")).collect()] == ["ACD"]
    cut = files.cleavage(spark, put("c.txt", "position a b c d\n3 A 0.9 x T1\n4 C 0.1 x T1\n9 D 0 x T1\n"), 0.5).collect()
    assert {tuple(r) for r in cut} == {("T1", 3), ("T1", 9)}
    ranks = files.ranks(spark, put("k.tsv", "peptide\tHLA-A01:01_NetMHCpan_%Rank\tHLA-A01:01_X_%Rank\tother\nP\t0.5\tNaN\t1\nQ\tbad\t2\t1\n")).collect()
    assert {tuple(r) for r in ranks} == {("P", "HLA-A01:01", "NetMHCpan", 0, 0.5), ("P", "HLA-A01:01", "X", 1, None), ("Q", "HLA-A01:01", "NetMHCpan", 0, None), ("Q", "HLA-A01:01", "X", 1, 2.0)}
    row = "\t".join(["c"] * 8)
    assert [r[0] for r in files.gff(spark, put("g.gff", f"# x\n{row}\tID=1;Name=gene-12\n{row}\tID=2\n")).collect()] == ["gene"]
    assert {tuple(r) for r in files.reads(spark, put("9mers_a.txt", "acd\n\n")).collect()} == {("ACD", "9mers_a.txt")}
    assert files.with_length_of_file(spark.read.text(put("10mers_b.txt", "x\n"))).head()["length"] == 10
    assert [tuple(r) for r in files.table(spark, put("t.tsv", "# c\na\tb\n1\t2\n"), sep="\t", comment="#").collect()] == [("1", "2")]
    assert files.feature_list(put("f.txt", "# c\na\n b # d\n\n")) == ["a", "b"] and files.folder_of("/x/run1_part.fasta") == "run1"
    with pytest.raises(ValueError):
        files.feature_list(put("e.txt", "# c\n"))
    assert files.json_file(spark, put("m.json", json.dumps({"a": [1]}))) == {"a": [1]}
    assert files.merged_settings({"a": {"b": 1, "c": 2}, "d": 1}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}, "d": 1}
    page = spark.createDataFrame([("<ul data-alleles-container><li class='x common'><label> HLA-A*01:01 </label></li><li><label>no</label></li></ul>",)], "html string")
    assert [r[0] for r in files.common_alleles(page).collect()] == ["HLA-A*01:01"]


def test_writers(spark, tmp_path):
    seqs = spark.createDataFrame([("h", "A" * 130)], "header string, seq string")
    files.write_fasta(seqs, str(tmp_path / "f"))
    assert files.fasta(spark, str(tmp_path / "f")).collect() == seqs.collect()
    of = spark.createDataFrame([("AAAAAAAA",), ("CCCCCCCCC",)], "peptide string")
    files.write_by_length(of, str(tmp_path / "l"))
    assert sorted(p.name for p in (tmp_path / "l").glob("length=*")) == ["length=8", "length=9"]
    with pytest.raises(ValueError):
        files.write_by_length(of.limit(0), str(tmp_path / "n"))


def test_cleavage_falls_back_to_all_windows_and_headers(spark):
    of = spark.createDataFrame([("T1", "MKTAYIAKQR"), ("T2", "AAAAAAAAA")], "transcript string, seq string")
    cuts = spark.createDataFrame([("T1", 9)], "transcript string, pos int")
    got = Counter((r["transcript"], r["peptide"]) for r in peptides.cleaved(of, cuts, (8,)).collect())
    assert got == Counter([("T1", "MKTAYIAK"), ("T2", "AAAAAAAA")])
    heads = spark.createDataFrame([("a b", "T|x", "q|ENST1.2|z", "ENSP|1|2|3|4|5|GENE"), ("c", "U|", "r|E.1|", "sp|P|N OS=a OX=1 GN=G2 PE=1")], "p string, i string, r string, g string")
    row = heads.select(peptides.transcript_id(F.col("p"), "pepsickle"), peptides.transcript_id(F.col("i"), "inputFasta"), peptides.transcript_id(F.col("r"), "referenceProteome"), peptides.gene_name(F.col("g"))).collect()
    assert [tuple(r) for r in row] == [("a", "T", "ENST1", "GENE"), ("c", "U", "E", "G2")]
    with pytest.raises(ValueError, match="more than 1 alleles"):
        peptides.fragments(of.select(F.col("seq").alias("peptide")), spark.createDataFrame([("HLA-A01:01",), ("HLA-A01:02",)], "allele string"), most=1)
