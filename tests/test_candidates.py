"""The candidate plan, scorers in the tools' formats, stage tables, and the rules that their parts follow."""

import json
import sys

import pytest
from pyspark.sql import functions as F

from lumenpep import scorers
from lumenpep.functions import alleles
from lumenpep.ml.linear import Linear, of_pipeline
from lumenpep.operators import features, labels, running, similarity
from lumenpep.plans import candidates
from lumenpep.plans.stages import Stages, fingerprint
from lumenpep.sources import files

PEPTIDES = ["MKTAYIAKQ", "KTAYIAKQR", "TAYIAKQRQI", "AYIAKQRQISF", "ACDEFGHI"]


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def program(kind, body):
    """A stand-in for a tool: reads all of its input, and prints what body makes of its lines."""
    code = f"import sys\nrows = sys.stdin.read().splitlines()\n{body}"
    return scorers.Program([sys.executable, "-c", code], scorers.FORMATS[kind], at_once=2)


def test_programs_in_each_format(spark):
    of = spark.createDataFrame([(p,) for p in PEPTIDES], "peptide string").repartition(2)
    ranks = program("ranks", "print('peptide\\tHLA-A01:01_T_%Rank\\tHLA-B07:02_T_%Rank')\nfor r in rows: print(r, len(r) / 10, '' if r[0] == 'A' else 'nan' if r[0] == 'M' else 1, sep='\\t')")
    got = {(r["peptide"], r["allele"]): (r["tool"], r["col_ord"], r["rank"]) for r in ranks.apply(of).collect()}
    assert len(got) == 10 and got["MKTAYIAKQ", "HLA-A01:01"] == ("T", 0, 0.9) and got["TAYIAKQRQI", "HLA-B07:02"] == ("T", 1, 1.0)
    assert got["MKTAYIAKQ", "HLA-B07:02"][2] is None and got["ACDEFGHI", "HLA-B07:02"][2] is None
    tap = program("tap", "assert rows[0] == 'peptide'\nprint('peptide,pred_score,pred_label')\nfor r in rows[1:]: print(r, 'NA' if r[0] == 'A' else 0.5, 'yes', sep=',')")
    assert {r["peptide"]: r["tap_score"] for r in tap.apply(of).collect()} == {p: None if p[0] == "A" else 0.5 for p in PEPTIDES}
    prime = program("prime", "print('# version\\n# alleles')\nprint('Peptide\\t%Rank_bestAllele\\tScore_bestAllele')\nfor r in rows: print(r, len(r), 0, sep='\\t')")
    assert {r["peptide"]: r["prime_rank"] for r in prime.apply(of).collect()} == {p: float(len(p)) for p in PEPTIDES}
    cnn = program("cnn", "print('peptide\\tHLA\\timmunogenicity')\nfor r in rows: print(*r.split(','), '' if r[0] == 'A' else 0.25, sep='\\t')")
    pairs = of.select("peptide", F.lit("HLA-A*0101").alias("allele"))
    assert {tuple(r) for r in cnn.apply(pairs).collect()} == {(p, "HLA-A*0101", 0.25) for p in PEPTIDES if p[0] != "A"}
    cuts = program("cleavage", "print('position residue probability flag protein')\nfor h, s in zip(rows[::2], rows[1::2]): print(len(s), s[-1], 0.0, 'x', h[1:])")
    assert {tuple(r) for r in cuts.apply(of.select(F.concat(F.lit("t"), "peptide").alias("transcript"), "peptide")).collect()} == {(f"t{p}", len(p), 0.0) for p in PEPTIDES}
    assert ranks.apply(of.limit(0)).collect() == []


def test_a_program_that_fails_is_an_error(spark):
    of = spark.createDataFrame([("AAAAAAAA",)], "peptide string")
    with pytest.raises(Exception, match="ended with 3: no licence"):
        program("prime", "sys.stderr.write('no licence'); sys.exit(3)").apply(of).collect()


def test_a_model_is_loaded_once_a_worker(spark, tmp_path):
    log = str(tmp_path / "loads")

    def load():
        with open(log, "a") as f:
            f.write("x")
        return 2.0

    import pyarrow as pa

    def score(model, batch):
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([model] * batch.num_rows)], names=["peptide", "tap_score"])

    one = scorers.Scorer(f"loads-{log}", scorers.TAP, load, score, at_once=1)
    of = spark.createDataFrame([(p,) for p in PEPTIDES * 4], "peptide string").coalesce(1)
    assert one.apply(of).agg(F.sum("tap_score")).head()[0] == 40.0 and one.apply(of).count() == 20
    assert len(open(log).read()) <= 2  # two jobs, in one worker or two


def sources(spark, tmp_path):
    """Every file in its tool's format, for five peptides."""
    fasta = ">T1|x\nMKTAYIAKQRQ\nISF\n>T2|y\nACDEFGHI\n"
    ranks = "peptide\tHLA-A01:01_NetMHCpan_%Rank\tHLA-B07:02_NetMHCpan_%Rank\tHLA-A01:01_MHCnuggets_%Rank\n" + "".join(f"{p}\t{i / 10}\t\t0.001\n" for i, p in enumerate(PEPTIDES))
    cnn = "peptide\tHLA\timmunogenicity\n" + "".join(f"{f}\t{a}\t{v}\n" for f, v in (("MKTAYIAKQ", 0.3), ("KTAYIAKQR", 0.4), ("TAYIAKQRQI", 0.5), ("AYIAKQRQIS", 0.6), ("YIAKQRQISF", 0.9)) for a in ("HLA-A*0101", "HLA-B*0702"))
    paths = {
        "inputFasta": put(tmp_path, "in.fasta", fasta),
        "customPeptides": put(tmp_path, "list.txt", "\n".join([*PEPTIDES, "", " MKTAYIAKQ ", "SHORT"])),
        "commonAlleles": put(tmp_path, "common.txt", "HLA-B07:02\n"),
        "inputAlleles": put(tmp_path, "alleles.txt", "HLA-A01:01\nHLA-B07:02\n\n"),
        "ranks": put(tmp_path, "ranks.tsv", ranks),
        "tap": put(tmp_path, "tap.csv", "peptide,pred_score,label\nMKTAYIAKQ,0.7,1\n"),
        "mtec_files": put(tmp_path, "reads.txt", "mktayiakqmktayiakq\nKTAYIAKQR\n"),
        "iedb_peptides": put(tmp_path, "iedb.txt", "MKTAYIAKA\nMKTAYIAKQ\n"),
        "benign_self_peptides": put(tmp_path, "self.txt", "MKTAYIAKK\n>x\n"),
        "deepimmuno": put(tmp_path, "cnn.txt", cnn),
        "prime": put(tmp_path, "prime.txt", "# a\nPeptide\t%Rank_bestAllele\tx\nMKTAYIAKQ\t0.9\t1\nKTAYIAKQR\t9\t1\n"),
        "model": put(tmp_path, "model.json", json.dumps(Linear(("best_rank", "tap_score", "length"), (-1.0, 2.0, 0.1), fill=(1.0, 0.0, 9.0)).settings())),
    }
    return candidates.from_paths(spark, paths)


def test_all_parts_from_files(spark, tmp_path):
    tables = candidates.pipeline(candidates.Config(), sources(spark, tmp_path))
    rows = {r["peptide"]: r for r in tables["feature_table"].collect()}
    assert sorted(rows) == sorted(PEPTIDES)
    one, eleven, eight = rows["MKTAYIAKQ"], rows["AYIAKQRQISF"], rows["ACDEFGHI"]
    assert (one["best_rank"], one["best_netmhc_r"], one["netmhc_a"], one["strong_binders_count"], one["mtec_expression_count"]) == (0.0, 0.0, "HLA-A01:01", 0, 2)
    assert "best_mhcnuggets_r" not in tables["feature_table"].columns and rows["KTAYIAKQR"]["best_rank"] == 0.1  # nuggets are off
    assert one["tap_score"] == 0.7 and one["PRIME_%Rank_bestAllele"] == 0.9 and rows["KTAYIAKQR"]["PRIME_%Rank_bestAllele"] == 9.0
    assert eleven["di_best_score"] == 0.9 and eleven["di_best_b_score"] == 0.9 and eight["di_best_score"] is None and one["di_avg_score"] == 0.3
    self_score = {r["peptide"]: r["similarity"] for r in similarity.similarity(spark.createDataFrame([("MKTAYIAKQ",)], "peptide string"), spark.createDataFrame([("MKTAYIAKA",), ("MKTAYIAKQ",)], "seq string")).collect()}
    assert one["pathogenicity"] == self_score["MKTAYIAKQ"] < 1 and eight["pathogenicity"] is None and 0 < one["selfsimilarity"] < 1
    ranked = tables["ranked"].orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == [1, 2, 3, 4, 5] and ranked[0]["peptide"] == "MKTAYIAKQ"
    assert [r["probability_immunogenic"] for r in ranked] == sorted((r["probability_immunogenic"] for r in ranked), reverse=True)
    assert {r["peptide"]: r["mtec_expression"] for r in tables["mtec_expression"].collect()}["MKTAYIAKQ"] == 0


@pytest.mark.parametrize(("flag", "gone", "column"), [("use_tap", "tap.csv", "tap_score"), ("use_mtec", "reads.txt", "mtec_expression_count"), ("use_pathogenicity", "iedb.txt", "pathogenicity"), ("use_selfsimilarity", "self.txt", "selfsimilarity"), ("use_prime", "prime.txt", "PRIME_%Rank_bestAllele"), ("use_deepimmuno", "cnn.txt", "di_best_score"), ("use_hlapred", "ranks.tsv", "best_rank")])
def test_what_is_off_is_not_read(spark, tmp_path, flag, gone, column):
    of = sources(spark, tmp_path)
    files_of = lambda c: {f.rsplit("/", 1)[1] for f in candidates.pipeline(c, of)["feature_table"].inputFiles()}
    on, off = candidates.Config(use_ml_model=False), candidates.Config(use_ml_model=False, **{flag: False})
    alleles_too = {"common.txt", "alleles.txt"} if flag == "use_deepimmuno" else set()  # no other part reads them from the plan
    assert files_of(on) - files_of(off) == {gone} | alleles_too
    assert column in candidates.pipeline(on, of)["feature_table"].columns and column not in candidates.pipeline(off, of)["feature_table"].columns
    scans = lambda c: candidates.pipeline(c, of)["feature_table"]._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert scans(off) < scans(on)


def test_generated_peptides_under_cleavage_and_the_reference_filter(spark, tmp_path):
    of = sources(spark, tmp_path) | candidates.from_paths(spark, {"cleavage": put(tmp_path, "cuts.txt", "position residue p flag protein\n9 K 0.9 x T1\n10 Q 0.1 x T1\n"), "refProteome": put(tmp_path, "ref.fasta", ">sp|1|A x=1 y=2 z=GENE1 e=3\nACDEFGHI\n>sp|2|B x=1 y=2 z=GENE2 e=3\nMKTAYIAK\n"), "genesToRemoveFromRef": put(tmp_path, "genes.txt", "GENE2\n")})
    off = {f: False for f in ("use_tap", "use_hlapred", "use_mtec", "use_pathogenicity", "use_selfsimilarity", "use_prime", "use_deepimmuno", "create_feature_table", "use_customPeptides")}
    made = lambda **c: {r["peptide"]: r["transcripts"] for r in candidates.pipeline(candidates.Config(use_generatePeptides=True, **off, **c), of)["generated"].collect()}
    assert made(pepsickleCleavageThreshold=0.5) == {"MKTAYIAK": ["T1"], "ACDEFGHI": ["T2"]}
    assert made(pepsickleCleavageThreshold=0.5, filter="noRefPeps") == {"MKTAYIAK": ["T1"]}
    assert len(made(peptide_lengths=(9,))) == 6
    with pytest.raises(ValueError, match="neither"):
        candidates.pipeline(candidates.Config(**off), of)


def test_settings_by_name(spark, tmp_path):
    path = put(tmp_path, "c.json", json.dumps({"peptide_lengths": "8-9", "pepsickleCleavageThreshold": "null", "use_mhcnuggets": True}))
    config = candidates.Config.of(files.json_file(spark, path))
    assert config.peptide_lengths == (8, 9) and config.pepsickleCleavageThreshold is None and config.tools() == ("NetMHCpan", "MixMHCpred", "MHCFlurry", "MHCnuggets")
    with pytest.raises(ValueError, match="unknown settings: use_magic"):
        candidates.Config.of({"use_magic": True})
    with pytest.raises(ValueError, match="no source: customPeptides"):
        candidates.pipeline(candidates.Config(), {})
    with pytest.raises(ValueError, match="unknown sources: x"):
        candidates.from_paths(spark, {"x": "y"})
    yaml = pytest.importorskip("yaml")
    assert files.yaml_file(spark, put(tmp_path, "c.yaml", yaml.safe_dump({"a": {"b": [1, 2]}}))) == {"a": {"b": [1, 2]}}
    assert files.yaml_file(spark, put(tmp_path, "e.yaml", "# nothing\n")) == {}


def test_results_are_published_by_prefix(spark, tmp_path):
    tables = candidates.pipeline(candidates.Config(), sources(spark, tmp_path))
    where = candidates.publish({n: tables[n] for n in ("feature_table", "mtec_expression")}, str(tmp_path / "out"))
    assert [w.rsplit("/", 2)[1:] for w in where] == [["feature", "feature_table"], ["mtec", "mtec_expression"]]
    assert spark.read.csv(where[0], header=True).count() == 5


def test_a_run_that_ends_between_stages_is_taken_up_again(spark, tmp_path):
    of, folder = sources(spark, tmp_path), str(tmp_path / "stages")
    broken = dict(of)
    broken["tap"] = lambda: (_ for _ in ()).throw(RuntimeError("the node is gone"))
    first = Stages(spark, folder)
    with pytest.raises(RuntimeError, match="the node is gone"):
        candidates.pipeline(candidates.Config(), broken, first)
    assert first.made == ["peptides", "hla", "mtec", "pathogenicity", "deepimmuno", "prime", "selfsimilarity"]
    second = Stages(spark, folder)
    tables = candidates.pipeline(candidates.Config(), of, second)
    assert second.made == ["tap", "feature_table", "ranked"]
    third = Stages(spark, folder)
    again = candidates.pipeline(candidates.Config(), of, third)
    assert third.made == [] and sorted(map(str, again["ranked"].collect())) == sorted(map(str, tables["ranked"].collect()))
    plain = candidates.pipeline(candidates.Config(), of)["ranked"]
    assert sorted(map(str, again["ranked"].collect())) == sorted(map(str, plain.collect()))


def test_another_input_setting_or_plan_is_another_table(spark, tmp_path):
    folder = str(tmp_path / "stages")
    spark.range(5).write.parquet(str(tmp_path / "in"))
    read = lambda: spark.read.parquet(str(tmp_path / "in"))

    def run(make, settings=None, **more):
        s = Stages(spark, folder, **more)
        return s, s.table("x", make, settings)

    s, df = run(lambda: read().filter("id > 1"))
    assert s.made == ["x"] and df.count() == 3
    assert run(lambda: read().filter("id > 1"))[0].made == []
    assert run(lambda: read().filter("id > 2"))[0].made == ["x"]
    assert run(lambda: read().filter("id > 1"), {"a": 1})[0].made == ["x"]
    assert run(lambda: read().filter("id > 1"), version="2")[0].made == ["x"]
    before = fingerprint(read())
    spark.range(5, 6).write.mode("append").parquet(str(tmp_path / "in"))
    assert fingerprint(read()) != before
    s, df = run(lambda: read().filter("id > 1"))
    assert s.made == ["x"] and df.count() == 4
    kept = Stages(spark, folder)
    kept.table("other", lambda: spark.range(1))
    assert kept.prune() == []
    assert len(s.prune()) == 4 and s.prune() == []
    assert run(lambda: read().filter("id > 1"))[0].made == [] and kept.table("other", lambda: spark.range(1)).count() == 1


def test_rows_and_functions_without_a_name_count_by_content(spark):
    made = lambda *rows: spark.createDataFrame([(r,) for r in rows], "x string")
    assert fingerprint(made("a", "b")) == fingerprint(made("a", "b")) != fingerprint(made("a", "c"))
    with_ = lambda n: made("a").mapInArrow(lambda batches: (b.slice(n) for b in batches), "x string")
    assert fingerprint(with_(0)) == fingerprint(with_(0)) != fingerprint(with_(1))
    of = made("a")
    assert fingerprint(of.filter("x > 'a'")) != fingerprint(of.filter("x < 'a'")) and fingerprint(of.join(made("b"), "x")) != fingerprint(of.join(made("c"), "x"))


def test_an_attempt_without_a_manifest_does_not_count(spark, tmp_path):
    import os

    s = Stages(spark, str(tmp_path))
    key = s.key("x", None, [spark.range(3)])
    spark.range(7).write.parquet(str(tmp_path / f"x-{key}" / "half"))
    assert s.table("x", lambda: spark.range(3)).count() == 3 and s.made == ["x"]
    s.prune()
    assert "half" not in os.listdir(tmp_path / f"x-{key}") and Stages(spark, str(tmp_path)).table("x", lambda: spark.range(3)).count() == 3
    with pytest.raises(ValueError, match="not a stage's name"):
        s.table("a/b", lambda: spark.range(1))


def test_a_linear_model_scores_as_its_pipeline_does(spark):
    from lumenpep.ml import workflow

    rows = spark.createDataFrame([(i, i % 2, float(i % 2) + i / 50, None if i % 7 == 0 else float(i % 5)) for i in range(60)], "id int, label int, a double, b double")
    model = workflow.fit(rows, "logreg", ["a", "b"], {"regParam": 0.1})
    linear = Linear.of(json.loads(json.dumps(of_pipeline(model, ["a", "b"]).settings())))
    one = {r["id"]: r["score"] for r in workflow.predict(model, rows, ["a", "b"]).collect()}
    two = {r["id"]: r["score"] for r in linear.predict(rows).collect()}
    assert all(abs(one[k] - two[k]) < 1e-9 for k in one)
    with pytest.raises(ValueError, match="missing features: b"):
        linear.predict(rows.drop("b"))
    with pytest.raises(ValueError, match="not a linear model"):
        of_pipeline(workflow.fit(rows, "rf", ["a", "b"], {"numTrees": 2, "maxDepth": 2}), ["a", "b"])


def test_allele_forms(spark):
    of = spark.createDataFrame([("HLA-C07:04",), ("HLA-A0201",), ("HLA-A02:01:01",), ("HLA-DRB101:01",), ("HLA-a02:01N",), (None,)], "a string")
    assert [r[0] for r in of.select(alleles.to_cnn(F.col("a"))).collect()] == ["HLA-C*0704", "HLA-A*0201", "HLA-A*020101", "HLA-DRB*10101", "HLA-a*0201N", None]
    for bad in ("HLA-A*02:01", "A02:01", "HLA-0201", ""):
        with pytest.raises(Exception, match="not HLA-<gene><digits>"):
            spark.createDataFrame([(bad,)], "a string").select(alleles.to_cnn(F.col("a"))).collect()


def test_names_in_figures_and_lines_of_text(spark, tmp_path):
    of = spark.createDataFrame([("hgb_avg_rank",), ("single PRIME_%Rank_bestAllele",), ("full_set",), ("logreg",), (None,)], "n string")
    assert [r[0] for r in of.select(alleles.shown_name(F.col("n"))).collect()] == ["HLA Rank", "PRIME Rank", "HGB model", "logreg", None]
    files.write_lines(of.withColumnRenamed("n", "peptide"), str(tmp_path / "lines"))
    assert sorted(r[0] for r in files.peptides(spark, str(tmp_path / "lines")).collect()) == ["full_set", "hgb_avg_rank", "logreg", "single PRIME_%Rank_bestAllele"]
    assert [r[0] for r in files.strict_reference(spark, put(tmp_path, "r.fasta", ">a\nACD\nEF\n>b\nAXZ\n")).collect()] == ["ACDEF"]


def test_common_alleles_are_of_the_marked_list_and_class(spark):
    page = """<ul class="menu"><li class="common"><label>not this list</label></li></ul>
      <UL id="u" data-alleles-container="1"><li class="uncommon"><label>HLA-A*99:99</label></li><li class="row common x"><input><label for="a"> HLA-A*01:01 </label></li>
      <li><label>HLA-B*00:00</label></li><li class='common'><span>x</span><label>HLA-<b>B*07:02</b></label></li><li class="common-not"><label>HLA-C*99:99</label></li></UL>
      <ul data-alleles-container><li class="common"><label>second list</label></li></ul>"""
    of = spark.createDataFrame([(page,), ("<p>none</p>",), (None,)], "html string")
    assert [r[0] for r in files.common_alleles(of).collect()] == ["HLA-A*01:01", "HLA-B*07:02"]


def test_frames_are_combined_in_one_shuffle(spark):
    a = spark.createDataFrame([("P", 1), ("Q", 2)], "peptide string, a int")
    b = spark.createDataFrame([("Q", "x"), ("R", None)], "peptide string, b string")
    got = features.combined([a, b])
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, features.feature_table([a, b]).collect()), key=str)
    with pytest.raises(ValueError, match="columns in two frames: a"):
        features.combined([a, a])


def test_of_repeated_feature_rows_the_first_counts(spark):
    rows = spark.createDataFrame([("P", 5, 2), ("P", 9, 1), ("Q", None, 3), ("Z", 1, 1)], "peptide string, x int, ord int")
    yes, no = spark.createDataFrame([("P",), ("Z",)], "peptide string"), spark.createDataFrame([("Q",), ("Z",)], "peptide string")
    assert sorted(map(tuple, labels.labelled(rows, yes, no, order="ord").collect())) == [("P", 9, 1, 1), ("Q", None, 3, 0)]
    assert sorted(map(tuple, labels.labelled(rows, yes, no).collect())) == [("P", 5, 2, 1), ("Q", None, 3, 0)]


def test_places_of_string_ids_are_counted_in_many_ranges(spark):
    of = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("id"), (F.col("id") % 2).cast("double").alias("score"))
    parts = running.ranged(of, "id", "part").groupBy("part").count().collect()
    assert len(parts) > 150 and max(r["count"] for r in parts) < 400
    got = sorted((-r["score"], r["id"], r["at"]) for r in running.positions(of).collect())
    assert [r[2] for r in got] == list(range(1, 20_001))
    hot = of.withColumn("id", F.when(F.rand(1) < 0.5, "same").otherwise(F.col("id")))
    assert running.ranged(hot, "id", "part").groupBy("part").count().count() > 150
