import numpy as np

from lumenpep.operators import curation, evaluate, peptides, stats
from lumenpep.operators.running import percentile_row, percentiles


def scored(spark):
    return spark.createDataFrame([(i, 1.0 - i / 10, y) for i, y in enumerate([1, 1, 0, 1, 0, 0, 0, 0, 0, 0])], "id long, score double, label int")


def test_topk_and_average_precision(spark):
    got = {r["percent"]: (r["capture"], r["precision"]) for r in evaluate.topk(scored(spark), (10, 25, 50)).collect()}
    assert got == {10: (33.333333, 1.0), 25: (66.666667, 0.666667), 50: (100.0, 0.6)}
    assert evaluate.average_precision(scored(spark)).first()[0] == round((1 + 1 + 3 / 4) / 3, 6)


def test_topk_of_equal_scores_goes_by_id(spark):
    rows = spark.createDataFrame([(i, 0.5, int(i < 3)) for i in range(10)], "id long, score double, label int")
    assert [tuple(r) for r in evaluate.topk(rows, (20, 50)).orderBy("percent").collect()] == [(20, 66.666667, 1.0), (50, 100.0, 0.6)]


def test_calibration_of_equal_scores_is_one_bin_and_of_none_is_empty(spark):
    one = spark.createDataFrame([(i, 0.5, i % 2) for i in range(4)], "id long, score double, label int")
    assert [tuple(r) for r in evaluate.calibration(one).collect()] == [(0, 4, 0.5, 0.5)]
    assert evaluate.calibration(one.limit(0)).collect() == []


def test_quotas(spark):
    assert peptides.quotas(10, {8: 350, 9: 6100, 10: 2400, 11: 800}) == {8: 0, 9: 6, 10: 3, 11: 1}


def test_sample_has_its_quota_or_all_there_are_and_is_the_same_again(spark):
    rows = spark.createDataFrame([("A" * 8,), ("A" * 8,)] + [("C" * 8 + x,) for x in "ACDEFGH"], "peptide string")
    take = lambda: sorted(r[0] for r in peptides.sampled(rows, 8, {8: 1, 9: 1}).collect())
    assert take() == take() and [len(p) for p in take()].count(9) == 4 and [len(p) for p in take()].count(8) == 1


def test_origins(spark):
    rows = [("Homo sapiens", None, None), ("Homo sapiens", "m", "r"), (None, None, "r"), ("virus", None, None), (None, None, None)]
    got = curation.origins(spark.createDataFrame(rows, "o string, m string, r string"), "o", "m", "r", "Homo").collect()
    assert [r["origin"] for r in got] == ["self", "neoantigen", "neoantigen", "viral", None]


def test_median_filled(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "id long, x double")
    assert [tuple(r) for r in stats.median_filled(df, ["x"], "id").orderBy("id").collect()] == [(1, 1.0, 0), (2, 2.0, 1), (3, 3.0, 0)]


def test_percentiles_are_exact(spark):
    rng = np.random.default_rng(0)
    sets = {"a": rng.normal(size=3000), "b": np.where(rng.random(3000) < 0.4, 7.0, rng.integers(0, 5, 3000)), "c": np.full(3000, np.nan), "d": np.r_[[2.5, 4.0], np.full(2998, np.nan)]}
    df = spark.createDataFrame([tuple(None if np.isnan(x) else float(x) for x in r) for r in zip(*sets.values(), strict=True)], "a double, b double, c double, d double")
    at = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r["feature"]: r["q"] for r in percentiles(df, list(sets), at).collect()}
    assert sorted(got) == ["a", "b", "d"]
    for c in got:
        assert np.allclose(got[c], np.nanquantile(sets[c], at), rtol=0, atol=1e-12)
    assert percentiles(df.limit(0), ["a"], at).collect() == [] and percentile_row(df, ["a", "c"], [0.5]).head()["_c"] is None
