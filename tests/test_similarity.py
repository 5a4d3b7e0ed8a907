"""Pruned similarity against every pair."""

import numpy as np
import pandas as pd
import pytest

from lumenpep.operators import similarity
from lumenpep.queries import QUERIES


def every_pair(peptides, refs, exclude):
    k, b = len(peptides[0]), similarity.matrix()
    w, e, r = np.array(similarity.weights(k)), similarity.encode(peptides), similarity.encode(refs)
    own = (w * b[e, e]).sum(axis=1)
    scores = np.array([[(w * b[p, q]).sum() for q in r] for p in e], dtype=float)
    return np.where(scores < own[:, None], scores, -np.inf).max(axis=1) if exclude else scores.max(axis=1)


@pytest.mark.parametrize("k", [3, 8, 9, 11])
@pytest.mark.parametrize("exclude", [True, False])
def test_pruning_changes_nothing(k, exclude):
    r = np.random.default_rng(k)
    draw = lambda n, letters: ["".join(x) for x in r.choice(list(letters), size=(n, k))]
    refs = sorted({*draw(400, similarity.ORDER), *draw(100, "ACW")})
    peptides = [*draw(60, similarity.ORDER), *draw(30, "ACW"), *refs[:20], refs[0][:-1] + "W"]
    for most in (2_000_000, 50):  # the latter halves its peptides again and again
        got = similarity._best(exclude, block=16, most=most)(pd.DataFrame({"peptide": peptides}), pd.DataFrame({"seq": refs}))
        assert got["peptide"].tolist() == peptides and (got["raw"].fillna(-np.inf).to_numpy(dtype=float) == every_pair(peptides, refs, exclude)).all()
        assert (got["pairs"] == len(refs)).all()


def test_groups_without_either_side():
    one = similarity._best(True)
    assert one(pd.DataFrame({"peptide": []}), pd.DataFrame({"seq": ["AAAA"]})).empty
    assert one(pd.DataFrame({"peptide": ["AAAA"]}), pd.DataFrame({"seq": []}))["raw"].isna().all()
    assert one(pd.DataFrame({"peptide": ["AAAA"]}), pd.DataFrame({"seq": ["AAAA"]}))["raw"].isna().all()


def test_all_windows_of_documents_are_compared_and_few_pairs_scored(spark):
    got = QUERIES["similarity_documents"](spark, "/root/testdata/sf0.001").cache()
    total = got.selectExpr("sum(scored) AS s", "sum(pairs) AS p").head()
    assert total["s"] < 0.05 * total["p"] and got.count() > 300_000
    some = got.orderBy("similarity", "peptide").limit(30).toPandas()
    some = pd.concat([some, got.orderBy("peptide").limit(30).toPandas()])
    refs = [r[0] for r in __import__("lumenpep.operators.peptides", fromlist=["windows"]).windows(spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").selectExpr("0 AS transcript", "upper(regexp_replace(text, '[^A-Za-z]', '')) AS seq")).select("peptide").distinct().collect()]
    for k, rows in some.groupby(some["peptide"].str.len()):
        peptides = rows["peptide"].tolist()
        w, e = np.array(similarity.weights(k)), similarity.encode(peptides)
        best = every_pair(peptides, [r for r in refs if len(r) == k], True) / (w * similarity.matrix()[e, e]).sum(axis=1)
        assert np.allclose(best, rows["similarity"].to_numpy(dtype=float), atol=1e-6)
    got.unpersist()


def test_weights_by_step():
    assert similarity.weights(8) == [1, 2, 9, 13, 13, 9, 2, 1] and similarity.weights(9) == [1, 2, 3, 13, 17, 13, 3, 2, 1]
    assert similarity.weights(10) == [1, 2, 3, 13, 17, 17, 13, 3, 2, 1] and similarity.weights(11) == [1, 2, 3, 13, 17, 21, 17, 13, 3, 2, 1]
    assert similarity.weights(8, 1) == [1, 2, 3, 3, 2, 1, 2, 1] and similarity.weights(9, 1) == [1, 2, 3, 4, 4, 3, 3, 2, 1]
    assert similarity.weights(10, 1) == [1, 2, 3, 4, 4, 3, 2, 3, 2, 1] and similarity.weights(11, 1) == [1, 2, 3, 4, 5, 5, 4, 3, 3, 2, 1]
    assert similarity.weights(9, 2) == [1, 2, 3, 7, 9, 7, 3, 2, 1]


def test_the_oldest_form_and_another_step(spark):
    of, ref = spark.createDataFrame([("AAAAAAAA",)], "peptide string"), spark.createDataFrame([("AAAAAAAA",), ("SAAAAAAA",)], "seq string")
    one = lambda **o: similarity.similarity(of, ref, **o).head()["similarity"]
    assert one(normalised=False, exclude_identity=False) == 200 and one(normalised=False) == 197 and one(normalised=False, step=1) == 4 * 15 - 3


def test_parts_of_a_long_list_grow_before_their_number_does(spark):
    of = spark.range(3000).selectExpr("concat('A', lpad(translate(id, '0123456789', 'ACDEFGHIKL'), 7, 'M')) AS peptide")
    for options, parts in ((dict(most=10), 300), (dict(most=10, turns=30, upto=200), 30), (dict(most=10, turns=4, upto=200), 15), (dict(most=5000, turns=4, upto=50000), 1)):
        many, part = similarity._parts(of, "peptide", **options)
        assert many.get(8, 1) == parts and of.select(part).distinct().count() == parts


def test_parts_of_more_rows_give_the_same_scores(spark):
    r = np.random.default_rng(9)
    words = lambda n: sorted({"".join(r.choice(list("ACDSWY"), k)) for k in r.integers(8, 10, n)})
    few, many = words(400), words(300)
    of, refs = spark.createDataFrame([(x,) for x in few], "peptide string"), spark.createDataFrame([(x,) for x in many], "seq string")
    one, two, three = ({tuple(x) for x in similarity.similarity(of, refs, counts=True, **o).select("peptide", "similarity", "pairs").collect()} for o in ({}, {"share": 5}, {"share": 3, "at_once": 50}))
    assert one == two == three and len(one) == len(few)
