"""Radial kernel, calibration, selection from sums of products, bootstrap, nested validation, missing values in boosting."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenpep.ml import calibration, kernel, network, resample, selection, workflow
from lumenpep.operators import evaluate, labels


@pytest.fixture(scope="module")
def rings(spark):
    r = np.random.default_rng(2)
    out = []
    for i in range(320):
        y = i % 2
        radius, angle = (1.0 if y else 3.0) + r.normal(0, 0.25), r.uniform(0, 2 * np.pi)
        out.append((i, y, float(radius * np.cos(angle)), float(radius * np.sin(angle)), i // 2 % 4))
    return spark.createDataFrame(out, "id int, label int, a double, b double, fold int").cache()


def test_random_features_come_near_the_kernel():
    r = np.random.default_rng(0)
    x = r.normal(size=(60, 3))
    exact = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    errors = []
    for dims in (100, 1600):
        z = kernel.mapped(x, 0.3, dims, 7)
        errors.append(np.sqrt(((z @ z.T - exact) ** 2).mean()))
    assert errors[1] < 0.03 and errors[1] < errors[0] / 2.5
    assert (kernel.mapped(x, 0.3, 50, 7) == kernel.mapped(x, 0.3, 50, 7)).all() and (kernel.mapped(x, 0.3, 50, 8) != kernel.mapped(x, 0.3, 50, 7)).any()


def test_a_radial_kernel_parts_rings_where_a_line_does_not(spark, rings, tmp_path):
    train, test = rings.filter("fold > 0"), rings.filter("fold = 0")
    radial = workflow.fit(train, "svm_rbf", ["a", "b"], {"C": 1, "gamma": 1.0, "dims": 200, "maxIter": 15})
    line = workflow.fit(train, "svm_linear", ["a", "b"], {"C": 1, "maxIter": 10})
    one, two = (evaluate.auroc(workflow.predict(m, test, ["a", "b"])).head()[0] for m in (radial, line))
    assert one > 0.98 > 0.7 > two
    workflow.save(radial, str(tmp_path / "m"), ["a", "b"], {"C": 1}, "svm_rbf")
    again, _ = workflow.load(spark, str(tmp_path / "m"))
    scores = [sorted(map(tuple, workflow.predict(m, test, ["a", "b"]).select("id", "score").collect())) for m in (radial, again)]
    assert scores[0] == scores[1]


def test_penalties_follow_the_number_of_rows(rings):
    few = workflow.fit(rings.limit(100), "logreg", ["a", "b"], {"C": 2})
    assert few.stages[-1].getRegParam() == pytest.approx(1 / 200)
    with pytest.raises(KeyError):
        workflow.fit(rings, "unknown", ["a"])


def plain_sigmoid(m, y):
    n1, n = y.sum(), len(y)
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n - n1 + 2))
    a = b = 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-(a * m + b)))
        g, h = np.array([(m * (p - t)).sum(), (p - t).sum()]), p * (1 - p)
        step = np.linalg.solve(np.array([[(m * m * h).sum(), (m * h).sum()], [(m * h).sum(), h.sum()]]), g)
        a, b = a - step[0], b - step[1]
    return a, b


def test_the_sigmoid_is_the_plain_one(spark):
    r = np.random.default_rng(3)
    y = r.integers(0, 2, 500)
    m = r.normal(y * 1.5, 1.0) * 3 - 4
    of = spark.createDataFrame([(float(a), int(b)) for a, b in zip(m, y, strict=True)], "margin double, label int")
    assert calibration.sigmoid(of) == pytest.approx(plain_sigmoid(m, y), rel=1e-6)
    parted = spark.createDataFrame([(float(i), int(i > 4)) for i in range(10)], "margin double, label int")
    slope, shift = calibration.sigmoid(parted)
    assert np.isfinite([slope, shift]).all() and slope > 0
    assert calibration.sigmoid(parted.limit(0)) == (1.0, 0.0)


@pytest.mark.parametrize("ensemble", [True, False])
def test_calibration_brings_probabilities_nearer_to_shares(spark, ensemble):
    r = np.random.default_rng(4)
    out = []
    for i in range(900):
        y = int(r.random() < 0.25)
        out.append((f"P{i}", y, float(r.normal(y, 1.0)), float(r.normal(0, 1)), i % 3))
    rows = spark.createDataFrame(out, "id string, label int, a double, b double, part int").cache()
    train, test = rows.filter("part > 0"), rows.filter("part = 0")
    plain = workflow.predict(workflow.fit(train, "svm_linear", ["a", "b"], {"C": 1, "maxIter": 10}), test, ["a", "b"])
    made = calibration.fit(labels.folds(train, ["label"], "id", 3), "svm_linear", ["a", "b"], {"C": 1, "maxIter": 10}, ensemble=ensemble)
    assert len(made.models) == (3 if ensemble else 1)
    after = made.predict(test)
    assert after.columns == [*test.columns, "score", "prediction"]
    before_, after_ = (evaluate.brier_ece(s.select(F.col("id"), "score", "label")).head() for s in (plain, after))
    assert after_["ece"] < before_["ece"] / 2 and after_["brier"] < before_["brier"]
    assert evaluate.auroc(after).head()[0] == pytest.approx(evaluate.auroc(plain).head()[0], abs=0.03)
    with pytest.raises(ValueError, match="missing features: b"):
        made.predict(test.drop("b"))


def test_calibration_of_a_classifier_that_is_no_column_expression(rings):
    made = calibration.fit(rings, "svm_rbf", ["a", "b"], {"C": 1, "gamma": 1.0, "dims": 100, "maxIter": 10})
    assert len(made.models) == 4
    scored = made.predict(rings)
    assert evaluate.auroc(scored).head()[0] > 0.98 and evaluate.brier_ece(scored.select("id", "score", "label")).head()["ece"] < 0.1


@pytest.fixture(scope="module")
def table(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(300, 5))
    x[:, 3] = x[:, 0] + r.normal(0, 0.1, 300)
    y = (x[:, 0] + 0.7 * x[:, 1] + r.normal(0, 0.7, 300) > 0).astype(int)
    rows = spark.createDataFrame([(*map(float, a), int(b), i % 3) for i, (a, b) in enumerate(zip(x, y, strict=True))], "f0 double, f1 double, f2 double, f3 double, f4 double, label int, fold int").cache()
    return x, y, np.arange(300) % 3, rows


def r2(x, y, fold, columns, alpha):
    out = []
    for k in np.unique(fold):
        a, b = x[fold != k][:, columns], y[fold != k]
        c = a - a.mean(axis=0)
        w = np.linalg.solve(c.T @ c + alpha * np.eye(len(columns)), c.T @ (b - b.mean()))
        t = y[fold == k]
        e = x[fold == k][:, columns] @ w + b.mean() - a.mean(axis=0) @ w
        out.append(1 - ((t - e) ** 2).sum() / ((t - t.mean()) ** 2).sum())
    return np.mean(out)


def test_selection_from_sums_is_selection_from_rows(table):
    x, y, fold, rows = table
    names = [f"f{i}" for i in range(5)]
    gram = selection.Gram(rows.repartition(5), names, "fold")
    f = gram.f_values()
    for i, n in enumerate(names):
        a, b = x[y == 0, i], x[y == 1, i]
        between = len(a) * (a.mean() - x[:, i].mean()) ** 2 + len(b) * (b.mean() - x[:, i].mean()) ** 2
        within = ((a - a.mean()) ** 2).sum() + ((b - b.mean()) ** 2).sum()
        assert f[n] == pytest.approx(between / (within / 298))
    assert gram.best(2) == sorted(names, key=lambda n: -f[n])[:2]
    had = []
    while len(had) < 3:
        had.append(max((i for i in range(5) if i not in had), key=lambda i: r2(x, y, fold, [*had, i], 1e-9)))
    assert gram.forward(3) == [names[i] for i in had]
    left = list(range(5))
    while len(left) > 2:
        left.remove(max(left, key=lambda i: r2(x, y, fold, [j for j in left if j != i], 1e-9)))
    assert gram.backward(2) == [names[i] for i in left]
    alpha, w, b = gram.ridge((0.1, 10.0, 1e4))
    assert alpha == max((0.1, 10.0, 1e4), key=lambda a: r2(x, y, fold, list(range(5)), a))
    c = x - x.mean(axis=0)
    want = np.linalg.solve(c.T @ c + alpha * np.eye(5), c.T @ (y - y.mean()))
    assert [w[n] for n in names] == pytest.approx(want) and b == pytest.approx(y.mean() - x.mean(axis=0) @ want)
    assert set(gram.eliminated(2)) <= set(names) and "f1" in gram.eliminated(2)


def test_sums_leave_out_rows_with_gaps_and_features_that_do_not_vary(spark):
    rows = spark.createDataFrame([(1.0, 5.0, 0), (2.0, 5.0, 1), (None, 5.0, 1), (3.0, 5.0, 0), (4.0, 5.0, 1)], "a double, b double, label int")
    gram = selection.Gram(rows, ["a", "b"])
    assert gram.of()[0, 0] == 4 and np.isnan(gram.f_values()["b"]) and gram.best(1) == ["a"]
    with pytest.raises(ValueError, match="a class without rows"):
        selection.Gram(rows.filter("label = 0"), ["a"]).f_values()


def test_bootstrap_intervals(spark):
    r = np.random.default_rng(6)
    y = r.integers(0, 2, 400)
    rows = [(i, float(np.round(r.normal(v, 1.2), 1)), int(v)) for i, v in enumerate(y)]
    of = spark.createDataFrame(rows, "id int, score double, label int").repartition(3)
    draws = of.select(F.explode(F.array(*(resample.weight(F.col("id"), F.lit(b)) for b in range(20)))).alias("w")).groupBy("w").count().collect()
    share = {d["w"]: d["count"] / 8000 for d in draws}
    assert abs(share[0] - np.exp(-1)) < 0.02 and abs(share[1] - np.exp(-1)) < 0.02 and abs(share[2] - np.exp(-1) / 2) < 0.02
    found = resample.auroc(of, 40)
    values = {d["resample"]: d["auroc"] for d in found.collect()}
    w = {(d["id"], 7): d["w"] for d in of.select("id", resample.weight(F.col("id"), F.lit(7)).alias("w")).collect()}
    ones, zeros = ([(s, w[i, 7]) for i, s, v in rows if v == c] for c in (1, 0))
    won = sum(a * b * (1.0 if s > t else 0.5 if s == t else 0.0) for s, a in ones for t, b in zeros)
    assert len(values) == 40 and values[7] == pytest.approx(won / (sum(a for _, a in ones) * sum(b for _, b in zeros)), abs=1e-6)
    at = resample.interval(found).head()
    assert at["low"] < evaluate.auroc(of).head()[0] < at["high"] and at["n"] == 40
    one_class = resample.auroc(of.filter("label = 1"), 3).collect()
    assert [d["auroc"] for d in one_class] == [None] * 3


def test_nested_validation_and_stored_results(spark, rings, tmp_path):
    found = resample.nested(rings, "svm_rbf", ["a", "b"], [{"C": 1, "gamma": 1.0, "dims": 60, "maxIter": 8}, {"C": 0.1, "gamma": 1e-6, "dims": 60, "maxIter": 8}], "id", outer=2, inner=2, metric="roc_auc").collect()
    assert {r["fold"] for r in found} == {0, 1} and {r["metric"] for r in found} == set(workflow.SCORERS)
    assert all("1.0" in r["params"] for r in found) and min(r["value"] for r in found if r["metric"] == "roc_auc") > 0.95
    for n, v in (("x", 0.5), ("y", 0.75)):
        spark.createDataFrame([("logreg", 0, "precision", v, "{}")], "model string, fold int, metric string, score double, params string").write.csv(str(tmp_path / n), header=True)
    assert sorted(map(tuple, workflow.stored_results(spark, {n: str(tmp_path / n) for n in "xy"}).select("training_set", "score").collect())) == [("x", 0.5), ("y", 0.75)]


def test_boosting_learns_from_what_is_missing(spark):
    r = np.random.default_rng(8)
    rows = spark.createDataFrame([(i, i % 2, None if i % 2 else float(r.normal()), float(r.normal())) for i in range(200)], "id int, label int, a double, b double")
    model = workflow.fit(rows, "hgb", ["a", "b"], {"maxIter": 3, "maxDepth": 2})
    assert evaluate.auroc(workflow.predict(model, rows, ["a", "b"])).head()[0] > 0.99
    assert evaluate.auroc(workflow.predict(workflow.fit(rows, "logreg", ["a", "b"], {"C": 1}), rows, ["a", "b"])).head()[0] < 0.8


def test_gradients_are_those_of_the_loss():
    r = np.random.default_rng(9)
    x, y, w, flat = r.normal(size=(7, 3)), r.integers(0, 2, 7), r.uniform(1, 2, 7), network.started(3, 1)
    masks = [(r.random((7, h)) >= 0.3) / 0.7 for h in network.HIDDEN]
    g, loss = network.gradient(x, y, w, flat, masks)
    for i in r.choice(len(flat), 40, replace=False):
        more = flat.copy()
        more[i] += 1e-6
        assert (network.gradient(x, y, w, more, masks)[1] - loss) / 1e-6 == pytest.approx(g[i], abs=1e-3)


def test_a_network_learns_what_no_line_parts_and_one_seed_gives_one_network(spark):
    r = np.random.default_rng(10)
    x = r.uniform(-1, 1, (240, 2))
    rows = spark.createDataFrame([(i, float(a), None if i == 5 else float(b), int((a > 0) != (b > 0))) for i, (a, b) in enumerate(x)], "id int, a double, b double, label int").repartition(2).cache()
    made, losses = network.fit(rows, ["a", "b"], epochs=60, rate=0.03, dropout=0.0)
    assert losses[-1] < 0.25 < losses[0] and evaluate.auroc(made.predict(rows)).head()[0] > 0.95
    few = [network.fit(of, ["a", "b"], epochs=2, batches=2, dropout=d)[0].weights for of, d in ((rows, 0.0), (rows, 0.0), (rows, 0.3))]
    assert few[0] == few[1] != few[2]
    again = network.Network.of_json(made.to_json())
    assert again == made
    with pytest.raises(ValueError, match="missing features: b"):
        made.predict(rows.drop("b"))
