"""Classifiers of peptides with MLlib: registry, grid search over folds, fixed parameters, saving, ranked predictions.

Features are imputed with the median of the training rows and scaled by median and interquartile range where the classifier
asks for it. Classes weigh the inverse of their share. A radial kernel is that of random Fourier features under a linear machine;
boosting sees, besides the filled features, which of them were missing.
"""

from __future__ import annotations

import itertools
import json
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, RobustScaler, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate
from ..session import written
from .kernel import RandomFourier

#: name -> (classifier, whether features are scaled, grid of its parameters). The grids are fixed values, but for the depth 40 of
#: forests, which trees here don't reach; C is a penalty against the sum of all rows' losses, gamma the radial kernel's width.
REGISTRY = {
    "logreg": (lambda: LogisticRegression(maxIter=100), True, {"C": [0.1, 1, 5, 10]}),
    "svm_linear": (lambda: LinearSVC(maxIter=100), True, {"C": [0.1, 1, 5, 10, 100]}),
    "svm_rbf": (lambda: LinearSVC(maxIter=100), True, {"C": [0.1, 1], "gamma": [0.01, 0.1, 1]}),
    "rf": (lambda: RandomForestClassifier(seed=0), False, {"numTrees": [200, 300], "maxDepth": [20, 30], "minInstancesPerNode": [1, 5]}),
    "hgb": (lambda: GBTClassifier(seed=0), False, {"maxIter": [100, 200], "maxDepth": [10, 20, 30], "stepSize": [0.05, 0.1]}),
}
SCORERS = ("precision", "recall", "roc_auc", "avg_precision", "f0.5")


def combinations(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, v, strict=True)) for v in itertools.product(*grid.values())]


def pipeline(name: str, features: list[str], params: dict | None = None) -> Pipeline:
    make, scale, _ = REGISTRY[name]
    params = dict(params or {})
    kernel = {k: params.pop(k) for k in ("gamma", "dims") if k in params}
    classifier = make().setFeaturesCol("_features").setLabelCol("label").setWeightCol("_weight")
    classifier.setParams(**params)
    filled = [f"_{f}" for f in features]
    parts, more = [Imputer(inputCols=features, outputCols=filled, strategy="median", relativeError=0.0001)], []
    if name == "hgb":  # a tree can part rows by what is missing
        more = [f"_missing_{f}" for f in features]
        cells = ", ".join(f"CAST(`{f}` IS NULL OR isnan(`{f}`) AS DOUBLE) AS `_missing_{f}`" for f in features)
        parts.insert(0, SQLTransformer(statement=f"SELECT *, {cells} FROM __THIS__"))
    parts.append(VectorAssembler(inputCols=[*filled, *more], outputCol="_vector" if scale else "_features"))
    if scale:
        parts.append(RobustScaler(inputCol="_vector", outputCol="_scaled" if name == "svm_rbf" else "_features", withCentering=True, withScaling=True))
    if name == "svm_rbf":
        parts.append(RandomFourier(inputCol="_scaled", outputCol="_features", **kernel))
    return Pipeline(stages=[*parts, classifier])


def _prepared(rows: DataFrame, features: list[str]) -> DataFrame:
    return rows.select(*(c for c in rows.columns if c not in features), *(F.col(f).cast("double").alias(f) for f in features))


def weighted(rows: DataFrame) -> DataFrame:
    """rows (label) with _weight: all rows over twice those of the class."""
    n = rows.groupBy("label").agg(F.count("*").alias("_n"))
    of = rows.join(F.broadcast(n), "label").crossJoin(F.broadcast(rows.agg(F.count("*").alias("_all"))))
    return of.withColumn("_weight", F.col("_all") / (2 * F.col("_n"))).drop("_n", "_all")


def fit(rows: DataFrame, name: str, features: list[str], params: dict | None = None) -> PipelineModel:
    """rows: label (0 or 1) and the features."""
    of = weighted(_prepared(rows, features))
    params = dict(params or {})
    if "C" in params:  # MLlib's penalty stands against the mean of the losses
        params["regParam"] = 1 / (params.pop("C") * max(1, of.count()))
    return pipeline(name, features, params).fit(of.withColumn("label", F.col("label").cast("double")))


def score_of(model: PipelineModel) -> Column:
    """Probability of class 1; of a linear support vector machine the logistic function of its margin."""
    if "LinearSVC" in type(model.stages[-1]).__name__:
        return 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1]))
    return vector_to_array("probability")[1]


def predict(model: PipelineModel, rows: DataFrame, features: list[str], threshold: float = 0.5) -> DataFrame:
    """rows with score and prediction. Order by falling score where written."""
    if lost := [f for f in features if f not in rows.columns]:
        raise ValueError(f"missing features: {', '.join(lost)}")
    out = model.transform(_prepared(rows, features)).withColumn("score", score_of(model))
    return out.select(*rows.columns, "score", (F.col("score") >= threshold).cast("int").alias("prediction"))


def metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """metric, value of the five scorers for scored (score, label)."""
    cells = evaluate.confusion(scored, threshold)
    f = F.try_divide(1.25 * F.col("tp"), 1.25 * F.col("tp") + 0.25 * F.col("fn") + F.col("fp"))
    one = cells.select(F.coalesce("precision", F.lit(0.0)).alias("precision"), F.coalesce("recall", F.lit(0.0)).alias("recall"), F.round(F.coalesce(f, F.lit(0.0)), 6).alias("f"))
    one = one.crossJoin(evaluate.auroc(scored)).crossJoin(evaluate.average_precision(scored))
    names = ("precision", "recall", "auroc", "average_precision", "f")
    return one.select(F.inline(F.array(*(F.struct(F.lit(s).alias("metric"), F.col(c).cast("double").alias("value")) for s, c in zip(SCORERS, names, strict=True)))))


def validate(rows: DataFrame, name: str, features: list[str], params: list[dict] | None = None, fold: str = "fold", at_once: int = 3) -> DataFrame:
    """model, params, fold, metric, value: for each set of parameters (the registry's grid, if none is given) and each fold, a
    classifier fitted on the other folds and measured on it. Rows with their folds are written once, and so are each fit's
    scores, from which all five metrics come; at_once fits run side by side, each of which is a distributed job."""
    params = params if params is not None else combinations(REGISTRY[name][2])
    of = written(rows, "folds")

    def one(task: tuple[int, dict]) -> DataFrame:
        k, p = task
        model = fit(of.filter(F.col(fold) != k).drop(fold), name, features, p)
        scored = written(predict(model, of.filter(F.col(fold) == k), features).select("score", "label"), "scores")
        return metrics(scored).select(F.lit(name).alias("model"), F.lit(json.dumps(p, sort_keys=True)).alias("params"), F.lit(k).alias("fold"), "metric", "value")

    tasks = [(k, p) for k in sorted(r[0] for r in of.select(fold).distinct().collect()) for p in params]
    with ThreadPool(at_once) as pool:
        return reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(of.sparkSession)(one), tasks))


def best(results: DataFrame, metric: str = "precision") -> tuple[str, dict]:
    """Model and parameters with the largest mean; results are a row a fit and metric."""
    of = results.filter(F.col("metric") == metric).groupBy("model", "params").agg(F.avg("value").alias("mean"))
    r = of.orderBy(F.desc_nulls_last("mean"), "model", "params").head()
    return r["model"], json.loads(r["params"])


def single_features(rows: DataFrame, name: str, features: list[str], params: dict, fold: str = "fold") -> DataFrame:
    """validate() with one set of parameters, for each feature alone and for all together (feature `all`)."""
    sets = {f: [f] for f in features} | {"all": features}
    return reduce(DataFrame.unionByName, (validate(rows, name, f, [params], fold).withColumn("feature", F.lit(k)) for k, f in sets.items()))


def save(model: PipelineModel, path: str, features: list[str], params: dict, name: str, **more) -> None:
    """The model, and beside it metadata.json."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    meta = json.dumps({"features": features, "best_params": params, "model": name, **more}, sort_keys=True)
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    meta = json.loads(spark.read.text(f"{path}/metadata").head()[0])
    return PipelineModel.load(f"{path}/model"), meta


def permutation_importance(model: PipelineModel, rows: DataFrame, features: list[str], key: str, seed: int = 42) -> DataFrame:
    """feature, importance: how much the area under the curve falls when the feature's values are dealt anew. Values are
    dealt by the order of two hashes, each counted through range by range."""
    from ..operators.running import running

    base = evaluate.auroc(predict(model, rows, features)).withColumnRenamed("auroc", "base")
    out = []
    for i, f in enumerate(features):
        place = lambda salt, df=rows: running(df.withColumn("_h", F.xxhash64(F.col(key), F.lit(salt))).withColumn("_one", F.lit(1)), "_h", ["_one"])
        values = place(f"{seed}{f}").select(F.col("_one_upto").alias("_at"), F.col(f).alias("_dealt"))
        mixed = place(f"{seed}").withColumnRenamed("_one_upto", "_at").join(values, "_at").withColumn(f, F.col("_dealt")).select(*rows.columns)
        found = evaluate.auroc(predict(model, mixed, features)).crossJoin(base)
        out.append(found.select(F.lit(f).alias("feature"), F.round(F.col("base") - F.col("auroc"), 6).alias("importance")))
    return reduce(DataFrame.unionByName, out)


def stored_results(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """training_set, model, fold, metric, score, params: the stored results of each training set (CSV with a header) together."""
    schema = "model string, fold int, metric string, score double, params string"
    return reduce(DataFrame.unionByName, (spark.read.schema(schema).csv(p, header=True).select(F.lit(n).alias("training_set"), "*") for n, p in paths.items()))


def tree_importance(model: PipelineModel, features: list[str]) -> list[tuple[str, float, float]]:
    """feature, mean and deviation of its importance over the trees of a forest."""
    trees = [t.featureImportances.toArray() for t in model.stages[-1].trees]
    mean = [sum(t[i] for t in trees) / len(trees) for i in range(len(features))]
    return [(f, m, (sum((t[i] - m) ** 2 for t in trees) / len(trees)) ** 0.5) for i, (f, m) in enumerate(zip(features, mean, strict=True))]
