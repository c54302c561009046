"""Early stopping, robust regression, several targets, curves and the run log."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F
from pyspark.sql import Observation

from equigap.ml import labs, training
from equigap.ml.metrics import binary_metrics, multiclass_metrics, regression_metrics


@pytest.mark.parametrize("losses, patience, want", [([3, 2, 1], 2, (2, 2)), ([3, 2, 4, 5, 1], 2, (1, 3)), ([1, 1, 1, 1], 3, (0, 3)), ([5], 4, (0, 0)),
                                                    ([4, 3, 5, 2, 6, 7, 8], 3, (3, 6)), ([math.nan, math.nan], 2, (1, 1))])
def test_patience(losses, patience, want):
    assert training.patience_round(losses, patience) == want


def rows(spark, n=600, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, z = rng.uniform(-2, 2), rng.uniform(-2, 2)
        out.append((i, x, z, float(x * x + z + rng.gauss(0, 1.5)), float(x + z + rng.gauss(0, 1) > 1), float(min(4, max(0, int(x + z + 2.5)))), "ab"[i % 2], i % 5 == 0, i % 97 / 97))
    df = spark.createDataFrame(out, "id long, x double, z double, y double, b double, c double, g string, is_val boolean, u double")
    return VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df).cache()


def test_boosting_stops_where_a_loop_over_all_rounds_does(spark):
    df = rows(spark).withColumnRenamed("y", "label")
    fit, valid = df.where("not is_val"), df.where("is_val")
    est = GBTRegressor(maxIter=25, maxDepth=4, stepSize=0.5, seed=3)
    model, losses = training.fit_boosting(est, fit, valid, patience=3)
    loss = lambda m: m.transform(valid).agg(F.avg((F.col("label") - F.col("prediction")) ** 2)).first()[0]
    every = [loss(est.copy({est.maxIter: k}).fit(fit)) for k in range(1, len(losses) + 1)]
    assert losses == pytest.approx(every)
    best, last = training.patience_round(every, 3)
    assert last == len(losses) - 1 and model.getNumTrees == best + 1 and loss(model) == pytest.approx(min(every))


def test_boosted_classifier_is_cut(spark):
    df = rows(spark).withColumnRenamed("b", "label")
    model, losses = training.fit_boosting(GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.8, seed=3), df.where("not is_val"), df.where("is_val"), patience=2)
    assert model.getNumTrees == training.patience_round(losses, 2)[0] + 1
    assert {r.prediction for r in model.transform(df).select("prediction").distinct().collect()} == {0.0, 1.0}


@pytest.mark.parametrize("hidden", [[], [4]])
def test_network_goes_on_from_its_weights(spark, hidden):
    df = rows(spark).withColumnRenamed("b", "label")
    est = MultilayerPerceptronClassifier(layers=[2, *hidden, 2], seed=1, maxIter=40)
    model, losses = training.fit_network(est, df.where("not is_val"), df.where("is_val"), patience=2, step=5)
    best, last = training.patience_round(losses, 2)
    assert last == len(losses) - 1 and losses[best] <= losses[0]
    assert training.log_loss(model.transform(df.where("is_val"))) == pytest.approx(losses[best])


def test_huber_agrees_with_the_loss_and_resists_outliers(spark):
    rng = np.random.default_rng(4)
    x = rng.uniform(-3, 3, 200)
    y = 2 * x + 1 + rng.normal(0, 0.5, 200)
    y[:10] += 60
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, label double"))
    model = training.HuberRegression(delta=1.0, maxIter=200, tol=1e-10).fit(df)

    def loss(b, a):
        r = np.abs(y - b * x - a)
        return np.where(r <= 1, r * r / 2, r - 0.5).sum()

    b, a = model.coefficients[0], model.intercept
    assert all(loss(b, a) <= loss(b + d, a + e) for d in (-1e-3, 0, 1e-3) for e in (-1e-3, 0, 1e-3))
    squares = LinearRegression(solver="normal").fit(df)
    assert abs(a - 1) < 0.2 < abs(squares.intercept - 1) and abs(b - 2) < 0.1


def test_class_weights_of_the_training_rows(spark):
    from equigap.ml.prep import class_weights

    df = spark.createDataFrame([(0, True)] * 6 + [(1, True)] * 2 + [(1, False)] * 10 + [(2, False)], "label int, is_train boolean")
    got = {(r.label, r.weight) for r in class_weights(df, "label", of=F.col("is_train")).collect()}
    assert got == {(0, 8 / 12), (1, 2.0), (2, 1.0)}
    many = spark.createDataFrame([(0, 1.0, k / 100) for k in range(100)] + [(1, 2.5, k / 100) for k in range(100)], "label int, weight double, u double")
    assert {r.label: r.n for r in training.oversampled(many).groupBy("label").agg(F.count("*").alias("n")).collect()} == {0: 100, 1: 250}


def test_six_targets_on_one_preparation(spark):
    df = rows(spark).drop("features", "is_val", "u").withColumns({f"t{k}": F.col("x") * k + F.col("z") for k in range(4)}).withColumn("t9", F.when(F.col("id") % 3 > 0, F.col("y")))
    targets = ["t0", "t1", "t2", "t3", "y", "t9"]
    curves = []
    runs, best, models = labs.run_lab(spark, df, "regresion", targets, ["id"], {"s": (["x", "z"], ["g"])}, configs={
        "LinearRegression": LinearRegression(), "GradientBoosting": GBTRegressor(maxIter=8, maxDepth=3, seed=1), "huber": training.HuberRegression()},
        run_prefix="p2", selection=("r2", True), curves=curves)
    found = {(r.target, r.model): r for r in runs.collect()}
    assert len(found) == 18 and set(best) == set(targets)
    for t in targets:
        assert best[t]["r2"] == max(r.r2 for (x, _), r in found.items() if x == t)
        assert best[t]["run_name"] == f"p2_{t}_s_{best[t]['model']}"
    assert all(found[f"t{k}", "LinearRegression"].r2 == pytest.approx(1.0) for k in range(4)) and best["y"]["model"] == "GradientBoosting"
    assert {c[0] for c in curves if c[1] == "val_loss"} == {f"p2_{t}_s_GradientBoosting" for t in targets}


def test_five_classes_with_weights(spark):
    df = rows(spark).drop("features", "is_val", "u")
    width = 2
    runs, best, _ = labs.run_lab(spark, df, "clasificacion_multiclase", "c", ["id"], {"s": (["x", "z"], [])}, configs={
        "LogisticRegression": LogisticRegression(maxIter=30), "RandomForestClassifier": RandomForestClassifier(numTrees=10, seed=1),
        "GradientBoostingClassifier": OneVsRest(classifier=GBTClassifier(maxIter=3, seed=1)),
        "mlp": MultilayerPerceptronClassifier(layers=[width, 8, 5], seed=1, maxIter=60)}, run_prefix="p3_multi")
    got = {r.model: r for r in runs.collect()}
    assert len(got) == 4 and all(r.accuracy > 0.5 and r.f1_macro > 0.3 for r in got.values())
    assert all((got[m].log_loss is None) == (m == "GradientBoostingClassifier") for m in got) and best["f1_macro"] == max(r.f1_macro for r in got.values())


def test_runs_are_evaluated_together_as_alone(spark):
    rng = random.Random(7)
    data = [(f"r{k % 3}", rng.randrange(2) if k % 3 else 1, float(rng.randrange(2)), rng.randrange(10) / 10) for k in range(500)]
    df = spark.createDataFrame(data, "run string, label int, prediction double, score double").cache()
    for metrics in (regression_metrics, binary_metrics, lambda d, by=None: multiclass_metrics(d, p_true="score", by=by)):
        for r in metrics(df, by=["run"]).collect():
            alone = metrics(df.where(F.col("run") == r.run)).first().asDict()
            assert {k: v for k, v in r.asDict().items() if k != "run"} == pytest.approx(alone)


def test_a_run_logged_twice_is_there_once(spark, tmp_path):
    df, curves = rows(spark).drop("features", "is_val", "u"), []
    runs, *_ = labs.run_lab(spark, df, "regresion", "y", ["id"], {"s": (["x", "z"], [])}, configs={
        "gbt": GBTRegressor(maxIter=4, seed=1), "lr": LinearRegression()}, curves=curves)
    path = str(tmp_path / "log")
    for _ in range(2):
        labs.log_runs(runs, path, curves)
    labs.log_runs(runs.where("model = 'lr'"), path)
    assert labs.read_run_log(spark, path).count() == 2
    got = labs.read_curves(spark, path).orderBy("epoch").collect()
    assert {(r.run_id, r.epoch, "val_loss", r.val_loss) for r in got if r.val_loss is not None} | {
        (r.run_id, r.epoch, "loss", r.loss) for r in got if r.loss is not None} == {(n, k, m, v) for n, m, k, v in curves}


def test_models_score_after_an_observation(spark):
    from equigap.operators.scenario import score

    df = rows(spark)
    seen = Observation()
    df.observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 600
    model = LogisticRegression(labelCol="b").fit(df)
    assert training.objective(model)
    assert score(model, df, kind="clasificacion_binaria").where("proba between 0 and 1").count() == 600
