"""Networks and logistic models on weighted rows against Spark's on the rows."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from equigap.ml import cells, labs, training


@pytest.fixture(scope="module")
def data(spark):
    rng, out = random.Random(5), []
    for i in range(3000):
        x, z = rng.randrange(-8, 9) / 4, float(rng.randrange(3))
        out.append((i, x, z, float(min(2, max(0, int(x + z + rng.gauss(0, 0.5))))), i % 5 == 0, 1.0 + i % 3, rng.random()))
    df = spark.createDataFrame(out, "id long, x double, z double, label double, is_val boolean, weight double, u double")
    return VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df).cache()


def test_weights_are_those_of_sparks_perceptron(data):
    est = MultilayerPerceptronClassifier(layers=[2, 5, 4, 3], seed=2, maxIter=30)
    model = est.fit(data)
    x = np.array([r.features.toArray() for r in data.collect()])
    y = np.array([int(r.label) for r in data.collect()])
    loss, gradient = training.loss_and_gradient(model.weights.toArray(), est.getLayers(), x, y, np.ones(len(y)))
    assert loss / len(y) == pytest.approx(training.log_loss(model.transform(data)), rel=1e-9)
    w, n = model.weights.toArray(), np.arange(1.0, len(y) + 1)
    at = lambda v: training.loss_and_gradient(v, est.getLayers(), x, y, n)
    for k in (0, 7, 14, 20, len(w) - 1):
        e = np.eye(len(w))[k] * 1e-5
        assert at(w)[1][k] == pytest.approx((at(w + e)[0] - at(w - e)[0]) / 2e-5, rel=1e-4, abs=1e-2)


def test_a_network_on_equal_rows_is_as_good_as_sparks(spark, data, monkeypatch):
    read, summed = [], training.summed_loss
    monkeypatch.setattr(training, "summed_loss", lambda table, *rest: (read.append(table.count()), summed(table, *rest))[1])
    est = MultilayerPerceptronClassifier(layers=[2, 6, 3], seed=2, maxIter=100)
    rows = data.where("not is_val")
    model, losses = training.fit_network(est, rows, data.where("is_val"), patience=100)
    assert len(losses) == 5 and max(read) <= 17 * 3 * 3
    assert training.log_loss(model.transform(rows)) <= training.log_loss(est.fit(rows).transform(rows)) + 0.01
    again, _ = training.fit_network(est, rows.repartition(7), data.where("is_val"), patience=100)
    assert np.allclose(again.weights.toArray(), model.weights.toArray(), rtol=0.05, atol=0.05)
    start = est.copy({est.initialWeights: Vectors.dense(np.full(6 * 3 + 3 * 7, 0.1))})
    assert training.fit_network(start, rows, data.where("is_val"), patience=1, step=100)[1][0] < 1


def test_logistic_models_on_equal_rows_are_those_on_rows(data):
    est = LogisticRegression(maxIter=200)
    model, _, curve = labs.fit_run(est, data, "clasificacion_multiclase")
    every = est.copy({est.weightCol: "weight"}).fit(data)
    p = lambda m: np.array([r.probability.toArray() for r in m.transform(data).orderBy("id").collect()])
    assert np.abs(p(model) - p(every)).max() < 2e-3 and curve
    table = cells.equal_rows(data)
    assert table.count() <= 17 * 3 * 3 and table.agg(F.sum("weight")).first()[0] == data.agg(F.sum("weight")).first()[0]
