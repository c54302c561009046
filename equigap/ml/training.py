"""Training beyond one ``fit``: early stopping with patience, robust
regression, oversampling, and models that can be shipped.

Boosted models are fitted whole, their validation loss is taken after every
tree, and the model is cut behind the best one.  Networks are trained in steps
from the weights of the step before, with a validation loss per step; without
hidden layers such a network is a logistic model.  Rows of equal features and label
are one row with a weight (Spark's perceptrons take none), and tasks add up the loss
and its gradient as matrix products of their rows; the driver holds the weights.  The Huber regression
reweights least squares, each round one pass of aggregated moments.  Linear
models of several labels on the same features are fitted on cells: rows of equal
features, with the number, mean and deviation of each label.  These are what least
squares takes from the rows, so that one pass serves all labels.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigap.operators.util import one_row
from equigap.session import materialize

#: Rounds without a better validation loss before training ends.
PATIENCE = 5
#: Iterations of a network's step.
STEP = 20


def patience_round(losses: list[float], patience: int = PATIENCE) -> tuple[int, int]:
    """The best round, and the round at which training ends: the first that is
    ``patience`` rounds behind the best so far.  Without a loss (no validation
    rows) all rounds count."""
    if any(math.isnan(x) for x in losses):
        return len(losses) - 1, len(losses) - 1
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        if k - best >= patience:
            return best, k
    return best, len(losses) - 1


def log_loss(pred: DataFrame, eps: float = 1e-15) -> float:
    p = F.element_at(vector_to_array("probability"), F.col("label").cast("int") + 1)
    loss = one_row(pred.agg((-F.avg(F.log(F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))))).alias("loss")))["loss"]
    return math.nan if loss is None else loss


def truncated(model, trees: int):
    """The boosted model's first ``trees`` trees."""
    if trees >= model.getNumTrees:
        return model
    sc, java = SparkContext._active_spark_context, model._java_obj
    kind = sc._jvm.org.apache.spark.ml
    cut = sc._gateway.new_array(kind.regression.DecisionTreeRegressionModel, trees)
    weights = sc._gateway.new_array(sc._gateway.jvm.double, trees)
    own, every = java.trees(), java.treeWeights()
    for k in range(trees):
        cut[k], weights[k] = own[k], every[k]
    made = kind.classification.GBTClassificationModel if isinstance(model, GBTClassificationModel) else kind.regression.GBTRegressionModel
    return type(model)(made(java.uid(), cut, weights))


def fit_boosting(est, rows: DataFrame, valid: DataFrame, patience: int = PATIENCE):
    """(model of the best round, validation losses up to the last round)."""
    model = est.fit(rows)
    losses = model.evaluateEachIteration(valid) if isinstance(est, GBTClassifier) else model.evaluateEachIteration(valid, est.getLossType())
    best, last = patience_round(losses, patience)
    return truncated(model, best + 1), losses[:last + 1]


def layer_weights(weights: np.ndarray, layers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(matrix, bias) of each layer, in the order of Spark's perceptrons."""
    out, at = [], 0
    for n, m in zip(layers, layers[1:]):
        out.append((weights[at:at + n * m].reshape(n, m), weights[at + n * m:at + n * m + m]))
        at += n * m + m
    return out


def loss_and_gradient(weights: np.ndarray, layers: list[int], x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Cross entropy of rows ``x`` with labels ``y``, each ``n`` times, summed, and its
    gradient: sigmoid layers, the last one softmax."""
    parts, values = layer_weights(weights, layers), [x]
    for k, (w, bias) in enumerate(parts):
        z = values[-1] @ w + bias
        values.append(z if k == len(parts) - 1 else 0.5 + 0.5 * np.tanh(0.5 * z))
    z = values.pop()
    z -= z.max(axis=1, keepdims=True)
    own = z[np.arange(len(y)), y]
    p = np.exp(z)
    total = p.sum(axis=1)
    loss = float(n @ (np.log(total) - own))
    p /= total[:, None]
    p[np.arange(len(y)), y] -= 1
    delta, found = p * n[:, None], []
    for k in range(len(parts) - 1, -1, -1):
        found += [delta.sum(axis=0), (values[k].T @ delta).ravel()]
        if k:
            delta = (delta @ parts[k][0].T) * values[k] * (1 - values[k])
    return loss, np.concatenate(found[::-1])


def summed_loss(table: DataFrame, weights: np.ndarray, layers: list[int]) -> tuple[float, np.ndarray]:
    """``loss_and_gradient`` of all rows of ``table`` (cell, label, n), for one row in all."""
    def sums(batches):
        out = np.zeros(2 + len(weights))
        for b in batches:
            if b.num_rows:
                x, y, n = b.column(0).flatten().to_numpy().reshape(b.num_rows, -1), b.column(1).to_numpy(), b.column(2).to_numpy()
                loss, gradient = loss_and_gradient(weights, layers, x, y, n)
                out += np.concatenate([[loss, n.sum()], gradient])
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([out.tolist()], pa.list_(pa.float64()))], ["part", "sums"])

    found = sorted(table.mapInArrow(sums, "part int, sums array<double>").collect())  # a row per task, added in one order
    out = np.sum([r["sums"] for r in found], axis=0)
    return out[0] / out[1], out[2:] / out[1]


def descended(loss, x: np.ndarray, rounds: int, tol: float, memory: int = 10, trials: int = 20) -> np.ndarray:
    """``x`` after ``rounds`` iterations of L-BFGS on ``loss`` (value and gradient); steps
    keep to the Wolfe conditions."""
    (f, g), steps = loss(x), []
    for _ in range(rounds):
        if np.linalg.norm(g) <= max(tol * abs(f), 1e-8):
            break
        d, used = -g, []
        for s, y in reversed(steps):
            used.append(s @ d / (s @ y))
            d = d - used[-1] * y
        if steps:
            d = d * (steps[-1][0] @ steps[-1][1] / (steps[-1][1] @ steps[-1][1]))
        for s, y in steps:
            d = d + s * (used.pop() - y @ d / (s @ y))
        slope, low, high, t = d @ g, 0.0, math.inf, 1.0 if steps else 1 / np.linalg.norm(g)
        for _ in range(trials):
            new, (value, gradient) = x + t * d, loss(x + t * d)
            if not value <= f + 1e-4 * t * slope:
                high = t
            elif gradient @ d < 0.9 * slope:
                low = t
            else:
                break
            t = (low + high) / 2 if high < math.inf else 2 * low
        if not value < f:
            break
        if (gradient - g) @ (new - x) > 0:
            steps = [*steps, (new - x, gradient - g)][-memory:]
        x, f, g = new, value, gradient
    return x


def fit_network(est: MultilayerPerceptronClassifier, rows: DataFrame, valid: DataFrame, patience: int = PATIENCE, step: int = STEP):
    """(model of the best step, validation losses), in steps of ``step`` iterations of
    L-BFGS up to the estimator's number."""
    spark, layers = rows.sparkSession, est.getLayers()
    one = spark.createDataFrame([(Vectors.dense([0.0] * layers[0]), 0.0)], ["features", "label"])

    def model_of(weights):
        """Spark's model with these weights, by default those that the seed gives."""
        return est.copy({est.maxIter: 0} | ({} if weights is None else {est.initialWeights: Vectors.dense(weights)})).fit(one)

    cells = rows.groupBy(vector_to_array("features").alias("cell"), F.col("label").cast("int").alias("label")).agg(F.count("*").cast("double").alias("n"))
    cells = materialize(cells, "network_cells")
    table = cells.repartition(max(spark.sparkContext.defaultParallelism, cells.rdd.getNumPartitions())).persist()
    try:
        weights, models, losses = model_of(est.getInitialWeights() if est.isSet(est.initialWeights) else None).weights.toArray(), [], []
        for _ in range(math.ceil(est.getMaxIter() / step)):
            weights = descended(lambda w: summed_loss(table, w, layers), weights, step, est.getTol())
            models.append(model_of(weights))
            losses.append(log_loss(models[-1].transform(valid)))
            best, _ = patience_round(losses, patience)
            if len(losses) - 1 - best >= patience:
                break
    finally:
        table.unpersist()
    return models[patience_round(losses, patience)[0]], losses


def oversampled(rows: DataFrame, weight: str = "weight", uniform: str = "u") -> DataFrame:
    """Each row as often as its weight says, counted in the least weight; the
    fraction is decided by the row's own number in [0, 1)."""
    low = one_row(rows.agg(F.min(weight).alias("low")))["low"]
    if not low:
        return rows
    times = F.col(weight) / F.lit(low)
    copies = F.floor(times + 1e-9) + (F.col(uniform) < times - F.floor(times + 1e-9)).cast("int")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies.cast("int")))).drop("__copy")


class HuberRegression:
    """Linear regression by the Huber loss: squares up to ``delta`` (in units of the
    label), absolute beyond."""

    def __init__(self, labelCol: str = "label", delta: float = 1.0, maxIter: int = 20, tol: float = 1e-4):
        self.label, self.delta, self.rounds, self.tol = labelCol, delta, maxIter, tol

    def params(self) -> dict:
        return {"loss": "huber", "delta": self.delta, "maxIter": self.rounds}

    def settled(self, now: list[float], before: list[float]) -> bool:
        return max(abs(a - b) for a, b in zip(now, before)) <= self.tol * (1 + max(map(abs, now)))

    def fit(self, rows: DataFrame) -> LinearRegressionModel:
        est = LinearRegression(labelCol=self.label, solver="normal", weightCol="__w")
        model, before = LinearRegression(labelCol=self.label, solver="normal").fit(rows), None
        for _ in range(self.rounds):
            now = [*model.coefficients, model.intercept]
            if before is not None and self.settled(now, before):
                break
            miss = F.abs(F.col(self.label) - F.col("prediction"))
            weighted = detached(model).transform(rows).withColumn("__w", F.when(miss <= self.delta, 1.0).otherwise(self.delta / miss)).drop("prediction")
            model, before = est.fit(weighted), now
        return model


def on_moments(est) -> bool:
    """Whether ``est`` is least squares that takes no more from the rows than moments."""
    return isinstance(est, HuberRegression) or (isinstance(est, LinearRegression) and est.getSolver() in ("auto", "normal")
                                                and est.getLoss() == "squaredError" and not est.isDefined(est.weightCol))


def label_cells(rows: DataFrame, models: dict[str, LinearRegressionModel], delta: float = 0.0) -> DataFrame:
    """cell (the features) and per label ``c`` of ``models`` n_c (rows), m_c and s_c (mean and
    deviation); rows without the label do not count.  Where there is a model, rows are
    weighed by the Huber loss of its prediction."""
    scored, found = rows, []
    for c, model in models.items():
        if model is None:
            found += [F.count(c).cast("double").alias(f"n_{c}"), F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
            continue
        scored = model.copy({model.predictionCol: f"__p_{c}"}).transform(scored)
        over = F.col(c) - F.col(f"__p_{c}")  # the prediction is the same in all of a cell
        w = F.when(F.abs(over) <= delta, 1.0).otherwise(delta / F.abs(over))
        n, mean = F.sum(w), F.sum(w * over) / F.sum(w)
        found += [n.alias(f"n_{c}"), (F.first(f"__p_{c}") + mean).alias(f"m_{c}"), F.sqrt(F.greatest(F.sum(w * over * over) / n - mean * mean, F.lit(0.0))).alias(f"s_{c}")]
    return materialize(scored.groupBy(vector_to_array("features").alias("cell")).agg(*found), "lab_moments")


def rows_of(table: DataFrame, c: str) -> DataFrame:
    """features, label and rows of a cell: two rows with its number, mean and deviation."""
    ends = F.explode(F.array(F.col(f"m_{c}") - F.col(f"s_{c}"), F.col(f"m_{c}") + F.col(f"s_{c}"))).alias("label")
    return table.where(F.col(f"n_{c}") > 0).select(array_to_vector("cell").alias("features"), ends, (F.col(f"n_{c}") / 2).alias("rows"))


def fit_labels(est, rows: DataFrame, labels: list[str], table: DataFrame) -> dict:
    """The models of ``est`` for each of the ``labels``, by their ``table`` of cells."""
    if not isinstance(est, HuberRegression):
        return {c: est.copy({est.weightCol: "rows"}).fit(rows_of(table, c)) for c in labels}
    plain = LinearRegression(solver="normal", weightCol="rows")
    models = {c: plain.fit(rows_of(table, c)) for c in labels}
    values = lambda model: [*model.coefficients, model.intercept]
    going = dict.fromkeys(labels)  # the values before, of the labels that are not done
    for _ in range(est.rounds):
        going = {c: before for c, before in going.items() if before is None or not est.settled(values(models[c]), before)}
        if not going:
            break
        now = label_cells(rows, {c: detached(models[c]) for c in going}, est.delta)
        going = {c: values(models[c]) for c in going}
        models |= {c: plain.fit(rows_of(now, c)) for c in going}
    return models


def objective(model) -> list[float]:
    """The training objective by iteration, where the model has one."""
    if getattr(model, "hasSummary", False):
        try:
            return [float(x) for x in model.summary.objectiveHistory]
        except Exception:  # a summary without a history
            return []
    return []


def detached(model):
    """``model`` without its training summary, which holds on to the session and
    would travel with every scoring task."""
    for part in [*getattr(model, "stages", []), *getattr(model, "models", [])]:
        detached(part)
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


def is_boosting(est) -> bool:
    return isinstance(est, (GBTClassifier, GBTRegressor))
