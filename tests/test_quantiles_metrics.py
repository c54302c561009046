"""Exact quantile refinement, ordinal, AUC and metric definitions vs brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from equigap.ml.metrics import binary_metrics, multiclass_metrics, regression_metrics, roc_auc
from equigap.operators.gaps import box_summary
from equigap.operators.quantiles import column_medians, quantile_row
from equigap.operators.util import ordinal_within


def test_quantiles_equal_numpy_with_hot_value(spark):
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.normal(250, 60, 20000), np.full(10000, 213.0)])  # a third of rows one value
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(7)
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    row = quantile_row(df, "x", qs).first()
    assert list(row) == pytest.approx(list(np.percentile(vals, [q * 100 for q in qs])), abs=1e-9)


def test_nan_is_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,), (3.0,), (None,)], "x double")
    assert tuple(quantile_row(df, "x", [0.5, 0.9]).first()) == pytest.approx((2.0, 2.8))
    assert tuple(quantile_row(df.where("x > 5"), "x", [0.5]).first()) == (None,)
    assert column_medians(df.withColumn("y", F.lit(None).cast("double")), ["x", "y"]) == {"x": 2.0, "y": None}


def test_many_cells(spark):
    rng = np.random.default_rng(1)
    rows = [(f"g{i % 300}" if i % 7 else None, *map(float, rng.integers(0, 50, 6))) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, " + ", ".join(f"m{k} double" for k in range(6)))
    got = {(r.metric, r.g): r for r in box_summary(df, [f"m{k}" for k in range(6)], "g").collect()}
    assert len(got) == 1800
    for (metric, g), r in list(got.items())[::97]:
        v = np.array([row[1 + int(metric[1])] for row in rows if row[0] == g])
        q1, q2, q3 = np.percentile(v, [25, 50, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert (r.q1, r.median, r.q3, r.n) == (q1, q2, q3, len(v)) and r.outliers == ((v < lo) | (v > hi)).sum()
        assert (r.whisker_low, r.whisker_high) == (v[v >= lo].min(), v[v <= hi].max())


def test_ordinal_within_hot_key(spark):
    rows = [(0 if i % 3 else 1, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t int")
    out = ordinal_within(df, "k", ["t"], partitions=6).collect()
    for k in (0, 1):
        ts = sorted(r.t for r in out if r.k == k)
        ords = {r.t: r.ordinal for r in out if r.k == k}
        assert [ords[t] for t in ts] == list(range(1, len(ts) + 1))


def _brute_auc(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    tot = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) + 0.3 * y, 1)  # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    assert roc_auc(df, partitions=5).first()[0] == pytest.approx(_brute_auc(y, s))
    one = df.where("label = 1")
    assert roc_auc(one).first()[0] is None


def test_binary_zero_division(spark):
    df = spark.createDataFrame([(1, 0, 0.2), (0, 0, 0.1)], "label int, prediction int, score double")
    m = binary_metrics(df).first()
    assert (m.precision, m.recall, m.f1, m.accuracy) == (0.0, 0.0, 0.0, 0.5)


def test_macro_f1_union_of_labels(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")]
    m = multiclass_metrics(spark.createDataFrame(rows, "label string, prediction string")).first()
    # per class f1: a = 2*1/(2+1), b = 2*1/(1+3), c = 0
    assert m.f1_macro == pytest.approx((2 / 3 + 0.5 + 0) / 3) and m.accuracy == 0.5


def test_regression_metrics(spark):
    y = np.array([1.0, 2.0, 3.0, 5.0])
    p = np.array([1.5, 2.0, 2.0, 6.0])
    m = regression_metrics(spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)],
                                                 "label double, prediction double")).first()
    assert m.rmse == pytest.approx(np.sqrt(np.mean((p - y) ** 2)))
    assert m.mae == pytest.approx(np.mean(np.abs(p - y)))
    assert m.r2 == pytest.approx(1 - np.sum((p - y) ** 2) / np.sum((y - y.mean()) ** 2))
