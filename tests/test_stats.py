"""Closed forms for the tails, invariants of the tests, OLS vs numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from equigap.stats import hypothesis as H
from equigap.stats.ols import ols
from equigap.stats.tails import f_sf, t_sf2


@pytest.mark.parametrize("t", [0.0, 0.5, 1.0, 2.5, 10.0, -3.0])
def test_t_tail_closed_forms(t):
    assert t_sf2(t, 1.0) == pytest.approx(1 - 2 * math.atan(abs(t)) / math.pi, abs=1e-12)
    assert t_sf2(t, 2.0) == pytest.approx(1 - abs(t) / math.sqrt(2 + t * t), abs=1e-12)


@pytest.mark.parametrize("f,d", [(0.5, 5), (4.0, 10), (25.0, 300)])
def test_f1_tail_equals_t_tail(f, d):
    assert f_sf(f, 1.0, float(d)) == pytest.approx(t_sf2(math.sqrt(f), float(d)), rel=1e-10)


def test_large_df_normal_limit():
    # df -> inf: two-sided p of 1.959964 is 0.05
    assert t_sf2(1.959964, 1e7) == pytest.approx(0.05, abs=1e-5)


def _groups(spark):
    rng = np.random.default_rng(7)
    a = rng.normal(10, 2, 200)
    b = rng.normal(11, 3, 150)
    rows = [("OFICIAL", float(x)) for x in a] + [("NO OFICIAL", float(x)) for x in b]
    return spark.createDataFrame(rows, "g string, v double"), a, b


def test_welch_matches_formula(spark):
    df, a, b = _groups(spark)
    r = H.welch(df, "v", "g").first()
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    t = (a.mean() - b.mean()) / math.sqrt(va + vb)
    dof = (va + vb) ** 2 / (va ** 2 / (len(a) - 1) + vb ** 2 / (len(b) - 1))
    pooled = math.sqrt(((len(a) - 1) * a.var(ddof=1) + (len(b) - 1) * b.var(ddof=1)) / (len(a) + len(b) - 2))
    assert r.t == pytest.approx(t) and r.df == pytest.approx(dof)
    assert r.cohen_d == pytest.approx((a.mean() - b.mean()) / pooled)
    assert r.diferencia == pytest.approx(b.mean() - a.mean())  # private - public, opposite sign to t and d
    assert r.p_valor == pytest.approx(t_sf2(t, dof))


def test_cohen_zero_variance(spark):
    df = spark.createDataFrame([("OFICIAL", 1.0), ("OFICIAL", 1.0), ("NO OFICIAL", 1.0), ("NO OFICIAL", 1.0)],
                               "g string, v double")
    assert H.welch(df, "v", "g").first().cohen_d == 0.0


def test_anova_two_groups_is_pooled_t_squared(spark):
    df, a, b = _groups(spark)
    g = df.withColumn("s", F.when(F.col("g") == "OFICIAL", "Estrato 1").otherwise("Estrato 2"))
    r = H.anova(g, "v", "s").first()
    sp2 = ((len(a) - 1) * a.var(ddof=1) + (len(b) - 1) * b.var(ddof=1)) / (len(a) + len(b) - 2)
    t2 = ((a.mean() - b.mean()) / math.sqrt(sp2 * (1 / len(a) + 1 / len(b)))) ** 2
    assert r.F == pytest.approx(t2)
    assert r.p_valor == pytest.approx(t_sf2(math.sqrt(t2), len(a) + len(b) - 2))


def test_stratified_min_group(spark):
    rows = [("Estrato 1", "OFICIAL", float(i)) for i in range(30)] + \
           [("Estrato 1", "NO OFICIAL", float(i) + 1) for i in range(30)] + \
           [("Estrato 2", "OFICIAL", float(i)) for i in range(29)] + \
           [("Estrato 2", "NO OFICIAL", float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "s string, g string, v double")
    out = H.stratified_tests(df, "v", "g", "s").collect()
    assert [r.Estrato for r in out] == ["Estrato 1"] and out[0].Brecha == 1.0


def test_ols_vs_numpy_and_rank_deficiency(spark):
    rng = np.random.default_rng(11)
    n = 400
    x1 = rng.normal(size=n)
    a = rng.integers(0, 2, n)
    b = rng.integers(0, 2, n)
    cat = np.where(rng.random(n) < 0.5, "u", "v")
    y = 2 + 3 * x1 + 1.5 * a - b + (cat == "v") * 0.7 + rng.normal(scale=0.5, size=n)
    rows = [(float(y[i]), float(x1[i]), int(a[i]), int(b[i]), int(a[i] + b[i]), str(cat[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "y double, x1 double, a int, b int, s int, c string")
    summ, t, f = ols(spark, df, "y", ["x1", "a", "b", "s"], ["c"], ["x1", "a", "c"])
    X = np.column_stack([np.ones(n), x1, a, (cat == "v").astype(float)])
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    coefs = {r.variable: r.coef for r in t.collect()}
    assert coefs["x1"] == pytest.approx(beta[1], rel=1e-6) and coefs["a"] == pytest.approx(beta[2], rel=1e-6)
    resid = y - X @ beta
    r2 = 1 - resid @ resid / ((y - y.mean()) @ (y - y.mean()))
    assert summ.first().r2 == pytest.approx(r2, rel=1e-6)
    # full model contains s = a + b (rank deficient): still answers, with every group tested
    names = [r.variable for r in f.collect()]
    assert {"x1", "a", "b", "s", "c"} <= set(names)
    assert {"x1 + a", "x1 + c", "a + c", "x1 + a + c"} <= set(names)


def test_trend_matches_polyfit(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=100)
    y = 4 * x + 1 + rng.normal(scale=0.1, size=100)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    r = H.trend(df, "x", "y").first()
    slope, icpt = np.polyfit(x, y, 1)
    assert (r.slope, r.intercept) == pytest.approx((slope, icpt)) and r.n == 100


def test_ols_wide_scales_dummy_and_dependent_column(spark):
    """A 1e9 column, a dummy and a dependent column: rank, coefficients, R2 and
    t as numpy gives them for the scaled design."""
    from equigap.stats.ols import fit, moments

    rng = np.random.default_rng(0)
    n = 3000
    a, g, b = rng.uniform(5.6e7, 9e8, n), rng.integers(0, 2, n), rng.integers(0, 3, n)
    lev = np.array(["p", "q", "r"])[rng.integers(0, 3, n)]
    y = 200 + 1e-8 * a + 32 * g + 5 * (lev == "r") + rng.normal(0, 20, n)
    rows = [(float(p), int(q), int(r), int(q + r), str(s), float(t)) for p, q, r, s, t in zip(a, g, b, lev, y)]
    df = spark.createDataFrame(rows, "a double, g int, b int, gb int, lev string, y double").repartition(5)
    f = fit(moments(df, "y", ["a", "g", "b", "gb"], ["lev"])[0])
    x = np.column_stack([np.ones(n), a, g, b, g + b, lev == "q", lev == "r"]).astype(float)
    scale = np.abs(x).max(0)
    want = np.linalg.lstsq(x / scale, y, rcond=1e-12)[0] / scale
    null = np.array([0, 0, 1, 1, -1, 0, 0]) / math.sqrt(3)
    want -= null * (null @ want)
    rss = ((y - x @ want) ** 2).sum()
    assert f.rank == 6 and f.beta == pytest.approx(want, rel=1e-6, abs=1e-9)
    assert f.rss == pytest.approx(rss) and f.r2 == pytest.approx(1 - rss / ((y - y.mean()) ** 2).sum())
    free = (x / scale)[:, [0, 1, 2, 3, 5, 6]]
    se = math.sqrt(np.linalg.inv(free.T @ free)[1, 1] * rss / (n - 6)) / scale[1]
    assert {r[0]: r[2] for r in f.t_table()}["a"] == pytest.approx(want[1] / se)


def test_ols_categorical_is_anova(spark):
    df, a, b = _groups(spark)
    g = df.withColumn("s", F.when(F.col("g") == "OFICIAL", "Estrato 1").otherwise("Estrato 2"))
    _, _, f = ols(spark, g, "v", [], ["s"], ["s"])
    assert f.first().p_value == pytest.approx(H.anova(g, "v", "s").first().p_valor, rel=1e-6)


def test_ols_many_levels(spark):
    from equigap.stats.ols import fit, moments

    df = spark.range(40_000).selectExpr("concat('l', id % 1000) as c", "id % 1000 + rand(1) as y", "rand(2) as x")
    f = fit(moments(df, "y", ["x"], ["c"])[0])
    assert f.rank == 1001 and f.r2 > 0.999


def test_ols_no_rows(spark):
    summary, t, f = ols(spark, spark.createDataFrame([], "y double, x double"), "y", ["x"], [], ["x"])
    assert summary.first().n_obs == 0
