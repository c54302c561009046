"""Registered statistical-test queries.

DuckDB has no t / F distribution, so the oracle queries carry t, df, d, F
and the group statistics; the p-values (T09) are registered as separate
rows-only queries and unit-tested against closed forms.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from equigap.functions import labels as L
from equigap.operators import gaps as G
from equigap.operators import joins as J
from equigap.plans import sqlbits as S
from equigap.plans.catalog import register
from equigap.plans.q_aggregates import SUBJECTS, _p1_frame, r6
from equigap.plans.tpch import exam_lines, exam_orders, region_gdp
from equigap.stats import hypothesis as H
from equigap.stats.ols import ols

_SUM = """n_a, mean_a, var_a, n_b, mean_b, var_b"""
_W = """, w AS (SELECT *, (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) AS t,
  (var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b) /
  ((var_a / n_a) * (var_a / n_a) / (n_a - 1) + (var_b / n_b) * (var_b / n_b) / (n_b - 1)) AS df,
  CASE WHEN sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / (n_a + n_b - 2)) = 0 THEN 0.0
       ELSE (mean_a - mean_b) / sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / (n_a + n_b - 2)) END AS d FROM s)
"""


def _stats_sql(src: str, value: str, group: str, a: str, b: str, keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    gb = f" GROUP BY {keys}" if keys else ""
    return f""", s AS (SELECT {k}CAST(count(CASE WHEN {group} = '{a}' THEN {value} END) AS BIGINT) AS n_a,
  avg(CASE WHEN {group} = '{a}' THEN {value} END) AS mean_a, var_samp(CASE WHEN {group} = '{a}' THEN {value} END) AS var_a,
  CAST(count(CASE WHEN {group} = '{b}' THEN {value} END) AS BIGINT) AS n_b,
  avg(CASE WHEN {group} = '{b}' THEN {value} END) AS mean_b, var_samp(CASE WHEN {group} = '{b}' THEN {value} END) AS var_b
  FROM {src} WHERE {value} IS NOT NULL{gb})
""" + _W


@register("T01_welch", _stats_sql("exam_orders", "punt_global", "cole_naturaleza", "OFICIAL", "NO OFICIAL")
          + "SELECT n_a, n_b, round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b, round(t, 6) AS t, "
            "round(df, 6) AS df, round(mean_b - mean_a, 6) AS diferencia FROM w")
def t01(spark, sf):
    w = H.welch(exam_orders(spark, sf), "punt_global", "cole_naturaleza")
    return r6(w.select("n_a", "n_b", "mean_a", "mean_b", "t", "df", "diferencia"), "mean_a", "mean_b", "t", "df",
              "diferencia")


@register("T02_cohen_d", _stats_sql("exam_lines", "punt_ingles", "cole_naturaleza", "OFICIAL", "NO OFICIAL")
          + "SELECT round(d, 6) AS cohen_d, " + S.effect("d") + " AS efecto FROM w")
def t02(spark, sf):
    w = H.welch(exam_lines(spark, sf), "punt_ingles", "cole_naturaleza")
    return r6(w.select("cohen_d", L.effect_label(F.col("cohen_d")).alias("efecto")), "cohen_d")


_T03_U = ", u AS (" + " UNION ALL ".join(
    f"SELECT '{k}' AS Materia, cole_naturaleza, {v} AS v FROM exam_lines" for k, v in SUBJECTS.items()) + ")\n"


@register("T03_subject_tests", _T03_U + _stats_sql("u", "v", "cole_naturaleza", "OFICIAL", "NO OFICIAL", "Materia")
          + """SELECT Materia, round_even(mean_a, 2) AS Publico, round_even(mean_b, 2) AS Privado,
  round_even(mean_b - mean_a, 2) AS Brecha, round_even(t, 4) AS t, round_even(d, 4) AS Cohen_d, """ + S.effect("d")
          + " AS Efecto FROM w")
def t03(spark, sf):
    return H.subject_tests(exam_lines(spark, sf), SUBJECTS, "cole_naturaleza").drop("p_valor")


@register("T04_stratified_tests", _stats_sql("exam_orders", "punt_global", "cole_naturaleza", "OFICIAL", "NO OFICIAL",
                                             "fami_estratovivienda")
          + """SELECT fami_estratovivienda AS Estrato, round_even(mean_a, 2) AS Publico, round_even(mean_b, 2) AS Privado,
  round_even(mean_b - mean_a, 2) AS Brecha, round_even(d, 4) AS Cohen_d, """ + S.effect("d") + """ AS Efecto,
  n_a AS n_pub, n_b AS n_priv FROM w WHERE n_a >= 30 AND n_b >= 30
  AND fami_estratovivienda IN ('Estrato 1','Estrato 2','Estrato 3','Estrato 4','Estrato 5','Estrato 6')""")
def t04(spark, sf):
    return H.stratified_tests(exam_orders(spark, sf), "punt_global", "cole_naturaleza", "fami_estratovivienda").drop("p_valor")


@register("T05_anova", """, g AS (SELECT fami_estratovivienda, count(*) AS n, avg(punt_global) AS m, var_samp(punt_global) AS v
  FROM exam_orders WHERE punt_global IS NOT NULL AND fami_estratovivienda IN
  ('Estrato 1','Estrato 2','Estrato 3','Estrato 4','Estrato 5','Estrato 6') GROUP BY 1),
t AS (SELECT sum(n) AS nn, sum(n * m) / sum(n) AS grand, count(*) AS k FROM g),
r AS (SELECT sum(n * (m - grand) * (m - grand)) AS ssb, sum(coalesce((n - 1) * v, 0.0)) AS ssw, max(nn) AS nn, max(k) AS k FROM g, t)
SELECT round((ssb / (k - 1)) / (ssw / (nn - k)), 6) AS F, CAST(k - 1 AS BIGINT) AS df_between,
  CAST(nn - k AS BIGINT) AS df_within FROM r""")
def t05(spark, sf):
    return r6(H.anova(exam_orders(spark, sf), "punt_global", "fami_estratovivienda").drop("p_valor"), "F")


@register("T07_trend_gap_gdp", """, p1 AS (SELECT *, """ + S.zone_residence("cole_area_ubicacion") + """ AS Area FROM exam_orders
  WHERE cole_area_ubicacion IS NOT NULL AND upper(cole_area_ubicacion) NOT IN ('SIN INFORMACIÓN', 'SIN INFORMACION', 'NAN')),
g AS (SELECT cole_mcpio_ubicacion, avg(CASE WHEN Area = 'Urbano' THEN punt_global END) - avg(CASE WHEN Area = 'Rural' THEN punt_global END) AS gap
  FROM p1 WHERE cole_mcpio_ubicacion IS NOT NULL GROUP BY 1),
j AS (SELECT g.gap, d.pib_miles_millones AS pib FROM g LEFT JOIN region_gdp d ON upper(trim(g.cole_mcpio_ubicacion)) = upper(trim(d.municipio)))
SELECT round(regr_slope(gap, pib), 6) AS slope, round(regr_intercept(gap, pib), 6) AS intercept,
  round(regr_r2(gap, pib), 6) AS r2, CAST(regr_count(gap, pib) AS BIGINT) AS n FROM j""")
def t07(spark, sf):
    gap = G.region_gap(_p1_frame(spark, sf), "punt_global", "cole_mcpio_ubicacion", "Area")
    j = J.with_gdp(gap, region_gdp(spark, sf), "cole_mcpio_ubicacion", "municipio", ["pib_miles_millones"])
    return r6(H.trend(j, "pib_miles_millones", "Brecha_Puntos"), "slope", "intercept", "r2")


@register("T07_trend_by_access", """SELECT tic, round(regr_slope(punt_global, punt_ingles), 6) AS slope,
  round(regr_intercept(punt_global, punt_ingles), 6) AS intercept, round(regr_r2(punt_global, punt_ingles), 6) AS r2,
  CAST(regr_count(punt_global, punt_ingles) AS BIGINT) AS n
FROM (SELECT *, CASE WHEN fami_tieneinternet IS NOT DISTINCT FROM 'Si' AND fami_tienecomputador IS NOT DISTINCT FROM 'Si'
  THEN 'Internet y Computador' WHEN fami_tieneinternet IS NOT DISTINCT FROM 'Si' THEN 'Solo Internet'
  WHEN fami_tienecomputador IS NOT DISTINCT FROM 'Si' THEN 'Solo Computador' ELSE 'Sin Acceso TIC' END AS tic FROM exam_lines)
GROUP BY tic""")
def t07b(spark, sf):
    d = exam_lines(spark, sf).withColumn("tic", L.access4("fami_tieneinternet", "fami_tienecomputador"))
    return r6(H.trend(d, "punt_ingles", "punt_global", by="tic"), "slope", "intercept", "r2")


@register("T11_flag_significant", "SELECT estu_consecutivo, CASE WHEN punt_global / 500 - 0.9 < 0.05 THEN 'Si' ELSE 'No' END "
          "AS significativa FROM exam_orders")
def t11(spark, sf):
    return exam_orders(spark, sf).select("estu_consecutivo",
                                         L.flag_significant(F.col("punt_global") / 500 - 0.9).alias("significativa"))


@register("T08_ols_one_predictor", """, s AS (SELECT count(*) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a,
  regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy
  FROM (SELECT punt_global AS y, punt_matematicas AS x FROM exam_lines))
SELECT round(b, 6) AS coef, round(b / sqrt(((syy - b * sxy) / (n - 2)) / sxx), 6) AS t_stat FROM s""")
def t08a(spark, sf):
    _, t, _ = ols(spark, exam_lines(spark, sf), "punt_global", ["punt_matematicas"], [], ["punt_matematicas"])
    return r6(t.select("coef", "t_stat"), "coef", "t_stat")


@register("T08_ols_two_predictors", """, s AS (SELECT count(*) AS n, covar_pop(a, a) AS aa, covar_pop(b, b) AS bb, covar_pop(a, b) AS ab,
  covar_pop(a, y) AS ay, covar_pop(b, y) AS b_y, covar_pop(y, y) AS yy
  FROM (SELECT punt_global AS y, punt_matematicas AS a, punt_ingles AS b FROM exam_lines)),
f AS (SELECT *, aa * bb - ab * ab AS det, (bb * ay - ab * b_y) / (aa * bb - ab * ab) AS ca, (aa * b_y - ab * ay) / (aa * bb - ab * ab) AS cb FROM s),
e AS (SELECT *, (yy - ca * ay - cb * b_y) / (n - 3) AS v FROM f)
SELECT 'punt_matematicas' AS variable, round(ca, 6) AS coef, round(ca / sqrt(v * bb / det), 6) AS t_stat FROM e
UNION ALL SELECT 'punt_ingles', round(cb, 6), round(cb / sqrt(v * aa / det), 6) FROM e""")
def t08b(spark, sf):
    x = ["punt_matematicas", "punt_ingles"]
    _, t, _ = ols(spark, exam_lines(spark, sf), "punt_global", x, [], x)
    return r6(t.select("variable", "coef", "t_stat"), "coef", "t_stat")


# ------------------------------------------------ rows-only (p-values) ----

@register("T09_welch_pvalues")
def t09(spark, sf):
    return H.subject_tests(exam_lines(spark, sf), SUBJECTS, "cole_naturaleza").select("Materia", "t", "p_valor")


@register("T05_anova_pvalue")
def t05p(spark, sf):
    return H.anova(exam_orders(spark, sf), "punt_global", "fami_estratovivienda")


@register("T06_region_insight", """, p1 AS (SELECT *, """ + S.zone_residence("cole_area_ubicacion") + """ AS Area FROM exam_orders
  WHERE cole_area_ubicacion IS NOT NULL AND upper(cole_area_ubicacion) NOT IN ('SIN INFORMACIÓN', 'SIN INFORMACION', 'NAN')),
g AS (SELECT cole_mcpio_ubicacion, avg(punt_global) FILTER (Area = 'Urbano') - avg(punt_global) FILTER (Area = 'Rural') AS d,
  count(punt_global) FILTER (Area = 'Urbano') AS n_a, count(punt_global) FILTER (Area = 'Rural') AS n_b FROM p1 GROUP BY 1)
SELECT cole_mcpio_ubicacion, round_even(d, 1) AS brecha, n_a, n_b FROM g WHERE n_a >= 2 AND n_b >= 2""")
def t06(spark, sf):
    return H.region_insight(_p1_frame(spark, sf), "punt_global", "Area", "cole_mcpio_ubicacion").drop("p_valor", "significancia")


@register("T06_region_significance")
def t06p(spark, sf):
    return H.region_insight(_p1_frame(spark, sf), "punt_global", "Area", "cole_mcpio_ubicacion")


_OLS_NUM = ["punt_matematicas", "punt_lectura_critica", "punt_c_naturales"]
_OLS_CAT = ["cole_naturaleza", "fami_estratovivienda", "fami_tienecomputador"]
_OLS_SEL = ["punt_matematicas", "punt_c_naturales", "cole_naturaleza", "fami_tienecomputador"]


@register("T08_ols_ttests")
def t08(spark, sf):
    _, t, _ = ols(spark, exam_lines(spark, sf), "punt_global", _OLS_NUM, _OLS_CAT, _OLS_SEL)
    return t


@register("T10_partial_f")
def t10(spark, sf):
    _, _, f = ols(spark, exam_lines(spark, sf), "punt_global", _OLS_NUM, _OLS_CAT, _OLS_SEL)
    return f
