"""Registered ML, metric and scenario queries (M*, X*, S12-S13).

Metric queries score deterministic predictions derived from the bound data,
so DuckDB can recompute them; training labs and scenario scoring depend on
Spark ML and are rows-only.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from equigap.functions import labels as L
from equigap.ml import labs
from equigap.ml.metrics import binary_metrics, multiclass_metrics, regression_metrics
from equigap.ml.prep import class_weights, fit_prep_stages, level_means, prep_statistics, split
from equigap.operators import scenario as X
from equigap.plans.catalog import register
from equigap.plans.q_aggregates import r6
from equigap.plans.tpch import exam_lines, exam_orders
from equigap.session import materialize, scratch_path

_YHAT = "punt_matematicas * 2.5 + 120"


@register("M14_regression_metrics", f""", p AS (SELECT punt_global AS y, {_YHAT} AS yh FROM exam_lines)
SELECT round(sqrt(avg((yh - y) * (yh - y))), 6) AS rmse, round(avg(abs(yh - y)), 6) AS mae,
  round(1 - sum((yh - y) * (yh - y)) / (var_pop(y) * count(*)), 6) AS r2 FROM p""")
def m14(spark, sf):
    p = exam_lines(spark, sf).select(F.col("punt_global").alias("label"), F.expr(_YHAT).alias("prediction"))
    return r6(regression_metrics(p), "rmse", "mae", "r2")


_BIN_SQL = """, p AS (SELECT CAST(punt_global < 250 AS INT) AS y, round(punt_matematicas / 100, 2) AS s,
  CAST(round(punt_matematicas / 100, 2) >= 0.5 AS INT) AS yh FROM exam_lines),
c AS (SELECT count(*) AS n, sum(CASE WHEN y = 1 AND yh = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN y = 0 AND yh = 1 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN y = 1 AND yh = 0 THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN y = yh THEN 1 ELSE 0 END) AS ok FROM p),
d AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM p GROUP BY s),
r AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM d),
a AS (SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS roc_auc FROM r)
SELECT round(ok / n, 6) AS accuracy, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) AS f1, round(roc_auc, 6) AS roc_auc FROM c, a"""


@register("M15_binary_metrics", _BIN_SQL)
def m15(spark, sf):
    s = F.round(F.col("punt_matematicas") / 100, 2)
    p = exam_lines(spark, sf).select(L.low_performance("punt_global").alias("label"), s.alias("score"),
                                     (s >= 0.5).cast("int").alias("prediction"))
    m = binary_metrics(p)
    return r6(m, *m.columns)


@register("M16_multiclass_metrics", """, p AS (SELECT desemp_ingles AS y, CASE WHEN punt_ingles < 20 THEN 'A-' WHEN punt_ingles < 40 THEN 'A1'
  WHEN punt_ingles < 60 THEN 'A2' WHEN punt_ingles < 80 THEN 'B1' ELSE 'B+' END AS yh FROM exam_lines),
conf AS (SELECT y, yh, count(*) AS c FROM p GROUP BY 1, 2),
pt AS (SELECT y AS k, sum(c) AS support FROM conf GROUP BY 1), pp AS (SELECT yh AS k, sum(c) AS predicted FROM conf GROUP BY 1),
tp AS (SELECT y AS k, c AS tp FROM conf WHERE y = yh),
lab AS (SELECT coalesce(pt.k, pp.k) AS k, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted FROM pt FULL JOIN pp ON pt.k = pp.k),
l2 AS (SELECT lab.*, coalesce(tp.tp, 0) AS tp FROM lab LEFT JOIN tp ON lab.k = tp.k)
SELECT round(sum(tp) / sum(support), 6) AS accuracy,
  round(avg(CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0.0 END), 6) AS f1_macro,
  (SELECT round(-avg(ln(least(greatest(punt_matematicas / 100, 1e-15), 1 - 1e-15))), 6) FROM exam_lines) AS log_loss FROM l2""")
def m16(spark, sf):
    e = F.col("punt_ingles")
    yh = F.when(e < 20, "A-").when(e < 40, "A1").when(e < 60, "A2").when(e < 80, "B1").otherwise("B+")
    p = exam_lines(spark, sf).select(F.col("desemp_ingles").alias("label"), yh.alias("prediction"), (F.col("punt_matematicas") / 100).alias("p_true"))
    return r6(multiclass_metrics(p, p_true="p_true"), "accuracy", "f1_macro", "log_loss")


@register("M15_M16_metrics_by_run", """, p AS (SELECT cole_naturaleza AS run_name, CAST(punt_global < 250 AS INT) AS y, round(punt_matematicas / 100, 2) AS s,
  CAST(round(punt_matematicas / 100, 2) >= 0.5 AS INT) AS yh FROM exam_lines),
d AS (SELECT run_name, s, sum(y) AS pos, sum(1 - y) AS neg FROM p GROUP BY 1, 2),
r AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY run_name ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM d),
a AS (SELECT run_name, sum(pos * (below + 0.5 * neg)) / nullif(sum(pos) * sum(neg), 0) AS roc_auc FROM r GROUP BY 1),
c AS (SELECT run_name, avg(CAST(y = yh AS INT)) AS accuracy, 2 * sum(y * yh) / nullif(sum(y) + sum(yh), 0) AS f1,
  -avg(ln(least(greatest(CASE WHEN y = 1 THEN s ELSE 1 - s END, 1e-15), 1 - 1e-15))) AS log_loss FROM p GROUP BY 1)
SELECT run_name, round(accuracy, 6) AS accuracy, round(coalesce(f1, 0.0), 6) AS f1, round(roc_auc, 6) AS roc_auc, round(log_loss, 6) AS log_loss FROM c JOIN a USING (run_name)""")
def m15_by_run(spark, sf):
    """Metrics of several runs (here one per school type) from shared aggregates."""
    s = F.round(F.col("punt_matematicas") / 100, 2)
    label = L.low_performance("punt_global")
    p = exam_lines(spark, sf).select(F.col("cole_naturaleza").alias("run_name"), label.alias("label"), s.alias("score"),
                                     (s >= 0.5).cast("int").alias("prediction"), F.when(label == 1, s).otherwise(1 - s).alias("p_true"))
    two = binary_metrics(p, by=["run_name"]).join(multiclass_metrics(p, p_true="p_true", by=["run_name"]).select("run_name", "log_loss"), "run_name")
    return r6(two.select("run_name", "accuracy", "f1", "roc_auc", "log_loss"), "accuracy", "f1", "roc_auc", "log_loss")


@register("M06_class_weights", """SELECT y AS label, round(n_total / (k * n), 6) AS weight FROM
(SELECT y, count(*) AS n, sum(count(*)) OVER () AS n_total, count(*) OVER () AS k FROM
  (SELECT CAST(punt_global < 250 AS INT) AS y FROM exam_orders) GROUP BY y)""")
def m06(spark, sf):
    d = exam_orders(spark, sf).select(L.low_performance("punt_global").alias("label"))
    return r6(class_weights(d, "label").select("label", "weight").distinct(), "weight")


@register("M02_prep_statistics", """SELECT round(quantile_cont(punt_matematicas, 0.5), 6) AS median,
  round(avg(punt_matematicas), 6) AS mean, round(stddev_pop(punt_matematicas), 6) AS std_pop,
  (SELECT fami_estratovivienda FROM exam_lines GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode FROM exam_lines""")
def m02(spark, sf):
    d = exam_lines(spark, sf)
    st = prep_statistics(d, ["punt_matematicas"], ["fami_estratovivienda"])
    row = (st["med_punt_matematicas"], st["mu_punt_matematicas"], st["sd_punt_matematicas"], st["mode_fami_estratovivienda"])
    return r6(spark.createDataFrame([row], "median double, mean double, std_pop double, mode string"), "median", "mean", "std_pop")


@register("M04_split", """, c AS (SELECT CAST(punt_global < 250 AS INT) AS clase, count(*) AS n FROM exam_orders WHERE punt_global IS NOT NULL GROUP BY 1)
SELECT true AS is_train, clase, CAST(round(n * 0.8) AS BIGINT) AS n FROM c UNION ALL SELECT false, clase, CAST(n - round(n * 0.8) AS BIGINT) FROM c""")
def m04(spark, sf):
    d = exam_orders(spark, sf).where("punt_global is not null").withColumn("clase", L.low_performance("punt_global"))
    return split(d, ["estu_consecutivo"], 0.8, 42, strata="clase").groupBy("is_train", "clase").agg(F.count("*").alias("n"))


# ------------------------------------------------------------ labs (R) ----

_TARGETS = ["punt_global", "punt_ingles", "punt_matematicas", "punt_sociales_ciudadanas", "punt_c_naturales", "punt_lectura_critica"]

_FS = {"basico": (["punt_matematicas", "punt_lectura_critica"], []),
       "contexto": (["punt_matematicas", "punt_c_naturales"], ["cole_naturaleza", "fami_estratovivienda", "fami_tieneinternet"])}


@register("M10_train_regression")
def m10(spark, sf):
    runs, _, _ = labs.run_lab(spark, exam_lines(spark, sf), "regresion", "punt_global", ["estu_consecutivo", "line_number"],
                              _FS, configs={k: v for k, v in labs.regression_catalogue().items()
                                            if k in ("LinearRegression", "Ridge", "Lasso", "GradientBoostingRegressor")},
                              run_prefix="p1_reg")
    return runs


@register("M10_train_six_targets")
def m10b(spark, sf):
    """Six targets on one preparation, the best by r2; the registered configurations are the linear ones."""
    cat = ["cole_naturaleza", "fami_estratovivienda", "fami_tieneinternet"]
    d = exam_lines(spark, sf).withColumn("edad", F.col("line_number").cast("double"))
    runs, best, _ = labs.run_lab(spark, d, "regresion", _TARGETS, ["estu_consecutivo", "line_number"], {"contexto": (["edad"], cat)},
                                 configs={k: v for k, v in labs.regression_catalogue().items() if k in ("LinearRegression", "Lasso")}
                                 | {"huber": labs.HuberRegression(delta=10.0, maxIter=8)}, run_prefix="p2", selection=("r2", True))
    return runs.withColumn("is_best", F.col("run_name").isin(*[r["run_name"] for r in best.values()]))


@register("M11_train_binary")
def m11(spark, sf):
    """The three binary targets: low performance, below the first quartile, high
    English level."""
    from equigap.operators.insights import cut_points
    from equigap.operators.util import one_row

    key, (num, cat) = ["estu_consecutivo", "line_number"], _FS["contexto"]
    d = materialize(exam_lines(spark, sf).select(*key, "punt_global", "desemp_ingles", *num, *cat), "binary_rows")  # read for the cut and each target
    p25 = one_row(cut_points(split(d, key).where("is_train"), "punt_global").select("umbral_riesgo"))["umbral_riesgo"]  # of training rows
    d = d.withColumns({"bajo": L.low_performance("punt_global"), "riesgo": L.priority_label("punt_global", p25),
                       "ingles": L.level_binary("desemp_ingles")})
    out = None
    for target in ("bajo", "riesgo", "ingles"):
        runs, _, _ = labs.run_lab(spark, d, "clasificacion_binaria", target, key,
                                  {"contexto": _FS["contexto"]}, run_prefix=f"p2_clf_{target}",
                                  configs=None if target == "bajo" else {"LogisticRegression": labs.classifier_catalogue()["LogisticRegression"]})
        out = runs if out is None else out.unionByName(runs)
    return out


@register("M12_train_multiclass")
def m12(spark, sf):
    """Five English levels: logistic, forest, boosting one against the rest, and a
    network, with the lab's class weights."""
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier
    from pyspark.ml.feature import StringIndexer

    d = exam_lines(spark, sf).where(L.level_keep("desemp_ingles"))
    d = StringIndexer(inputCol="desemp_ingles", outputCol="nivel", stringOrderType="alphabetAsc").fit(d).transform(d)
    fs = (["punt_ingles"], ["fami_tieneinternet", "fami_tienecomputador"])
    width = labs.feature_size(d.withColumnRenamed("nivel", "label"), fit_prep_stages(d, *fs))
    runs, _, _ = labs.run_lab(spark, d, "clasificacion_multiclase", "nivel", ["estu_consecutivo", "line_number"], {"tic": fs},
                              configs={"LogisticRegression": LogisticRegression(maxIter=100), "RandomForestClassifier": RandomForestClassifier(numTrees=20, maxDepth=6, seed=42),
                                       "GradientBoostingClassifier": OneVsRest(classifier=GBTClassifier(maxIter=5, maxDepth=3, seed=42)),
                                       "mlp_64_32": labs.network_catalogue("clasificacion_multiclase", width, 5)["mlp_64_32"]}, run_prefix="p3_multi")
    return runs


@register("M13_train_custom")
def m13(spark, sf):
    sel = ["punt_c_naturales", "cole_naturaleza"]
    d = exam_lines(spark, sf)
    runs, best, models = labs.run_lab(spark, d, "regresion", "punt_global", ["estu_consecutivo", "line_number"],
                              {"custom": ([c for c in sel if c.startswith("punt")], [c for c in sel if not c.startswith("punt")])},
                              configs={"LinearRegression": LinearRegression(), "nonsense": LinearRegression(labelCol="missing")},
                              run_prefix="p3_custom_reg", tolerant=True)
    path = scratch_path(spark, f"models/pregunta_3-{uuid.uuid4().hex[:8]}")
    labs.save_best(models[best["run_name"]], labs.run_metadata(best, "punt_global"), f"{path}/custom")
    _, meta = labs.load_best(path)  # the custom model is found first
    return runs.withColumn("stored", F.col("run_name") == meta["run_name"])


# -------------------------------------------------------- scenarios (R) ----

def _fit_orders_model(spark: SparkSession, sf: str):
    d = exam_orders(spark, sf).withColumn("Area", F.when(F.col("cole_area_ubicacion") == "URBANO", "Urbano")
                                          .otherwise("Rural"))
    num, cat = ["punt_sociales_ciudadanas"], ["Area", "cole_naturaleza", "fami_estratovivienda"]
    d = materialize(d.select("estu_consecutivo", *num, *cat, "punt_global"), "orders_model")  # the fit reads it many times
    stages = fit_prep_stages(d, num, cat)
    model = Pipeline(stages=stages + [LinearRegression(labelCol="punt_global")]).fit(d)
    return d, model


def _fit_means(d, label: str, by: str, rows: str | None = None):
    """A linear model on one categorical, which predicts the category's mean; ``rows``: as
    many rows a row stands for."""
    weight = {"weightCol": rows} if rows else {}
    return Pipeline(stages=[*fit_prep_stages(d, [], [by], rows=rows), LinearRegression(labelCol=label, **weight)]).fit(d)


@register("X01_score_by_type", """, m AS (SELECT cole_naturaleza AS k, round_even(least(500, greatest(0, avg(punt_global))), 1) AS m FROM exam_orders GROUP BY 1)
SELECT estu_consecutivo AS scenario_id, a.m AS a, b.m AS b, round_even(b.m - a.m, 4) AS delta FROM exam_orders o JOIN m a ON a.k = o.cole_naturaleza
JOIN m b ON b.k = CASE o.cole_naturaleza WHEN 'OFICIAL' THEN 'NO OFICIAL' WHEN 'NO OFICIAL' THEN 'OFICIAL' ELSE o.cole_naturaleza END""")
def x01a(spark, sf):
    d = exam_orders(spark, sf)
    sc = X.flip(d.select(F.col("estu_consecutivo").alias("scenario_id"), "cole_naturaleza"), "cole_naturaleza", "OFICIAL", "NO OFICIAL")
    return X.score_scenarios(_fit_means(d, "punt_global", "cole_naturaleza"), sc)


@register("X01_score_binary")
def x01b(spark, sf):
    from pyspark.ml.classification import LogisticRegression

    d = exam_orders(spark, sf).withColumn("bajo", L.low_performance("punt_global"))
    stages = fit_prep_stages(d, ["punt_sociales_ciudadanas"], ["cole_naturaleza"])
    model = Pipeline(stages=[*stages, LogisticRegression(labelCol="bajo")]).fit(d)
    sc = X.flip(d.select(F.col("estu_consecutivo").alias("scenario_id"), "punt_sociales_ciudadanas", "cole_naturaleza"), "cole_naturaleza", "OFICIAL", "NO OFICIAL")
    return X.score_scenarios(model, sc, kind="clasificacion_binaria")


@register("X04_zone_means", """SELECT round(avg(punt_global) FILTER (cole_area_ubicacion = 'URBANO')
  - avg(punt_global) FILTER (cole_area_ubicacion IS DISTINCT FROM 'URBANO'), 6) AS impacto_medio, CAST(count(*) AS BIGINT) AS n FROM exam_orders""")
def x04a(spark, sf):
    d = exam_orders(spark, sf).withColumn("Area", F.when(F.col("cole_area_ubicacion") == "URBANO", "Urbano").otherwise("Rural"))
    return r6(X.zone_impact(_fit_means(d, "punt_global", "Area"), d.select("Area")), "impacto_medio")


@register("X06_adjusted_gaps_by_type", " UNION ALL ".join(f"""SELECT '{t}' AS target, '{t.removeprefix("punt_")}' AS slug, e AS estrato,
  round_even(o, 2) AS pred_oficial, round_even(p, 2) AS pred_privado, round_even(round_even(p, 2) - round_even(o, 2), 2) AS brecha_ajustada
FROM (SELECT avg({t}) FILTER (cole_naturaleza = 'OFICIAL') AS o, avg({t}) FILTER (cole_naturaleza = 'NO OFICIAL') AS p FROM exam_lines),
  (SELECT DISTINCT fami_estratovivienda AS e FROM exam_lines)""" for t in _TARGETS))
def x06a(spark, sf):
    """The six targets' gaps by school type on the scenario grid."""
    from equigap.operators import joins as J

    d = materialize(level_means(exam_lines(spark, sf), ["cole_naturaleza", "fami_estratovivienda"], _TARGETS), "level_means")
    grid = J.scenario_grid(spark.createDataFrame([(t,) for t in _TARGETS], "target string"), d.select("fami_estratovivienda").distinct(),
                           d.select("cole_naturaleza").distinct(), {})
    return X.adjusted_gap_table({t: _fit_means(d, t, "cole_naturaleza", "rows") for t in _TARGETS}, grid)


@register("X01_score_scenarios")
def x01(spark, sf):
    d, model = _fit_orders_model(spark, sf)
    sc = X.flip(d.select("estu_consecutivo", "punt_sociales_ciudadanas", "Area", "cole_naturaleza",
                         "fami_estratovivienda").withColumnRenamed("estu_consecutivo", "scenario_id"),
                "cole_naturaleza", "OFICIAL", "NO OFICIAL")
    return X.score_scenarios(model, sc)


_FLIP_SQL = """SELECT estu_consecutivo AS scenario_id, cole_naturaleza, 'A' AS side FROM exam_orders
UNION ALL SELECT estu_consecutivo, CASE cole_naturaleza WHEN 'OFICIAL' THEN 'NO OFICIAL' WHEN 'NO OFICIAL' THEN 'OFICIAL'
  ELSE cole_naturaleza END, 'B' FROM exam_orders"""


@register("X03_flip", _FLIP_SQL)
def x03(spark, sf):
    d = exam_orders(spark, sf).select("estu_consecutivo", "cole_naturaleza")
    return X.flip(d.withColumnRenamed("estu_consecutivo", "scenario_id"), "cole_naturaleza", "OFICIAL", "NO OFICIAL")


@register("X04_zone_impact")
def x04(spark, sf):
    d, model = _fit_orders_model(spark, sf)
    return X.zone_impact(model, d.select("punt_sociales_ciudadanas", "Area", "cole_naturaleza", "fami_estratovivienda"))


def _tic_impact(spark: SparkSession, sf: str):
    from equigap.operators.clean import modeling_frame
    from equigap.roles import Roles

    m = modeling_frame(exam_lines(spark, sf), Roles()).select("punt_ingles", "internet_flag", "computador_flag",
                                                              "tic_score", "tic_interaccion")
    m = materialize(m, "tic_model")  # the fit reads it many times
    stages = fit_prep_stages(m, ["internet_flag", "computador_flag", "tic_score", "tic_interaccion"], [])
    model = Pipeline(stages=stages + [LinearRegression(labelCol="punt_ingles")]).fit(m)
    return X.tic_impact(model, m, features=["internet_flag", "computador_flag", "tic_score", "tic_interaccion"])


@register("X05_tic_impact")
def x05(spark, sf):
    return _tic_impact(spark, sf)


@register("X05_tic_impact_means", """, f AS (SELECT punt_ingles AS y, CASE upper(trim(fami_tieneinternet)) WHEN 'SI' THEN 1 WHEN 'NO' THEN 0 END AS i FROM exam_lines),
m AS (SELECT avg(y) FILTER (i = 1) AS one, avg(y) FILTER (i = 0) AS zero FROM f)
SELECT round((SELECT avg(one - CASE i WHEN 1 THEN one ELSE zero END) FROM f, m WHERE i IS NOT NULL), 6) AS impacto_medio,
  (SELECT CAST(count(*) AS BIGINT) FROM f WHERE i IS NOT NULL) AS n""")
def x05a(spark, sf):
    """By a model on the one flag, which predicts the flag's means."""
    from equigap.operators.clean import modeling_frame
    from equigap.roles import Roles

    m = modeling_frame(exam_lines(spark, sf), Roles()).select("punt_ingles", "internet_flag").where("internet_flag is not null")
    model = Pipeline(stages=[*fit_prep_stages(m, ["internet_flag"], []), LinearRegression(labelCol="punt_ingles")]).fit(m)
    return r6(X.tic_impact(model, m, features=["internet_flag"]), "impacto_medio")


@register("X06_adjusted_gap_table")
def x06(spark, sf):
    from equigap.operators import joins as J

    targets, cat = _TARGETS, ["cole_naturaleza", "fami_estratovivienda", "estu_genero"]
    d = materialize(level_means(exam_lines(spark, sf), cat, targets), "level_means")
    stages = fit_prep_stages(d, [], cat, rows="rows")
    models = {t: Pipeline(stages=stages + [LinearRegression(labelCol=t, weightCol="rows")]).fit(d) for t in targets}
    grid = J.scenario_grid(spark.createDataFrame([(t,) for t in targets], "target string"),
                           d.select("fami_estratovivienda").distinct(), d.select("cole_naturaleza").distinct(),
                           {"estu_genero": "F"})
    return X.adjusted_gap_table(models, grid)


@register("X07_predicted_level")
def x07(spark, sf):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer

    d = exam_orders(spark, sf).where(L.level_keep("desemp_ingles"))
    idx = StringIndexer(inputCol="desemp_ingles", outputCol="label", stringOrderType="alphabetAsc").fit(d)
    d = idx.transform(d)
    stages = fit_prep_stages(d, ["punt_global"], ["cole_naturaleza"])
    model = Pipeline(stages=stages + [LogisticRegression(maxIter=50)]).fit(d)
    return X.predicted_level(model.transform(d), list(idx.labels)).groupBy("nivel_predicho").count()


@register("X07_predicted_level_means", """, c AS (SELECT cole_naturaleza AS k, desemp_ingles AS l, count(*) AS n FROM exam_orders
  WHERE desemp_ingles IN ('A-', 'A1', 'A2', 'B1', 'B+') GROUP BY 1, 2),
b AS (SELECT k, l FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, l) AS rn FROM c) WHERE rn = 1)
SELECT estu_consecutivo, l AS nivel_predicho FROM exam_orders o JOIN b ON b.k = o.cole_naturaleza WHERE desemp_ingles IN ('A-', 'A1', 'A2', 'B1', 'B+')""")
def x07a(spark, sf):
    """By a tree on the one categorical, which predicts the most frequent level of each category."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import StringIndexer

    d = exam_orders(spark, sf).where(L.level_keep("desemp_ingles"))
    idx = StringIndexer(inputCol="desemp_ingles", outputCol="label", stringOrderType="alphabetAsc").fit(d)
    d = idx.transform(d)
    model = Pipeline(stages=[*fit_prep_stages(d, [], ["cole_naturaleza"]), DecisionTreeClassifier(maxDepth=10)]).fit(d)
    return X.predicted_level(model.transform(d), list(idx.labels)).select("estu_consecutivo", "nivel_predicho")


@register("X02_scenario_inputs", """, p AS (SELECT municipio, pib_miles_millones AS pib FROM region_gdp),
a AS (SELECT quantile_cont(p.pib, 0.5) AS pib FROM exam_lines l JOIN p ON l.cole_mcpio_ubicacion = p.municipio)
SELECT l.cole_mcpio_ubicacion AS municipio,
  (upper(trim(fami_tieneinternet)) IS NOT DISTINCT FROM 'SI')::INT + (upper(trim(fami_tienecomputador)) IS NOT DISTINCT FROM 'SI')::INT AS tic_score,
  coalesce(p.pib, (SELECT pib FROM a)) AS pib, CAST(count(*) AS BIGINT) AS count
FROM exam_lines l LEFT JOIN p ON l.cole_mcpio_ubicacion = p.municipio WHERE l.cole_mcpio_ubicacion IS NOT NULL GROUP BY 1, 2, 3
UNION ALL SELECT NULL, (upper(trim(fami_tieneinternet)) IS NOT DISTINCT FROM 'SI')::INT + (upper(trim(fami_tienecomputador)) IS NOT DISTINCT FROM 'SI')::INT,
  NULL, CAST(count(*) AS BIGINT) FROM exam_lines WHERE cole_mcpio_ubicacion IS NULL GROUP BY 2""")
def x02(spark, sf):
    from equigap.operators import joins as J
    from equigap.plans.tpch import region_gdp

    lines = exam_lines(spark, sf)
    form = lines.select(F.col("cole_mcpio_ubicacion").alias("municipio"), "fami_tieneinternet", "fami_tienecomputador")
    f = lines.join(region_gdp(spark, sf), F.col("cole_mcpio_ubicacion") == F.col("municipio"), "left")
    gdp = J.gdp_lookup(f, form.select("municipio").distinct(), "cole_mcpio_ubicacion", "pib_miles_millones", None)
    return X.scenario_inputs(form, gdp).groupBy("municipio", "tic_score", "pib").count()


@register("X08_result_facts")
def x08(spark, sf):
    from equigap.operators.runs import best_runs
    from equigap.operators.util import one_row_frame
    from equigap.plans.q_runs import runs_table

    d, model = _fit_orders_model(spark, sf)
    zone = X.zone_impact(model, d.select("punt_sociales_ciudadanas", "Area", "cole_naturaleza", "fami_estratovivienda"))
    impacts = [zone.select(F.col("impacto_medio").alias("impacto_zona")), _tic_impact(spark, sf).select(F.col("impacto_medio").alias("impacto_tic"))]
    return X.result_facts(best_runs(runs_table(spark, sf)), one_row_frame(spark, impacts))


@register("S12_S13_save_load_best", "SELECT CAST(count(*) AS BIGINT) AS n, 'punt_global' AS target FROM exam_orders")
def s12(spark, sf):
    d, model = _fit_orders_model(spark, sf)
    path = scratch_path(spark, f"models/pregunta_1-{uuid.uuid4().hex[:8]}")
    labs.save_best(model, {"target": "punt_global", "features": ["punt_sociales_ciudadanas", "Area"]}, path)
    loaded, meta = labs.load_best(path)
    return loaded.transform(d).agg(F.count("*").alias("n"), F.lit(meta["target"]).alias("target"))


# ----------------------------------------------- catalogues and selection ----

@register("M01_feature_sets", """SELECT fs AS feature_set, col AS "column", CAST(nn AS BIGINT) AS non_null FROM (
  SELECT 'basico' AS fs, 'punt_matematicas' AS col, count(punt_matematicas) AS nn FROM exam_lines
  UNION ALL SELECT 'basico', 'punt_lectura_critica', count(punt_lectura_critica) FROM exam_lines
  UNION ALL SELECT 'contexto', 'punt_matematicas', count(punt_matematicas) FROM exam_lines
  UNION ALL SELECT 'contexto', 'fami_tienecomputador', count(fami_tienecomputador) FROM exam_lines)""")
def m01(spark, sf):
    """Feature sets restricted to the columns present in the bound table,
    with each column's non-null count (one aggregate over the whole table)."""
    from equigap.ml.prep import feature_sets

    d = exam_lines(spark, sf)
    catalogue = {"basico": ["punt_matematicas", "punt_lectura_critica", "fami_educacionmadre"],
                 "contexto": ["punt_matematicas", "fami_tienecomputador", "cole_jornada"]}
    fs = feature_sets(d.columns, catalogue)
    cols = sorted({c for v in fs.values() for c in v})
    nn = d.agg(*[F.count(c).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(k).alias("feature_set"), F.lit(c).alias("column"), F.col(c).cast("long").alias("non_null"))
                     for k, v in fs.items() for c in v])
    return nn.select(F.inline(rows))


@register("M03_harmonise_missing", """SELECT estu_consecutivo, CASE WHEN trim(raw) IN ('', 'nan', 'None', 'NaN') THEN NULL ELSE raw END AS jornada
FROM (SELECT estu_consecutivo, CASE order_key % 4 WHEN 0 THEN ' ' WHEN 1 THEN 'nan' ELSE desemp_ingles END AS raw FROM exam_orders)""")
def m03(spark, sf):
    from equigap.ml.prep import harmonise_missing

    d = exam_orders(spark, sf)
    raw = F.when(F.col("order_key") % 4 == 0, F.lit(" ")).when(F.col("order_key") % 4 == 1, F.lit("nan")).otherwise(
        F.col("desemp_ingles"))
    return harmonise_missing(d.select("estu_consecutivo", raw.alias("jornada")), ["jornada"])


def _hash_sql(seed: int) -> str:
    return f"('0x' || substr(md5(estu_consecutivo || '|' || CAST(line_number AS VARCHAR) || '|{seed}'), 1, 8))::BIGINT / 4294967296.0"


@register("M05_validation_flag", f"""SELECT is_train, is_train AND is_val AS "(is_train AND is_val)", CAST(count(*) AS BIGINT) AS count FROM (
  SELECT {_hash_sql(42)} < 0.8 AS is_train, {_hash_sql(7)} < 0.2 AS is_val FROM exam_lines) GROUP BY 1, 2""")
def m05(spark, sf):
    from equigap.ml.prep import validation_flag

    d = validation_flag(split(exam_lines(spark, sf), ["estu_consecutivo", "line_number"]), ["estu_consecutivo", "line_number"])
    return d.groupBy("is_train", F.col("is_train") & F.col("is_val")).count()


def _small_features(spark, sf):
    return exam_lines(spark, sf), {"tic": (["punt_ingles"], ["fami_tieneinternet", "cole_naturaleza"])}


@register("M07_regression_catalogue")
def m07(spark, sf):
    d, fs = _small_features(spark, sf)
    runs, _, _ = labs.run_lab(spark, d, "regresion", "punt_global", ["estu_consecutivo", "line_number"], fs,
                              configs=labs.regression_catalogue(), run_prefix="reg")
    return runs


@register("M08_classifier_catalogue")
def m08(spark, sf):
    d, fs = _small_features(spark, sf)
    d = d.withColumn("bajo", L.low_performance("punt_global"))
    runs, _, _ = labs.run_lab(spark, d, "clasificacion_binaria", "bajo", ["estu_consecutivo", "line_number"], fs,
                              configs=labs.classifier_catalogue(), run_prefix="clf")
    return runs


@register("M09_network_catalogue")
def m09(spark, sf):
    d, fs = _small_features(spark, sf)
    d = d.withColumn("bajo", L.low_performance("punt_global"))
    num, cat = fs["tic"]
    width = labs.feature_size(d.withColumnRenamed("bajo", "label"), fit_prep_stages(d, num, cat))
    runs, _, _ = labs.run_lab(spark, d, "clasificacion_binaria", "bajo", ["estu_consecutivo", "line_number"], fs,
                              configs=labs.network_catalogue("clasificacion_binaria", width), run_prefix="p1_bin")
    reg, _, _ = labs.run_lab(spark, d, "regresion", "punt_global", ["estu_consecutivo", "line_number"], fs,
                             configs=labs.network_catalogue("regresion", width), run_prefix="p1_reg")
    return runs.unionByName(reg)


@register("M17_M18_M19_select_and_log")
def m17(spark, sf):
    """Best-run choice (first wins ties), replacement gate against the
    previously logged best, and the run log appended in the shared folder."""
    d, fs = _small_features(spark, sf)
    d = d.withColumn("bajo", L.low_performance("punt_global"))
    from pyspark.ml.classification import LogisticRegression

    runs, best, models = labs.run_lab(spark, d, "clasificacion_binaria", "bajo", ["estu_consecutivo", "line_number"], fs,
                                 configs={"lr": LogisticRegression(maxIter=50), "lr_l2": LogisticRegression(maxIter=50, regParam=0.1)},
                                 run_prefix="p2_clf")
    # An older log: the weaker configuration alone.  The gate compares with it
    # before the new runs are logged, and guards the save.
    path = scratch_path(spark, f"run_log-{uuid.uuid4().hex[:8]}")
    labs.log_runs(runs.where(F.col("run_name") != best["run_name"]), path)
    old = labs.read_run_log(spark, path).agg(F.max("f1")).first()[0]
    accepted = labs.accept_update(best["f1"], old)
    if accepted:
        labs.save_best(models[best["run_name"]], labs.run_metadata(best, "bajo", threshold=0.5), f"{path}/model")
    labs.log_runs(runs, path)  # all runs; what is logged already is replaced
    return labs.read_run_log(spark, path).select("run_name", "f1", (F.col("run_name") == best["run_name"]).alias("is_best"),
                                                     F.lit(old).alias("f1_before"), F.lit(accepted).alias("accept_update"))


@register("X03_flip_oracle", _FLIP_SQL)
def x03o(spark, sf):
    d = exam_orders(spark, sf).select("estu_consecutivo", "cole_naturaleza")
    return X.flip(d.withColumnRenamed("estu_consecutivo", "scenario_id"), "cole_naturaleza", "OFICIAL", "NO OFICIAL")
