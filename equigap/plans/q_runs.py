"""Run-log queries (S04-S07, W01-W08, C35, C36) over a run log derived from
``events``: a user is a run, an event type is a metric key, the latest event
of each type is the metric's value (as the latest line of a metric file),
first / last event times are the run's start / end.  Run names, tags and
selected variables are fixed rules of the run key, so some runs lack tags
and exercise the name-based inference.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigap.functions import labels as L
from equigap.operators import runs as R
from equigap.plans.catalog import register
from equigap.plans.tpch import load
from equigap.session import scratch_path
from equigap.sources.runs import infer_run_tags, pivot_runs, read_runs, run_variables, write_run_tree

# Event type -> metric key of the derived run log.
EVENT_METRIC = {"view": "rmse", "click": "r2", "signup": "f1", "purchase": "f1_macro", "error": "mae"}
# Feature-set default variable lists.
FEATURE_SETS = {"tic_basico": ["internet_flag", "computador_flag", "tic_score", "tic_interaccion"],
                "tic_contexto": ["internet_flag", "computador_flag", "estrato_cat", "zona", "tipo_colegio"]}
CATALOGUE = ["internet_flag", "computador_flag", "tic_score", "tic_interaccion", "estrato_cat", "zona",
             "tipo_colegio", "genero"]

_NAME_SQL = ("CASE run_key % 6 WHEN 0 THEN 'p3_reg_tic_basico_' WHEN 1 THEN 'p3_bin_tic_contexto_' "
             "WHEN 2 THEN 'p3_multi_tic_basico_' WHEN 3 THEN 'p3_custom_reg_' WHEN 4 THEN 'p3_custom_bin_' "
             "ELSE 'reg_global_mlp_' END || CAST(run_key AS VARCHAR)")


def _metric_key():
    km = None
    for k, v in EVENT_METRIC.items():
        km = F.when(F.col("event_type") == k, v) if km is None else km.when(F.col("event_type") == k, v)
    return km


def _facts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    ev = load(spark, sf, "events")
    key = F.col("user_id")
    metrics = ev.groupBy(key.alias("run_key"), _metric_key().alias("key")).agg(F.max_by("value", "ts").alias("value"))
    facts = metrics.select(F.lit("derived").alias("experiment_id"), F.col("run_key").cast("string").alias("run_id"),
                           F.lit("metrics").alias("kind"), "key", F.col("value").cast("string").alias("value"))
    rk = F.col("run_key")
    name = (F.when(rk % 6 == 0, "p3_reg_tic_basico_").when(rk % 6 == 1, "p3_bin_tic_contexto_")
            .when(rk % 6 == 2, "p3_multi_tic_basico_").when(rk % 6 == 3, "p3_custom_reg_")
            .when(rk % 6 == 4, "p3_custom_bin_").otherwise("reg_global_mlp_"))
    task = (F.when(rk % 4 == 0, F.lit(None)).when((rk % 6 == 0) | (rk % 6 == 3), "regresion")
            .when((rk % 6 == 1) | (rk % 6 == 4), "clasificacion_binaria").when(rk % 6 == 2, "clasificacion_multiclase"))
    sel = F.when(rk % 5 == 0, F.lit("zona, genero,zona ,tipo_colegio"))
    tags = ev.select(key.alias("run_key")).distinct().select(
        F.lit("derived").alias("experiment_id"), F.col("run_key").cast("string").alias("run_id"),
        F.explode(F.array(
            F.struct(F.lit("task").alias("key"), task.alias("value")),
            F.struct(F.lit("model_name").alias("key"), F.concat(F.lit("model_"), (rk % 3).cast("string")).alias("value")),
            F.struct(F.lit("selected_vars").alias("key"), sel.alias("value")),
        )).alias("t"),
    ).select("experiment_id", "run_id", F.lit("tags").alias("kind"), "t.key", "t.value").where(F.col("value").isNotNull())
    meta = ev.groupBy(key.alias("run_key")).agg(
        F.unix_millis(F.min("ts").cast("timestamp")).alias("start_time"),
        F.unix_millis(F.max("ts").cast("timestamp")).alias("end_time"))
    meta = meta.select(F.lit("derived").alias("experiment_id"), F.col("run_key").cast("string").alias("run_id"),
                       F.concat(name, F.col("run_key").cast("string")).alias("run_name"), "start_time", "end_time")
    return facts.unionByName(tags), meta


def runs_table(spark: SparkSession, sf: str) -> DataFrame:
    facts, meta = _facts(spark, sf)
    runs = infer_run_tags(pivot_runs(facts, meta))
    return runs.withColumn("model", F.col("tag_model_name")).withColumn("config_id", F.col("run_name")).withColumn(
        "selected_vars", F.col("tag_selected_vars"))


_RUNS_SQL = f""", lm AS (SELECT user_id AS run_key, CASE event_type WHEN 'view' THEN 'rmse' WHEN 'click' THEN 'r2'
  WHEN 'signup' THEN 'f1' WHEN 'purchase' THEN 'f1_macro' ELSE 'mae' END AS key, max_by(value, ts) AS v FROM events GROUP BY 1, 2),
mt AS (SELECT user_id AS run_key, epoch_us(min(ts)) // 1000 AS start_time, epoch_us(max(ts)) // 1000 AS end_time
  FROM events GROUP BY 1),
rw AS (SELECT mt.run_key, CAST(mt.run_key AS VARCHAR) AS run_id, {_NAME_SQL} AS run_name, start_time, end_time,
  max(CASE WHEN key = 'rmse' THEN v END) AS rmse, max(CASE WHEN key = 'mae' THEN v END) AS mae,
  max(CASE WHEN key = 'r2' THEN v END) AS r2, max(CASE WHEN key = 'f1' THEN v END) AS f1,
  max(CASE WHEN key = 'f1_macro' THEN v END) AS f1_macro
  FROM mt LEFT JOIN lm USING (run_key) GROUP BY mt.run_key, start_time, end_time),
tg AS (SELECT *, CASE WHEN run_key % 4 = 0 THEN NULL WHEN run_key % 6 IN (0, 3) THEN 'regresion'
  WHEN run_key % 6 IN (1, 4) THEN 'clasificacion_binaria' WHEN run_key % 6 = 2 THEN 'clasificacion_multiclase' END AS tag_task,
  'model_' || CAST(run_key % 3 AS VARCHAR) AS model,
  CASE WHEN run_key % 5 = 0 THEN 'zona, genero,zona ,tipo_colegio' END AS selected_vars FROM rw),
runs AS (SELECT *, CASE WHEN tag_task IS NOT NULL AND tag_task <> '' THEN tag_task
  WHEN starts_with(run_name, 'p3_') THEN CASE WHEN starts_with(run_name, 'p3_custom_reg') OR starts_with(run_name, 'p3_reg') THEN 'regresion'
    WHEN starts_with(run_name, 'p3_custom_bin') OR starts_with(run_name, 'p3_bin') THEN 'clasificacion_binaria'
    WHEN starts_with(run_name, 'p3_custom_multi') OR starts_with(run_name, 'p3_multi') THEN 'clasificacion_multiclase' END END AS task,
  CASE WHEN starts_with(run_name, 'p3_') AND len(string_split(run_name, '_')) >= 3 THEN
    CASE WHEN string_split(run_name, '_')[2] = 'custom' THEN 'custom' ELSE string_split(run_name, '_')[3] END END AS feature_set,
  run_name AS config_id
  FROM tg)
"""
_RUNS_FILTER = " WHERE task IS NOT NULL OR starts_with(run_name, 'p3_')"


@register("S04_read_runs", _RUNS_SQL + "SELECT run_id, run_name, start_time, end_time, rmse, mae, r2, f1, f1_macro FROM runs")
def s04(spark, sf):
    """The run log as a tree of packed files (every event a line of its metric's file, in
    no order), read back."""
    facts, meta = _facts(spark, sf)
    ev = load(spark, sf, "events")
    line = F.concat_ws(" ", F.unix_micros(F.col("ts").cast("timestamp")).cast("string"), F.col("value").cast("string"), F.lit("0"))
    files = ev.groupBy(F.lit("derived").alias("experiment_id"), F.col("user_id").cast("string").alias("run_id"), F.lit("metrics").alias("kind"),
                       _metric_key().alias("key")).agg(F.array_join(F.collect_list(line), "\n").alias("value"))
    path = scratch_path(spark, f"run_tree-{uuid.uuid4().hex[:8]}")
    write_run_tree(files.unionByName(facts.where("kind = 'tags'")), meta, path)
    return read_runs(spark, path, packed=True).select("run_id", "run_name", "start_time", "end_time", "rmse", "mae", "r2", "f1", "f1_macro")


@register("S05_infer_run_tags", _RUNS_SQL + "SELECT run_id, task, feature_set FROM runs" + _RUNS_FILTER)
def s05(spark, sf):
    return runs_table(spark, sf).select("run_id", "task", "feature_set")


_DEF = {k: ",".join(v) for k, v in FEATURE_SETS.items()}
_S07_SQL = (_RUNS_SQL + ", sv AS (SELECT run_id, coalesce(nullif(trim(selected_vars), ''), CASE feature_set "
            + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _DEF.items()) + " END) AS src FROM runs" + _RUNS_FILTER + ")\n")


@register("S07_run_variables", _S07_SQL + """SELECT run_id, array_to_string(list_distinct_ordered, ',') AS variables FROM
(SELECT run_id, list(x ORDER BY pos) FILTER (WHERE rn = 1) AS list_distinct_ordered FROM
  (SELECT run_id, x, pos, row_number() OVER (PARTITION BY run_id, x ORDER BY pos) AS rn FROM
    (SELECT run_id, trim(unnest(string_split(coalesce(src, ''), ','))) AS x, generate_subscripts(string_split(coalesce(src, ''), ','), 1) AS pos FROM sv))
  WHERE x <> '' GROUP BY run_id)""")
def s07(spark, sf):
    v = run_variables(runs_table(spark, sf), FEATURE_SETS)
    return v.where(F.size("variables") > 0).select("run_id", F.array_join("variables", ",").alias("variables"))


@register("C35_run_var_lists", _S07_SQL.replace("FROM runs" + _RUNS_FILTER, "FROM runs" + _RUNS_FILTER) + """, items AS (
  SELECT run_id, trim(unnest(string_split(coalesce(selected_vars, ''), ','))) AS x,
    generate_subscripts(string_split(coalesce(selected_vars, ''), ','), 1) AS pos FROM runs""" + _RUNS_FILTER + """),
inc AS (SELECT run_id, string_agg(x, ', ' ORDER BY pos) AS variables_included FROM items WHERE x <> '' GROUP BY run_id),
cat AS (SELECT unnest(['""" + "','".join(CATALOGUE) + """']) AS v, generate_subscripts(['""" + "','".join(CATALOGUE) + """'], 1) AS cpos),
exc AS (SELECT inc.run_id, string_agg(v, ', ' ORDER BY cpos) AS variables_excluded FROM inc, cat
  WHERE NOT EXISTS (SELECT 1 FROM items i WHERE i.run_id = inc.run_id AND i.x = cat.v) GROUP BY inc.run_id)
SELECT r.run_id, coalesce(inc.variables_included, 'N/D') AS variables_included,
  CASE WHEN inc.run_id IS NULL THEN 'N/D' ELSE coalesce(exc.variables_excluded, '') END AS variables_excluded
FROM (SELECT run_id FROM runs""" + _RUNS_FILTER + """) r LEFT JOIN inc USING (run_id) LEFT JOIN exc USING (run_id)""")
def c35(spark, sf):
    runs = runs_table(spark, sf)
    inc, exc = L.run_var_lists("selected_vars", CATALOGUE)
    return runs.select("run_id", inc.alias("variables_included"), exc.alias("variables_excluded"))


@register("C36_run_arch", _RUNS_SQL + """SELECT run_id, replace(CASE WHEN contains(s, '_mlp_') THEN split_part(s, '_mlp_', 2) ELSE s END, '_', '-') AS arch,
  CASE WHEN starts_with(run_name, 'p2_clf_') OR starts_with(run_name, 'clf_bin_') OR starts_with(run_name, 'clf_') THEN 'Clasificación binaria'
    WHEN starts_with(run_name, 'reg_') THEN 'Regresión' ELSE '' END AS tipo
FROM (SELECT run_id, run_name, CASE WHEN starts_with(run_name, 'p2_clf_clf_') THEN substr(run_name, 12)
  WHEN starts_with(run_name, 'p2_clf_') THEN substr(run_name, 8) WHEN starts_with(run_name, 'clf_bin_') THEN substr(run_name, 9)
  WHEN starts_with(run_name, 'clf_') THEN substr(run_name, 5) WHEN starts_with(run_name, 'reg_') THEN substr(run_name, 5)
  ELSE run_name END AS s FROM runs)""")
def c36(spark, sf):
    facts, meta = _facts(spark, sf)
    return meta.select("run_id", L.run_arch("run_name").alias("arch"), L.run_task("run_name").alias("tipo"))


_RANK_SQL = _RUNS_SQL + """, rk AS (SELECT *, CASE WHEN task = 'regresion' THEN 'rmse' WHEN task = 'clasificacion_multiclase' THEN 'f1_macro' ELSE 'f1' END AS m,
  CASE WHEN task = 'regresion' THEN rmse WHEN task = 'clasificacion_multiclase' THEN f1_macro ELSE f1 END AS v FROM runs""" + _RUNS_FILTER + """),
rk2 AS (SELECT *, row_number() OVER (PARTITION BY task ORDER BY CASE WHEN task = 'regresion' THEN v END ASC NULLS LAST,
  CASE WHEN task <> 'regresion' THEN v END DESC NULLS LAST, CASE WHEN task = 'regresion' THEN r2 END DESC NULLS LAST, run_id) AS rank
  FROM rk WHERE task IS NOT NULL AND v IS NOT NULL)
"""


@register("W01_best_runs", _RANK_SQL + "SELECT task, model, feature_set, m AS metric, round_even(v, 4) AS metric_value, run_id FROM rk2 WHERE rank = 1")
def w01(spark, sf):
    return R.best_runs(runs_table(spark, sf))


@register("M17_best_by", _RUNS_SQL + """SELECT config_id, best, run_id FROM (SELECT *, 'f1' AS best, row_number() OVER (PARTITION BY feature_set ORDER BY f1 DESC, start_time, run_id) AS rn
  FROM runs""" + _RUNS_FILTER.replace("WHERE ", "WHERE (") + """) AND f1 IS NOT NULL) WHERE rn = 1
UNION ALL SELECT config_id, 'rmse', run_id FROM (SELECT *, row_number() OVER (PARTITION BY feature_set ORDER BY rmse, start_time, run_id) AS rn
  FROM runs""" + _RUNS_FILTER.replace("WHERE ", "WHERE (") + """) AND rmse IS NOT NULL) WHERE rn = 1""")
def m17_best(spark, sf):
    """The best run of each feature set, by f1 (higher) and by rmse (lower)."""
    from equigap.ml.labs import best_by

    runs = runs_table(spark, sf)
    parts = [best_by(runs, "feature_set", m, higher, ["start_time", "run_id"]).select("config_id", F.lit(m).alias("best"), "run_id")
             for m, higher in (("f1", True), ("rmse", False))]
    return parts[0].unionByName(parts[1])


@register("M18_accept_update", _RUNS_SQL + "SELECT run_id, f1_macro IS NULL OR f1 - f1_macro >= -0.005 AS accepted FROM runs WHERE f1 IS NOT NULL")
def m18_gate(spark, sf):
    """Each run's f1 against a stored one."""
    from equigap.ml.labs import accepted

    facts, meta = _facts(spark, sf)
    return pivot_runs(facts, meta).where("f1 is not null").select("run_id", accepted(F.col("f1"), F.col("f1_macro")).alias("accepted"))


@register("W02_top_runs", _RANK_SQL + """SELECT task, CAST(rank AS INT) AS rank, model, feature_set, selected_vars,
  CASE m WHEN 'rmse' THEN 'RMSE' WHEN 'f1_macro' THEN 'F1 macro' ELSE 'F1' END AS metric, round_even(v, 4) AS metric_value,
  config_id, run_id FROM rk2 WHERE rank <= 2""")
def w02(spark, sf):
    return R.top_runs(runs_table(spark, sf), 2)


@register("W03_top_classifiers", _RUNS_SQL + """SELECT run_id, f1, CAST(row_number() OVER (ORDER BY f1 DESC, run_id) AS INT) AS top_rank
FROM (SELECT * FROM runs""" + _RUNS_FILTER + """) WHERE f1 IS NOT NULL ORDER BY f1 DESC, run_id LIMIT 3""")
def w03(spark, sf):
    return R.top_classifiers(runs_table(spark, sf), 3).select("run_id", "f1", F.col("top_rank").cast("int"))


@register("W04_compare_runs", _RUNS_SQL + "SELECT config_id, feature_set, rmse AS value FROM runs WHERE task = 'regresion' AND rmse IS NOT NULL")
def w04(spark, sf):
    return R.compare_runs(runs_table(spark, sf), "regresion", "rmse")


def _history(spark, sf):
    """Per-run training curve derived from events: epoch = position of the
    event inside its run by time (distributed ordinal, no per-run task)."""
    from equigap.operators.util import ordinal_within

    ev = load(spark, sf, "events").select("user_id", "ts", "event_id", "value", "event_type")
    ev = ordinal_within(ev, "user_id", ["ts", "event_id"], out="epoch")
    return ev.select(F.col("user_id").cast("string").alias("run_id"), F.col("epoch").cast("int").alias("epoch"),
                     F.col("value").alias("loss"),
                     F.when(F.col("event_type") != "error", F.col("value") * 1.1).alias("val_loss"))


@register("W05_loss_curves", """, h AS (SELECT CAST(user_id AS VARCHAR) AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch,
  value AS loss, CASE WHEN event_type <> 'error' THEN value * 1.1 END AS val_loss FROM events)
SELECT run_id, epoch, 'loss' AS series, loss AS value FROM h
UNION ALL SELECT run_id, epoch, 'val_loss', round(val_loss, 6) FROM h WHERE val_loss IS NOT NULL""")
def w05(spark, sf):
    c = R.loss_curves(_history(spark, sf))
    return c.select("run_id", F.col("epoch").cast("long").alias("epoch"), "series",
                    F.when(F.col("series") == "val_loss", F.round(F.col("value") + F.lit(1e-9), 6))
                    .otherwise(F.col("value")).alias("value"))


@register("W07_cap_rows", "SELECT * FROM events ORDER BY md5(CAST(event_id AS VARCHAR) || '|42') LIMIT 1000")
def w07(spark, sf):
    """Reproducible sample of 1,000 events (the sampling operator)."""
    return R.cap_rows(load(spark, sf, "events"), 1000, seed=42, key=["event_id"])


@register("W08_distinct_pairs", "SELECT DISTINCT user_id, event_type FROM events")
def w08(spark, sf):
    return R.distinct_pairs(load(spark, sf, "events"), ["user_id", "event_type"])


@register("W08_stack", "SELECT event_id, value FROM events")
def w08b(spark, sf):
    """Views and everything else, stacked again."""
    ev = load(spark, sf, "events")
    view = F.col("event_type").eqNullSafe("view")
    return R.stack(ev.where(view).select("event_id", "value"), ev.where(~view).select("event_id", "value"))
