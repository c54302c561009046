"""Run-log reader on a hand-made tree (S04-S07, W01-W05), ML prep, split,
labs, persistence and scenario scoring."""

import json
import os

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from equigap.ml import labs
from equigap.ml.prep import class_weights, fit_prep_stages, split
from equigap.operators import runs as R
from equigap.operators import scenario as X
from equigap.sources.runs import infer_run_tags, read_history, read_runs, run_variables, write_run_tree


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.fixture(scope="module")
def run_tree(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("mlruns"))
    runs = [  # run_id, name, start, metrics, tags
        ("r1", "p3_reg_tic_basico_1", 1000, {"rmse": "1 12.0 0\n2 11.5 1\n", "r2": "1 0.20 0"}, {"task": "regresion"}),
        ("r2", "p3_reg_tic_contexto_2", 2000, {"rmse": "5 11.5 0", "r2": "5 0.30 0"}, {}),  # no task tag
        ("r3", "p3_bin_tic_basico_3", 3000, {"f1": "1 0.40 0"}, {"task": "clasificacion_binaria",
                                                               "selected_vars": "zona, genero,zona"}),
        ("r4", "legacy_run", 4000, {"f1": "1 0.90 0"}, {}),  # no task, no p3_ prefix: dropped
        ("r5", "p3_bin_x_5", 5000, {"f1": "1 0.40 0"}, {"task": "clasificacion_binaria"}),  # tie with r3
    ]
    for rid, name, start, metrics, tags in runs:
        base = f"{root}/exp1/{rid}"
        _write(f"{base}/meta.yaml", f"run_id: {rid}\nrun_name: {name}\nstart_time: {start}\nend_time: {start + 500}\n")
        for k, v in metrics.items():
            _write(f"{base}/metrics/{k}", v)
        for k, v in tags.items():
            _write(f"{base}/tags/{k}", v)
        _write(f"{base}/params/layers", "[64, 32]")
    _write(f"{root}/exp1/r1/artifacts/history/history.csv", "loss,val_loss\n3.0,3.5\n2.0,\n1.5,1.7\n")
    return root


def test_read_runs_and_tags(spark, run_tree):
    runs = read_runs(spark, run_tree, max_runs=10)
    rows = {r.run_id: r for r in runs.collect()}
    assert rows["r1"].rmse == 11.5  # latest line of the metric file
    assert rows["r1"].param_layers == "[64, 32]" and rows["r3"].f1 == 0.4
    assert read_runs(spark, run_tree, max_runs=2).select("run_id").collect()[0][0] == "r5"  # newest first
    t = {r.run_id: (r.task, r.feature_set) for r in infer_run_tags(runs).collect()}
    assert t["r2"] == ("regresion", "tic") and "r4" not in t


def test_best_and_top_runs(spark, run_tree):
    runs = infer_run_tags(read_runs(spark, run_tree)).withColumn("model", F.lit("m")).withColumn(
        "config_id", F.col("run_name")).withColumn("selected_vars", F.col("tag_selected_vars"))
    best = {r.task: (r.run_id, r.metric_value) for r in R.best_runs(runs).collect()}
    assert best == {"regresion": ("r2", 11.5), "clasificacion_binaria": ("r3", 0.4)}  # tie -> run_id order
    top = R.top_runs(runs, 2).where("task = 'regresion'").orderBy("rank").collect()
    assert [r.run_id for r in top] == ["r2", "r1"] and top[0].metric == "RMSE"
    v = {r.run_id: r.variables for r in run_variables(runs, {"tic": ["a", "b"]}).collect()}
    assert v["r3"] == ["zona", "genero"] and v["r2"] == ["a", "b"]


def test_history_and_curves(spark, run_tree):
    h = read_history(spark, run_tree).orderBy("epoch").collect()
    assert [(r.run_id, r.epoch, r.loss, r.val_loss) for r in h] == [
        ("r1", 1, 3.0, 3.5), ("r1", 2, 2.0, None), ("r1", 3, 1.5, 1.7)]
    c = R.loss_curves(read_history(spark, run_tree))
    assert c.count() == 5  # 3 loss + 2 non-null val_loss


def test_cap_rows_independent_of_partitioning(spark):
    df = spark.range(0, 5000)
    a = sorted(r.id for r in R.cap_rows(df.repartition(1), 100, key=["id"]).collect())
    b = sorted(r.id for r in R.cap_rows(df.repartition(17), 100, key=["id"]).collect())
    assert a == b and len(a) == 100
    assert R.cap_rows(df, None).count() == 5000  # default: no cap


def _frame(spark, n=2000):
    rng = np.random.default_rng(4)
    x = rng.normal(size=n)
    cat = rng.choice(["a", "b", "c"], size=n)
    y = 50 + 3 * x + np.where(cat == "b", 2.0, 0.0) + rng.normal(scale=0.1, size=n)  # inside the 0-500 clip
    rows = [(str(i), float(x[i]) if i % 50 else None, str(cat[i]) if i % 70 else None, float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id string, x double, c string, y double")


def test_prep_unknown_category_and_scaling(spark):
    df = _frame(spark)
    stages = fit_prep_stages(df, ["x"], ["c"])
    model = Pipeline(stages=stages).fit(df)
    xs = np.array([r.x for r in df.collect() if r.x is not None])
    med = float(np.median(xs))
    filled = np.array([r.x if r.x is not None else med for r in df.collect()])
    new = spark.createDataFrame([("n", 1.0, "zzz")], "id string, x double, c string")
    v = model.transform(new).first().features.toArray()
    assert v[0] == pytest.approx((1.0 - filled.mean()) / filled.std())  # population std
    assert list(v[1:]) == [0.0, 0.0, 0.0]  # unseen category -> all zeros


def test_split_deterministic_and_weights(spark):
    df = _frame(spark)
    a = {r.id for r in split(df.repartition(1), ["id"]).where("is_train").collect()}
    b = {r.id for r in split(df.repartition(9), ["id"]).where("is_train").collect()}
    assert a == b and 0.75 < len(a) / 2000 < 0.85
    w = class_weights(df.withColumn("lab", (F.col("y") > 50).cast("int")), "lab")
    tot = w.agg(F.sum("weight")).first()[0]
    assert tot == pytest.approx(2000.0)  # balanced weights sum to n


def test_lab_persist_and_scenarios(spark, tmp_path):
    df = _frame(spark)
    runs, best, models = labs.run_lab(spark, df, "regresion", "y", ["id"], {"s": (["x"], ["c"])},
                                      configs={"LinearRegression": LinearRegression(),
                                               "broken": LinearRegression(labelCol="nope")}, tolerant=True)
    rows = {r.model: r for r in runs.collect()}
    assert rows["broken"].error is not None and rows["LinearRegression"].r2 > 0.9  # failures counted, not raised
    assert best["model"] == "LinearRegression"
    path = str(tmp_path / "best")
    labs.save_best(models[best["run_name"]], {"target": "y"}, path)
    model, meta = labs.load_best(path)
    assert meta == {"target": "y"}
    # Flipping c from a to b moves predictions by the fitted effect (~2)
    sc = X.flip(df.where("c = 'a' AND x IS NOT NULL").withColumnRenamed("id", "scenario_id"), "c", "a", "b")
    deltas = X.score_scenarios(model, sc).agg(F.avg("delta")).first()[0]
    assert deltas == pytest.approx(2.0, abs=0.2)
    imp = X.mean_impact(model, df.where("x IS NOT NULL AND c IS NOT NULL"), {"c": "a"}, {"c": "b"}).first()
    assert imp.impacto_medio == pytest.approx(2.0, abs=0.2)  # linear model: equals its coefficient
    assert labs.accept_update(0.70, 0.704) and not labs.accept_update(0.69, 0.70)


def test_load_best_per_target_fallback(spark, tmp_path):
    df = _frame(spark, 300)
    model = Pipeline(stages=fit_prep_stages(df, ["x"], []) + [LinearRegression(labelCol="y")]).fit(df)
    labs.save_best(model, {"target": "global"}, str(tmp_path / "global"))
    got = labs.load_best_per_target(str(tmp_path), ["matematicas", "global"])
    assert got["matematicas"][1] == {"target": "global"} and got["global"][1] == {"target": "global"}
    with pytest.raises(FileNotFoundError):
        labs.load_best(str(tmp_path / "missing"))


def test_residence_frame(spark):
    from equigap.operators.clean import residence_frame
    from equigap.roles import Roles

    rows = [("CABECERA", "URBANO", "Estrato 1"), ("RURAL", None, "SIN INFORMACION"), ("x", "SIN INFORMACION", "Sin Estrato"),
            (" medellin ", "RURAL DISPERSO", None)]
    df = spark.createDataFrame(rows, "cole_mcpio_ubicacion string, estu_areareside string, fami_estratovivienda string")
    out = residence_frame(df, Roles(residence="estu_areareside"))
    assert [tuple(r) for r in out.select("cole_mcpio_ubicacion", "Area").collect()] == [("CABECERA", "Urbano")]


def test_ridge_and_lasso_as_closed_forms(spark):
    import numpy as np
    from pyspark.ml.feature import VectorAssembler

    rng = np.random.default_rng(1)
    x, n = rng.normal(0, 1, 40), 40
    y = 3 * x + rng.normal(0, 2, n)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, label double")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    xc, yc = x - x.mean(), y - y.mean()
    models = labs.regression_catalogue(rows=n, deviation=float(y.std()))
    assert models["Ridge"].fit(df).coefficients[0] == pytest.approx((xc @ yc) / (xc @ xc + 1.0), rel=1e-4)
    assert models["Lasso"].fit(df).coefficients[0] == pytest.approx((xc @ yc - n * 0.001) / (xc @ xc), rel=1e-3)


def test_stratified_split_is_exact(spark):
    df = spark.range(1000).withColumn("c", F.when(F.col("id") % 10 == 0, "rare").otherwise("usual"))
    got = {(r.c, r.is_train): r["count"] for r in split(df, ["id"], 0.8, strata="c").groupBy("c", "is_train").count().collect()}
    assert got == {("rare", True): 80, ("rare", False): 20, ("usual", True): 720, ("usual", False): 180}


def test_a_packed_tree_reads_like_its_rows(spark, tmp_path):
    """odd names, nulls, and no file per run and key."""
    facts = spark.createDataFrame([("e", "a/b %", "metrics", "rmse", "2 7.5 0\n9 1.5 0\n9 2.5 1\n\n"), ("e", "a/b %", "tags", "task", "one\ntwo"),
                                   ("e", None, "metrics", "f1", "1 0.5"), ("e", "z", "metrics", None, "1 3.0 0")] +
                                  [("e", f"r{k}", "metrics", key, f"{k} {k}.5 0") for k in range(300) for key in ("mae", "r2")],
                                  "experiment_id string, run_id string, kind string, key string, value string")
    meta = facts.select("experiment_id", "run_id").distinct().selectExpr("*", "concat('n ', run_id) run_name", "5L start_time", "cast(null as long) end_time")
    root = str(tmp_path / "log")
    write_run_tree(facts.coalesce(2), meta.coalesce(2), root)
    got = {r.run_id: r for r in read_runs(spark, root, packed=True).collect()}
    assert len(got) == 303 and all((got[f"r{k}"].mae, got[f"r{k}"].r2) == (k + 0.5, k + 0.5) for k in range(300))
    odd, unnamed = got["a/b %"], got["__HIVE_DEFAULT_PARTITION__"]
    assert (odd.rmse, odd.tag_task, odd.run_name, odd.start_time, odd.end_time) == (2.5, "one\ntwo", "n a/b %", 5, None)
    assert unnamed.f1 == 0.5 and got["z"].rmse is None
    assert sum(len([f for f in names if f.startswith("part-")]) for _, _, names in os.walk(root)) <= 4
