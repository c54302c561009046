"""Run ranking and comparison.

Windows always partition by task (a handful of groups over the run table,
never over fact rows); ``run_id`` breaks ties so results are deterministic.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _task_metric(task: Column) -> tuple[Column, Column]:
    metric = F.when(task == "regresion", "rmse").when(task == "clasificacion_multiclase", "f1_macro").otherwise("f1")
    value = (
        F.when(task == "regresion", F.col("rmse"))
        .when(task == "clasificacion_multiclase", F.col("f1_macro"))
        .otherwise(F.col("f1"))
    )
    return metric, value


def _ranked(runs: DataFrame, r2_tiebreak: bool = True) -> DataFrame:
    t = F.col("task")
    metric, value = _task_metric(t)
    reg = t == "regresion"
    order = [
        F.when(reg, F.col("__v")).asc_nulls_last(),
        F.when(~reg, F.col("__v")).desc_nulls_last(),
    ]
    if r2_tiebreak:
        order.append(F.when(reg, F.col("r2")).desc_nulls_last())
    order.append(F.col("run_id").asc())
    w = Window.partitionBy("task").orderBy(*order)
    base = runs.where(F.col("task").isNotNull()).withColumn("__m", metric).withColumn("__v", value)
    return base.where(F.col("__v").isNotNull()).withColumn("rank", F.row_number().over(w))


def best_runs(runs: DataFrame, r2_tiebreak: bool = True) -> DataFrame:
    """Best run per task (min rmse then max r2 / max f1_macro / max f1)."""
    r = _ranked(runs, r2_tiebreak).where(F.col("rank") == 1)
    return r.select("task", "model", "feature_set", F.col("__m").alias("metric"),
                    F.bround("__v", 4).alias("metric_value"), "run_id")


def top_runs(runs: DataFrame, n: int = 2) -> DataFrame:
    """Top-n runs per task with rank and metric label."""
    r = _ranked(runs).where(F.col("rank") <= n)
    label = F.when(F.col("__m") == "rmse", "RMSE").when(F.col("__m") == "f1_macro", "F1 macro").otherwise("F1")
    return r.select("task", F.col("rank").cast("int").alias("rank"), "model", "feature_set", "selected_vars",
                    label.alias("metric"), F.bround("__v", 4).alias("metric_value"), "config_id", "run_id")


def top_classifiers(runs: DataFrame, n: int = 3) -> DataFrame:
    """Top-n classification runs by f1 (a top-k report) flagged with
    the best by accuracy / precision-free f1 (first on ties)."""
    clf = runs.where(F.col("f1").isNotNull())
    top = clf.orderBy(F.desc("f1"), F.asc("run_id")).limit(n)
    return top.withColumn("top_rank", F.row_number().over(Window.orderBy(F.desc("f1"), F.asc("run_id"))))


def compare_runs(runs: DataFrame, task: str, metric: str, config_col: str = "config_id") -> DataFrame:
    """Metric per configuration for one task."""
    return runs.where(F.col("task") == task).select(config_col, "feature_set", F.col(metric).alias("value")).where(
        F.col("value").isNotNull())


def loss_curves(history: DataFrame) -> DataFrame:
    """Long form (run, epoch, series, value): every loss, and val_loss
    where present."""
    long = history.unpivot(["run_id", "epoch"], ["loss", "val_loss"], "series", "value")
    return long.where(F.col("value").isNotNull())


def ordered(df: DataFrame, by: list[Column | str]) -> DataFrame:
    """Explicit sort (range-partitioned, distributed)."""
    return df.orderBy(*by)


def cap_rows(df: DataFrame, n: int | None, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """Reproducible sample of ``n`` rows: the ``n`` smallest
    ``md5(key|seed)``.  Independent of partitioning; ``None`` (the
    default everywhere) means no cap.  This is a sampling operator: the
    limit is the feature."""
    if not n:
        return df
    cols = key or df.columns
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed))))
    return df.withColumn("__h", h).orderBy("__h").limit(n).drop("__h")


def distinct_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct combinations."""
    return df.select(*cols).distinct()


def stack(*dfs: DataFrame) -> DataFrame:
    """Concatenate by column name."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
