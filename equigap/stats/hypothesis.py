"""Significance tests from distributed sufficient statistics.

Fact rows are reduced to (n, mean, var_samp) per group in one aggregation;
t, Welch-Satterthwaite df, Cohen's d and F are column formulas on that tiny
result, and p-values come from :mod:`equigap.stats.tails` on the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equigap.functions import labels as L
from equigap.operators.util import aggregate_metrics
from equigap.stats.tails import f_pvalue, t_pvalue

# Group labels of the P2 statistics script.
PUBLIC = "OFICIAL"
PRIVATE = "NO OFICIAL"
STRATA_ORDER = ["Estrato 1", "Estrato 2", "Estrato 3", "Estrato 4", "Estrato 5", "Estrato 6"]


def _group_stats(df: DataFrame, value: str, group: str, a: str, b: str, keys: list[str]) -> DataFrame:
    """n, mean, var_samp of side a and side b per key, one pass."""
    va = F.when(F.col(group) == a, F.col(value))
    vb = F.when(F.col(group) == b, F.col(value))
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(va).cast("long").alias("n_a"), F.avg(va).alias("mean_a"), F.var_samp(va).alias("var_a"),
        F.count(vb).cast("long").alias("n_b"), F.avg(vb).alias("mean_b"), F.var_samp(vb).alias("var_b"),
    )


def _tested(s: DataFrame) -> DataFrame:
    """Group statistics with t, df, cohen_d, p_valor and diferencia."""
    w = welch_columns()
    s = s.withColumn("t", w["t"]).withColumn("df", w["df"]).withColumn("cohen_d", w["d"])
    return s.withColumn("p_valor", t_pvalue(F.col("t"), F.col("df"))).withColumn("diferencia", F.col("mean_b") - F.col("mean_a"))


def welch_columns() -> dict[str, Column]:
    """t, df (Welch-Satterthwaite) and Cohen's d from the summary columns;
    the sign is a - b for both t and d."""
    # try_divide: a zero variance or a one-row side gives null, not an ANSI error
    sa = F.try_divide(F.col("var_a"), F.col("n_a"))
    sb = F.try_divide(F.col("var_b"), F.col("n_b"))
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(sa + sb))
    dfree = F.try_divide((sa + sb) * (sa + sb),
                         F.try_divide(sa * sa, F.col("n_a") - 1) + F.try_divide(sb * sb, F.col("n_b") - 1))
    pooled = F.sqrt(F.try_divide((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b"),
                                 F.col("n_a") + F.col("n_b") - 2))
    d = F.when(pooled == 0, F.lit(0.0)).otherwise(F.try_divide(F.col("mean_a") - F.col("mean_b"), pooled))
    return {"t": t, "df": dfree, "d": d}


def welch(df: DataFrame, metric: str, group: str, a: str = PUBLIC, b: str = PRIVATE, keys: list[str] | None = None) -> DataFrame:
    """T01 + T02: Welch t (a - b), df, two-sided p, Cohen's d (a - b) and the
    private - public style difference (b - a), per key (or one row)."""
    return _tested(_group_stats(df, metric, group, a, b, keys or []))


def subject_tests(df: DataFrame, subjects: dict[str, str], group: str, a: str = PUBLIC, b: str = PRIVATE) -> DataFrame:
    """Welch test per subject (one pass of conditional aggregates);
    means rounded 2, t and d rounded 4, sorted by gap descending."""
    of = lambda side, fn: lambda v: fn(F.when(F.col(group) == side, v))
    aggs = {f"{k}_{x}": of(side, fn) for x, side in (("a", a), ("b", b)) for k, fn in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))}
    long = aggregate_metrics(df, [], list(subjects.values()), aggs | {"values": F.count}, "__col").where(F.col("values") > 0)
    name = None
    for k, v in subjects.items():
        name = F.when(F.col("__col") == v, k) if name is None else name.when(F.col("__col") == v, k)
    r = _tested(long.withColumn("Materia", name))
    return r.select(
        "Materia",
        F.bround("mean_a", 2).alias("Publico"),
        F.bround("mean_b", 2).alias("Privado"),
        F.bround(F.col("mean_b") - F.col("mean_a"), 2).alias("Brecha"),
        F.bround("t", 4).alias("t"),
        F.col("p_valor"),
        F.bround("cohen_d", 4).alias("Cohen_d"),
        L.effect_label(F.col("cohen_d")).alias("Efecto"),
    ).orderBy(F.desc("Brecha"))


def stratified_tests(df: DataFrame, metric: str, group: str, strat: str, a: str = PUBLIC, b: str = PRIVATE,
                     min_n: int = 30, strata: list[str] | None = None) -> DataFrame:
    """Welch test within each listed stratum where both sides have at
    least ``min_n`` rows (F05)."""
    strata = strata or STRATA_ORDER
    base = df.where(F.col(strat).isin(*strata))
    r = welch(base, metric, group, a, b, keys=[strat])
    r = r.where((F.col("n_a") >= min_n) & (F.col("n_b") >= min_n))
    return r.select(
        F.col(strat).alias("Estrato"),
        F.bround("mean_a", 2).alias("Publico"),
        F.bround("mean_b", 2).alias("Privado"),
        F.bround(F.col("mean_b") - F.col("mean_a"), 2).alias("Brecha"),
        F.col("p_valor"),
        F.bround("cohen_d", 4).alias("Cohen_d"),
        L.effect_label(F.col("cohen_d")).alias("Efecto"),
        F.col("n_a").alias("n_pub"),
        F.col("n_b").alias("n_priv"),
    )


def anova_groups(df: DataFrame, metric: str, group: str, groups: list[str] | None = None) -> DataFrame:
    """Per-group n, mean and var_samp of the ANOVA (groups with n > 0)."""
    groups = groups or STRATA_ORDER
    return (
        df.where(F.col(group).isin(*groups) & F.col(metric).isNotNull())
        .groupBy(group)
        .agg(F.count("*").cast("long").alias("n"), F.avg(metric).alias("mean"), F.var_samp(metric).alias("var"))
    )


def anova(df: DataFrame, metric: str, group: str, groups: list[str] | None = None) -> DataFrame:
    """One-way ANOVA F and p from per-group sufficient statistics.

    SSB = sum n_i (mean_i - grand)^2, SSW = sum (n_i - 1) var_i; the second
    aggregation runs over at most len(groups) rows."""
    g = anova_groups(df, metric, group, groups)
    everything = Window.partitionBy()  # over the <= len(groups) group rows
    j = g.withColumn("n_total", F.sum("n").over(everything)).withColumn(
        "grand", F.sum(F.col("n") * F.col("mean")).over(everything) / F.col("n_total")).withColumn(
        "k", F.count("*").over(everything))
    r = j.groupBy("n_total", "k").agg(
        F.sum(F.col("n") * (F.col("mean") - F.col("grand")) * (F.col("mean") - F.col("grand"))).alias("ssb"),
        F.sum(F.coalesce((F.col("n") - 1) * F.col("var"), F.lit(0.0))).alias("ssw"),
    )
    d1 = F.col("k") - 1
    d2 = F.col("n_total") - F.col("k")
    f = F.try_divide(F.try_divide(F.col("ssb"), d1), F.try_divide(F.col("ssw"), d2))
    r = r.select(f.alias("F"), d1.cast("long").alias("df_between"), d2.cast("long").alias("df_within"))
    return r.withColumn("p_valor", f_pvalue(F.col("F"), F.col("df_between"), F.col("df_within")))


def region_insight(df: DataFrame, metric: str, zone: str, region_col: str | None = None, region: str | None = None,
                   a: str = "Urbano", b: str = "Rural") -> DataFrame:
    """A - b gap (1 decimal) with Welch p and SIGNIFICATIVA / NO
    significativa; no row when either side has fewer than 2 rows.  With a
    region column and no region one row per region, in one pass."""
    base = df if region is None or region in ("TODOS", "Todos") else df.where(F.col(region_col) == region)
    each = region_col if region is None and region_col else None
    r = welch(base, metric, zone, a, b, [each] if each else None).where((F.col("n_a") >= 2) & (F.col("n_b") >= 2))
    return r.select(
        *([each] if each else []),
        F.bround(F.col("mean_a") - F.col("mean_b"), 1).alias("brecha"),
        F.col("p_valor"),
        F.when(F.col("p_valor") < 0.05, "SIGNIFICATIVA").otherwise("NO significativa").alias("significancia"),
        "n_a", "n_b",
    )


def trend(df: DataFrame, x: str, y: str, by: str | None = None) -> DataFrame:
    """Simple OLS y ~ x (optionally per group) via regr_* aggregates."""
    aggs = [
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).cast("long").alias("n"),
    ]
    return (df.where(F.col(by).isNotNull()).groupBy(by).agg(*aggs)) if by else df.agg(*aggs)
