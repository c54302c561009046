"""Group aggregates and gap measures.

Every measure is one ``groupBy`` with conditional aggregates (partial
aggregation map-side), never one filtered scan per group or subject.  Group
keys with null values are dropped first, as pandas does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equigap.functions import labels as L
from equigap.operators.quantiles import cell_quantiles, quantiles_of, ranked_counts
from equigap.operators.util import aggregate_metrics, metric_order, one_row, unpivot_metrics


def _nn(*cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def mean_by(df: DataFrame, metric: str, keys: list[str], out: str = "mean") -> DataFrame:
    """Mean of ``metric`` by keys (null keys dropped)."""
    return df.where(_nn(*keys)).groupBy(*keys).agg(F.avg(metric).alias(out))


def mean_std_by(df: DataFrame, metric: str, keys: list[str]) -> DataFrame:
    """Mean and sample std by keys."""
    return df.where(_nn(*keys)).groupBy(*keys).agg(
        F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std")
    )


def region_map(df: DataFrame, metric: str, region: str, lat: str = "lat", lon: str = "lon",
               gdp: str | None = None) -> DataFrame:
    """Mean score (and GDP, constant per region) by (region, lat, lon);
    rows without coordinates drop out; plus the min / max of the means."""
    aggs = [F.avg(metric).alias(metric)]
    if gdp:
        aggs.append(F.max(gdp).alias("pib"))
    per = df.where(_nn(region, lat, lon)).groupBy(region, lat, lon).agg(*aggs)
    everything = Window.partitionBy()  # over the per-region table only
    return per.withColumn("min_value", F.min(metric).over(everything)).withColumn(
        "max_value", F.max(metric).over(everything))


def region_gap(df: DataFrame, metric: str, region: str, zone: str, a: str = "Urbano", b: str = "Rural",
               out: str = "Brecha_Puntos") -> DataFrame:
    """Signed a - b mean gap per region (pivot by conditional avg);
    null when a side is missing."""
    g = df.where(_nn(region, zone)).groupBy(region).agg(
        F.avg(F.when(F.col(zone) == a, F.col(metric))).alias(a),
        F.avg(F.when(F.col(zone) == b, F.col(metric))).alias(b),
    )
    return g.withColumn(out, F.col(a) - F.col(b))


def region_gap_abs(df: DataFrame, metric: str, region_key: str, zone: str, a: str = "URBANO",
                   b: str = "RURAL", out: str = "brecha_rural_urbana") -> DataFrame:
    """|a - b| per region over rows with region, zone and metric present."""
    base = df.where(_nn(region_key, zone, metric))
    g = base.groupBy(region_key).agg(
        F.avg(F.when(F.col(zone) == a, F.col(metric))).alias(a),
        F.avg(F.when(F.col(zone) == b, F.col(metric))).alias(b),
    )
    return g.withColumn(out, F.abs(F.col(a) - F.col(b)))


def top_gap_regions(df: DataFrame, metric: str, region: str, zone: str, n: int = 10,
                    a: str = "Urbano", b: str = "Rural") -> DataFrame:
    """Mean and std by (region, zone) for the ``n`` regions with the
    largest a - b gap among regions that have both zones.

    One pass over the fact: the (region, zone) table is aggregated once and
    the gap, the top-n (a limit over one row per region) and the semi join
    all run on that small table."""
    detail = mean_std_by(df, metric, [region, zone])
    gaps = detail.groupBy(region).agg(
        (F.max(F.when(F.col(zone) == a, F.col("mean"))) - F.max(F.when(F.col(zone) == b, F.col("mean"))))
        .alias("Diferencia"))
    top = gaps.where(F.col("Diferencia").isNotNull()).orderBy(F.desc("Diferencia"), F.asc(region)).limit(n)
    return detail.join(top.select(region), region, "left_semi")


def region_vs_all(df: DataFrame, metric: str, region_col: str, zone: str, region: str,
                  label: str = "PROMEDIO ANTIOQUIA") -> DataFrame:
    """Per-zone mean/std of one region stacked on the department-wide
    per-zone mean/std (labelled ``label``).  One scan: both statistics are
    conditional aggregates of the same ``groupBy(zone)``, stacked afterwards
    on the (one row per zone) result."""
    local_v = F.when(F.col(region_col) == region, F.col(metric))
    g = df.where(_nn(zone)).groupBy(zone).agg(
        F.avg(local_v).alias("l_mean"), F.stddev_samp(local_v).alias("l_std"), F.count(local_v).alias("l_n"),
        F.avg(metric).alias("t_mean"), F.stddev_samp(metric).alias("t_std"),
    )
    local = g.where(F.col("l_n") > 0).select(zone, F.col("l_mean").alias("mean"), F.col("l_std").alias("std"),
                                             F.lit(region).alias(region_col))
    total = g.select(zone, F.col("t_mean").alias("mean"), F.col("t_std").alias("std"), F.lit(label).alias(region_col))
    return local.unionByName(total)


def subject_gaps(df: DataFrame, subjects: dict[str, str], group: str, a: str = "Privado", b: str = "Público") -> DataFrame:
    """Per subject private mean, public mean and difference (each rounded
    to 1; the difference from unrounded means); null triple if a side is
    empty.  One pass of conditional averages."""
    side = lambda x: lambda v: F.avg(F.when(F.col(group) == x, v))
    g = aggregate_metrics(df, [], list(subjects.values()), {"__a": side(a), "__b": side(b)}, "col")
    materia = None
    for k, v in subjects.items():
        materia = F.when(F.col("col") == v, k) if materia is None else materia.when(F.col("col") == v, k)
    both = F.col("__a").isNotNull() & F.col("__b").isNotNull()
    return g.select(
        materia.alias("materia"),
        F.when(both, F.bround(F.col("__a") - F.col("__b"), 1)).alias("brecha"),
        F.when(both, F.bround(F.col("__b"), 1)).alias("media_publico"),
        F.when(both, F.bround(F.col("__a"), 1)).alias("media_privado"),
    )


def region_type_gap(df: DataFrame, metric: str, region: str, group: str, lat: str = "lat", lon: str = "lon",
                    a: str = "Privado", b: str = "Público") -> DataFrame:
    """A10: per (region, lat, lon): both type means and their difference,
    rounded to 1, rows without a difference dropped -- when both types occur
    in the selection; otherwise the overall mean per region (``promedio``)."""
    base = df.where(_nn(region, lat, lon, metric, group))
    per = base.groupBy(region, lat, lon).agg(
        F.avg(F.when(F.col(group) == a, F.col(metric))).alias("__a"),
        F.avg(F.when(F.col(group) == b, F.col(metric))).alias("__b"),
        F.avg(metric).alias("__all"),
        F.max((F.col(group) == a).cast("int")).alias("__has_a"),
        F.max((F.col(group) == b).cast("int")).alias("__has_b"),
    )
    everything = Window.partitionBy()  # over the per-region table only
    j = per.withColumn("__types", F.max("__has_a").over(everything) + F.max("__has_b").over(everything))
    both = F.col("__types") == 2
    out = j.select(
        region, lat, lon,
        F.when(both, F.bround(F.col("__a") - F.col("__b"), 1)).alias("brecha"),
        F.when(both, F.bround(F.col("__b"), 1)).alias("media_pub"),
        F.when(both, F.bround(F.col("__a"), 1)).alias("media_priv"),
        F.when(~both, F.col("__all")).alias("promedio"),
        both.alias("__both"),
    )
    return out.where(~F.col("__both") | F.col("brecha").isNotNull()).drop("__both")


def median_gap(df: DataFrame, metric: str, group: str, a: str, b: str, out: str = "gap") -> DataFrame:
    """median(a) - median(b); null if a side is missing.  Both
    medians come from one scan."""
    per = cell_quantiles(df.where(F.col(group).isin(a, b)), [group], metric, [0.5])
    return per.agg(
        F.max(F.when(F.col(group) == a, F.col("q50"))).alias("median_a"),
        F.max(F.when(F.col(group) == b, F.col("q50"))).alias("median_b"),
    ).withColumn(out, F.col("median_a") - F.col("median_b"))


def level_by_access(df: DataFrame, level: str, access: str) -> DataFrame:
    """Counts by English level x access with the level order."""
    order = metric_order(F.col(level), L.ENGLISH_LEVELS)
    return (
        df.where(_nn(level, access))
        .groupBy(level, access)
        .agg(F.count("*").cast("long").alias("n"))
        .withColumn("level_order", order)
    )


def share_by(df: DataFrame, col: str) -> DataFrame:
    """Count and share of each category (null category dropped)."""
    g = df.where(_nn(col)).groupBy(col).agg(F.count("*").cast("long").alias("n"))
    return g.select(col, "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def histogram(df: DataFrame, metric: str, bins: int = 40) -> DataFrame:
    """Equal-width histogram over [min, max] (last bin closed)."""
    r = one_row(df.agg(F.min(metric).alias("__lo"), F.max(metric).alias("__hi")))  # range as literals
    j = df.where(F.col(metric).isNotNull()).select(metric, F.lit(r["__lo"]).cast("double").alias("__lo"),
                                                   F.lit(r["__hi"]).cast("double").alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    b = F.when(width == 0, 0).otherwise(
        F.least(F.floor((F.col(metric) - F.col("__lo")) / width), F.lit(bins - 1))
    ).cast("int")
    g = j.groupBy(b.alias("bin"), "__lo", "__hi").agg(F.count("*").cast("long").alias("n"))
    return g.select(
        "bin",
        (F.col("__lo") + F.col("bin") * (F.col("__hi") - F.col("__lo")) / bins).alias("bin_lo"),
        (F.col("__lo") + (F.col("bin") + 1) * (F.col("__hi") - F.col("__lo")) / bins).alias("bin_hi"),
        "n",
    )


def box_summary(df: DataFrame, metrics: list[str], group: str | None) -> DataFrame:
    """min/q1/median/q3/max, 1.5 IQR fences, whiskers (most extreme
    values inside the fences) and outlier counts per (metric, group).

    The facts are read once, into counts per (metric, group, value); the
    quartiles, fences, whiskers and outliers all come from these."""
    keys = ["metric"] + ([group] if group else [])
    long = unpivot_metrics(df, [group] if group else [], metrics, "metric", "v")
    if group:
        long = long.where(F.col(group).isNotNull())
    ranked = ranked_counts(long, keys, "v")
    q = quantiles_of(ranked, keys, [0.25, 0.5, 0.75]).withColumnsRenamed({"q25": "q1", "q50": "median", "q75": "q3"})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    q = q.withColumn("lower_fence", F.col("q1") - reach).withColumn("upper_fence", F.col("q3") + reach)
    v = F.col("v")
    inside = v.between(F.col("lower_fence"), F.col("upper_fence"))
    of_cell = ranked.join(q, keys).groupBy(*keys, "q1", "median", "q3", "lower_fence", "upper_fence").agg(
        F.min(v).alias("min"), F.max(v).alias("max"), F.sum("n").cast("long").alias("n"),
        F.min(F.when(v >= F.col("lower_fence"), v)).alias("whisker_low"), F.max(F.when(v <= F.col("upper_fence"), v)).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).cast("long").alias("outliers"))
    return of_cell.select(*keys, "min", "q1", "median", "q3", "max", "n", "lower_fence", "upper_fence", "whisker_low", "whisker_high", "outliers")


def yearly_mean(df: DataFrame, metric: str, period: str, key: str | list[str] | None = None) -> DataFrame:
    """Mean by year (first 4 characters of the period; rows with a
    non-numeric year dropped), optionally by more keys."""
    more = [key] if isinstance(key, str) else key or []
    base = df.select(L.period_year(period).alias("anio"), *more, metric)
    kcols = ["anio", *more]
    return base.where(_nn(*kcols)).groupBy(*kcols).agg(F.avg(metric).alias(metric))


def region_ranking(df: DataFrame, metric: str, region: str) -> DataFrame:
    """Mean by region with its ascending rank (1 = lowest mean).

    The rank is a global window over the per-region aggregate (one row per
    region), never over fact rows."""
    g = mean_by(df, metric, [region], out=metric)
    return g.withColumn("rank", F.row_number().over(Window.orderBy(F.col(metric).asc_nulls_last(), F.col(region))))


def stratum_type_mean(df: DataFrame, metric: str, stratum: str, group: str) -> DataFrame:
    """Mean by (normalised stratum, school type) with the stratum order."""
    lab = L.stratum_label(stratum)
    base = df.where(_nn(stratum, metric, group)).select(lab.alias("estrato_clean"), F.col(group), F.col(metric))
    g = base.where(F.col("estrato_clean").isNotNull()).groupBy("estrato_clean", group).agg(F.avg(metric).alias(metric))
    return g.withColumn("estrato_orden", L.stratum_order("estrato_clean"))


def prob_difference(df: DataFrame, flag: str, level: str, levels: tuple[str, ...] = ("B1", "B+"),
                    yes: str = "Si", no: str = "No") -> DataFrame:
    """100*(P(level in levels | yes) - P(. | no)) rounded to 2; 0.0 when
    a side is empty; null levels count in the denominator."""
    hit = F.coalesce(F.col(level).isin(*levels), F.lit(False)).cast("double")
    g = df.agg(
        F.avg(F.when(F.col(flag) == yes, hit)).alias("__p_yes"),
        F.avg(F.when(F.col(flag) == no, hit)).alias("__p_no"),
    )
    both = F.col("__p_yes").isNotNull() & F.col("__p_no").isNotNull()
    return g.select(
        F.when(both, F.bround((F.col("__p_yes") * 100) - (F.col("__p_no") * 100), 2)).otherwise(F.lit(0.0))
        .alias("diferencia_z")
    )


def mean_adjusted_gap(tab: DataFrame, target: str = "target", gap: str = "brecha_ajustada") -> DataFrame:
    """Mean adjusted gap per target, ascending."""
    return tab.groupBy(target).agg(F.avg(gap).alias("brecha_media")).orderBy("brecha_media")
