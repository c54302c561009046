"""Insight batch (E2): cut points, risk, stratum-adjusted gaps, region
priorities and the KPI record (A11-A13, A16-A22, A33-A34).

Fact rows are only ever aggregated; thresholds are one-row aggregates read as
one row and applied as literals, region tables are bounded by the number of
regions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equigap.functions import labels as L
from equigap.functions.text import normalize_key
from equigap.operators.quantiles import quantile_row, quantiles_of, ranked_cells
from equigap.operators.util import aggregate_metrics, metric_order, one_row, one_row_frame

# Default cut points of the insight batch.
DEFAULT_QS = (0.1, 0.25, 0.5, 0.75, 0.9)
RISK_FALLBACK = 250.0


def cut_points(df: DataFrame, metric: str, qs: tuple[float, ...] = DEFAULT_QS, fallback: float = RISK_FALLBACK) -> DataFrame:
    """One row with q10..q90 (linear interpolation) and the risk
    threshold (q25, or ``fallback`` when there is no score)."""
    row = quantile_row(df, metric, qs)
    names = [f"q{int(round(q * 100))}" for q in qs]
    out = row.select(*[F.col(n) for n in names])
    return out.withColumn("umbral_riesgo", F.coalesce(F.col("q25"), F.lit(fallback)) if "q25" in names
                          else F.lit(fallback))


def with_risk(df: DataFrame, metric: str, cuts: DataFrame) -> DataFrame:
    """Attach C27 (binary) and C26 (band) targets using the one-row cuts."""
    c = one_row(cuts.select("umbral_riesgo", "q25", "q75"))  # scalars, applied as literals
    thr = F.lit(c["umbral_riesgo"]).cast("double")
    q25 = F.lit(c["q25"] if c["q25"] is not None else c["umbral_riesgo"]).cast("double")
    q75 = F.lit(c["q75"] if c["q75"] is not None else c["umbral_riesgo"]).cast("double")
    return df.withColumn("prioridad_binaria", L.at_risk(metric, thr)).withColumn(
        "prioridad", L.priority_band(metric, q25, q75))


def risk_rate(df_risk: DataFrame) -> DataFrame:
    """Share at risk x 100 over all rows (null scores count as 0)."""
    return df_risk.agg((F.avg("prioridad_binaria") * 100).alias("tasa_riesgo"))


def risk_by_segment(df_risk: DataFrame, segments: dict[str, Column | str]) -> DataFrame:
    """Risk rate x 100 by (segment, value) for several segment columns in
    one pass (unpivot, then one groupBy); null values dropped."""
    cols = [(F.col(c) if isinstance(c, str) else c).cast("string").alias(name) for name, c in segments.items()]
    base = df_risk.select(*cols, F.col("prioridad_binaria"))
    long = base.unpivot(["prioridad_binaria"], list(segments), "segmento", "valor")
    return long.where(F.col("valor").isNotNull()).groupBy("segmento", "valor").agg(
        (F.avg("prioridad_binaria") * 100).alias("tasa_riesgo"), F.count("*").cast("long").alias("n")
    )


def standardized_means(df: DataFrame, metric: str, group: str, strat: str, by: list[str] | None = None) -> DataFrame:
    """Directly standardised mean per group: strata weights are the
    stratum shares among rows with metric, group and stratum present; per
    group sum(mean_s * w_s) / sum(w_s) over the strata the group has.

    One aggregate over fact rows; the rest runs on the (group x stratum)
    table, whose size is bounded by the number of strata and groups."""
    by = by or []
    base = df.where(F.col(metric).isNotNull() & F.col(group).isNotNull() & F.col(strat).isNotNull())
    cell = base.groupBy(*by, group, strat).agg(F.count("*").alias("__n"), F.avg(metric).alias("__m"))
    return _standardised(cell, group, strat, by)


def _standardised(cell: DataFrame, group: str, strat: str, by: list[str]) -> DataFrame:
    cell = cell.withColumn("__ns", F.sum("__n").over(Window.partitionBy(*by, strat)))
    return cell.groupBy(*by, group).agg(
        (F.sum(F.col("__m") * F.col("__ns")) / F.sum("__ns")).alias("ajustado")
    )


def adjusted_gaps(df: DataFrame, metrics: list[str], group: str, strat: str, a: str = "PRIVADO",
                  b: str = "PUBLICO") -> DataFrame:
    """Stratum-adjusted a - b gap for every metric (one pass of
    conditional aggregates), only where both groups exist; ``is_max`` marks the
    metric with the largest |gap| (first in metric order on ties)."""
    base = df.where(F.col(group).isNotNull() & F.col(strat).isNotNull())
    cell = aggregate_metrics(base, [group, strat], metrics, {"__n": F.count, "__m": F.avg}).where("__n > 0")
    adj = _standardised(cell, group, strat, ["metric"])
    g = adj.groupBy("metric").agg(
        F.max(F.when(F.col(group) == a, F.col("ajustado"))).alias("privado_ajustado"),
        F.max(F.when(F.col(group) == b, F.col("ajustado"))).alias("publico_ajustado"),
    ).where(F.col("privado_ajustado").isNotNull() & F.col("publico_ajustado").isNotNull())
    g = g.withColumn("gap_privado_menos_publico", F.col("privado_ajustado") - F.col("publico_ajustado"))
    g = g.withColumn("metric_order", metric_order(F.col("metric"), metrics))
    rank = F.row_number().over(Window.orderBy(F.abs(F.col("gap_privado_menos_publico")).desc(), F.col("metric_order")))
    return g.withColumn("is_max", rank == 1)


def display_name(df: DataFrame, key: str, name: str) -> DataFrame:
    """Most frequent raw name per normalised key, smallest on ties: names are
    counted first, and the first of a key's counts is kept as they are read."""
    counts = df.where(F.col(key).isNotNull() & F.col(name).isNotNull()).groupBy(key, F.col(name).alias("__name")).agg(F.count("*").alias("__n"))
    return counts.groupBy(key).agg(F.min_by("__name", F.struct(-F.col("__n"), F.col("__name"))).alias("municipio_display"))


def _by_normalised_region(base: DataFrame, region: str, sums: dict[str, Column], counts: dict[str, Column]) -> DataFrame:
    """Two-stage aggregation: first by the raw region name (partial
    aggregation, one row per distinct spelling), then the C10 key is computed
    once per spelling and the partial sums are merged per key.  The text
    fold runs on distinct names, not on fact rows.  The display name is the
    most frequent spelling, smallest on ties (A20)."""
    aggs = [F.sum(v).alias(f"s_{k}") for k, v in sums.items()]
    aggs += [F.count(v).alias(f"c_{k}") for k, v in counts.items()]
    aggs.append(F.count("*").alias("__n"))
    per_name = base.groupBy(region).agg(*aggs).withColumn("MUNICIPIO_NORM", normalize_key(region))
    merged = [F.sum(f"s_{k}").alias(f"s_{k}") for k in sums] + [F.sum(f"c_{k}").alias(f"c_{k}") for k in counts]
    merged += [F.sum("__n").alias("__n"),
               F.min_by(region, F.struct(-F.col("__n"), F.col(region))).alias("municipio_display")]
    return per_name.groupBy("MUNICIPIO_NORM").agg(*merged)


def region_zone_gap(df: DataFrame, metric: str, region: str, zone: str) -> DataFrame:
    """Q1 table: |URBANO - RURAL| mean per normalised region key + display
    name; regions lacking a side have a null gap."""
    base = df.select(
        F.col(region), L.zone_strict(zone).alias("ZONA"), F.col(metric).cast("double").alias(metric)
    ).where(F.col(region).isNotNull() & F.col("ZONA").isNotNull() & F.col(metric).isNotNull())
    u = F.when(F.col("ZONA") == "URBANO", F.col(metric))
    r = F.when(F.col("ZONA") == "RURAL", F.col(metric))
    g = _by_normalised_region(base, region, {"u": u, "r": r}, {"u": u, "r": r})
    stats = g.select("MUNICIPIO_NORM", F.try_divide(F.col("s_u"), F.col("c_u")).alias("URBANO"),
                     F.try_divide(F.col("s_r"), F.col("c_r")).alias("RURAL"), "municipio_display")
    return stats.withColumn("brecha_rural_urbana", F.abs(F.col("URBANO") - F.col("RURAL")))


def region_priority(gap: DataFrame, gap_col: str = "brecha_rural_urbana",
                    gdp_col: str | None = "pib_miles_millones") -> DataFrame:
    """Regions with a gap; prioridad_alta = gap >= q75(gap) and, when a
    GDP cut exists, GDP <= q25(GDP) (null GDP -> false).  The cuts are
    exact percentiles over the region table (one row per region)."""
    g = gap.where(F.col(gap_col).isNotNull())
    # cut points as whole-table windows over the region table: the fact plan
    # under it runs once (no self cross join re-evaluating it)
    everything = Window.partitionBy()
    j = g.withColumn("__gap_cut", F.percentile(gap_col, 0.75).over(everything)).withColumn(
        "__pib_cut", F.percentile(gdp_col, 0.25).over(everything) if gdp_col else F.lit(None).cast("double"))
    flag = F.col(gap_col) >= F.col("__gap_cut")
    if gdp_col:
        flag = F.when(F.col("__pib_cut").isNull(), flag).otherwise(
            flag & F.coalesce(F.col(gdp_col) <= F.col("__pib_cut"), F.lit(False))
        )
    return j.withColumn("prioridad_alta", flag).withColumnRenamed("__gap_cut", "gap_cut").withColumnRenamed(
        "__pib_cut", "pib_cut"
    )


def low_gdp_top(prio: DataFrame, key: str = "MUNICIPIO_NORM", gap_col: str = "brecha_rural_urbana",
                gdp_col: str = "pib_miles_millones", n: int = 15) -> DataFrame:
    """Top-n regions by gap among those with GDP <= the GDP cut (all
    regions when there is no cut).  A top-k report over the region table."""
    keep = F.col("pib_cut").isNull() | (F.col(gdp_col) <= F.col("pib_cut"))
    return prio.where(keep).orderBy(F.desc(gap_col), F.asc(key)).limit(n)


def digital_potential(df: DataFrame, english: str, region: str, internet_flag: Column, computer_flag: Column) -> DataFrame:
    """Per normalised region: English mean with / without digital access,
    gap (null -> 0), share without access, row count, display name."""
    base = df.select(
        F.col(region), L.access2(internet_flag, computer_flag).alias("ACCESO"), F.col(english).cast("double").alias("__e")
    ).where(F.col(region).isNotNull() & F.col("__e").isNotNull())
    con = F.when(F.col("ACCESO") == "CON_ACCESO", F.col("__e"))
    sin = F.when(F.col("ACCESO") == "SIN_ACCESO", F.col("__e"))
    g = _by_normalised_region(base, region, {"con": con, "sin": sin}, {"con": con, "sin": sin})
    return g.select(
        "MUNICIPIO_NORM",
        F.try_divide(F.col("s_con"), F.col("c_con")).alias("CON_ACCESO"),
        F.try_divide(F.col("s_sin"), F.col("c_sin")).alias("SIN_ACCESO"),
        (F.col("c_sin") / F.col("__n")).alias("share_sin_acceso"),
        F.col("__n").cast("long").alias("estudiantes"),
        "municipio_display",
    ).withColumn("gap_ingles_digital", F.coalesce(F.col("CON_ACCESO") - F.col("SIN_ACCESO"), F.lit(0.0)))


def potential_class(pot: DataFrame) -> DataFrame:
    """ALTO / MEDIO / BAJO from the q75 cuts of gap and share."""
    everything = Window.partitionBy()  # the region table: one row per region
    j = pot.withColumn("__gc", F.percentile("gap_ingles_digital", 0.75).over(everything)).withColumn(
        "__sc", F.percentile("share_sin_acceso", 0.75).over(everything))
    g, s = F.col("gap_ingles_digital"), F.col("share_sin_acceso")
    cls = (
        F.when((g >= F.col("__gc")) & (s >= F.col("__sc")), "ALTO")
        .when((g >= F.col("__gc") * 0.5) & (s >= F.col("__sc") * 0.5), "MEDIO")
        .otherwise("BAJO")
    )
    return j.withColumn("potencial_mejora", cls).drop("__gc", "__sc")


def priority_lists(tab: DataFrame, key: str = "MUNICIPIO_NORM", n: int = 25) -> DataFrame:
    """First ``n`` rows of a region table in key order (a top-k payload)."""
    return tab.orderBy(key).limit(n)


def kpis(df: DataFrame, roles, gdp: DataFrame | None = None, region_priority_table: DataFrame | None = None) -> DataFrame:
    """The KPI record as one row: risk rate and threshold, urban - rural
    median gap, largest stratum-adjusted private - public gap and its metric,
    digital English median gap, number of priority regions.  Each part is a
    one-row aggregate; a missing role gives a null KPI."""
    from equigap.session import materialize

    # several passes read the facts: write the needed columns once instead of
    # recomputing the joins under ``df`` for every pass
    needed = [c for c in dict.fromkeys([roles.score, roles.zone, roles.school_type, roles.stratum, roles.english,
                                        roles.internet, roles.computer, *roles.subjects]) if c and c in df.columns]
    df = materialize(df.select(*needed), "kpi_fact")
    # quartile, medians and risk all come from one table of counts per cell and value
    cells, gaps, kpi = {}, {}, {}
    if roles.score:
        cells["all"] = (None, roles.score)
    if roles.score and roles.zone:
        zone = L.zone_strict(roles.zone)
        cells |= {side: (zone == side, roles.score) for side in ("URBANO", "RURAL")}
        gaps["brecha_rural_urbana_p50"] = ("URBANO", "RURAL")
    if roles.english and roles.internet and roles.computer:
        access = L.access2(L.yes_no_flag(roles.internet), L.yes_no_flag(roles.computer))
        cells |= {side: (access == side, roles.english) for side in ("CON_ACCESO", "SIN_ACCESO")}
        gaps["impacto_digital_ingles_gap"] = ("CON_ACCESO", "SIN_ACCESO")
    if cells:
        ranked = ranked_cells(df, cells)
        found = {r["cell"]: r for r in quantiles_of(ranked, ["cell"], [0.25, 0.5]).collect()}  # a row per cell
        for name, sides in gaps.items():
            kpi[name] = found[sides[0]]["q50"] - found[sides[1]]["q50"] if all(x in found for x in sides) else None
        if roles.score:
            cut = found["all"]["q25"] if "all" in found else RISK_FALLBACK
            below = ranked.where("cell = 'all'").agg(F.sum(F.when(L.at_risk("v", cut) == 1, F.col("n")).otherwise(0)).alias("n")).first()["n"] or 0
            rows = df.count()
            kpi |= {"tasa_riesgo_departamental": below / rows * 100 if rows else None, "umbral_riesgo": float(cut)}
    parts = []
    if kpi:
        parts.append(df.sparkSession.createDataFrame([tuple(kpi.values())], ", ".join(f"{k} double" for k in kpi)))
    if roles.school_type and roles.stratum and roles.subjects:
        t = df.withColumn("__t", L.school_type(roles.school_type))
        g = adjusted_gaps(t, roles.subjects, "__t", roles.stratum).where("is_max")
        parts.append(g.select(F.col("gap_privado_menos_publico").alias("impacto_estimado_publico_privado_max"),
                              F.col("metric").alias("impacto_estimado_publico_privado_metric")))
    if region_priority_table is not None:
        parts.append(region_priority_table.agg(
            F.sum(F.col("prioridad_alta").cast("long")).alias("municipios_prioridad_alta")))
    return one_row_frame(df.sparkSession, parts)  # every part is a one-row aggregate
