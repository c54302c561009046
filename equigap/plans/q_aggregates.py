"""Registered aggregate, gap, join and insight queries (A*, J*, F*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigap.functions import labels as L
from equigap.functions.text import normalize_key
from equigap.operators import filters as FL
from equigap.operators import gaps as G
from equigap.operators import insights as I
from equigap.operators import joins as J
from equigap.plans import sqlbits as S
from equigap.plans.catalog import register
from equigap.plans.tpch import exam_lines, exam_orders, region_coords, region_gdp


# Output rounding for the oracle comparison: 6 decimals, with exact ties at
# the 7th decimal broken upward by a 1e-9 nudge (far below the reported
# precision) so that summation order cannot flip them; the oracle SQL uses
# the same rule (catalog.register rewrites its round(x, 6) calls).
TIE_NUDGE = 1e-9


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Round the listed double columns to 6 decimals (oracle-stable)."""
    return df.select(*[F.round(F.col(c) + F.lit(TIE_NUDGE), 6).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# ------------------------------------------------------------ flagship ----

def q1_priority_table(spark: SparkSession, sf: str) -> DataFrame:
    """C12 zone -> A06 |urban - rural| per normalised region (+A20
    display name) -> J03 GDP on the normalised key -> A18 priority."""
    fact = exam_orders(spark, sf)
    gap = I.region_zone_gap(fact, "punt_global", "cole_mcpio_ubicacion", "cole_area_ubicacion")
    gap = J.region_with_gdp(gap, region_gdp(spark, sf), "MUNICIPIO_NORM", "municipio", ["pib_miles_millones"])
    prio = I.region_priority(gap)
    return r6(prio.select("MUNICIPIO_NORM", "municipio_display", "URBANO", "RURAL", "brecha_rural_urbana",
                          "pib_miles_millones", "gap_cut", "pib_cut", "prioridad_alta"),
              "URBANO", "RURAL", "brecha_rural_urbana", "gap_cut", "pib_cut")


Q1_SQL = f"""
, base AS (
  SELECT cole_mcpio_ubicacion AS m, {S.zone_strict('cole_area_ubicacion')} AS zona, punt_global AS s,
         {S.norm_key('cole_mcpio_ubicacion')} AS k
  FROM exam_orders
  WHERE cole_mcpio_ubicacion IS NOT NULL AND cole_area_ubicacion IS NOT NULL AND punt_global IS NOT NULL),
names AS (SELECT k, m, count(*) AS c FROM base GROUP BY k, m),
disp AS (SELECT k, first(m ORDER BY c DESC, m) AS municipio_display FROM names GROUP BY k),
st AS (SELECT k, avg(CASE WHEN zona = 'URBANO' THEN s END) AS URBANO, avg(CASE WHEN zona = 'RURAL' THEN s END) AS RURAL
       FROM base GROUP BY k),
gdp AS (SELECT {S.norm_key('municipio')} AS k, max(pib_miles_millones) AS pib_miles_millones FROM region_gdp GROUP BY 1),
gap AS (SELECT st.k AS MUNICIPIO_NORM, d.municipio_display, URBANO, RURAL, abs(URBANO - RURAL) AS brecha_rural_urbana,
               g.pib_miles_millones
        FROM st JOIN disp d ON st.k = d.k LEFT JOIN gdp g ON st.k = g.k
        WHERE abs(URBANO - RURAL) IS NOT NULL),
cuts AS (SELECT quantile_cont(brecha_rural_urbana, 0.75) AS gap_cut, quantile_cont(pib_miles_millones, 0.25) AS pib_cut
         FROM gap)
SELECT MUNICIPIO_NORM, municipio_display, round(URBANO, 6) AS URBANO, round(RURAL, 6) AS RURAL,
       round(brecha_rural_urbana, 6) AS brecha_rural_urbana, pib_miles_millones, round(gap_cut, 6) AS gap_cut,
       round(pib_cut, 6) AS pib_cut,
       CASE WHEN pib_cut IS NULL THEN brecha_rural_urbana >= gap_cut
            ELSE brecha_rural_urbana >= gap_cut AND coalesce(pib_miles_millones <= pib_cut, false) END AS prioridad_alta
FROM gap, cuts
"""

register("A18_region_priority", Q1_SQL)(q1_priority_table)


# ------------------------------------------------------ plain aggregates --

SUBJECTS = {"Matematicas": "punt_matematicas", "Lectura Critica": "punt_lectura_critica",
            "Ciencias Naturales": "punt_c_naturales", "Sociales y Ciudadanas": "punt_sociales_ciudadanas",
            "Ingles": "punt_ingles", "Puntaje Global": "punt_global"}
METRICS = list(SUBJECTS.values())


def _p2_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Line grain with the P2 school relabel (Público / Privado)."""
    df = exam_lines(spark, sf)
    return df.withColumn("naturaleza", L.relabel("cole_naturaleza", L.SCHOOL_RELABEL))


_P2_SQL = (", p2 AS (SELECT *, CASE cole_naturaleza WHEN 'OFICIAL' THEN 'Público' WHEN 'NO OFICIAL' THEN 'Privado' "
           "ELSE cole_naturaleza END AS naturaleza FROM exam_lines)\n")


@register("A01_mean_by", """SELECT fami_estratovivienda, cole_naturaleza, round(avg(punt_global), 6) AS mean
FROM exam_orders WHERE fami_estratovivienda IS NOT NULL AND cole_naturaleza IS NOT NULL GROUP BY 1, 2""")
def a01(spark, sf):
    return r6(G.mean_by(exam_orders(spark, sf), "punt_global", ["fami_estratovivienda", "cole_naturaleza"]), "mean")


_AREA_SQL = (", p1 AS (SELECT *, " + S.zone_residence("cole_area_ubicacion") + " AS Area FROM exam_orders "
             "WHERE cole_area_ubicacion IS NOT NULL AND upper(cole_area_ubicacion) NOT IN "
             "('SIN INFORMACIÓN', 'SIN INFORMACION', 'NAN'))\n")


def _p1_frame(spark, sf):
    df = exam_orders(spark, sf)
    return df.where(L.zone_residence_keep("cole_area_ubicacion")).withColumn("Area", L.zone_residence("cole_area_ubicacion"))


@register("A02_mean_std_by", _AREA_SQL + """SELECT cole_mcpio_ubicacion, Area, round(avg(punt_global), 6) AS mean,
round(stddev_samp(punt_global), 6) AS std FROM p1 GROUP BY 1, 2""")
def a02(spark, sf):
    return r6(G.mean_std_by(_p1_frame(spark, sf), "punt_global", ["cole_mcpio_ubicacion", "Area"]), "mean", "std")


_GEO_SQL = (", geo AS (SELECT e.*, c.lat, c.lon, g.pib_miles_millones FROM exam_orders e "
            "LEFT JOIN (SELECT upper(trim(cole_mcpio_ubicacion)) AS k, max(lat) AS lat, max(lon) AS lon FROM coords GROUP BY 1) c "
            "ON upper(trim(e.cole_mcpio_ubicacion)) = c.k "
            "LEFT JOIN (SELECT upper(trim(municipio)) AS k, max(pib_miles_millones) AS pib_miles_millones FROM region_gdp GROUP BY 1) g "
            "ON upper(trim(e.cole_mcpio_ubicacion)) = g.k)\n")


def _geo_frame(spark, sf):
    df = exam_orders(spark, sf)
    df = J.with_coords(df, region_coords(spark, sf), "cole_mcpio_ubicacion")
    return J.with_gdp(df, region_gdp(spark, sf), "cole_mcpio_ubicacion", "municipio", ["pib_miles_millones"])


@register("A03_region_map", _GEO_SQL + """, per AS (SELECT cole_mcpio_ubicacion, lat, lon, avg(punt_global) AS punt_global,
  max(pib_miles_millones) AS pib FROM geo WHERE cole_mcpio_ubicacion IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL
  GROUP BY 1, 2, 3)
SELECT cole_mcpio_ubicacion, lat, lon, round(punt_global, 6) AS punt_global, pib,
  round(min(punt_global) OVER (), 6) AS min_value, round(max(punt_global) OVER (), 6) AS max_value FROM per""")
def a03(spark, sf):
    return r6(G.region_map(_geo_frame(spark, sf), "punt_global", "cole_mcpio_ubicacion", gdp="pib_miles_millones"),
              "punt_global", "min_value", "max_value")


@register("A05_region_gap", _AREA_SQL + """SELECT cole_mcpio_ubicacion, round(avg(CASE WHEN Area = 'Urbano' THEN punt_global END), 6) AS Urbano,
round(avg(CASE WHEN Area = 'Rural' THEN punt_global END), 6) AS Rural,
round(avg(CASE WHEN Area = 'Urbano' THEN punt_global END) - avg(CASE WHEN Area = 'Rural' THEN punt_global END), 6) AS Brecha_Puntos
FROM p1 WHERE cole_mcpio_ubicacion IS NOT NULL GROUP BY 1""")
def a05(spark, sf):
    return r6(G.region_gap(_p1_frame(spark, sf), "punt_global", "cole_mcpio_ubicacion", "Area"), "Urbano", "Rural",
              "Brecha_Puntos")


@register("A06_region_gap_abs", f"""SELECT cole_mcpio_ubicacion,
round(abs(avg(CASE WHEN z = 'URBANO' THEN punt_global END) - avg(CASE WHEN z = 'RURAL' THEN punt_global END)), 6) AS brecha_rural_urbana
FROM (SELECT *, {S.zone_strict('cole_area_ubicacion')} AS z FROM exam_orders) WHERE cole_mcpio_ubicacion IS NOT NULL
AND z IS NOT NULL AND punt_global IS NOT NULL GROUP BY 1""")
def a06(spark, sf):
    d = exam_orders(spark, sf).withColumn("z", L.zone_strict("cole_area_ubicacion"))
    return r6(G.region_gap_abs(d, "punt_global", "cole_mcpio_ubicacion", "z").select("cole_mcpio_ubicacion",
              "brecha_rural_urbana"), "brecha_rural_urbana")


@register("A07_top_gap_regions", _AREA_SQL + """, d AS (SELECT cole_mcpio_ubicacion, Area, avg(punt_global) AS mean,
  stddev_samp(punt_global) AS std FROM p1 GROUP BY 1, 2),
g AS (SELECT cole_mcpio_ubicacion, avg(CASE WHEN Area = 'Urbano' THEN punt_global END) - avg(CASE WHEN Area = 'Rural' THEN punt_global END) AS dif
  FROM p1 GROUP BY 1),
t AS (SELECT cole_mcpio_ubicacion FROM g WHERE dif IS NOT NULL ORDER BY dif DESC, cole_mcpio_ubicacion LIMIT 10)
SELECT d.cole_mcpio_ubicacion, Area, round(mean, 6) AS mean, round(std, 6) AS std FROM d SEMI JOIN t USING (cole_mcpio_ubicacion)""")
def a07(spark, sf):
    return r6(G.top_gap_regions(_p1_frame(spark, sf), "punt_global", "cole_mcpio_ubicacion", "Area"), "mean", "std")


@register("A08_region_vs_all", _AREA_SQL + """SELECT Area, round(avg(punt_global), 6) AS mean, round(stddev_samp(punt_global), 6) AS std,
'NATION_7' AS cole_mcpio_ubicacion FROM p1 WHERE cole_mcpio_ubicacion = 'NATION_7' GROUP BY Area
UNION ALL SELECT Area, round(avg(punt_global), 6), round(stddev_samp(punt_global), 6), 'PROMEDIO ANTIOQUIA' FROM p1 GROUP BY Area""")
def a08(spark, sf):
    return r6(G.region_vs_all(_p1_frame(spark, sf), "punt_global", "cole_mcpio_ubicacion", "Area", "NATION_7"),
              "mean", "std")


@register("A09_subject_gaps", _P2_SQL + ", u AS (" + " UNION ALL ".join(
    f"SELECT '{k}' AS materia, {v} AS v, naturaleza FROM p2" for k, v in SUBJECTS.items()) + """),
g AS (SELECT materia, avg(CASE WHEN naturaleza = 'Privado' THEN v END) AS a, avg(CASE WHEN naturaleza = 'Público' THEN v END) AS b
      FROM u WHERE v IS NOT NULL AND naturaleza IS NOT NULL GROUP BY materia)
SELECT materia, round_even(a - b, 1) AS brecha, round_even(b, 1) AS media_publico, round_even(a, 1) AS media_privado FROM g""")
def a09(spark, sf):
    return G.subject_gaps(_p2_frame(spark, sf), SUBJECTS, "naturaleza")


@register("A10_region_type_gap", _GEO_SQL + """, b AS (SELECT cole_mcpio_ubicacion, lat, lon, punt_global, naturaleza FROM
  (SELECT *, CASE cole_naturaleza WHEN 'OFICIAL' THEN 'Público' WHEN 'NO OFICIAL' THEN 'Privado' ELSE cole_naturaleza END AS naturaleza FROM geo)
  WHERE cole_mcpio_ubicacion IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND punt_global IS NOT NULL AND naturaleza IS NOT NULL),
p AS (SELECT cole_mcpio_ubicacion, lat, lon, avg(CASE WHEN naturaleza = 'Privado' THEN punt_global END) AS a,
  avg(CASE WHEN naturaleza = 'Público' THEN punt_global END) AS b2, avg(punt_global) AS al FROM b GROUP BY 1, 2, 3),
t AS (SELECT max(CASE WHEN naturaleza = 'Privado' THEN 1 ELSE 0 END) + max(CASE WHEN naturaleza = 'Público' THEN 1 ELSE 0 END) AS n FROM b)
SELECT cole_mcpio_ubicacion, lat, lon, CASE WHEN n = 2 THEN round_even(a - b2, 1) END AS brecha,
  CASE WHEN n = 2 THEN round_even(b2, 1) END AS media_pub, CASE WHEN n = 2 THEN round_even(a, 1) END AS media_priv,
  CASE WHEN n <> 2 THEN round(al, 6) END AS promedio
FROM p, t WHERE n <> 2 OR (a - b2) IS NOT NULL""")
def a10(spark, sf):
    d = _geo_frame(spark, sf).withColumn("naturaleza", L.relabel("cole_naturaleza", L.SCHOOL_RELABEL))
    return r6(G.region_type_gap(d, "punt_global", "cole_mcpio_ubicacion", "naturaleza"), "promedio")


_CUTS_SQL = """, cuts AS (SELECT quantile_cont(punt_global, 0.1) AS q10, quantile_cont(punt_global, 0.25) AS q25,
  quantile_cont(punt_global, 0.5) AS q50, quantile_cont(punt_global, 0.75) AS q75, quantile_cont(punt_global, 0.9) AS q90
  FROM exam_lines)
"""


@register("A11_cut_points", _CUTS_SQL + """SELECT round(q10, 6) AS q10, round(q25, 6) AS q25, round(q50, 6) AS q50,
round(q75, 6) AS q75, round(q90, 6) AS q90, round(coalesce(q25, 250.0), 6) AS umbral_riesgo FROM cuts""")
def a11(spark, sf):
    c = I.cut_points(exam_lines(spark, sf), "punt_global")
    return r6(c, *c.columns)


def _risk_frame(spark, sf):
    df = exam_lines(spark, sf)
    return I.with_risk(df, "punt_global", I.cut_points(df, "punt_global"))


_RISK_SQL = _CUTS_SQL + """, risk AS (SELECT *, CAST(coalesce(punt_global < q25, false) AS INT) AS prioridad_binaria
  FROM exam_lines, cuts)
"""


@register("A12_risk_rate", _RISK_SQL + "SELECT round(avg(prioridad_binaria) * 100, 6) AS tasa_riesgo FROM risk")
def a12(spark, sf):
    return r6(I.risk_rate(_risk_frame(spark, sf)), "tasa_riesgo")


@register("A13_risk_by_segment", _RISK_SQL + f""", seg AS (
  SELECT 'ZONA' AS segmento, {S.zone_strict('cole_area_ubicacion')} AS valor, prioridad_binaria FROM risk
  UNION ALL SELECT 'TIPO_COLEGIO', {S.school_type('cole_naturaleza')}, prioridad_binaria FROM risk
  UNION ALL SELECT 'ACCESO_INTERNET', {S.access2(S.yes_no('fami_tieneinternet'), S.yes_no('fami_tienecomputador'))},
    prioridad_binaria FROM risk)
SELECT segmento, valor, round(avg(prioridad_binaria) * 100, 6) AS tasa_riesgo, CAST(count(*) AS BIGINT) AS n
FROM seg WHERE valor IS NOT NULL GROUP BY 1, 2""")
def a13(spark, sf):
    segs = {"ZONA": L.zone_strict("cole_area_ubicacion"), "TIPO_COLEGIO": L.school_type("cole_naturaleza"),
            "ACCESO_INTERNET": L.access2(L.yes_no_flag("fami_tieneinternet"), L.yes_no_flag("fami_tienecomputador"))}
    return r6(I.risk_by_segment(_risk_frame(spark, sf), segs), "tasa_riesgo")


@register("A14_median_gap", f"""SELECT round(quantile_cont(CASE WHEN z = 'URBANO' THEN punt_global END, 0.5), 6) AS median_a,
round(quantile_cont(CASE WHEN z = 'RURAL' THEN punt_global END, 0.5), 6) AS median_b,
round(quantile_cont(CASE WHEN z = 'URBANO' THEN punt_global END, 0.5) - quantile_cont(CASE WHEN z = 'RURAL' THEN punt_global END, 0.5), 6) AS gap
FROM (SELECT *, {S.zone_strict('cole_area_ubicacion')} AS z FROM exam_orders)""")
def a14(spark, sf):
    d = exam_orders(spark, sf).withColumn("z", L.zone_strict("cole_area_ubicacion"))
    return r6(G.median_gap(d, "punt_global", "z", "URBANO", "RURAL"), "median_a", "median_b", "gap")


_ACC = S.access2(S.yes_no("fami_tieneinternet"), S.yes_no("fami_tienecomputador"))


@register("A15_median_access_gap", f"""SELECT round(quantile_cont(CASE WHEN a = 'CON_ACCESO' THEN punt_ingles END, 0.5), 6) AS median_a,
round(quantile_cont(CASE WHEN a = 'SIN_ACCESO' THEN punt_ingles END, 0.5), 6) AS median_b,
round(quantile_cont(CASE WHEN a = 'CON_ACCESO' THEN punt_ingles END, 0.5) - quantile_cont(CASE WHEN a = 'SIN_ACCESO' THEN punt_ingles END, 0.5), 6) AS gap
FROM (SELECT *, {_ACC} AS a FROM exam_lines)""")
def a15(spark, sf):
    d = exam_lines(spark, sf).withColumn(
        "a", L.access2(L.yes_no_flag("fami_tieneinternet"), L.yes_no_flag("fami_tienecomputador")))
    return r6(G.median_gap(d, "punt_ingles", "a", "CON_ACCESO", "SIN_ACCESO"), "median_a", "median_b", "gap")


@register("A16_standardized_means", f""", b AS (SELECT {S.school_type('cole_naturaleza')} AS g, fami_estratovivienda AS s, punt_global AS v
  FROM exam_orders WHERE punt_global IS NOT NULL AND fami_estratovivienda IS NOT NULL),
b2 AS (SELECT * FROM b WHERE g IS NOT NULL),
c AS (SELECT g, s, count(*) AS n, avg(v) AS m FROM b2 GROUP BY 1, 2),
w AS (SELECT *, sum(n) OVER (PARTITION BY s) AS ns FROM c)
SELECT g AS TIPO_COLEGIO, round(sum(m * ns) / sum(ns), 6) AS ajustado FROM w GROUP BY g""")
def a16(spark, sf):
    d = exam_orders(spark, sf).withColumn("TIPO_COLEGIO", L.school_type("cole_naturaleza"))
    return r6(I.standardized_means(d, "punt_global", "TIPO_COLEGIO", "fami_estratovivienda"), "ajustado")


_ADJ_SQL = ", u AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, {i} AS mo, {S.school_type('cole_naturaleza')} AS g, fami_estratovivienda AS s, {m} AS v FROM exam_lines"
    for i, m in enumerate(METRICS)) + """),
b AS (SELECT * FROM u WHERE v IS NOT NULL AND g IS NOT NULL AND s IS NOT NULL),
c AS (SELECT metric, mo, g, s, count(*) AS n, avg(v) AS m FROM b GROUP BY 1, 2, 3, 4),
w AS (SELECT *, sum(n) OVER (PARTITION BY metric, s) AS ns FROM c),
adj AS (SELECT metric, mo, g, sum(m * ns) / sum(ns) AS a FROM w GROUP BY 1, 2, 3),
gp AS (SELECT metric, mo, max(CASE WHEN g = 'PRIVADO' THEN a END) AS privado_ajustado,
  max(CASE WHEN g = 'PUBLICO' THEN a END) AS publico_ajustado FROM adj GROUP BY 1, 2),
gaps AS (SELECT *, privado_ajustado - publico_ajustado AS gap FROM gp
  WHERE privado_ajustado IS NOT NULL AND publico_ajustado IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (ORDER BY abs(gap) DESC, mo) AS rk FROM gaps)
"""


@register("A17_adjusted_gaps", _ADJ_SQL + """SELECT metric, round(privado_ajustado, 6) AS privado_ajustado,
round(publico_ajustado, 6) AS publico_ajustado, round(gap, 6) AS gap_privado_menos_publico, rk = 1 AS is_max FROM ranked""")
def a17(spark, sf):
    d = exam_lines(spark, sf).withColumn("TIPO_COLEGIO", L.school_type("cole_naturaleza"))
    a = I.adjusted_gaps(d, METRICS, "TIPO_COLEGIO", "fami_estratovivienda")
    return r6(a.select("metric", "privado_ajustado", "publico_ajustado", "gap_privado_menos_publico", "is_max"),
              "privado_ajustado", "publico_ajustado", "gap_privado_menos_publico")


@register("A19_low_gdp_top", Q1_SQL.replace("SELECT MUNICIPIO_NORM, municipio_display, round(URBANO", "SELECT * FROM (SELECT MUNICIPIO_NORM, municipio_display, round(URBANO")
          + ") WHERE pib_cut IS NULL OR pib_miles_millones <= pib_cut ORDER BY brecha_rural_urbana DESC, MUNICIPIO_NORM LIMIT 15")
def a19(spark, sf):
    return I.low_gdp_top(q1_priority_table(spark, sf))


_NAMES_SQL = f""", nm AS (SELECT {S.norm_key('m')} AS k, m FROM (SELECT CASE WHEN order_key % 3 = 0 THEN lower(cole_mcpio_ubicacion)
  ELSE cole_mcpio_ubicacion END AS m FROM exam_orders) WHERE m IS NOT NULL),
cnt AS (SELECT k, m, count(*) AS c FROM nm GROUP BY 1, 2)
"""


@register("A20_display_name", _NAMES_SQL + "SELECT k AS MUNICIPIO_NORM, first(m ORDER BY c DESC, m) AS municipio_display FROM cnt GROUP BY k")
def a20(spark, sf):
    d = exam_orders(spark, sf)
    m = F.when(F.col("order_key") % 3 == 0, F.lower("cole_mcpio_ubicacion")).otherwise(F.col("cole_mcpio_ubicacion"))
    d = d.select(m.alias("m")).where(F.col("m").isNotNull()).withColumn("MUNICIPIO_NORM", normalize_key("m"))
    return I.display_name(d, "MUNICIPIO_NORM", "m")


_POT_SQL = f""", pb AS (SELECT cole_mcpio_ubicacion AS m, {_ACC} AS a, punt_ingles AS e, {S.norm_key('cole_mcpio_ubicacion')} AS k
  FROM exam_lines WHERE cole_mcpio_ubicacion IS NOT NULL AND punt_ingles IS NOT NULL),
pc AS (SELECT k, m, count(*) AS c FROM pb GROUP BY 1, 2),
pd AS (SELECT k, first(m ORDER BY c DESC, m) AS municipio_display FROM pc GROUP BY k),
pot AS (SELECT pb.k AS MUNICIPIO_NORM, avg(CASE WHEN a = 'CON_ACCESO' THEN e END) AS CON_ACCESO,
  avg(CASE WHEN a = 'SIN_ACCESO' THEN e END) AS SIN_ACCESO, avg(CASE WHEN a = 'SIN_ACCESO' THEN 1.0 ELSE 0.0 END) AS share_sin_acceso,
  CAST(count(*) AS BIGINT) AS estudiantes FROM pb GROUP BY pb.k),
pot2 AS (SELECT pot.*, pd.municipio_display, coalesce(CON_ACCESO - SIN_ACCESO, 0.0) AS gap_ingles_digital
  FROM pot JOIN pd ON pot.MUNICIPIO_NORM = pd.k)
"""
_POT_COLS = ["CON_ACCESO", "SIN_ACCESO", "share_sin_acceso", "gap_ingles_digital"]


def _potential(spark, sf):
    d = exam_lines(spark, sf)
    return I.digital_potential(d, "punt_ingles", "cole_mcpio_ubicacion", L.yes_no_flag("fami_tieneinternet"),
                               L.yes_no_flag("fami_tienecomputador"))


@register("A21_digital_potential", _POT_SQL + "SELECT MUNICIPIO_NORM, municipio_display, estudiantes, "
          + ", ".join(f"round({c}, 6) AS {c}" for c in _POT_COLS) + " FROM pot2")
def a21(spark, sf):
    p = _potential(spark, sf)
    return r6(p.select("MUNICIPIO_NORM", "municipio_display", "estudiantes", *_POT_COLS), *_POT_COLS)


_CLS_SQL = _POT_SQL + """, pc2 AS (SELECT quantile_cont(gap_ingles_digital, 0.75) AS gc, quantile_cont(share_sin_acceso, 0.75) AS sc FROM pot2),
cls AS (SELECT pot2.*, CASE WHEN gap_ingles_digital >= gc AND share_sin_acceso >= sc THEN 'ALTO'
  WHEN gap_ingles_digital >= gc * 0.5 AND share_sin_acceso >= sc * 0.5 THEN 'MEDIO' ELSE 'BAJO' END AS potencial_mejora FROM pot2, pc2)
"""


@register("A22_potential_class", _CLS_SQL + "SELECT MUNICIPIO_NORM, potencial_mejora, round(gap_ingles_digital, 6) AS gap_ingles_digital FROM cls")
def a22(spark, sf):
    c = I.potential_class(_potential(spark, sf))
    return r6(c.select("MUNICIPIO_NORM", "potencial_mejora", "gap_ingles_digital"), "gap_ingles_digital")


@register("A23_level_by_access", f"""SELECT desemp_ingles, tic, CAST(count(*) AS BIGINT) AS n,
CASE desemp_ingles WHEN 'A-' THEN 0 WHEN 'A1' THEN 1 WHEN 'A2' THEN 2 WHEN 'B1' THEN 3 WHEN 'B+' THEN 4 END AS level_order
FROM (SELECT desemp_ingles, CASE WHEN fami_tieneinternet IS NOT DISTINCT FROM 'Si' AND fami_tienecomputador IS NOT DISTINCT FROM 'Si'
  THEN 'Internet y Computador' WHEN fami_tieneinternet IS NOT DISTINCT FROM 'Si' THEN 'Solo Internet'
  WHEN fami_tienecomputador IS NOT DISTINCT FROM 'Si' THEN 'Solo Computador' ELSE 'Sin Acceso TIC' END AS tic FROM exam_lines)
WHERE desemp_ingles IS NOT NULL GROUP BY 1, 2""")
def a23(spark, sf):
    d = exam_lines(spark, sf).withColumn("tic", L.access4("fami_tieneinternet", "fami_tienecomputador"))
    return G.level_by_access(d, "desemp_ingles", "tic")


@register("A24_share_by", """SELECT estu_genero, CAST(count(*) AS BIGINT) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM exam_orders WHERE estu_genero IS NOT NULL GROUP BY 1""")
def a24(spark, sf):
    return r6(G.share_by(exam_orders(spark, sf), "estu_genero"), "share")


@register("A25_histogram", """, r AS (SELECT min(punt_global) AS lo, max(punt_global) AS hi FROM exam_orders),
b AS (SELECT CAST(CASE WHEN (hi - lo) / 40 = 0 THEN 0 ELSE least(floor((punt_global - lo) / ((hi - lo) / 40)), 39) END AS INT) AS bin,
  lo, hi FROM exam_orders, r WHERE punt_global IS NOT NULL)
SELECT bin, round(lo + bin * (hi - lo) / 40, 6) AS bin_lo, round(lo + (bin + 1) * (hi - lo) / 40, 6) AS bin_hi,
  CAST(count(*) AS BIGINT) AS n FROM b GROUP BY bin, lo, hi""")
def a25(spark, sf):
    return r6(G.histogram(exam_orders(spark, sf), "punt_global"), "bin_lo", "bin_hi")


_BOX_METRICS = ["punt_global", "punt_ingles", "punt_matematicas"]
_BOX_SQL = ", u AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, cole_naturaleza, {m} AS v FROM exam_lines" for m in _BOX_METRICS) + """),
b AS (SELECT * FROM u WHERE v IS NOT NULL AND cole_naturaleza IS NOT NULL),
q AS (SELECT metric, cole_naturaleza, min(v) AS mn, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med,
  quantile_cont(v, 0.75) AS q3, max(v) AS mx, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY 1, 2),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q),
w AS (SELECT b.metric, b.cole_naturaleza, min(CASE WHEN v >= lf THEN v END) AS wl, max(CASE WHEN v <= uf THEN v END) AS wh,
  CAST(sum(CASE WHEN v < lf OR v > uf THEN 1 ELSE 0 END) AS BIGINT) AS outliers FROM b JOIN f USING (metric, cole_naturaleza) GROUP BY 1, 2)
SELECT f.metric, f.cole_naturaleza, round(mn, 6) AS min, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round(mx, 6) AS max, n, round(lf, 6) AS lower_fence, round(uf, 6) AS upper_fence, round(wl, 6) AS whisker_low,
  round(wh, 6) AS whisker_high, outliers FROM f JOIN w USING (metric, cole_naturaleza)"""


@register("A26_box_summary", _BOX_SQL)
def a26(spark, sf):
    b = G.box_summary(exam_lines(spark, sf), _BOX_METRICS, "cole_naturaleza")
    return r6(b, "min", "q1", "median", "q3", "max", "lower_fence", "upper_fence", "whisker_low", "whisker_high")


@register("A27_yearly_mean", """SELECT CAST(substr(CAST(periodo AS VARCHAR), 1, 4) AS INT) AS anio, round(avg(punt_global), 6) AS punt_global
FROM exam_orders WHERE regexp_full_match(substr(CAST(periodo AS VARCHAR), 1, 4), '[0-9]+') GROUP BY 1""")
def a27(spark, sf):
    return r6(G.yearly_mean(exam_orders(spark, sf), "punt_global", "periodo"), "punt_global")


@register("A28_yearly_mean_by_access", """SELECT CAST(substr(CAST(periodo AS VARCHAR), 1, 4) AS INT) AS anio, cole_mcpio_ubicacion, tic,
round(avg(punt_ingles), 6) AS punt_ingles FROM (SELECT *, CASE WHEN fami_tieneinternet IS NOT DISTINCT FROM 'Si' AND
  fami_tienecomputador IS NOT DISTINCT FROM 'Si' THEN 'Internet y Computador' WHEN fami_tieneinternet IS NOT DISTINCT FROM 'Si'
  THEN 'Solo Internet' WHEN fami_tienecomputador IS NOT DISTINCT FROM 'Si' THEN 'Solo Computador' ELSE 'Sin Acceso TIC' END AS tic
  FROM exam_lines WHERE cole_mcpio_ubicacion IS NOT NULL)
WHERE regexp_full_match(substr(CAST(periodo AS VARCHAR), 1, 4), '[0-9]+') GROUP BY 1, 2, 3""")
def a28(spark, sf):
    d = exam_lines(spark, sf).withColumn("tic", L.access4("fami_tieneinternet", "fami_tienecomputador"))
    return r6(G.yearly_mean(d, "punt_ingles", "periodo", key=["cole_mcpio_ubicacion", "tic"]), "punt_ingles")


@register("A29_region_ranking", """SELECT cole_mcpio_ubicacion, round(punt_ingles, 6) AS punt_ingles,
CAST(row_number() OVER (ORDER BY punt_ingles NULLS LAST, cole_mcpio_ubicacion) AS INT) AS rank FROM
(SELECT cole_mcpio_ubicacion, avg(punt_ingles) AS punt_ingles FROM exam_lines WHERE cole_mcpio_ubicacion IS NOT NULL GROUP BY 1)""")
def a29(spark, sf):
    return r6(G.region_ranking(exam_lines(spark, sf), "punt_ingles", "cole_mcpio_ubicacion"), "punt_ingles")


@register("A30_stratum_type_mean", _P2_SQL + """, s AS (SELECT CASE WHEN trim(fami_estratovivienda) IN ('Estrato 1','Estrato 2',
  'Estrato 3','Estrato 4','Estrato 5','Estrato 6','Sin Estrato') THEN trim(fami_estratovivienda) WHEN trim(fami_estratovivienda)
  IN ('1','2','3','4','5','6') THEN 'Estrato ' || trim(fami_estratovivienda) END AS estrato_clean, naturaleza, punt_matematicas AS v
  FROM p2 WHERE fami_estratovivienda IS NOT NULL AND punt_matematicas IS NOT NULL AND naturaleza IS NOT NULL)
SELECT estrato_clean, naturaleza, round(avg(v), 6) AS punt_matematicas,
  CASE WHEN estrato_clean = 'Sin Estrato' THEN 7 ELSE TRY_CAST(substr(estrato_clean, 9, 1) AS INT) END AS estrato_orden
FROM s WHERE estrato_clean IS NOT NULL GROUP BY 1, 2""")
def a30(spark, sf):
    return r6(G.stratum_type_mean(_p2_frame(spark, sf), "punt_matematicas", "fami_estratovivienda", "naturaleza"),
              "punt_matematicas")


@register("A31_prob_difference", """, p AS (SELECT avg(CASE WHEN fami_tieneinternet = 'Si' THEN CAST(coalesce(desemp_ingles IN ('B1','B+'), false) AS DOUBLE) END) AS py,
  avg(CASE WHEN fami_tieneinternet = 'No' THEN CAST(coalesce(desemp_ingles IN ('B1','B+'), false) AS DOUBLE) END) AS pn FROM exam_lines)
SELECT CASE WHEN py IS NOT NULL AND pn IS NOT NULL THEN round_even(py * 100 - pn * 100, 2) ELSE 0.0 END AS diferencia_z FROM p""")
def a31(spark, sf):
    return G.prob_difference(exam_lines(spark, sf), "fami_tieneinternet", "desemp_ingles")


def _stratum_gap_table(spark, sf):
    """Per (metric, stratum) private - public mean gap, the A32 input."""
    d = _p2_frame(spark, sf)
    from equigap.operators.util import unpivot_metrics

    long = unpivot_metrics(d, ["naturaleza", "fami_estratovivienda"], METRICS, "target", "v")
    return long.where(F.col("v").isNotNull()).groupBy("target", "fami_estratovivienda").agg(
        (F.avg(F.when(F.col("naturaleza") == "Privado", F.col("v")))
         - F.avg(F.when(F.col("naturaleza") == "Público", F.col("v")))).alias("brecha_ajustada"))


@register("A32_mean_adjusted_gap", _P2_SQL + ", u AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS target, fami_estratovivienda, naturaleza, {m} AS v FROM p2" for m in METRICS) + """),
t AS (SELECT target, fami_estratovivienda, avg(CASE WHEN naturaleza = 'Privado' THEN v END) - avg(CASE WHEN naturaleza = 'Público' THEN v END) AS g
  FROM u WHERE v IS NOT NULL GROUP BY 1, 2)
SELECT target, round(avg(g), 6) AS brecha_media FROM t GROUP BY target""")
def a32(spark, sf):
    return r6(G.mean_adjusted_gap(_stratum_gap_table(spark, sf)), "brecha_media")


@register("A34_priority_lists", Q1_SQL.replace("SELECT MUNICIPIO_NORM, municipio_display, round(URBANO", "SELECT * FROM (SELECT MUNICIPIO_NORM, municipio_display, round(URBANO")
          + ") ORDER BY MUNICIPIO_NORM LIMIT 25")
def a34(spark, sf):
    return I.priority_lists(q1_priority_table(spark, sf))


# --------------------------------------------------------------- joins ----

@register("J01_with_gdp", """SELECT e.estu_consecutivo, g.pib_miles_millones FROM exam_orders e LEFT JOIN
(SELECT upper(trim(municipio)) AS k, max(pib_miles_millones) AS pib_miles_millones FROM region_gdp GROUP BY 1) g
ON upper(trim(e.cole_mcpio_ubicacion)) = g.k""")
def j01(spark, sf):
    d = J.with_gdp(exam_orders(spark, sf), region_gdp(spark, sf), "cole_mcpio_ubicacion", "municipio", ["pib_miles_millones"])
    return d.select("estu_consecutivo", "pib_miles_millones")


@register("J02_with_coords", _GEO_SQL + "SELECT estu_consecutivo, lat, lon FROM geo")
def j02(spark, sf):
    d = J.with_coords(exam_orders(spark, sf), region_coords(spark, sf), "cole_mcpio_ubicacion")
    return d.select("estu_consecutivo", "lat", "lon")


@register("J02_with_coords_raw_key", """SELECT e.estu_consecutivo, c.lat, c.lon FROM exam_orders e LEFT JOIN
(SELECT cole_mcpio_ubicacion AS k, max(lat) AS lat, max(lon) AS lon FROM coords GROUP BY 1) c ON lower(e.cole_mcpio_ubicacion) = c.k""")
def j02b(spark, sf):
    d = exam_orders(spark, sf).withColumn("raw", F.lower("cole_mcpio_ubicacion"))
    return J.with_coords(d, region_coords(spark, sf), "raw", raw_key=True).select("estu_consecutivo", "lat", "lon")


@register("J03_region_with_gdp", f"""SELECT a.k AS MUNICIPIO_NORM, round(a.m, 6) AS mean, g.pib_miles_millones FROM
(SELECT {S.norm_key('cole_mcpio_ubicacion')} AS k, avg(punt_global) AS m FROM exam_orders WHERE cole_mcpio_ubicacion IS NOT NULL GROUP BY 1) a
LEFT JOIN (SELECT {S.norm_key('municipio')} AS k, max(pib_miles_millones) AS pib_miles_millones FROM region_gdp GROUP BY 1) g ON a.k = g.k""")
def j03(spark, sf):
    d = exam_orders(spark, sf).withColumn("MUNICIPIO_NORM", normalize_key("cole_mcpio_ubicacion"))
    a = G.mean_by(d, "punt_global", ["MUNICIPIO_NORM"])
    return r6(J.region_with_gdp(a, region_gdp(spark, sf), "MUNICIPIO_NORM", "municipio", ["pib_miles_millones"]), "mean")


@register("J04_gap_with_gdp", _GEO_SQL.replace("FROM exam_orders e", "FROM (SELECT *, " + S.zone_residence("cole_area_ubicacion")
          + " AS Area FROM exam_orders WHERE cole_area_ubicacion IS NOT NULL AND upper(cole_area_ubicacion) NOT IN "
          "('SIN INFORMACIÓN', 'SIN INFORMACION', 'NAN')) e") + """, g AS (SELECT cole_mcpio_ubicacion,
  avg(CASE WHEN Area = 'Urbano' THEN punt_global END) - avg(CASE WHEN Area = 'Rural' THEN punt_global END) AS Brecha_Puntos
  FROM geo WHERE cole_mcpio_ubicacion IS NOT NULL GROUP BY 1)
SELECT g.cole_mcpio_ubicacion, round(Brecha_Puntos, 6) AS Brecha_Puntos, p.pib_miles_millones FROM g
LEFT JOIN (SELECT DISTINCT cole_mcpio_ubicacion, pib_miles_millones FROM geo) p USING (cole_mcpio_ubicacion)""")
def j04(spark, sf):
    d = J.with_gdp(_p1_frame(spark, sf), region_gdp(spark, sf), "cole_mcpio_ubicacion", "municipio", ["pib_miles_millones"])
    gap = G.region_gap(d, "punt_global", "cole_mcpio_ubicacion", "Area").select("cole_mcpio_ubicacion", "Brecha_Puntos")
    return r6(J.gap_with_gdp(gap, d, "cole_mcpio_ubicacion", "pib_miles_millones"), "Brecha_Puntos")


@register("J05_with_display", _NAMES_SQL + f""", disp AS (SELECT k, first(m ORDER BY c DESC, m) AS municipio_display FROM cnt GROUP BY k),
a AS (SELECT {S.norm_key('cole_mcpio_ubicacion')} AS k, avg(punt_global) AS m FROM exam_orders WHERE cole_mcpio_ubicacion IS NOT NULL GROUP BY 1)
SELECT a.k AS MUNICIPIO_NORM, round(a.m, 6) AS mean, disp.municipio_display FROM a LEFT JOIN disp ON a.k = disp.k""")
def j05(spark, sf):
    d = exam_orders(spark, sf)
    m = F.when(F.col("order_key") % 3 == 0, F.lower("cole_mcpio_ubicacion")).otherwise(F.col("cole_mcpio_ubicacion"))
    names = I.display_name(d.select(m.alias("m")).withColumn("MUNICIPIO_NORM", normalize_key("m")), "MUNICIPIO_NORM", "m")
    a = G.mean_by(d.withColumn("MUNICIPIO_NORM", normalize_key("cole_mcpio_ubicacion")), "punt_global", ["MUNICIPIO_NORM"])
    return r6(J.with_display(a, names, "MUNICIPIO_NORM"), "mean")


@register("J06_keep_regions", """, t AS (SELECT cole_mcpio_ubicacion FROM (SELECT cole_mcpio_ubicacion, avg(punt_global) AS m FROM exam_orders
  GROUP BY 1) ORDER BY m DESC, cole_mcpio_ubicacion LIMIT 5)
SELECT estu_consecutivo, cole_mcpio_ubicacion FROM exam_orders SEMI JOIN t USING (cole_mcpio_ubicacion)""")
def j06(spark, sf):
    d = exam_orders(spark, sf)
    top = G.mean_by(d, "punt_global", ["cole_mcpio_ubicacion"]).orderBy(F.desc("mean"), "cole_mcpio_ubicacion").limit(5)
    return J.keep_regions(d, top, "cole_mcpio_ubicacion").select("estu_consecutivo", "cole_mcpio_ubicacion")


@register("J08_gdp_lookup", """, f AS (SELECT e.cole_mcpio_ubicacion, g.pib_miles_millones AS pib, g.pib_miles_millones / 1000 AS pc FROM exam_orders e
  LEFT JOIN region_gdp g ON e.cole_mcpio_ubicacion = g.municipio),
r AS (SELECT n_name AS municipio FROM nation UNION ALL SELECT n_name || '_X' FROM nation WHERE n_nationkey % 2 = 0),
br AS (SELECT cole_mcpio_ubicacion AS municipio, quantile_cont(pib, 0.5) AS g, quantile_cont(pc, 0.5) AS p FROM f GROUP BY 1),
al AS (SELECT quantile_cont(pib, 0.5) AS ga, quantile_cont(pc, 0.5) AS pa FROM f)
SELECT r.municipio, round(CASE WHEN g IS NOT NULL THEN g ELSE coalesce(ga, 0.0) END, 6) AS pib,
  round(CASE WHEN g IS NOT NULL THEN p ELSE pa END, 6) AS pib_per_capita FROM r LEFT JOIN br USING (municipio), al""")
def j08(spark, sf):
    gdp = region_gdp(spark, sf).withColumn("pc", F.col("pib_miles_millones") / 1000)
    f = exam_orders(spark, sf).join(gdp, F.col("cole_mcpio_ubicacion") == F.col("municipio"), "left").select(
        "cole_mcpio_ubicacion", F.col("pib_miles_millones").alias("pib"), "pc")
    nation = spark.read.parquet(f"{sf}/nation.parquet")
    regions = nation.select(F.col("n_name").alias("municipio")).unionByName(
        nation.where(F.col("n_nationkey") % 2 == 0).select(F.concat("n_name", F.lit("_X")).alias("municipio")))
    return r6(J.gdp_lookup(f, regions, "cole_mcpio_ubicacion", "pib", "pc"), "pib", "pib_per_capita")


@register("J09_scenario_grid", """SELECT t.target, s.fami_estratovivienda, n.cole_naturaleza, 'MIXTO' AS cole_genero, 'COMPLETA' AS cole_jornada
FROM (SELECT DISTINCT desemp_ingles AS target FROM exam_orders) t,
(SELECT DISTINCT fami_estratovivienda FROM exam_orders) s, (SELECT DISTINCT cole_naturaleza FROM exam_orders) n""")
def j09(spark, sf):
    d = exam_orders(spark, sf)
    return J.scenario_grid(d.select(F.col("desemp_ingles").alias("target")).distinct(),
                           d.select("fami_estratovivienda").distinct(), d.select("cole_naturaleza").distinct(),
                           {"cole_genero": "MIXTO", "cole_jornada": "COMPLETA"})


def _kpi_sql() -> str:
    risk = _RISK_SQL.replace("cuts", "kcuts")
    q1 = Q1_SQL.replace("FROM exam_orders", "FROM exam_lines")
    q1 = q1[: q1.index("SELECT MUNICIPIO_NORM, municipio_display, round(URBANO")].replace("cuts AS", "qcuts AS")
    adj = _ADJ_SQL
    return (risk + q1 + adj + f""", zz AS (SELECT *, {S.zone_strict('cole_area_ubicacion')} AS z, {_ACC} AS acc FROM exam_lines)
SELECT round((SELECT avg(prioridad_binaria) * 100 FROM risk), 6) AS tasa_riesgo_departamental,
  round((SELECT coalesce(q25, 250.0) FROM kcuts), 6) AS umbral_riesgo,
  round((SELECT quantile_cont(CASE WHEN z = 'URBANO' THEN punt_global END, 0.5) - quantile_cont(CASE WHEN z = 'RURAL' THEN punt_global END, 0.5) FROM zz), 6) AS brecha_rural_urbana_p50,
  round((SELECT gap FROM ranked WHERE rk = 1), 6) AS impacto_estimado_publico_privado_max,
  (SELECT metric FROM ranked WHERE rk = 1) AS impacto_estimado_publico_privado_metric,
  round((SELECT quantile_cont(CASE WHEN acc = 'CON_ACCESO' THEN punt_ingles END, 0.5) - quantile_cont(CASE WHEN acc = 'SIN_ACCESO' THEN punt_ingles END, 0.5) FROM zz), 6) AS impacto_digital_ingles_gap,
  (SELECT CAST(sum(CASE WHEN CASE WHEN pib_cut IS NULL THEN brecha_rural_urbana >= gap_cut ELSE brecha_rural_urbana >= gap_cut
     AND coalesce(pib_miles_millones <= pib_cut, false) END THEN 1 ELSE 0 END) AS BIGINT) FROM gap, qcuts) AS municipios_prioridad_alta""")


@register("A33_kpis", _kpi_sql())
def a33(spark, sf):
    from equigap.roles import Roles

    lines = exam_lines(spark, sf)
    gap = I.region_zone_gap(lines, "punt_global", "cole_mcpio_ubicacion", "cole_area_ubicacion")
    gap = J.region_with_gdp(gap, region_gdp(spark, sf), "MUNICIPIO_NORM", "municipio", ["pib_miles_millones"])
    k = I.kpis(lines, Roles(), region_priority_table=I.region_priority(gap))
    return r6(k, "tasa_riesgo_departamental", "umbral_riesgo", "brecha_rural_urbana_p50",
              "impacto_estimado_publico_privado_max", "impacto_digital_ingles_gap")


@register("J07_local_vs_all", _AREA_SQL + """SELECT Area, round(avg(punt_global), 6) AS mean, round(stddev_samp(punt_global), 6) AS std,
'NATION_11' AS cole_mcpio_ubicacion FROM p1 WHERE cole_mcpio_ubicacion = 'NATION_11' GROUP BY Area
UNION ALL SELECT Area, round(avg(punt_global), 6), round(stddev_samp(punt_global), 6), 'PROMEDIO ANTIOQUIA' FROM p1 GROUP BY Area""")
def j07(spark, sf):
    d = _p1_frame(spark, sf)
    local = G.mean_std_by(d.where(F.col("cole_mcpio_ubicacion") == "NATION_11"), "punt_global", ["Area"]).withColumn(
        "cole_mcpio_ubicacion", F.lit("NATION_11"))
    total = G.mean_std_by(d, "punt_global", ["Area"]).withColumn("cole_mcpio_ubicacion", F.lit("PROMEDIO ANTIOQUIA"))
    return r6(J.local_vs_all(local, total), "mean", "std")


@register("W06_ordered", _P2_SQL + """SELECT estrato_clean, naturaleza, round(avg(v), 6) AS punt_global FROM
(SELECT 'Estrato ' || substr(fami_estratovivienda, 9, 1) AS estrato_clean, naturaleza, punt_global AS v FROM p2)
GROUP BY 1, 2 ORDER BY 1, 2""")
def w06(spark, sf):
    from equigap.operators.runs import ordered

    g = G.stratum_type_mean(_p2_frame(spark, sf), "punt_global", "fami_estratovivienda", "naturaleza")
    return r6(ordered(g, ["estrato_orden", "naturaleza"]).drop("estrato_orden"), "punt_global")
