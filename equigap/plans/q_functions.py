"""Registered projection / cleaning / filter queries (C*, F*, S11).

Edge cases (text scores, sentinels, bare strata, junk periods) are derived
inside the query from the bound tables, identically in both engines, so the
rules are exercised on every row of the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equigap.functions import labels as L
from equigap.functions.text import fold_text, normalize_key, upper_key
from equigap.operators import clean as C
from equigap.operators import filters as FL
from equigap.operators.util import one_row
from equigap.plans import sqlbits as S
from equigap.plans.catalog import register
from equigap.plans.tpch import exam_lines, exam_orders, load
from equigap.roles import Roles

OID = "estu_consecutivo"
LID = ["estu_consecutivo", "line_number"]


def _proj(name: str, grain: str, cols, sql_cols: dict[str, str],
          where=None, sql_where: str | None = None, pre=None,
          sql_pre: dict[str, str] | None = None, apply=None):
    """Register a row-wise projection over a bound grain: Spark selects the
    id columns plus ``cols``; DuckDB does the same with ``sql_cols``.
    ``pre`` adds derived input columns first (the edge-case generators), which
    ``apply``, an operator on frames, then works on."""
    ids = [OID] if grain == "exam_orders" else LID

    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = exam_orders(spark, sf) if grain == "exam_orders" else exam_lines(spark, sf)
        # Column specs are built lazily: no SparkContext is needed to list queries
        if pre:
            df = df.select("*", *[c.alias(k) for k, c in pre().items()])
        if apply is not None:
            df = apply(df)
        if where is not None:
            df = df.where(where())
        return df.select(*ids, *[c.alias(k) for k, c in cols().items()])

    src = grain
    if sql_pre:
        src = f"(SELECT *, {', '.join(f'{v} AS {k}' for k, v in sql_pre.items())} FROM {grain})"
    sel = ", ".join(ids + [f"{v} AS {k}" for k, v in sql_cols.items()])
    sql = f"SELECT {sel} FROM {src} t" + (f" WHERE {sql_where}" if sql_where else "")
    register(name, sql)(run)


# --------------------------------------------------------------- text ----

def _docs_raw(df: DataFrame) -> Column:
    # every fifth document wrapped in spaces and double quotes
    return F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit('  "'), F.col("text"), F.lit('"  '))).otherwise(F.col("text"))


@register("C01_fold_text", """
SELECT doc_id, {fold} AS text_folded
FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '  "' || text || '"  ' ELSE text END AS raw FROM documents)
""".replace("{fold}", S.fold("raw")))
def c01(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents")
    return d.select("doc_id", fold_text(_docs_raw(d)).alias("text_folded"))


@register("C10_normalize_key", f"SELECT conv_id, turn, {S.norm_key('text')} AS key FROM conversations")
def c10(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "conversations")
    return d.select("conv_id", "turn", normalize_key("text").alias("key"))


@register("C07_dedup_documents", """
SELECT doc_id, lang, n_chars FROM (
  SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1
""")
def c07(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents")
    return C.dedup(d, "text", ["doc_id"]).select("doc_id", "lang", "n_chars")


@register("C07_dedup_whole_row", "SELECT DISTINCT lang, source FROM documents")
def c07b(spark: SparkSession, sf: str) -> DataFrame:
    return C.dedup(load(spark, sf, "documents").select("lang", "source"))


# ---------------------------------------------------------- cleaning ----

_area_raw = lambda: F.when(F.col("order_key") % 4 == 0, F.lit("")).when(F.col("order_key") % 4 == 1, F.lit("nan")).otherwise(
    F.col("cole_area_ubicacion"))
_area_raw_sql = "CASE order_key % 4 WHEN 0 THEN '' WHEN 1 THEN 'nan' ELSE cole_area_ubicacion END"

_proj("C02_null_sentinels", "exam_orders",
      lambda: {"area": F.col("raw")},
      {"area": "CASE WHEN raw IN ('', 'nan', 'None', 'SIN INFORMACION') THEN NULL ELSE raw END"},
      pre=lambda: {"raw": _area_raw()}, sql_pre={"raw": _area_raw_sql}, apply=lambda df: C.null_sentinels(df, ["raw"]))

_bil_raw = lambda: F.when(F.col("order_key") % 3 == 0, F.lit(None).cast("string")).otherwise(
    F.when(F.col("order_key") % 3 == 1, F.lit("S")).otherwise(F.lit("N")))
_bil_sql = "CASE order_key % 3 WHEN 0 THEN NULL WHEN 1 THEN 'S' ELSE 'N' END"
_proj("C03_fill_default", "exam_orders", lambda: {"cole_bilingue": F.col("raw")},
      {"cole_bilingue": "coalesce(raw, 'N')"}, pre=lambda: {"raw": _bil_raw()}, sql_pre={"raw": _bil_sql}, apply=lambda df: C.fill_default(df, "raw"))

# text score: every 11th row 'abc', every 13th padded, else integer text
_txt = lambda: (F.when(F.col("order_key") % 11 == 0, F.lit("abc"))
        .when(F.col("order_key") % 13 == 0, F.lit(" 42 "))
        .otherwise(F.floor(F.col("punt_global") * 10).cast("string")))
_txt_sql = ("CASE WHEN order_key % 11 = 0 THEN 'abc' WHEN order_key % 13 = 0 THEN ' 42 ' "
            "ELSE CAST(CAST(floor(punt_global * 10) AS BIGINT) AS VARCHAR) END")
_proj("C04_to_number", "exam_orders", lambda: {"score": C.to_number("raw")}, {"score": "TRY_CAST(trim(raw) AS DOUBLE)"},
      pre=lambda: {"raw": _txt()}, sql_pre={"raw": _txt_sql})

_proj("C05_guard_range", "exam_lines",
      lambda: {"punt_ingles": C.guard_range("punt_ingles", 0, 100),
       "punt_sociales_ciudadanas": C.guard_range("punt_sociales_ciudadanas", 0, 100),
       "punt_global": C.guard_range(F.col("punt_global") + 100, 0, 500)},
      {"punt_ingles": "CASE WHEN punt_ingles BETWEEN 0 AND 100 THEN punt_ingles END",
       "punt_sociales_ciudadanas": "CASE WHEN punt_sociales_ciudadanas BETWEEN 0 AND 100 THEN punt_sociales_ciudadanas END",
       "punt_global": "CASE WHEN punt_global + 100 BETWEEN 0 AND 500 THEN punt_global + 100 END"})

_SUBJ100 = ["punt_ingles", "punt_matematicas", "punt_sociales_ciudadanas", "punt_c_naturales", "punt_lectura_critica"]


@register("C06_drop_incomplete", "SELECT estu_consecutivo, line_number FROM exam_lines WHERE "
          + " AND ".join(f"{c} BETWEEN 0 AND 100" for c in _SUBJ100) + " AND punt_global BETWEEN 0 AND 500")
def c06(spark: SparkSession, sf: str) -> DataFrame:
    df = exam_lines(spark, sf)
    g = df.select(*LID, *[C.guard_range(c, 0, 100).alias(c) for c in _SUBJ100],
                  C.guard_range("punt_global", 0, 500).alias("punt_global"))
    return C.drop_incomplete(g, _SUBJ100 + ["punt_global"]).select(*LID)


@register("C08_clean_audit", """
, v AS (SELECT estu_consecutivo AS k, CASE WHEN """ + " AND ".join(f"{c} BETWEEN 0 AND 100" for c in _SUBJ100)
          + """ AND punt_global BETWEEN 0 AND 500 THEN 1 ELSE 0 END AS ok FROM exam_lines),
pk AS (SELECT k, count(*) AS n, sum(ok) AS n_ok FROM v GROUP BY k)
SELECT CAST(sum(n) AS BIGINT) AS rows_loaded, CAST(sum(n_ok) AS BIGINT) AS rows_complete,
       CAST(sum(CASE WHEN n_ok > 0 THEN 1 ELSE 0 END) AS BIGINT) AS rows_deduplicated FROM pk
""")
def c08(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_audit(exam_lines(spark, sf), Roles(), _SUBJ100, ["punt_global"])


@register("E0_clean_scores", """
, c AS (SELECT estu_consecutivo, line_number, """ + ", ".join(
    f"CASE WHEN {c} BETWEEN 0 AND 100 THEN {c} END AS {c}" for c in _SUBJ100) + """,
  CASE WHEN punt_global BETWEEN 0 AND 500 THEN punt_global END AS punt_global FROM exam_lines),
k AS (SELECT * FROM c WHERE """ + " AND ".join(f"{c} IS NOT NULL" for c in _SUBJ100 + ["punt_global"]) + """),
r AS (SELECT *, row_number() OVER (PARTITION BY estu_consecutivo
  ORDER BY line_number, punt_ingles, punt_matematicas, punt_global) AS rn FROM k)
SELECT estu_consecutivo, line_number, round(punt_ingles + punt_matematicas + punt_global, 6) AS total FROM r WHERE rn = 1
""")
def e0(spark: SparkSession, sf: str) -> DataFrame:
    df = exam_lines(spark, sf).select(*LID, *_SUBJ100, "punt_global", "cole_mcpio_ubicacion")
    # line numbers repeat inside an order in this data: the explicit order
    # carries tie-breakers so "first" is well defined in both engines
    out = C.clean_scores(df, Roles(), text_cols=["cole_mcpio_ubicacion"],
                         order=["line_number", "punt_ingles", "punt_matematicas", "punt_global"])
    from equigap.plans.q_aggregates import r6

    return r6(out.select(*LID, (F.col("punt_ingles") + F.col("punt_matematicas") + F.col("punt_global")).alias("total")),
              "total")


# ------------------------------------------------------------ recodes ----

_proj("C09_upper_key", "exam_orders", lambda: {"key": upper_key(F.lower("cole_mcpio_ubicacion"))},
      {"key": "upper(trim(lower(cole_mcpio_ubicacion)))"})

_proj("C11_zone_residence", "exam_orders", lambda: {"Area": L.zone_residence("cole_area_ubicacion")},
      {"Area": S.zone_residence("cole_area_ubicacion")},
      where=lambda: L.zone_residence_keep("cole_area_ubicacion"),
      sql_where="cole_area_ubicacion IS NOT NULL AND upper(cole_area_ubicacion) NOT IN "
                "('SIN INFORMACIÓN', 'SIN INFORMACION', 'NAN')")

_proj("C12_zone_strict", "exam_orders", lambda: {"ZONA": L.zone_strict("cole_area_ubicacion")},
      {"ZONA": S.zone_strict("cole_area_ubicacion")})

_cab_raw = lambda: F.when(F.col("order_key") % 7 == 0, F.lit("CABECERA MUNICIPAL")).otherwise(F.col("cole_area_ubicacion"))
_cab_sql = "CASE WHEN order_key % 7 = 0 THEN 'CABECERA MUNICIPAL' ELSE cole_area_ubicacion END"
_proj("C13_zone_cabecera", "exam_orders", lambda: {"zona": L.zone_cabecera("raw")}, {"zona": S.zone_cabecera("raw")},
      pre=lambda: {"raw": _cab_raw()}, sql_pre={"raw": _cab_sql})

_proj("C14_school_type", "exam_orders", lambda: {"TIPO_COLEGIO": L.school_type("cole_naturaleza")},
      {"TIPO_COLEGIO": S.school_type("cole_naturaleza")})

_proj("C15_relabel", "exam_orders", lambda: {"naturaleza": L.relabel("cole_naturaleza", L.SCHOOL_RELABEL)},
      {"naturaleza": "CASE cole_naturaleza WHEN 'OFICIAL' THEN 'Público' WHEN 'NO OFICIAL' THEN 'Privado' "
                     "ELSE cole_naturaleza END"})

_proj("C16_yes_no_flag", "exam_lines",
      lambda: {"internet_flag": L.yes_no_flag("fami_tieneinternet"), "computador_flag": L.yes_no_flag("fami_tienecomputador")},
      {"internet_flag": S.yes_no("fami_tieneinternet"), "computador_flag": S.yes_no("fami_tienecomputador")})

_proj("C17_form_flag", "exam_lines", lambda: {"computador": L.form_flag("fami_tienecomputador")},
      {"computador": "CASE WHEN upper(trim(fami_tienecomputador)) = 'SI' THEN 1 ELSE 0 END"})

_i = lambda: L.yes_no_flag("fami_tieneinternet")
_c = lambda: L.yes_no_flag("fami_tienecomputador")
_si, _sc = S.yes_no("fami_tieneinternet"), S.yes_no("fami_tienecomputador")
_proj("C18_access2", "exam_lines", lambda: {"ACCESO_INTERNET": L.access2(_i(), _c())}, {"ACCESO_INTERNET": S.access2(_si, _sc)})

_proj("C19_access4", "exam_lines", lambda: {"Acceso_TIC": L.access4("fami_tieneinternet", "fami_tienecomputador")},
      {"Acceso_TIC": "CASE WHEN fami_tieneinternet IS NOT DISTINCT FROM 'Si' AND fami_tienecomputador IS NOT DISTINCT "
                     "FROM 'Si' THEN 'Internet y Computador' WHEN fami_tieneinternet IS NOT DISTINCT FROM 'Si' THEN "
                     "'Solo Internet' WHEN fami_tienecomputador IS NOT DISTINCT FROM 'Si' THEN 'Solo Computador' "
                     "ELSE 'Sin Acceso TIC' END"})

_proj("C20_internet_label", "exam_lines", lambda: {"Tiene_Internet": L.internet_label("fami_tienecomputador")},
      {"Tiene_Internet": "CASE WHEN fami_tienecomputador IS NOT DISTINCT FROM 'Si' THEN 'Con Internet' "
                         "ELSE 'Sin Internet' END"})

_proj("C21_tic_score", "exam_lines",
      lambda: {"tic_score": L.tic_score(_i(), _c()), "tic_interaccion": L.tic_interaction(_i(), _c())},
      {"tic_score": f"CASE WHEN {_si} IS NULL AND {_sc} IS NULL THEN NULL ELSE coalesce({_si}, 0) + coalesce({_sc}, 0) END",
       "tic_interaccion": f"{_si} * {_sc}"})


@register("C22_modeling_frame", f"""
SELECT estu_consecutivo, line_number, {_si} AS internet_flag, {_sc} AS computador_flag,
  CASE WHEN {_si} IS NULL AND {_sc} IS NULL THEN NULL ELSE coalesce({_si}, 0) + coalesce({_sc}, 0) END AS tic_score,
  {_si} * {_sc} AS tic_interaccion, upper(trim(fami_estratovivienda)) AS estrato_cat,
  {S.zone_cabecera('cole_area_ubicacion')} AS zona, {S.school_type('cole_naturaleza')} AS tipo_colegio,
  upper(trim(estu_genero)) AS genero, CAST(substr(CAST(periodo AS VARCHAR), 1, 4) AS INT) AS periodo_year,
  upper(trim(cole_mcpio_ubicacion)) AS municipio
FROM exam_lines""")
def c22(spark: SparkSession, sf: str) -> DataFrame:
    m = C.modeling_frame(exam_lines(spark, sf), Roles())
    return m.select(*LID, "internet_flag", "computador_flag", "tic_score", "tic_interaccion", "estrato_cat", "zona",
                    "tipo_colegio", "genero", "periodo_year", "municipio")


_per_raw = lambda: F.when(F.col("order_key") % 9 == 0, F.concat(F.lit("x"), F.col("periodo").cast("string"))).when(
    F.col("order_key") % 9 == 1, F.substring(F.col("periodo").cast("string"), 1, 4)).otherwise(F.col("periodo").cast("string"))
_per_sql = ("CASE WHEN order_key % 9 = 0 THEN 'x' || CAST(periodo AS VARCHAR) WHEN order_key % 9 = 1 "
            "THEN substr(CAST(periodo AS VARCHAR), 1, 4) ELSE CAST(periodo AS VARCHAR) END")
_proj("C23_period_year", "exam_orders", lambda: {"anio": L.period_year("raw")},
      {"anio": "CASE WHEN regexp_full_match(substr(raw, 1, 4), '[0-9]+') THEN CAST(substr(raw, 1, 4) AS INT) END"},
      pre=lambda: {"raw": _per_raw()}, sql_pre={"raw": _per_sql})
_proj("C24_period_label", "exam_orders", lambda: {"periodo_label": L.period_label("raw")},
      {"periodo_label": "CASE WHEN length(raw) >= 5 THEN substr(raw, 1, 4) || '-' || substr(raw, 5) ELSE raw END"},
      pre=lambda: {"raw": _per_raw()}, sql_pre={"raw": _per_sql})

_str_raw = lambda: (F.when(F.col("order_key") % 5 == 0, F.substring("fami_estratovivienda", 9, 1))
            .when(F.col("order_key") % 5 == 1, F.lit(" Sin Estrato "))
            .when(F.col("order_key") % 5 == 2, F.lit("9")).otherwise(F.col("fami_estratovivienda")))
_str_sql = ("CASE order_key % 5 WHEN 0 THEN substr(fami_estratovivienda, 9, 1) WHEN 1 THEN ' Sin Estrato ' "
            "WHEN 2 THEN '9' ELSE fami_estratovivienda END")
_lab_sql = ("CASE WHEN trim(raw) IN ('Estrato 1','Estrato 2','Estrato 3','Estrato 4','Estrato 5','Estrato 6','Sin Estrato') "
            "THEN trim(raw) WHEN trim(raw) IN ('1','2','3','4','5','6') THEN 'Estrato ' || trim(raw) END")
_proj("C25_stratum_norm", "exam_orders",
      lambda: {"estrato": L.stratum_label("raw"), "orden": L.stratum_order(L.stratum_label("raw"))},
      {"estrato": _lab_sql,
       "orden": f"CASE WHEN ({_lab_sql}) = 'Sin Estrato' THEN 7 ELSE TRY_CAST(substr({_lab_sql}, 9, 1) AS INT) END"},
      where=lambda: L.stratum_label("raw").isNotNull(), sql_where=f"({_lab_sql}) IS NOT NULL",
      pre=lambda: {"raw": _str_raw()}, sql_pre={"raw": _str_sql})


def _with_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    from equigap.operators.quantiles import quantile_row

    df = exam_orders(spark, sf)
    q = one_row(quantile_row(df, "punt_global", [0.25, 0.75]))  # two scalars
    return df.withColumn("q25", F.lit(q["q25"]).cast("double")).withColumn("q75", F.lit(q["q75"]).cast("double"))


_Q_SQL = ", q AS (SELECT quantile_cont(punt_global, 0.25) AS q25, quantile_cont(punt_global, 0.75) AS q75 FROM exam_orders)\n"


@register("C26_priority_band", _Q_SQL + """SELECT estu_consecutivo, CASE WHEN punt_global IS NULL THEN NULL
  WHEN punt_global <= q25 THEN 'ALTA' WHEN punt_global <= q75 THEN 'MEDIA' ELSE 'BAJA' END AS prioridad FROM exam_orders, q""")
def c26(spark: SparkSession, sf: str) -> DataFrame:
    d = _with_quartiles(spark, sf)
    return d.select(OID, L.priority_band("punt_global", F.col("q25"), F.col("q75")).alias("prioridad"))


@register("C27_at_risk", _Q_SQL + """SELECT estu_consecutivo,
  CAST(coalesce(CASE WHEN order_key % 10 = 0 THEN NULL ELSE punt_global END < q25, false) AS INT) AS riesgo
FROM exam_orders, q""")
def c27(spark: SparkSession, sf: str) -> DataFrame:
    d = _with_quartiles(spark, sf)
    s = F.when(F.col("order_key") % 10 == 0, F.lit(None)).otherwise(F.col("punt_global"))
    return d.select(OID, L.at_risk(s, F.col("q25")).alias("riesgo"))


_proj("C28_low_performance", "exam_orders", lambda: {"bajo": L.low_performance("punt_global")},
      {"bajo": "CAST(punt_global < 250 AS INT)"})


@register("C29_priority_label", _Q_SQL + "SELECT estu_consecutivo, CAST(punt_global < q25 AS INT) AS prioridad FROM exam_orders, q")
def c29(spark: SparkSession, sf: str) -> DataFrame:
    d = _with_quartiles(spark, sf)
    return d.select(OID, L.priority_label("punt_global", F.col("q25")).alias("prioridad"))


_proj("C30_level_targets", "exam_orders", lambda: {"desemp_ingles": F.col("desemp_ingles"), "nivel_b": L.level_binary("desemp_ingles")},
      {"desemp_ingles": "desemp_ingles", "nivel_b": "CAST(desemp_ingles IN ('B1', 'B+') AS INT)"},
      where=lambda: L.level_keep("desemp_ingles"), sql_where="desemp_ingles IN ('A-', 'A1', 'A2', 'B1', 'B+')")

_proj("C31_effect_label", "exam_orders", lambda: {"efecto": L.effect_label((F.col("punt_global") - 250) / 250)},
      {"efecto": S.effect("(punt_global - 250) / 250")})

_proj("C32_p_label", "exam_orders", lambda: {"interpretacion": L.p_label(F.col("punt_global") / 500 - 0.9)},
      {"interpretacion": "CASE WHEN punt_global / 500 - 0.9 < 0.001 THEN 'p<0.001 *** (altamente significativo)' "
                         "WHEN punt_global / 500 - 0.9 < 0.01 THEN 'p<0.01 ** (muy significativo)' "
                         "WHEN punt_global / 500 - 0.9 < 0.05 THEN 'p<0.05 * (significativo)' "
                         "ELSE printf('p=%.4f (no significativo al 5%%)', punt_global / 500 - 0.9) END"})

_proj("C33_scenario_label", "exam_orders", lambda: {"etiqueta": L.scenario_label(F.col("punt_global") / 500)},
      {"etiqueta": "CASE WHEN punt_global / 500 >= 0.5 THEN 'Prioridad ALTA' ELSE 'Prioridad estándar' END"})

_proj("C34_clip_pred", "exam_lines",
      lambda: {"pred_score": L.clip_pred(F.col("punt_global") * 1.2 - 50, 0, 500, 1),
       "pred_subject": L.clip_pred(F.col("punt_ingles") - 3, 0, 500, 1),
       "proba": L.clip_pred(F.col("punt_lectura_critica") / 80 - 0.1, 0, 1, 4)},
      {"pred_score": "round_even(least(greatest(punt_global * 1.2 - 50, 0), 500), 1)",
       "pred_subject": "round_even(least(greatest(punt_ingles - 3, 0), 500), 1)",
       "proba": "round_even(least(greatest(punt_lectura_critica / 80 - 0.1, 0), 1), 4)"})

# Display labels of the English levels (C37 example mapping).
LEVEL_LABELS = {"A-": "Pre A1", "A1": "Principiante", "A2": "Basico", "B1": "Intermedio"}
_proj("C37_label_map", "exam_orders", lambda: {"nivel": L.label_map("desemp_ingles", LEVEL_LABELS)},
      {"nivel": "CASE desemp_ingles " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LEVEL_LABELS.items())
                + " ELSE desemp_ingles END"})


# ------------------------------------------------------------ filters ----

@register("F01_by_region", "SELECT estu_consecutivo FROM exam_orders WHERE cole_mcpio_ubicacion = 'NATION_3'")
def f01(spark: SparkSession, sf: str) -> DataFrame:
    return FL.by_region(exam_orders(spark, sf), "cole_mcpio_ubicacion", "NATION_3").select(OID)


@register("F01_by_region_all", "SELECT estu_consecutivo FROM exam_orders")
def f01b(spark: SparkSession, sf: str) -> DataFrame:
    return FL.by_region(exam_orders(spark, sf), "cole_mcpio_ubicacion", "TODOS").select(OID)


@register("F02_by_period_range", """
, p AS (SELECT periodo, row_number() OVER (ORDER BY periodo) - 1 AS r FROM (SELECT DISTINCT periodo FROM exam_orders)),
b AS (SELECT max(CASE WHEN r = 2 THEN periodo END) AS lo, max(CASE WHEN r = 5 THEN periodo END) AS hi FROM p)
SELECT periodo, CAST(count(*) AS BIGINT) AS n FROM exam_orders, b WHERE periodo BETWEEN lo AND hi GROUP BY periodo""")
def f02(spark: SparkSession, sf: str) -> DataFrame:
    d = FL.by_period_range(exam_orders(spark, sf), "periodo", 2, 5)
    return d.groupBy("periodo").agg(F.count("*").cast("long").alias("n"))


_f03_raw = lambda: F.when(F.col("order_key") % 6 == 0, F.lit("SIN INFORMACION")).when(
    F.col("order_key") % 6 == 1, F.lit(None).cast("string")).otherwise(F.col("fami_estratovivienda"))
_f03_sql = "CASE order_key % 6 WHEN 0 THEN 'SIN INFORMACION' WHEN 1 THEN NULL ELSE fami_estratovivienda END"


@register("F03_known_stratum", f"""SELECT estu_consecutivo, raw AS estrato FROM (SELECT *, {_f03_sql} AS raw FROM exam_orders)
WHERE raw IS NOT NULL AND upper(raw) NOT IN ('SIN INFORMACION', 'SIN INFORMACIÓN')""")
def f03(spark: SparkSession, sf: str) -> DataFrame:
    d = exam_orders(spark, sf).withColumn("raw", _f03_raw())
    return FL.known_stratum(d, "raw").select(OID, F.col("raw").alias("estrato"))


_OPT_COLS = ["cole_mcpio_ubicacion", "cole_naturaleza", "fami_estratovivienda", "cole_area_ubicacion", "desemp_ingles"]


@register("F04_option_lists", """
, u AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM exam_orders" for c in _OPT_COLS) + """),
v AS (SELECT DISTINCT col, trim(value) AS value FROM u
      WHERE value IS NOT NULL AND upper(trim(value)) NOT IN ('NAN', 'SIN INFORMACION', ''))
SELECT col AS "column", value, CAST(row_number() OVER (PARTITION BY col ORDER BY value) AS INT) AS pos FROM v
UNION ALL SELECT 'cole_mcpio_ubicacion', 'TODOS', 0""")
def f04(spark: SparkSession, sf: str) -> DataFrame:
    return FL.option_lists(exam_orders(spark, sf), _OPT_COLS, region_col="cole_mcpio_ubicacion")


@register("F05_min_group", """
, c AS (SELECT cole_mcpio_ubicacion, fami_estratovivienda,
          CAST(count(CASE WHEN cole_naturaleza = 'OFICIAL' THEN 1 END) AS BIGINT) AS n_pub,
          CAST(count(CASE WHEN cole_naturaleza = 'NO OFICIAL' THEN 1 END) AS BIGINT) AS n_priv
        FROM exam_orders GROUP BY 1, 2)
SELECT * FROM c WHERE n_pub >= 30 AND n_priv >= 30""")
def f05(spark: SparkSession, sf: str) -> DataFrame:
    c = exam_orders(spark, sf).groupBy("cole_mcpio_ubicacion", "fami_estratovivienda").agg(
        F.count(F.when(F.col("cole_naturaleza") == "OFICIAL", 1)).cast("long").alias("n_pub"),
        F.count(F.when(F.col("cole_naturaleza") == "NO OFICIAL", 1)).cast("long").alias("n_priv"),
    )
    return FL.min_group(c, ["n_pub", "n_priv"], 30)


@register("S11_distinct_regions", "SELECT DISTINCT upper(trim(cole_mcpio_ubicacion)) AS cole_mcpio_ubicacion "
          "FROM exam_orders WHERE cole_mcpio_ubicacion IS NOT NULL")
def s11(spark: SparkSession, sf: str) -> DataFrame:
    from equigap.sources.files import distinct_regions

    return distinct_regions(exam_orders(spark, sf), "cole_mcpio_ubicacion")
