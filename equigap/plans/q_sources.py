"""Source / sink round trips (S01-S03, S06, S08-S10): tables derived from
the bound data are written to the shared scratch folder in the reference's
file layouts (CSV with a text code column, a BOM / padded / ';' GDP file, a
history CSV per run) and read back with the readers."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from equigap.plans.catalog import register
from equigap.plans.q_aggregates import SUBJECTS, r6
from equigap.plans.tpch import exam_lines, exam_orders, load, region_coords, region_gdp
from equigap.session import scratch_path
from equigap.sources import files as FS
from equigap.sources.runs import read_history
from equigap.stats import hypothesis as H


def _tmp(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


@register("S01_S08_scores_csv", """SELECT cole_cod_mcpio_ubicacion, CAST(count(*) AS BIGINT) AS n, round(avg(punt_global), 6) AS mean
FROM exam_orders GROUP BY 1""")
def s01(spark, sf):
    path = _tmp(spark, "scores_csv")
    cols = ["estu_consecutivo", "cole_cod_mcpio_ubicacion", "cole_mcpio_ubicacion", "punt_global"]
    FS.write_clean(exam_orders(spark, sf).select(*cols), path, fmt="csv")
    schema = StructType([StructField("estu_consecutivo", StringType()), StructField("cole_cod_mcpio_ubicacion", DoubleType()),
                         StructField("cole_mcpio_ubicacion", StringType()), StructField("punt_global", DoubleType())])
    back = FS.read_scores(spark, path, schema)  # the code column is forced back to text: leading zeros survive
    return r6(back.groupBy("cole_cod_mcpio_ubicacion").agg(F.count("*").alias("n"), F.avg("punt_global").alias("mean")), "mean")


@register("S02_region_dim", """SELECT upper(trim(municipio)) AS Municipio, pib_miles_millones AS pib,
  round(100 * pib_miles_millones / sum(pib_miles_millones) OVER (), 2) AS share FROM region_gdp""")
def s02(spark, sf):
    path = _tmp(spark, "pib_csv")
    g = region_gdp(spark, sf)
    share = F.format_string("%.2f%%", F.round(100 * F.col("pib_miles_millones") / F.sum("pib_miles_millones").over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy()), 2))
    messy = g.select(F.concat(F.lit(" "), F.lower("municipio"), F.lit(" ")).alias("﻿Municipio "),
                     share.alias("Participacion %"), F.col("pib_miles_millones").alias("PIB miles de millones"),
                     F.lit("").alias(" "))
    messy.coalesce(1).write.mode("overwrite").option("header", True).option("sep", ";").csv(path)
    d = FS.read_region_dim(spark, path)
    return d.select("Municipio", F.col("PIB miles de millones").alias("pib"), F.col("Participacion %").alias("share"))


@register("S03_read_coords", "SELECT cole_mcpio_ubicacion, lat, lon FROM coords")
def s03(spark, sf):
    path = _tmp(spark, "coords_csv")
    region_coords(spark, sf).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return FS.read_coords(spark, path)


_HIST_SQL = """, d AS (SELECT user_id, CAST(ts AS DATE) AS day, avg(value) AS loss FROM events GROUP BY 1, 2),
h AS (SELECT CAST(user_id AS VARCHAR) AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY day) AS epoch, round(loss, 6) AS loss FROM d)
SELECT run_id, CAST(epoch AS INT) AS epoch, loss, round(loss + 0.5, 6) AS val_loss FROM h"""


@register("S06_read_history", _HIST_SQL)
def s06(spark, sf):
    """Each run's curve is its mean value per day, so a run's file has a line
    per day however many events it has."""
    path = _tmp(spark, "runs")
    day = load(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("run_id"), F.to_date("ts").alias("day")).agg(F.avg("value").alias("loss"))
    h = r6(day, "loss").withColumn("val_loss", F.round(F.col("loss") + 0.5, 6)).withColumn("exp", F.lit("derived"))
    (h.repartition("run_id").sortWithinPartitions("run_id", "day").select("exp", "run_id", "loss", "val_loss")
     .write.mode("overwrite").partitionBy("exp", "run_id").option("header", True).csv(path))
    return read_history(spark, path, pattern="*/*/*.csv", run_regex=r"/run_id=([^/]+)/[^/]+$")


@register("S09_S10_results_roundtrip", """
SELECT tabla, disponible, filas FROM (VALUES ('brecha_por_materia', true), ('anova_estratos', true), ('brecha_por_estrato', true),
  ('tendencia_tic', true), ('no_escrita', false)) t(tabla, disponible),
  LATERAL (SELECT CASE tabla WHEN 'brecha_por_materia' THEN SUBJECT_COUNT WHEN 'anova_estratos' THEN 1
    WHEN 'brecha_por_estrato' THEN (SELECT count(*) FROM (SELECT fami_estratovivienda FROM exam_orders WHERE punt_global IS NOT NULL
      AND fami_estratovivienda IN ('Estrato 1','Estrato 2','Estrato 3','Estrato 4','Estrato 5','Estrato 6') GROUP BY 1
      HAVING count(punt_global) FILTER (cole_naturaleza = 'OFICIAL') >= 30 AND count(punt_global) FILTER (cole_naturaleza = 'NO OFICIAL') >= 30))
    WHEN 'tendencia_tic' THEN (SELECT count(DISTINCT fami_tieneinternet) FROM exam_lines WHERE fami_tieneinternet IS NOT NULL) ELSE 0 END::BIGINT AS filas)"""
          .replace("SUBJECT_COUNT", str(len(SUBJECTS))))
def s09(spark, sf):
    """The four statistics tables written and read back, with the rows of
    each; one that was not written is not available."""
    base, lines, orders = _tmp(spark, "results"), exam_lines(spark, sf), exam_orders(spark, sf)
    FS.write_result(H.subject_tests(lines, SUBJECTS, "cole_naturaleza"), base, "brecha_por_materia")
    FS.write_result(H.anova(orders, "punt_global", "fami_estratovivienda"), base, "anova_estratos")
    FS.write_result(H.stratified_tests(orders, "punt_global", "cole_naturaleza", "fami_estratovivienda"), base, "brecha_por_estrato")
    FS.write_result(H.trend(lines, "punt_ingles", "punt_global", by="fami_tieneinternet"), base, "tendencia_tic")
    got = FS.read_results(spark, base, ["brecha_por_materia", "anova_estratos", "brecha_por_estrato", "tendencia_tic", "no_escrita"])
    rows = [(k, v is not None, v.count() if v is not None else 0) for k, v in got.items()]
    return spark.createDataFrame(rows, "tabla string, disponible boolean, filas long")
