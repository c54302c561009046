"""Cleaning (C02-C08), gaps and insight operators on hand-made frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from equigap.operators import clean as C
from equigap.operators import gaps as G
from equigap.operators import insights as I
from equigap.roles import Roles

SCHEMA = "estu_consecutivo string, punt_global string, punt_ingles string, cole_mcpio_ubicacion string, ord int"


def test_clean_scores_edge_rows(spark):
    rows = [
        ("1", "500", "100", ' "Medellín" ', 1),      # bounds inclusive, quotes + accent folded
        ("2", "abc", "50", "X", 2),                  # text score -> null -> dropped
        ("3", "300", "100.1", "X", 3),               # > 100 -> dropped
        ("4", "300", "-0.1", "X", 4),                # < 0 -> dropped
        ("5", "200", "40", "SIN INFORMACION", 5),    # sentinel -> null text, row kept
        ("5", "250", "41", "Y", 6),                  # duplicate key: first by order wins
        ("6", None, "40", "Y", 7),                   # null score -> dropped
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = C.clean_scores(df, Roles(), subjects_100=["punt_ingles"], global_500=["punt_global"],
                         text_cols=["cole_mcpio_ubicacion"], order=["ord"])
    got = sorted((r.estu_consecutivo, r.punt_global, r.cole_mcpio_ubicacion) for r in out.collect())
    assert got == [("1", 500.0, "Medellin"), ("5", 200.0, None)]
    audit = C.clean_audit(df, Roles(), ["punt_ingles"], ["punt_global"]).first()
    assert tuple(audit) == (7, 3, 2)


def test_dedup_whole_row_and_hot_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert C.dedup(df).count() == 2
    hot = spark.range(0, 3000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("o"))
    first = {r.k: r.o for r in C.dedup(hot, "k", ["o"]).collect()}
    assert first == {1: 0, 0: 1}


def test_region_gap_signs(spark):
    rows = [("A", "Urbano", 10.0), ("A", "Rural", 4.0), ("B", "Urbano", 5.0), (None, "Rural", 1.0)]
    df = spark.createDataFrame(rows, "r string, z string, s double")
    got = {r.r: r.Brecha_Puntos for r in G.region_gap(df, "s", "r", "z").collect()}
    assert got == {"A": 6.0, "B": None}  # null when a side is missing, null region dropped
    absg = {r.r: r.brecha_rural_urbana for r in G.region_gap_abs(
        df.withColumn("z", F.upper("z")).withColumn("z", F.when(F.col("z") == "URBANO", "URBANO").otherwise("RURAL")),
        "s", "r", "z").collect()}
    assert absg["A"] == 6.0


def test_subject_gaps_round_from_unrounded(spark):
    rows = [("Privado", 10.04, 1.0), ("Privado", 10.04, 1.0), ("Público", 9.0, None)]
    df = spark.createDataFrame(rows, "g string, m double, e double")
    got = {r.materia: tuple(r)[1:] for r in G.subject_gaps(df, {"M": "m", "E": "e"}, "g").collect()}
    assert got["M"] == (1.0, 9.0, 10.0)
    assert got["E"] == (None, None, None)  # a side is empty


def test_standardized_one_stratum_is_plain_mean(spark):
    rows = [("PUBLICO", "s1", 1.0), ("PUBLICO", "s1", 3.0), ("PRIVADO", "s1", 10.0)]
    df = spark.createDataFrame(rows, "g string, s string, v double")
    got = {r.g: r.ajustado for r in I.standardized_means(df, "v", "g", "s").collect()}
    assert got == {"PUBLICO": 2.0, "PRIVADO": 10.0}


def test_standardized_weights(spark):
    # strata weights 3/4 and 1/4 from all rows; PRIVADO lacks s2 -> only s1
    rows = [("PUBLICO", "s1", 1.0), ("PUBLICO", "s2", 5.0), ("PRIVADO", "s1", 3.0), ("PRIVADO", "s1", 3.0)]
    df = spark.createDataFrame(rows, "g string, s string, v double")
    got = {r.g: r.ajustado for r in I.standardized_means(df, "v", "g", "s").collect()}
    assert got["PUBLICO"] == pytest.approx(1.0 * 0.75 + 5.0 * 0.25)
    assert got["PRIVADO"] == pytest.approx(3.0)


def test_adjusted_gap_tie_first_metric(spark):
    rows = [("PUBLICO", "s", 1.0, 1.0), ("PRIVADO", "s", 3.0, 3.0)]
    df = spark.createDataFrame(rows, "g string, s string, a double, b double")
    got = {r.metric: r.is_max for r in I.adjusted_gaps(df, ["a", "b"], "g", "s").collect()}
    assert got == {"a": True, "b": False}


def test_region_priority_null_gdp_and_no_cut(spark):
    rows = [("A", 10.0, 1.0), ("B", 1.0, 5.0), ("C", 20.0, None), ("D", 30.0, 0.5)]
    df = spark.createDataFrame(rows, "MUNICIPIO_NORM string, brecha_rural_urbana double, pib_miles_millones double")
    got = {r.MUNICIPIO_NORM: r.prioridad_alta for r in I.region_priority(df).collect()}
    # q75(gap) = 22.5 -> only D reaches it; D's GDP 0.5 <= q25(GDP); C has null GDP -> false
    assert got == {"A": False, "B": False, "C": False, "D": True}
    nogdp = df.withColumn("pib_miles_millones", F.lit(None).cast("double"))
    got2 = {r.MUNICIPIO_NORM: r.prioridad_alta for r in I.region_priority(nogdp).collect()}
    assert got2["D"] is True and got2["C"] is False  # no GDP cut: gap rule only


def test_potential_class(spark):
    rows = [("A", 10.0, 0.9), ("B", 4.0, 0.5), ("C", 0.0, 0.0), ("D", 8.0, 0.8)]
    df = spark.createDataFrame(rows, "MUNICIPIO_NORM string, gap_ingles_digital double, share_sin_acceso double")
    got = {r.MUNICIPIO_NORM: r.potencial_mejora for r in I.potential_class(df).collect()}
    # q75(gap) = 8.5, q75(share) = 0.825 (linear interpolation)
    assert got == {"A": "ALTO", "B": "BAJO", "C": "BAJO", "D": "MEDIO"}


def test_box_and_histogram_vs_numpy(spark):
    rng = np.random.default_rng(1)
    vals = list(map(float, rng.normal(50, 10, 500))) + [150.0]
    df = spark.createDataFrame([(v, "g") for v in vals], "v double, grp string")
    b = G.box_summary(df, ["v"], "grp").first()
    q1, med, q3 = np.percentile(vals, [25, 50, 75])
    assert (b.q1, b.median, b.q3) == pytest.approx((q1, med, q3))
    assert b.outliers == sum(1 for v in vals if v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1))
    h = G.histogram(df, "v", 40).agg(F.sum("n")).first()[0]
    assert h == len(vals)


def test_prob_difference(spark):
    rows = [("Si", "B1"), ("Si", None), ("No", "A1"), ("No", "B+"), (None, "B1")]
    df = spark.createDataFrame(rows, "f string, lvl string")
    assert G.prob_difference(df, "f", "lvl").first()[0] == 0.0  # 50% - 50%
    only_yes = df.where("f = 'Si'")
    assert G.prob_difference(only_yes, "f", "lvl").first()[0] == 0.0  # empty side -> 0.0


def test_median_gap_strategies_agree(spark):
    rng = np.random.default_rng(3)
    rows = [("U" if i % 3 else "R", float(x)) for i, x in enumerate(rng.normal(0, 1, 3000))]
    df = spark.createDataFrame(rows, "g string, s double")
    ex = G.median_gap(df, "s", "g", "U", "R").first()
    au = G.median_gap(df.repartition(7), "s", "g", "U", "R").first()
    assert ex.gap == pytest.approx(au.gap)
    u = [v for g, v in rows if g == "U"]
    assert ex.median_a == pytest.approx(float(np.median(u)))


def test_option_lists_defaults_and_all_value(spark):
    from equigap.operators.filters import option_lists

    df = spark.createDataFrame([(" B ", None), ("A", "nan"), ("SIN INFORMACION", None), ("A", "")],
                               "municipio string, jornada string")
    got = sorted(tuple(r) for r in option_lists(df, ["municipio", "jornada"], region_col="municipio",
                                                  defaults={"jornada": ["COMPLETA", "MANANA"]}).collect())
    assert got == [("jornada", "COMPLETA", 1), ("jornada", "MANANA", 2),
                   ("municipio", "A", 1), ("municipio", "B", 2), ("municipio", "TODOS", 0)]


def test_one_row_helpers_and_grid(spark):
    from equigap.operators.joins import scenario_grid
    from equigap.operators.util import one_row, one_row_frame

    a = spark.createDataFrame([(1.0,)], "x double")
    b = spark.createDataFrame([("s",)], "y string")
    assert one_row(a) == {"x": 1.0}
    assert tuple(one_row_frame(spark, [a, b]).first()) == (1.0, "s")
    with pytest.raises(ValueError):
        one_row(spark.range(2))
    g = scenario_grid(spark.createDataFrame([("g",)], "target string"), spark.range(3).withColumnRenamed("id", "s"),
                      spark.range(2).withColumnRenamed("id", "k"), {"p": "x"})
    assert g.count() == 6 and set(g.columns) == {"target", "s", "k", "p"}


def test_dedup_needs_an_order_and_keeps_null_orders(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (2, None, "c"), (None, 1, "d")], "k int, o int, v string")
    assert sorted(r.v for r in C.dedup(df, "k", ["o"]).collect()) == ["b", "c", "d"]
    with pytest.raises(ValueError):
        C.dedup(df, "k")


def test_audit_without_id_and_with_padded_keys(spark):
    rows = [("1", 10.0, 100.0), ("1", 10.0, 100.0), ("2", 20.0, 200.0), ("3", None, 100.0), (" 4", 30.0, 300.0), ("4", 30.0, 300.0)]
    df = spark.createDataFrame(rows, "estu_consecutivo string, punt_ingles double, punt_global double")
    for frame, roles in ((df, Roles()), (df.drop("estu_consecutivo"), Roles())):
        clean = C.clean_scores(frame, roles, ["punt_ingles"], ["punt_global"])
        audit = C.clean_audit(frame, roles, ["punt_ingles"], ["punt_global"]).first()
        assert tuple(audit) == (6, 5, clean.count())
