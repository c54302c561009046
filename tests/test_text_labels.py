"""C01-C37 scalar rules on hand-made rows (FIXTURES F-G edge cases)."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from equigap.functions import labels as L
from equigap.functions.text import fold_text, normalize_key


def py_fold(s):
    t = unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode().strip()
    import re

    return re.sub(r'^"(.*)"$', r"\1", t)


TEXTS = ["  Medellín ", '"QUOTED"', '  " inner spaces "  ', "ﬁnal ½ straße", "Œuvre ÆON", "niño ", "x\n\"y\"",
         '"a\nb"', "ＦＵＬＬ", "𝐁old", "plain", ""]


def test_fold_matches_python(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = [r[0] for r in df.select(fold_text("t")).collect()]
    assert got == [py_fold(t) for t in TEXTS]


def test_normalize_key_null_and_upper(spark):
    df = spark.createDataFrame([(" Peñol ",), (None,), ("straße",)], "t string")
    got = [r[0] for r in df.select(normalize_key("t")).collect()]
    assert got == ["PENOL", None, "STRASSE"]


def _one(spark, col, rows, schema="v string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_zone_rules(spark):
    rows = [("RURAL",), ("URBANO",), ("Cabecera Municipal",), ("SIN INFORMACION",), (None,)]
    assert _one(spark, L.zone_strict("v"), rows) == ["RURAL", "URBANO", "CABECERA MUNICIPAL", "SIN INFORMACION", None]
    assert _one(spark, L.zone_cabecera("v"), rows) == ["RURAL", "URBANO", "URBANO", "SIN INFORMACION", None]
    assert _one(spark, L.zone_residence("v"), rows[:3]) == ["Rural", "Urbano", "Urbano"]
    assert _one(spark, L.zone_residence_keep("v"), rows) == [True, True, True, False, False]


def test_school_type_order(spark):
    rows = [("NO OFICIAL",), ("OFICIAL",), ("Privado",), ("publico",), ("OTRO",)]
    assert _one(spark, L.school_type("v"), rows) == ["PRIVADO", "PUBLICO", "PRIVADO", "PUBLICO", "OTRO"]


def test_flags_and_access(spark):
    rows = [("Si", "No"), (None, "Si"), (None, None), ("no", "x")]
    df = spark.createDataFrame(rows, "i string, c string")
    i, c = L.yes_no_flag("i"), L.yes_no_flag("c")
    got = df.select(i, c, L.access2(i, c), L.access4("i", "c"), L.tic_score(i, c), L.tic_interaction(i, c),
                    L.form_flag("c")).collect()
    assert [tuple(r) for r in got] == [
        (1, 0, "CON_ACCESO", "Solo Internet", 1, 0, 0),
        (None, 1, "CON_ACCESO", "Solo Computador", 1, None, 1),
        (None, None, "SIN_ACCESO", "Sin Acceso TIC", None, None, 0),  # both null -> SIN_ACCESO
        (0, None, "SIN_ACCESO", "Sin Acceso TIC", 0, None, 0),
    ]


def test_period_rules(spark):
    rows = [("2015",), ("20151",), ("x",), ("201",)]
    assert _one(spark, L.period_year("v"), rows) == [2015, 2015, None, 201]
    assert _one(spark, L.period_label("v"), rows) == ["2015", "2015-1", "x", "201"]


def test_stratum_norm(spark):
    rows = [("1",), ("Estrato 1",), (" Sin Estrato ",), ("9",), (None,)]
    labs = _one(spark, L.stratum_label("v"), rows)
    assert labs == ["Estrato 1", "Estrato 1", "Sin Estrato", None, None]
    assert _one(spark, L.stratum_order(L.stratum_label("v")), rows[:3]) == [1, 1, 7]


def test_band_vs_at_risk_boundary(spark):
    rows = [(213.0,), (100.0,), (300.0,), (500.0,), (None,)]
    assert _one(spark, L.priority_band("v", 213.0, 300.0), rows, "v double") == ["ALTA", "ALTA", "MEDIA", "BAJA", None]
    # equal to q25 is ALTA in the band but not at risk; null score counts as 0
    assert _one(spark, L.at_risk("v", 213.0), rows, "v double") == [0, 1, 0, 0, 0]


def test_effect_and_p_labels(spark):
    d = [(-0.3123,), (0.1,), (0.5,), (0.9,)]
    assert _one(spark, L.effect_label("v"), d, "v double") == ["small", "negligible", "medium", "large"]
    p = [(0.0001,), (0.005,), (0.03,), (0.12345,)]
    got = _one(spark, L.p_label("v"), p, "v double")
    assert got[0].startswith("p<0.001 ***") and got[1].startswith("p<0.01 **") and got[2].startswith("p<0.05 *")
    assert got[3] == "p=0.1235 (no significativo al 5%)" or got[3] == "p=0.1234 (no significativo al 5%)"


def test_clip_and_scenario_label(spark):
    rows = [(-5.0,), (250.04,), (612.0,)]
    assert _one(spark, L.clip_pred("v", 0, 500, 1), rows, "v double") == [0.0, 250.0, 500.0]
    assert _one(spark, L.scenario_label(F.col("v") / 500), rows, "v double") == [
        "Prioridad estándar", "Prioridad ALTA", "Prioridad ALTA"]


@pytest.mark.parametrize("name,arch,task", [
    ("p2_clf_clf_32_16", "32-16", "Clasificación binaria"),
    ("reg_lectura_critica_mlp_128_64_32", "128-64-32", "Regresión"),
    ("other_run", "other-run", ""),
])
def test_run_names(spark, name, arch, task):
    r = spark.createDataFrame([(name,)], "v string").select(L.run_arch("v"), L.run_task("v")).first()
    assert tuple(r) == (arch, task)


def test_run_var_lists(spark):
    df = spark.createDataFrame([("zona, genero",), (None,)], "v string")
    inc, exc = L.run_var_lists("v", ["genero", "zona", "tic_score"])
    assert [tuple(r) for r in df.select(inc, exc).collect()] == [("zona, genero", "tic_score"), ("N/D", "N/D")]
