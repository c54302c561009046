"""File readers on hand-made files (FIXTURES F-A, F-B, F-C)."""

from equigap.sources import files as FS


def test_region_dim_bom_padded_semicolon(spark, tmp_path):
    p = tmp_path / "pib.csv"
    p.write_text("﻿Municipio ;Participacion %;PIB miles de millones;Poblacion ;PIB per capita;\n"
                 " medellín ;40.34%;77,5;2500000;31000;\n"
                 "Abejorral;0.10%;0.2;19000;10500;\n"
                 "Antioquia;100.00%;192.1;6800000;28000;\n", encoding="utf-8")
    d = FS.read_region_dim(spark, str(p))
    assert "" not in d.columns and "Municipio" in d.columns and "Poblacion" in d.columns
    rows = {r.Municipio: r for r in d.collect()}
    assert set(rows) == {"MEDELLÍN", "ABEJORRAL", "ANTIOQUIA"}
    assert rows["MEDELLÍN"]["PIB miles de millones"] is None  # a decimal comma is no number
    assert rows["ABEJORRAL"]["Participacion %"] == 0.1 and rows["ABEJORRAL"]["PIB miles de millones"] == 0.2


def test_scores_code_column_keeps_leading_zeros(spark, tmp_path):
    p = tmp_path / "scores.csv"
    p.write_text("estu_consecutivo,cole_cod_mcpio_ubicacion,punt_global\nA1,05001,250\nA2,05002,abc\n")
    d = FS.read_scores(spark, str(p))
    assert [r.cole_cod_mcpio_ubicacion for r in d.orderBy("estu_consecutivo").collect()] == ["05001", "05002"]


def test_coords_and_distinct_regions(spark, tmp_path):
    p = tmp_path / "coords.csv"
    p.write_text("cole_mcpio_ubicacion,lat,lon\nBRICEÑO,7.1,-75.5\nDONMATÍAS,6.4,-75.4\n", encoding="utf-8")
    c = FS.read_coords(spark, str(p))
    assert c.count() == 2 and dict(c.dtypes)["lat"] == "double"
    regs = spark.createDataFrame([(" b ",), ("a",), ("B",), (None,)], "m string")
    assert [r.m for r in FS.distinct_regions(regs, "m").collect()] == ["A", "B"]


def test_region_dim_comma_share_and_total_row(spark, tmp_path):
    p = tmp_path / "pib2.csv"
    p.write_text("﻿Municipio ,Peso relativo municipal (%),PIB miles de millones,Poblacion ,PIB per capita,\n"
                 "Ciudad A,40.34%,401502.76,2518480,159422652,\n"
                 "Pueblo B,0.24%,2429.08,21030,115505468,\n", encoding="utf-8")
    d = FS.read_region_dim(spark, str(p))
    r = {x.Municipio: x for x in d.collect()}
    assert r["CIUDAD A"]["Peso relativo municipal (%)"] == 40.34
    assert r["PUEBLO B"]["PIB miles de millones"] == 2429.08 and r["PUEBLO B"]["Poblacion"] == 21030.0


def test_missing_result_is_unavailable_and_other_failures_raise(spark, tmp_path):
    import pytest

    FS.write_result(spark.range(3), str(tmp_path), "there")
    got = FS.read_results(spark, str(tmp_path), ["there", "not_there"])
    assert got["there"].count() == 3 and got["not_there"] is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        FS.read_results(spark, str(tmp_path), ["broken"], fmt="parquet")


def test_first_row_of_the_file_stays(spark, tmp_path):
    """Shuffled keys over several files and many splits, as pandas keeps them."""
    import random

    import pandas as pd

    from equigap.operators import clean as C
    from equigap.roles import Roles
    from equigap.sources.files import RECORD, read_scores

    rng = random.Random(2)
    frames = []
    for name in ("a.csv", "b.csv", "c.csv"):
        ids = [f" K{rng.randrange(400)}" for _ in range(3000)]
        frames.append(pd.DataFrame({"estu_consecutivo": ids, "punt_ingles": [rng.randrange(130) for _ in ids], "punt_global": [rng.randrange(500) for _ in ids],
                                    "cole_mcpio_ubicacion": [f"Medell\u00edn {k}" for k in range(len(ids))]}))
        frames[-1].to_csv(tmp_path / name, index=False)
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "9k")
    try:
        read = read_scores(spark, str(tmp_path), record=True)
        place = [r[0] for r in read.orderBy(RECORD).select("cole_mcpio_ubicacion").collect()]
        got = C.clean_scores(read, Roles(), subjects_100=["punt_ingles"], global_500=["punt_global"])
        got = {tuple(r) for r in got.select("estu_consecutivo", "punt_ingles", "punt_global", "cole_mcpio_ubicacion", RECORD).collect()}
    finally:
        spark.conf.set(size, before)
    whole = pd.concat(frames, ignore_index=True)
    assert place == list(whole["cole_mcpio_ubicacion"])  # ordinals are the places in the files
    whole["record"] = range(len(whole))
    whole["estu_consecutivo"] = whole["estu_consecutivo"].str.strip().str.upper()
    kept = whole[whole["punt_ingles"] <= 100].drop_duplicates("estu_consecutivo", keep="first")
    assert {(r[0], r[1], r[2], r[4]) for r in got} == {(r.estu_consecutivo, float(r.punt_ingles), float(r.punt_global), r.record) for r in kept.itertuples()}
    assert all(r[3].startswith("MEDELLIN ") or r[3].startswith("Medellin ") for r in got)
