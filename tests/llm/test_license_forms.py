"""Known texts at several wrap widths and in comments."""

import textwrap

from equigap.llm import license_scan


def found(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.license_id for r in license_scan.matches(frame, license_scan.known_texts(spark)).orderBy("i").collect()]


def wrapped(text, width):
    parts = [" ".join(p.split()) for p in text.split("\n\n")]
    return "\n\n".join(p if p.startswith("Copyright") else textwrap.fill(p, width, break_long_words=False) for p in parts)


def test_known_texts_wrapped_and_in_comments(spark):
    cases = [(k, form(wrapped(t.replace("(c) the copyright holder", holder), width)))
             for k, t in license_scan.TEXTS.items() for width, holder in ((20, "2020 X Inc."), (37, "(c) 1999-2003 Some Body"), (52, "© The Y Project"), (64, "X"), (77, "[2020] Z"))
             for form in (str, lambda x: textwrap.indent(x, "# "), lambda x: textwrap.indent(x, "// "), lambda x: "/*\n" + textwrap.indent(x, " * ") + "\n */")]
    assert found(spark, [t for _, t in cases]) == [k for k, _ in cases]


def test_wrapped_line_that_starts_with_copyright(spark):
    isc = license_scan.TEXTS["ISC"].replace("above copyright notice", "above\ncopyright notice")
    mit = license_scan.TEXTS["MIT"].replace("OR COPYRIGHT\nHOLDERS", "OR\nCOPYRIGHT HOLDERS")
    alone = mit.replace("COPYRIGHT HOLDERS", "COPYRIGHT\nHOLDERS")
    assert found(spark, [isc, mit, alone]) == ["ISC", "MIT", "MIT"]
    forms = ["# Copyright 2020 X", "// (c) X", "* Copyright X", "(C) 2020 X", "-- © 2020 X", "copyright by X"]
    assert found(spark, [license_scan.TEXTS["MIT"].replace("Copyright (c) the copyright holder", f) for f in forms]) == ["MIT"] * len(forms)


def test_items_are_no_holder_lines(spark):
    c = license_scan.canonical
    [r] = spark.createDataFrame([("(c) You must retain\n(b) You must",)], "t string").select(c(license_scan.F.col("t")).alias("c")).collect()
    assert r.c == "c you must retain b you must"


def test_short_licences_headers_and_a_folder(spark, tmp_path):
    bsd = license_scan.TEXTS["BSD-3-Clause"].replace("the copyright holder\n", "2015, Somebody\n", 1)
    header = "# Copyright 2020 X\n" + "\n".join("# " + x for x in license_scan.TEXTS["Apache-2.0"].split("\n"))
    gpl = license_scan.TEXTS["GPL-3.0"].replace("https://", "http://")
    assert found(spark, [bsd, license_scan.TEXTS["Unlicense"].upper(), license_scan.TEXTS["BSL-1.0"], header, gpl]) == [
        "BSD-3-Clause", "Unlicense", "BSL-1.0", "Apache-2.0", "GPL-3.0"]
    (tmp_path / "Long-1.0.txt").write_text("Long License\n\nTerms and conditions\n" * 50)
    docs = spark.createDataFrame([(1, "LONG licence - terms and conditions. " * 50), (2, bsd)], "doc_id long, text string")
    got = {r.doc_id: r.license_id for r in license_scan.scan(docs, license_scan.known_folder(spark, str(tmp_path))).collect()}
    assert got == {1: "Long-1.0", 2: "BSD-3-Clause"}
