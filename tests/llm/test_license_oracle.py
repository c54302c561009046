"""The SQL of the licence query against its code, on lines that name a holder
and lines that only look so."""

import duckdb
from conftest import table

from equigap.llm import license_scan
from equigap.llm.queries import ORACLE, QUERIES

LINES = ["Copyright 2020 X", "copyright: (c) x", "copyright notice and this permission", "COPYRIGHT HOLDERS BE LIABLE", "(c) You must retain", "(c) 2020 Some Body",
         "(c) copyright notice", "© The Y Project", "# Copyright X", "// (C) copyright 1999 a", " * copyrighted by z", "copyright", "(c)", "a copyright 2020", "-- © any", ""]


def test_oracle_follows_the_holder_rule(spark, tmp_path):
    rows = [(i, f"Some text\n{x}\nmore\n{x.upper()}", "a") for i, x in enumerate(LINES)]
    rows += [(100, license_scan.TEXTS["MIT"], "a"), (101, license_scan.TEXTS["ISC"].replace("above copyright notice", "above\ncopyright notice"), "b"), (102, None, None)]
    path = str(tmp_path / "documents.parquet")
    table(spark, rows, path)
    got = [tuple(r) for r in QUERIES["op2_license_digests"](spark, str(tmp_path)).orderBy("doc_id").collect()]
    sql = ORACLE["op2_license_digests"].replace("from documents", f"from '{path}/*.parquet'")
    assert got == duckdb.sql(f"select doc_id, canonical_sha256, license_id, n_license_lines, line_licenses from ({sql}) order by doc_id").fetchall()
    assert [r[2] for r in got[16:18]] == ["MIT", "ISC"] and len({r[1] for r in got}) > 8
