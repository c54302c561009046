"""The pipeline, stage by stage on what the one before kept, against brute
force, on the driver's smallest documents and on awkward rows."""

import os
from collections import Counter

import brute
import duckdb
import pytest

import corpus_pipeline as P
from equigap.llm.queries import MIXING_SQL, QUERIES, WORD_BPE
from equigap.llm.util import documents

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def bag(rows):
    return Counter(tuple(r) for r in rows)


@pytest.fixture(params=["driver", "awkward"])
def start(request, spark, docs):
    if request.param == "driver":
        if not os.path.isdir(SF):
            pytest.skip("driver test data not present")
        return documents(spark, SF)
    return docs.select(*COLUMNS).where("doc_id is null or doc_id != 304")  # brute force compares all lines


def test_stages(spark, start, tmp_path):
    def step(k, docs):
        path = str(tmp_path / str(k))
        P.STAGES[k][1](spark, docs, SF).write.parquet(path)
        return spark.read.parquet(path), path

    rows = [tuple(r) for r in start.select(*COLUMNS).collect()]
    kept, _ = step(0, start)
    verdict = brute.quality([(r[3], r[1]) for r in rows])
    assert kept.columns == COLUMNS and bag(kept.collect()) == bag(r for r, v in zip(rows, verdict) if v[-1])

    rows = [tuple(r) for r in kept.collect()]
    lines, _ = step(1, kept)
    want = [(r[0], text, r[2], r[3], len(text)) for r, (_, _, text) in zip(rows, brute.line_dedup([(r[0], r[1]) for r in rows]))]
    assert lines.columns == COLUMNS and bag(lines.collect()) == bag(want)

    rows = sorted((tuple(r) for r in lines.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    near, path = step(2, lines)
    groups = brute.simhash_groups([r[1] for r in rows])
    assert near.columns == COLUMNS and Counter(r.doc_id for r in near.collect()) == Counter(rows[g][0] for g in set(groups))

    mixed, _ = step(3, near)
    sql = "with " + MIXING_SQL.format(docs=f"'{path}/*.parquet'") + " select doc_id, copies from mixed where copies > 0"
    want = Counter()
    for doc, copies in duckdb.sql(sql).fetchall():
        want[doc] += copies
    assert mixed.columns == COLUMNS and Counter(r.doc_id for r in mixed.collect()) == want

    rows = mixed.collect()
    packed, _ = step(4, mixed)
    want = Counter()
    for r, ids in zip(rows, brute.token_ids([r.text for r in rows], WORD_BPE)):
        ids = [*ids, 0]
        want.update((r.doc_id, a // 2048, a, len(ids[a:a + 2048]), brute.crc(ids[a:a + 2048])) for a in range(0, len(ids), 2048))
    got = packed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert brute.check_packing([(r.sequence_id, r.offset, r.length) for r in got], 2048) >= -(-sum(r.length for r in got) // 2048)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_run(spark):
    assert [k for k, _ in P.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "mix_sources", "best_fit_packing"]
    assert P.run(spark, SF).count() > 0


def test_empty(spark, nothing, tmp_path):
    docs = nothing.select(*COLUMNS)
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    assert docs.count() == 0


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
