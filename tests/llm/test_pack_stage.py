"""The packing stage of the pipeline sends and encodes little text at a time, with the operator's results."""

from conftest import table

import corpus_pipeline
from equigap.llm import packing
from equigap.llm.queries import WORD_BPE, vocabulary

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_small_batches_and_slices(spark, tmp_path, monkeypatch):
    rows = [(i, None if i % 7 == 3 else f"Line {i} of a text, with words. " * (i % 50), "a") for i in range(60)]
    docs = table(spark, rows, str(tmp_path / "documents.parquet"))
    seen, cut, before = [], packing.cut, spark.conf.get(ROWS)

    def watched(*args, **options):
        seen.append((options["slice_bytes"], int(spark.conf.get(ROWS))))
        return cut(*args, **options | {"slice_bytes": 500})

    want = packing.packed_documents(docs, vocabulary(WORD_BPE))
    monkeypatch.setattr(packing, "cut", watched)
    got = corpus_pipeline.pack(spark, docs, "")
    pieces = lambda df: sorted(map(tuple, df.select("doc_id", "piece", "start", "length", "ids_crc32").collect()))
    assert pieces(got) == pieces(want)
    assert got.agg({"sequence_id": "max"}).first() == want.agg({"sequence_id": "max"}).first()
    assert seen == [(1 << 20, 2000)] and spark.conf.get(ROWS) == before
