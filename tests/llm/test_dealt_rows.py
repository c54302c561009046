"""The same rows whatever way the input was dealt: read from files, or shuffled
with a wide column beside and partitions that adaptive execution joins."""

from collections import Counter

import pytest
from conftest import table
from pyspark.sql import functions as F

from equigap.llm import chunk_dedup, license_scan, line_dedup, mixing, quality, secret_scan, simhash, token_files
from equigap.llm.queries import FLAT_END_ID, WORD_BPE, vocabulary


@pytest.fixture(scope="module")
def shuffled(spark, tmp_path_factory):
    import random

    rng = random.Random(21)
    words = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in ("n", "r", "st", "lm")]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 150))).replace(" b", ".\nB"), f"s{i % 3}") for i in range(300)]
    rows += [(i, rows[i][1] + " password = hunter2hunter2hunter2", "s0") for i in range(0, 100, 7)] + [(None, None, None), (5, rows[5][1], "s1")]
    docs = table(spark, rows, str(tmp_path_factory.mktemp("dealt") / "documents.parquet"))
    return docs, docs.withColumn("wide", F.repeat(F.sha2(F.coalesce("text", F.lit("")), 512), 30)).repartition(40, "doc_id")


RUNS = {
    "op1": lambda d: token_files.document_counts(d, vocabulary(WORD_BPE), FLAT_END_ID).select("doc_id", "n_tokens"),
    "op2": license_scan.scan,
    "op4": quality.judge,
    "op4 clean": lambda d: quality.clean(d).select("doc_id", "text", "source", "n_chars"),
    "op5": lambda d: mixing.mix(d).drop("row"),
    "op5 mixed": lambda d: mixing.mixed(d).select("doc_id", "text", "source"),
    "op6": lambda d: line_dedup.deduped(d, counts=("n", "gone")).select("doc_id", "text", "n", "gone"),
    "op7": lambda d: simhash.linked(d).select("doc_id", "fingerprint", "component_id"),
    "op7 one": lambda d: simhash.one_of_each(d).select("doc_id", "text"),
    "op9": secret_scan.scan,
    "op10": lambda d: chunk_dedup.dedup_exact(d).select("doc_id", "keep_id", "group_size", "text_sha256"),
}


@pytest.mark.parametrize("name", RUNS)
def test_same_rows(spark, shuffled, name):
    plain, dealt = shuffled
    bag = lambda df: Counter(map(tuple, df.collect()))
    want = bag(RUNS[name](plain))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "20k")
    try:
        assert bag(RUNS[name](dealt)) == want
    finally:
        spark.conf.set(size, before)
