"""The sample of ordinary words depends on the data alone."""

import random
import string

from equigap.llm import secret_scan


def test_sample_does_not_follow_partitions(spark, monkeypatch):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices(string.ascii_lowercase, k=9))
    docs = [(i, " ".join(word() for _ in range(20)) + " secret=" + "".join(rng.choices(string.ascii_letters, k=24))) for i in range(300)]
    models, train = [], secret_scan.train

    def seen(values, words):
        models.append(sorted(r.value for r in words.collect()))
        return train(values, words)

    monkeypatch.setattr(secret_scan, "train", seen)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for parts in (1, 4):
        secret_scan.scan(frame.repartition(parts, "doc_id") if parts > 1 else frame.coalesce(1), sample_docs=60).collect()
    assert models[0] == models[1] and 30 * 20 < len(models[0]) < 100 * 20
