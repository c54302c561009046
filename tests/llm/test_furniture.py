"""Lines above the limit leave the texts of kept documents."""

from conftest import table

from equigap.llm import quality


def body(i, n):
    return " ".join("w" + "abcdefghij"[i % 10] * (1 + i // 10) + "y" * k for k in range(n))


def test_furniture_leaves_kept_texts(spark, tmp_path):
    rows = [(i, f"  Home  MENU {i}\n{body(i, 60)}\n\nLast 7 line\nown line {body(i, 2)}\n{body(50 + i, 60)}", "hot") for i in range(30)]
    rows += [(100, f"home menu 5\n{body(40, 60)}", "other"), (101, f"home menu 5\n{body(41, 60)}", None)]
    rows += [(102, f"{body(42, 60)}\nlast 8 LINE", "hot"), (103, f"no furniture {body(43, 60)}", "hot")]
    docs = table(spark, rows, str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in quality.clean(docs).collect()}
    want = {i: f"{body(i, 60)}\n\nown line {body(i, 2)}\n{body(50 + i, 60)}" for i in range(30)}
    want |= {100: rows[30][1], 101: rows[31][1], 102: body(42, 60), 103: rows[33][1]}
    assert {d: r.text for d, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert quality.clean(docs).columns == docs.columns


def test_limit_of_a_large_host_is_bounded(spark):
    """A line on 150 of 16,000 documents, under 1 % of them, and one on 90."""
    from pyspark.sql import functions as F

    line = F.when(F.col("id") < 150, F.lit("home menu\n")).when(F.col("id") < 240, F.lit("some line\n")).otherwise(F.lit(""))
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(F.lit("w"), F.translate(F.md5(F.concat_ws("-", "id", k)), "0123456789", "ghijklmnop"))), " ")
    docs = spark.range(16_000).select(F.col("id").alias("doc_id"), F.concat(line, words).alias("text"), F.lit("hot").alias("source"))
    got = {r.removed_words: r.n for r in quality.judge(docs).groupBy("removed_words").agg(F.count("*").alias("n")).collect()}
    assert got == {2: 150, 0: 15_850}
