"""Work that must not grow beyond the rows: inputs read once, no rows dealt by their class."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from equigap.ml.prep import class_weights, fit_prep_stages, level_means, split
from equigap.plans import q_ml


def exam(spark, n=400):
    rng = random.Random(5)
    out = []
    for i in range(n):
        school, stratum = rng.choice(["OFICIAL", "NO OFICIAL"]), rng.choice(["Estrato 1", "Estrato 2", "Estrato 3", None])
        out.append((str(i), 1 + i % 7, rng.choice("FM"), school, stratum, rng.choice(["URBANO", "RURAL"]), rng.choice(["Si", "No"]), rng.choice(["Si", "No", None]),
                    *[rng.gauss(50, 20) + 5 * len(school) + ord((stratum or "9")[-1]) for _ in q_ml._TARGETS]))
    names = ["estu_consecutivo string", "line_number int", "estu_genero string", "cole_naturaleza string", "fami_estratovivienda string", "cole_area_ubicacion string",
             "fami_tieneinternet string", "fami_tienecomputador string", *[f"{t} double" for t in q_ml._TARGETS]]
    return spark.createDataFrame(out, ", ".join(names))


def counted(spark, df):
    """``df`` and a counter of the rows that are computed of it."""
    seen = spark.sparkContext.accumulator(0)

    def through(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(through, df.schema), seen


def test_least_squares_on_level_means_is_that_of_all_rows(spark):
    df, cat = exam(spark).cache(), ["cole_naturaleza", "fami_estratovivienda"]
    means = level_means(df, cat, ["punt_global"]).cache()
    one = Pipeline(stages=[*fit_prep_stages(means, [], cat, rows="rows"), LinearRegression(labelCol="punt_global", weightCol="rows")]).fit(means)
    every = Pipeline(stages=[*fit_prep_stages(df, [], cat), LinearRegression(labelCol="punt_global")]).fit(df)
    assert one.stages[0].getStatement() == every.stages[0].getStatement()
    scored = lambda m: [r.prediction for r in m.transform(means).orderBy(*cat).select("prediction").collect()]
    assert scored(one) == pytest.approx(scored(every), rel=1e-5)
    odd = level_means(df.withColumn("punt_global", F.when(F.col("estu_consecutivo") != "0", F.col("punt_global"))), cat, ["punt_global"])
    assert odd.where("punt_global is null").count() == 1 and odd.agg(F.sum("rows")).first()[0] == 400


@pytest.mark.parametrize("query", ["x06", "x06a"])
def test_adjusted_gaps_read_the_lines_once(spark, monkeypatch, query):
    df, seen = counted(spark, exam(spark))
    monkeypatch.setattr(q_ml, "exam_lines", lambda *_: df)
    assert getattr(q_ml, query)(spark, "").count() == 6 * 4
    assert seen.value == 400


def test_impacts_read_their_rows_once(spark, monkeypatch):
    orders, seen = counted(spark, exam(spark))
    lines, seen_too = counted(spark, exam(spark))
    monkeypatch.setattr(q_ml, "exam_orders", lambda *_: orders)
    monkeypatch.setattr(q_ml, "exam_lines", lambda *_: lines)
    assert q_ml.x04(spark, "").first()["n"] > 200 and q_ml.x05(spark, "").first()["n"] > 200
    assert (seen.value, seen_too.value) == (400, 400)


def test_classes_do_not_deal_rows(spark):
    """Neither the split nor the weights join rows by their class."""
    df = spark.createDataFrame([(k, None if k % 10 == 9 else k % 3) for k in range(1000)], "id int, label int").cache()
    flagged = class_weights(split(df, ["id"], 0.8, 42, strata="label"), "label", of=F.col("is_train"))
    assert "Join" not in flagged._jdf.queryExecution().optimizedPlan().toString()
    found = {r.label: (r.n, r.train, r.weight) for r in flagged.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_train").alias("train"), F.max("weight").alias("weight")).collect()}
    assert all(abs(train - 0.8 * n) <= 1 for n, train, _ in found.values())
    total = sum(train for _, train, _ in found.values())
    assert {k: w for k, (_, _, w) in found.items()} == {None: 1.0} | {k: total / (4 * found[k][1]) for k in range(3)}
