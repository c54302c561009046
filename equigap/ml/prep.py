"""Feature preparation (M01-M06) as Spark ML pipeline stages.

Fitted statistics are computed in one aggregation and frozen into a
``SQLTransformer`` statement, so the whole preprocessing persists inside the
``PipelineModel``:

* numeric: exact median imputation, then standard scaling by the
  *population* std (zero variance left unscaled);
* categorical: most-frequent imputation, then ``StringIndexer`` with
  ``handleInvalid='keep'`` and ``OneHotEncoder(dropLast=True)``, which drops
  exactly the "unknown" slot: unseen categories become all zeros.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equigap.operators.util import one_row


def feature_sets(columns: list[str], catalogue: dict[str, list[str]]) -> dict[str, list[str]]:
    """Every feature set restricted to the columns present."""
    present = set(columns)
    out = {k: [c for c in v if c in present] for k, v in catalogue.items()}
    return {k: v for k, v in out.items() if v}


def harmonise_missing(df: DataFrame, categorical: list[str]) -> DataFrame:
    """Categorical blanks and text nulls become real nulls."""
    return df.select(*[
        F.when(F.trim(F.col(c).cast("string")).isin("", "nan", "None", "NaN"), F.lit(None)).otherwise(
            F.col(c).cast("string")).alias(c) if c in categorical else F.col(c)
        for c in df.columns
    ])


def _q(name: str) -> str:
    return f"`{name}`"


def level_means(df: DataFrame, categorical: list[str], targets: list[str], rows: str = "rows") -> DataFrame:
    """A row per combination of levels: its number of ``rows`` and each target's mean,
    null where a target is null.  Least squares on these, weighed by ``rows``, has the
    solution of least squares on all rows."""
    mean = lambda t: F.when(F.count(t) == F.count("*"), F.avg(t)).alias(t)
    return df.groupBy(*categorical).agg(*[mean(t) for t in targets], F.count("*").cast("double").alias(rows))


def prep_statistics(df: DataFrame, numeric: list[str], categorical: list[str], rows: str | None = None) -> dict:
    """med_, mu_, sd_ (of the median-imputed values) per numeric column
    and mode_ per categorical one.  ``rows``: how many rows a row stands for, in
    a table of ``level_means``, which has no numeric columns."""
    from equigap.operators.quantiles import column_medians

    # exact medians (interpolated, like the reference's imputer), one job
    st = {f"med_{c}": v for c, v in column_medians(df, numeric).items()}
    if categorical:
        # most frequent value, ties to the least: counts first, then one row per column
        times = F.col(rows) if rows else F.lit(1)
        long = df.select(times.alias("__rows"), *[F.col(c).cast("string").alias(c) for c in categorical]).unpivot("__rows", categorical, "name", "value")
        counts = long.where("value is not null").groupBy("name", "value").agg(F.sum("__rows").alias("n"))
        modes = counts.groupBy("name").agg(F.min_by("value", F.struct((-F.col("n")).alias("k"), "value")).alias("mode"))
        st.update({f"mode_{c}": None for c in categorical} | {f"mode_{r['name']}": r["mode"] for r in modes.collect()})
    # mean / std_pop of the imputed numeric values (second small aggregate)
    sel = []
    for c in numeric:
        med = st[f"med_{c}"] if st[f"med_{c}"] is not None else 0.0
        sel.append(F.coalesce(F.col(c).cast("double"), F.lit(float(med))).alias(c))
    mom = df.select(*sel).agg(*[F.avg(c).alias(f"mu_{c}") for c in numeric],
                              *[F.stddev_pop(c).alias(f"sd_{c}") for c in numeric]).first() if numeric else None
    return st | (mom.asDict() if mom else {})


def fit_prep_stages(df: DataFrame, numeric: list[str], categorical: list[str], features_col: str = "features", rows: str | None = None):
    """Fit the preprocessing; returns pipeline stages (fitted stats are
    literals of the SQL stage, indexers are fitted with the model)."""
    st = mom = prep_statistics(df, numeric, categorical, rows)
    exprs = []
    for c in numeric:
        med = float(st[f"med_{c}"]) if st[f"med_{c}"] is not None else 0.0
        mu = float(mom[f"mu_{c}"] or 0.0)
        sd = float(mom[f"sd_{c}"] or 0.0)
        scale = sd if sd > 0 else 1.0
        exprs.append(f"(coalesce(CAST({_q(c)} AS DOUBLE), {med!r}) - {mu!r}) / {scale!r} AS {_q(c + '__num')}")
    for c in categorical:
        mode = st[f"mode_{c}"]
        lit = "NULL" if mode is None else "'" + str(mode).replace("'", "''") + "'"
        exprs.append(f"coalesce(CAST({_q(c)} AS STRING), {lit}) AS {_q(c + '__cat')}")
    stages = [SQLTransformer(statement="SELECT *, " + ", ".join(exprs) + " FROM __THIS__")] if exprs else []
    vec_inputs = [c + "__num" for c in numeric]
    if categorical:
        stages.append(StringIndexer(inputCols=[c + "__cat" for c in categorical],
                                    outputCols=[c + "__idx" for c in categorical], handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=[c + "__idx" for c in categorical],
                                    outputCols=[c + "__ohe" for c in categorical], dropLast=True))
        vec_inputs += [c + "__ohe" for c in categorical]
    stages.append(VectorAssembler(inputCols=vec_inputs, outputCol=features_col, handleInvalid="keep"))
    return stages


def unit_hash(key_cols: list[str], seed: int):
    """Uniform [0, 1) from the first 8 hex digits of the key's md5:
    independent of partitioning, and of the engine."""
    digits = F.substring(F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed)))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 32)


def _by_class(label: str, values: dict) -> Column:
    """The value of the row's class as an expression, so that rows are not dealt by
    their class; null for other classes."""
    out = F.lit(None).cast("double")
    for k, v in values.items():
        out = F.when(F.col(label).eqNullSafe(F.lit(k)), F.lit(float(v))).otherwise(out)
    return out


def split(df: DataFrame, key: list[str], frac: float = 0.8, seed: int = 42, col: str = "is_train", strata: str | None = None) -> DataFrame:
    """Deterministic train / test flag from a hash of the row key,
    identical under any partitioning, without a shuffle.

    With ``strata`` each class is cut at its own threshold: the hash below
    which ``frac`` of its rows lie (exact to one row; from counts per class
    and thousandth of the hash, then from the rows of one thousandth)."""
    u = unit_hash(key, seed)
    if strata is None:
        return df.withColumn(col, u < frac)
    counts = df.groupBy(F.col(strata).alias("__s"), F.floor(u * 1000).alias("__b")).agg(F.count("*").alias("__n"))
    of = Window.partitionBy("__s")
    upto = F.sum("__n").over(of.orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    goal = F.round(F.sum("__n").over(of) * frac)
    edge = counts.select("__s", "__b", (upto - F.col("__n")).alias("__before"), upto.alias("__upto"), goal.alias("__goal"))
    edge = edge.where("__before < __goal and __goal <= __upto").select("__s", "__b", (F.col("__goal") - F.col("__before")).cast("int").alias("__k"))
    near = df.select(F.col(strata).alias("__t"), u.alias("__u")).join(edge, F.expr("__t <=> __s and floor(__u * 1000) = __b"))
    place = F.row_number().over(Window.partitionBy("__s").orderBy("__u"))
    cuts = near.withColumn("__i", place).where("__i <= __k").groupBy("__s").agg(F.max("__u").alias("__cut"))
    cut = _by_class(strata, {r["__s"]: r["__cut"] for r in cuts.collect()})  # a row per class
    return df.withColumn(col, F.coalesce(u <= cut, F.lit(False)))


def validation_flag(df: DataFrame, key: list[str], frac: float = 0.2, seed: int = 7, col: str = "is_val") -> DataFrame:
    """Validation tail inside the training part (second hash, other seed)."""
    return df.withColumn(col, unit_hash(key, seed) < frac)


def class_weights(df: DataFrame, label: str, col: str = "weight", of: Column | None = None) -> DataFrame:
    """Balanced weights n / (k * n_class) from the per-class counts (one row
    per class); counted over the rows where ``of`` (the training rows) holds, by
    default over all.  A class that has none of them weighs 1."""
    counted = df if of is None else df.where(of)
    counts = {r[0]: r[1] for r in counted.groupBy(label).agg(F.count("*")).collect()}
    n, k = sum(counts.values()), len(counts)
    return df.withColumn(col, F.coalesce(_by_class(label, {c: n / (k * nc) for c, nc in counts.items() if c is not None}), F.lit(1.0)))
