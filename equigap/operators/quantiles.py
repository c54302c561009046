"""Exact quantiles with linear interpolation (numpy / pandas default), per
cell of any keys, by one algorithm at every size.

Rows are counted per (cell, value), combined map-side, so a value that a
third of all rows share is one row per task.  The counts are range-partitioned
by (cell, value) and written once with their partition; a value's cumulative
count is then a running sum within its partition plus the totals of the
cell's earlier partitions.  A quantile's two ranks fall on the values whose
cumulative counts span them.  No value, cell or rank visits the driver, and
no cell is held by one task.

NaN is null, as in pandas, and nulls are left out; a cell without values has
no row, and over no cell (``keys=[]``) an empty input gives one row of nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equigap.session import materialize


def quantile_name(q: float) -> str:
    return f"q{int(round(q * 100))}"


def ranked_counts(df: DataFrame, keys: list[str], value: Column | str, times: Column | str | None = None,
                  extra: dict[str, Column] | None = None, partitions: int | None = None) -> DataFrame:
    """``keys``, v, n (rows with it), before (rows of the cell below it), total
    (rows of the cell), and sums of ``extra`` per value.  A row stands for ``times`` rows,
    if given."""
    extra = extra or {}
    v = F.col(value) if isinstance(value, str) else value
    times = F.lit(1).cast("long") if times is None else F.col(times) if isinstance(times, str) else times
    counts = df.select(*keys, v.try_cast("double").alias("v"), times.alias("n"), *[c.alias(k) for k, c in extra.items()])
    counts = counts.where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy(*keys, "v").agg(F.sum("n").alias("n"), *[F.sum(k).alias(k) for k in extra])
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = materialize(counts.repartitionByRange(parts, *keys, "v").withColumn("__part", F.spark_partition_id()), "value_counts")
    of_cell = Window.partitionBy(*keys)
    earlier = of_cell.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy(*keys, "__part").agg(F.sum("n").alias("__sum"))
    sums = sums.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__part").alias("__p"),
                       F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__base"), F.sum("__sum").over(of_cell).alias("total"))
    same = F.col("__part") == F.col("__p")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    own = Window.partitionBy("__part", *keys).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("__own", F.coalesce(F.sum("n").over(own), F.lit(0))).join(sums, same)
    return placed.select(*keys, "v", "n", *extra, (F.col("__base") + F.col("__own")).alias("before"), "total")


def quantiles_of(ranked: DataFrame, keys: list[str], qs) -> DataFrame:
    """``keys`` and a column qNN per quantile, of ``ranked_counts``."""
    aggs = []
    for q in qs:
        at = (F.col("total") - 1) * F.lit(float(q))
        low = F.floor(at)
        high = F.least(low + 1, F.col("total") - 1)
        spans = lambda rank: F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("n")), F.col("v")))
        lo, hi = spans(low), spans(high)
        aggs.append((lo + (hi - lo) * F.max(at - low)).alias(quantile_name(q)))
    return ranked.groupBy(*keys).agg(*aggs)


def cell_quantiles(df: DataFrame, keys: list[str], value: Column | str, qs) -> DataFrame:
    """``keys`` and a column qNN per quantile of ``value``."""
    return quantiles_of(ranked_counts(df, keys, value), keys, qs)


def ranked_cells(df: DataFrame, cells: dict[str, tuple[Column | None, Column | str]]) -> DataFrame:
    """``ranked_counts`` by ``cell`` for named cells that overlap as they like: a row
    counts in each cell whose condition (None: always) holds, with the cell's
    value.  All cells come from one scan and one table of counts."""
    parts = []
    for name, (when, value) in cells.items():
        v = (F.col(value) if isinstance(value, str) else value).try_cast("double")
        parts.append(F.struct(F.lit(name).alias("cell"), (v if when is None else F.when(when, v)).alias("value")))
    each = df.select(F.explode(F.array(*parts)).alias("c")).select("c.*").where("value is not null")
    return ranked_counts(each, ["cell"], "value")


def quantile_row(df: DataFrame, metric: str, qs) -> DataFrame:
    """One row with a column qNN per quantile over all rows."""
    return cell_quantiles(df, [], metric, qs)


def column_medians(df: DataFrame, cols: list[str]) -> dict:
    """The median of each column, all in one job; None for a column without values."""
    if not cols:
        return {}
    numbers = df.select(*[F.col(c).try_cast("double").alias(c) for c in cols])
    long = numbers.unpivot([], cols, "__name", "__value")
    found = {r["__name"]: r["q50"] for r in cell_quantiles(long, ["__name"], "__value", [0.5]).collect()}  # a row per column
    return {c: found.get(c) for c in cols}
