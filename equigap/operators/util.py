"""Small plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unpivot_metrics(df: DataFrame, ids: list[str], metrics: list[str], name: str = "metric",
                    value: str = "value") -> DataFrame:
    """Long form (ids..., metric, value) of several numeric columns, one pass."""
    cast = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return cast.unpivot(ids, metrics, name, value)


def aggregate_metrics(df: DataFrame, keys: list[str], metrics: list[str], aggs: dict, name: str = "metric") -> DataFrame:
    """``keys``, metric and one column per aggregate (a function of the metric's
    column), a row per metric.  Facts are read once as they are; only the
    aggregated rows are turned into one per metric."""
    wide = df.groupBy(*keys).agg(*[fn(F.col(m).cast("double")).alias(f"__{i}_{k}") for i, m in enumerate(metrics) for k, fn in aggs.items()])
    rows = [F.struct(F.lit(m).alias(name), *[F.col(f"__{i}_{k}").alias(k) for k in aggs]) for i, m in enumerate(metrics)]
    return wide.select(*keys, F.inline(F.array(*rows)))


def metric_order(name_col: Column, metrics: list[str]) -> Column:
    """Position (0-based) of a metric name in a fixed list."""
    out = None
    for i, m in enumerate(metrics):
        out = F.when(name_col == m, i) if out is None else out.when(name_col == m, i)
    return out


def ordinal_within(df: DataFrame, key: str, order: list[str], out: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """1-based position of each row inside its ``key`` group by ``order``
    (``row_number() over (partition by key order by ...)``) without sending
    a whole group to one task: the rows are range-partitioned on
    (key, order), so a group holding a third of all rows is spread over
    many contiguous partitions; per-(partition, key) counts (a table of at
    most partitions x keys-per-partition rows) give each slice its offset.
    Requires ``order`` to make rows unique within a key (add an id)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    srt = df.repartitionByRange(n, key, *order).withColumn("__pid", F.spark_partition_id())
    # materialise once in the shared checkpoint folder: the partition id is
    # then a stored value, identical for the count and the ranking branch
    # (recomputing the range exchange could re-coalesce partitions under AQE)
    from equigap.session import checkpoint_dir

    checkpoint_dir(spark)
    srt = srt.checkpoint(eager=True)
    slices = srt.groupBy("__pid", key).agg(F.count("*").alias("__c"))
    from pyspark.sql import Window

    prior = Window.partitionBy(key).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = slices.withColumn("__off", F.coalesce(F.sum("__c").over(prior), F.lit(0))).select("__pid", key, "__off")
    local = Window.partitionBy("__pid", key).orderBy(*order)
    ranked = srt.withColumn("__rn", F.row_number().over(local))
    return ranked.join(offs, ["__pid", key]).withColumn(out, F.col("__off") + F.col("__rn")).drop("__pid", "__rn", "__off")


def one_row(df: DataFrame) -> dict:
    """Values of a one-row aggregate (a bounded collect of a single row) so
    they can be applied as literals instead of cross-joining the row back."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one row, got {len(rows)}")
    return rows[0].asDict()


def one_row_frame(spark, parts: list[DataFrame]) -> DataFrame:
    """Side-by-side union of several one-row aggregates as one row."""
    from pyspark.sql.types import StructType

    values, fields = {}, []
    for p in parts:
        values.update(one_row(p))
        fields.extend(p.schema.fields)
    return spark.createDataFrame([tuple(values[f.name] for f in fields)], StructType(fields))
