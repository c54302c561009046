"""Shared helpers: scratch tables in the cluster's shared folder, row ids,
connected components."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigap.session import scratch_path

#: Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


class Scratch:
    """Written tables of one operator run, under the shared folder that
    ``spark.checkpoint.dir`` names.  A written table cuts lineage: a lost
    executor costs the tasks that read it again, not the passes before it, and
    ids assigned while writing stay as they are."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def numbered(self, df: DataFrame, row: str) -> DataFrame:
        """``df`` written once with a number ``row`` for each of its rows.  Two
        passes over a plan may deal its rows differently (adaptive execution
        sizes a shuffle by the columns read, Spark sizes splits by the cores it
        has); rows that are numbered and written are the same in all passes."""
        return self.write(df.withColumn(row, F.monotonically_increasing_id()), "numbered")

    def ordinals(self, df: DataFrame, name: str, group: list[str], order: list[str]) -> DataFrame:
        """``df`` written in order of ``group`` and ``order`` (nulls first), with
        ordinal (from 0, within the group) and members (of the group).  Rows are
        range-partitioned by both, so a group of any size is spread over tasks;
        its rows in the partitions before are added up per (partition, group).
        The groups' names must not be those of new columns."""
        keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
        n = shuffle_partitions(self.spark)
        sorted_ = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
        placed = self.write(sorted_, name)
        part = F.shiftright("place", 33).alias("part")
        slices = placed.groupBy(part, *group).agg(F.count("*").alias("n"), F.min("place").alias("first"))
        of = Window.partitionBy(*group)
        before = F.coalesce(F.sum("n").over(of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        slices = slices.select(F.col("part").alias("o_part"), *[F.col(g).alias(f"o_{g}") for g in group],
                               (before - F.col("first")).alias("o_shift"), F.sum("n").over(of).alias("members"))
        slices = self.write(slices, f"{name}-slices")
        same = F.shiftright("place", 33) == F.col("o_part")
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"o_{g}"))
        return placed.join(small(slices, 256), same).select(*df.columns, (F.col("place") + F.col("o_shift")).alias("ordinal"), "members")

    def drop(self, *names: str) -> None:
        """Delete tables that nothing will read again."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Spark's setting ``key`` is ``value`` inside, and as before afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def in_file_order(df: DataFrame) -> bool:
    """Whether ``df`` only reads files, computes columns and filters, so that its
    rows come in the files' order whatever columns are read."""
    steps = re.findall(r"^[\s:+\-]*(?:\*\(\d+\) ?)?(\w+)", df._jdf.queryExecution().executedPlan().toString(), re.M)
    return set(steps) <= {"Project", "Filter", "FileScan", "ColumnarToRow"}


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        out.append(name)
    return out


def schema_with(df: DataFrame, **more: str) -> T.StructType:
    """``df``'s schema with more columns, given as name=type."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in more.items())).fields])


def plain_spaces(text: Column) -> Column:
    """``text`` with runs of white space other than line ends as one space.
    Most texts have single spaces only, which costs a search less than a
    regular expression."""
    odd = F.lit(False)
    for run in ("  ", "\t", "\x0b", "\x0c", "\r"):
        odd = odd | F.contains(text, F.lit(run))
    return F.when(odd, F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")).otherwise(text)


#: Bytes that a table may take to be broadcast; beyond that it is shuffled.
BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df``, a written table of rows of at most ``row_bytes``, marked for
    broadcast if its size is within BROADCAST_BYTES."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df
