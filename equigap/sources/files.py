"""File sources and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from equigap.functions.text import py_strip, upper_key
from equigap.session import materialize

# Columns read as text even when they look numeric.
STRING_OVERRIDES = ["cole_cod_mcpio_ubicacion"]
#: Name of the column with a record's place in its files.
RECORD = "record"


def with_record_ordinal(df: DataFrame, out: str = RECORD) -> DataFrame:
    """``df``, read from text files, with each record's place in the files (from 0;
    files by path).

    A reading task sees a split's records in order, so (file, split's start,
    place in the task) orders them.  The rows are written once with these;
    records before a split are then a prefix sum over the splits of its file
    and over the files, and the place in the split is the place in the task less
    that of the split's first record.  No rows are sorted or sent to one task."""
    placed = materialize(df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
                                   F.monotonically_increasing_id().alias("__at")), "records")
    splits = placed.groupBy("__file", "__block").agg(F.count("*").alias("n"), F.min("__at").alias("first"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = splits.groupBy("__file").agg(F.sum("n").alias("n")).select(F.col("__file").alias("f_file"), before(Window.orderBy("__file")).alias("f_base"))
    splits = splits.select("__file", "__block", (before(Window.partitionBy("__file").orderBy("__block")) - F.col("first")).alias("s_shift"))
    splits = splits.join(files, F.expr("__file = f_file")).select(F.col("__file").alias("s_file"), F.col("__block").alias("s_block"), (F.col("f_base") + F.col("s_shift")).alias("s_shift"))
    return placed.join(splits, F.expr("__file = s_file and __block = s_block")).select(*df.columns, (F.col("__at") + F.col("s_shift")).alias(out))


def read_scores(spark: SparkSession, path: str, schema: StructType | None = None, record: bool = False) -> DataFrame:
    """Fact CSV with a header; the code column stays a string.  With
    ``record`` a column RECORD holds each row's place in the files, by which
    cleaning keeps the first row of a key.

    With an explicit schema there is no inference pass; without one every
    column is read as text (the cleaning pipeline coerces scores with
    ``try_cast``), which keeps leading zeros of codes."""
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", False)
    if schema is not None:
        fields = [StructField(f.name, StringType(), True) if f.name in STRING_OVERRIDES else f for f in schema.fields]
        df = reader.schema(StructType(fields)).csv(path)
    else:
        df = reader.option("inferSchema", False).csv(path)
    return with_record_ordinal(df) if record else df


def _clean_header(df: DataFrame) -> DataFrame:
    names = []
    for c in df.columns:
        n = c.replace("﻿", "").strip()
        names.append(n)
    keep = [(c, n) for c, n in zip(df.columns, names) if n and not n.startswith("_c")]
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in keep])


def read_region_dim(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """GDP dimension: BOM and padded header names removed, trailing empty
    column dropped, key upper/trimmed, numbers parsed (share '40.34%' ->
    40.34).  ``sep=None`` sniffs ';' vs ',' from the header line."""
    if sep is None:
        head = spark.read.text(path).limit(1).first()
        line = head[0] if head else ""
        sep = ";" if line.count(";") > line.count(",") else ","
    raw = spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8").csv(path)
    df = _clean_header(raw)
    out = []
    for c in df.columns:
        if c.lower() == "municipio":
            out.append(upper_key(c).alias("Municipio"))
        elif "%" in c or c.lower().startswith("particip"):
            out.append(F.regexp_replace(py_strip(F.col(f"`{c}`")), "%", "").try_cast("double").alias(c))
        elif c.lower().startswith("pib") or c.lower().startswith("poblacion"):
            # a decimal comma is no number: null
            out.append(py_strip(F.col(f"`{c}`")).try_cast("double").alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def read_coords(spark: SparkSession, path: str) -> DataFrame:
    """Municipality coordinates."""
    schema = "cole_mcpio_ubicacion string, lat double, lon double"
    return spark.read.option("header", True).option("encoding", "UTF-8").schema(schema).csv(path)


def write_clean(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write the clean table (Parquet by default; CSV with header)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_result(df: DataFrame, base: str, name: str, fmt: str = "csv") -> str:
    """Write one statistics table under ``base``."""
    path = f"{base.rstrip('/')}/{name}"
    write_clean(df, path, fmt=fmt)
    return path


def read_results(spark: SparkSession, base: str, names: list[str], fmt: str = "csv") -> dict[str, DataFrame | None]:
    """Read the statistics tables back; a missing table maps to None
    (the availability flag); any other failure is raised."""
    out: dict[str, DataFrame | None] = {}
    for n in names:
        path = f"{base.rstrip('/')}/{n}"
        try:
            r = spark.read.option("header", True).option("inferSchema", True).csv(path) if fmt == "csv" \
                else spark.read.parquet(path)
            out[n] = r
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            out[n] = None
    return out


def distinct_regions(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct upper/trimmed region names."""
    return df.select(upper_key(col).alias(col)).where(F.col(col).isNotNull()).distinct().orderBy(col)


def export_regions(df: DataFrame, col: str, path: str) -> None:
    """S11 sink: the sorted list as UTF-8 CSV, its files in order."""
    distinct_regions(df, col).write.mode("overwrite").option("header", True).csv(path)
