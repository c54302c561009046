"""Filters F01-F05."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equigap.functions.text import py_strip
from equigap.operators.util import one_row

# Fixed values: "all regions" selector values.
ALL_VALUES = ("TODOS", "Todos")


def by_region(df: DataFrame, region_col: str, region: str | None, all_value: tuple[str, ...] = ALL_VALUES) -> DataFrame:
    """region filter; the all-value (or None) bypasses it."""
    if region is None or region in all_value:
        return df
    return df.filter(F.col(region_col) == F.lit(region))


def by_period_range(df: DataFrame, period_col: str, i: int, j: int) -> DataFrame:
    """keep rows whose period lies between the i-th and j-th (0-based,
    inclusive) of the sorted distinct periods.

    Distinct periods are a tiny aggregate; they are ranked on Spark and the
    two bounding values are joined back, so nothing goes through the driver.
    """
    periods = df.select(F.col(period_col).alias("__p")).where(F.col("__p").isNotNull()).distinct()
    ranked = periods.withColumn("__r", F.row_number().over(Window.orderBy("__p")) - 1)
    bounds = ranked.agg(
        F.max(F.when(F.col("__r") == F.lit(i), F.col("__p"))).alias("__lo"),
        F.max(F.when(F.col("__r") == F.lit(j), F.col("__p"))).alias("__hi"),
    )
    b = one_row(bounds)  # two scalars, applied as a literal range (prunable)
    if b["__lo"] is None or b["__hi"] is None:
        return df.where(F.lit(False))
    return df.filter(F.col(period_col).between(F.lit(b["__lo"]), F.lit(b["__hi"])))


def known_stratum(df: DataFrame, col: str) -> DataFrame:
    """drop null and SIN INFORMACION stratum; 'Sin Estrato' stays."""
    # Stratum sentinels.
    return df.filter(F.col(col).isNotNull() & ~F.upper(F.col(col).cast("string")).isin("SIN INFORMACION", "SIN INFORMACIÓN"))


# Option-list sentinels (upper-cased comparison).
OPTION_SENTINELS = ("NAN", "SIN INFORMACION", "")


# Option lists used when a column has no usable value.
OPTION_DEFAULTS = {
    "estrato": ["ESTRATO 1", "ESTRATO 2"], "zona": ["URBANO", "RURAL"], "tipo_colegio": ["PUBLICO", "PRIVADO"],
    "jornada": ["COMPLETA", "MANANA"], "genero": ["MASCULINO", "FEMENINO", "MIXTO"],
    "edu_padre": ["SECUNDARIA", "TECNICA"], "edu_madre": ["SECUNDARIA", "TECNICA"],
}


def option_lists(df: DataFrame, cols: list[str], region_col: str | None = None, all_value: str = "TODOS",
                 defaults: dict[str, list[str]] | None = None) -> DataFrame:
    """(column, value, pos) of the distinct, trimmed, sentinel-free values
    of every listed categorical, in one pass (unpivot + distinct).  The region
    list gets the all-value in front (pos 0); a column left without values
    gets its fixed default list (``defaults``), via an anti join on the
    (tiny) set of columns that do have values."""
    present = [c for c in cols if c in df.columns]
    long = df.select(*[F.col(c).cast("string").alias(c) for c in present]).unpivot(
        [], present, "column", "value"
    )
    vals = (
        long.select("column", py_strip(F.col("value")).alias("value"))
        .where(F.col("value").isNotNull() & ~F.upper(F.col("value")).isin(*OPTION_SENTINELS))
        .distinct()
    )
    ranked = vals.withColumn("pos", F.row_number().over(Window.partitionBy("column").orderBy("value")))
    if region_col and region_col in present:
        head = df.sparkSession.createDataFrame([(region_col, all_value, 0)], "column string, value string, pos int")
        ranked = ranked.unionByName(head)
    out = ranked.select("column", "value", F.col("pos").cast("int").alias("pos"))
    if defaults:
        fallback = df.sparkSession.createDataFrame(
            [(c, v, i + 1) for c, vals in defaults.items() if c in cols for i, v in enumerate(vals)],
            "column string, value string, pos int")
        have = out.select("column").distinct()
        out = out.unionByName(fallback.join(have, "column", "left_anti"))
    return out


def min_group(counts: DataFrame, count_cols: list[str], n: int) -> DataFrame:
    """keep groups where every listed count is >= n."""
    cond = F.lit(True)
    for c in count_cols:
        cond = cond & (F.coalesce(F.col(c), F.lit(0)) >= n)
    return counts.filter(cond)
