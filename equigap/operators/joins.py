"""Joins J01-J09.  All equi (left outer / semi), and the scenario grid.  No
hints: Spark broadcasts a dimension when its size in bytes allows it, at
planning or, under adaptive execution, once the size is known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigap.functions.text import normalize_key, upper_key
from equigap.operators.quantiles import quantiles_of, ranked_counts
from equigap.operators.util import one_row
from equigap.session import materialize


def region_dim(dim: DataFrame, name_col: str, value_cols: list[str], key: str = "__key",
               normalise: bool = False) -> DataFrame:
    """Dimension keyed by upper(trim(name)) (or the C10 key), one row per key
    so the join cannot fan out."""
    k = normalize_key(name_col) if normalise else upper_key(name_col)
    return dim.select(k.alias(key), *value_cols).where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.max(c).alias(c) for c in value_cols]
    )


def with_gdp(df: DataFrame, dim: DataFrame, region_col: str, name_col: str, value_cols: list[str],
             normalise: bool = False) -> DataFrame:
    """Fact LEFT JOIN GDP on upper(trim(region)); no fan-out."""
    d = region_dim(dim, name_col, value_cols, normalise=normalise)
    k = normalize_key(region_col) if normalise else upper_key(region_col)
    return df.join(d, k == F.col("__key"), "left").drop("__key")


def with_coords(df: DataFrame, coords: DataFrame, region_col: str, name_col: str = "cole_mcpio_ubicacion",
                raw_key: bool = False, normalise: bool = False) -> DataFrame:
    """Fact LEFT JOIN coordinates.  ``raw_key`` joins on the raw name
    (P2 behaviour); ``normalise`` uses the accent-free C10 key."""
    vals = [c for c in coords.columns if c != name_col]
    if raw_key:
        d = coords.select(F.col(name_col).alias("__key"), *vals).groupBy("__key").agg(*[F.max(c).alias(c) for c in vals])
        return df.join(d, F.col(region_col) == F.col("__key"), "left").drop("__key")
    return with_gdp(df, coords, region_col, name_col, vals, normalise=normalise)


def region_with_gdp(agg: DataFrame, dim: DataFrame, key_col: str, name_col: str, value_cols: list[str]) -> DataFrame:
    """Region aggregate (keyed by the C10 key) LEFT JOIN GDP on C10 key."""
    d = region_dim(dim, name_col, value_cols, normalise=True)
    return agg.join(d, F.col(key_col) == F.col("__key"), "left").drop("__key")


def gap_with_gdp(gap: DataFrame, df: DataFrame, region_col: str, gdp_col: str) -> DataFrame:
    """Gap per region LEFT JOIN distinct (region, GDP) pairs of the fact."""
    pairs = df.select(region_col, gdp_col).distinct()
    return gap.join(pairs, region_col, "left")


def with_display(agg: DataFrame, names: DataFrame, key_col: str) -> DataFrame:
    """Attach display names (one per key)."""
    return agg.join(names, key_col, "left")


def keep_regions(detail: DataFrame, top: DataFrame, region_col: str) -> DataFrame:
    """Rows of ``detail`` whose region is in ``top`` (semi join)."""
    return detail.join(top.select(region_col), region_col, "left_semi")


def local_vs_all(local: DataFrame, total: DataFrame) -> DataFrame:
    """Stack local and department rows by column name."""
    return local.unionByName(total)


def gdp_lookup(df: DataFrame, regions: DataFrame, region_col: str, gdp_col: str, per_cap_col: str | None,
               out_region: str = "municipio") -> DataFrame:
    """Per requested region, (median GDP, median per-capita) of the fact
    rows of that region; when the region has no GDP, the medians over all rows.
    Per-capita stays null when the region has GDP but no per-capita."""
    pc = F.col(per_cap_col) if per_cap_col else F.lit(None).cast("double")
    # Values are counted first; the regions' and the overall medians are then read
    # off one table of counts, which is range-partitioned within a region, too.
    counts = df.groupBy(F.col(region_col).alias("__r"), F.col(gdp_col).try_cast("double").alias("g"), pc.try_cast("double").alias("pc")).agg(F.count("*").alias("__n"))
    long = counts.unpivot(["__r", "__n"], ["g", "pc"], "__measure", "__v")
    scoped = long.select(F.explode(F.array(F.struct(F.lit(True).alias("__all"), F.lit(None).cast(counts.schema["__r"].dataType).alias(out_region)),
                                           F.struct(F.lit(False).alias("__all"), F.col("__r").alias(out_region)))).alias("s"), "__measure", "__v", "__n")
    keys = ["__all", out_region, "__measure"]
    medians = quantiles_of(ranked_counts(scoped.select("s.*", "__measure", "__v", "__n"), keys, "__v", "__n"), keys, [0.5])
    medians = materialize(medians, "gdp_medians")  # a row per region and measure
    of = lambda m: F.max(F.when(F.col("__measure") == m, F.col("q50")))
    by_region = medians.where("not __all").groupBy(out_region).agg(of("g").alias("__g"), of("pc").alias("__pc"))
    o = one_row(medians.where("__all").agg(of("g").alias("g"), of("pc").alias("pc")))
    req = regions.select(F.col(out_region)).join(by_region, out_region, "left")
    found = F.col("__g").isNotNull()
    return req.select(
        out_region,
        F.when(found, F.col("__g")).otherwise(F.lit(o["g"] if o["g"] is not None else 0.0).cast("double")).alias("pib"),
        F.when(found, F.col("__pc")).otherwise(F.lit(o["pc"]).cast("double")).alias("pib_per_capita"),
    )


def scenario_grid(targets: DataFrame, strata: DataFrame, types: DataFrame, profile: dict) -> DataFrame:
    """Targets x strata x school types on a fixed profile (the
    reference's what-if grid).  The value lists are exploded per target: two
    arrays exploded over the targets, so the grid may be of any size."""
    def values(d: DataFrame):
        """The frame's rows as an array of literals (a list a user typed)."""
        return F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(d.schema.fields, r)]) for r in d.collect()])

    grid = targets.withColumn("__s", F.explode(values(strata))).withColumn("__t", F.explode(values(types)))
    grid = grid.select(*targets.columns, "__s.*", "__t.*")
    for k, v in profile.items():
        grid = grid.withColumn(k, F.lit(v))
    return grid
