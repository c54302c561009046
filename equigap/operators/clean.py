"""Cleaning pipeline (C02-C08) and the modeling frame.

All steps are narrow projections / filters except de-duplication, which
shuffles once on its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from equigap.functions import labels as L
from equigap.functions.text import fold_text, py_strip
from equigap.roles import Roles
from equigap.sources.files import RECORD

# Text sentinels turned into null after folding.
SENTINELS = ["", "nan", "None", "SIN INFORMACION"]


def fold_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """C01 over every string column (or ``cols``)."""
    cols = cols if cols is not None else [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.select(*[fold_text(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def null_sentinels(df: DataFrame, cols: list[str], values: list[str] | None = None) -> DataFrame:
    """Exact sentinel values -> null."""
    vals = SENTINELS if values is None else values
    return df.select(
        *[F.when(F.col(c).isin(*vals), F.lit(None)).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
          for c in df.columns]
    )


def fill_default(df: DataFrame, col: str, value: str = "N") -> DataFrame:
    """Null -> default (cole_bilingue -> N)."""
    return df.fillna({col: value}) if col in df.columns else df


def to_number(col: Column | str) -> Column:
    """Numeric coercion; unparsable text -> null (ANSI-safe)."""
    c = F.col(col) if isinstance(col, str) else col
    return py_strip(c.cast("string")).try_cast("double")


def guard_range(col: Column | str, lo: float, hi: float) -> Column:
    """Inclusive bounds; outside -> null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.between(F.lit(lo), F.lit(hi)), c)


def drop_incomplete(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop a row if any listed score is null."""
    return df.dropna(subset=[c for c in cols if c in df.columns])


def dedup(df: DataFrame, key: str | None = None, order: list[Column | str] | None = None) -> DataFrame:
    """Keep the first row per key by an explicit order (null order
    values last, null keys one key); whole-row distinct when there is no key.

    ``row_number() = 1`` lets Spark keep one row per key and task before the
    shuffle, so a key holding a third of all rows costs one row per task."""
    if key is None or key not in df.columns:
        return df.distinct()
    if not order:
        raise ValueError("an order says which row of a key is the first")
    by = [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in order]
    first = Window.partitionBy(key).orderBy(*by)
    return df.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def _ranges(roles: Roles, subjects_100: list[str] | None, global_500: list[str] | None) -> dict[str, int]:
    """Score columns and their upper bounds."""
    subjects_100 = subjects_100 if subjects_100 is not None else [
        c for c in [roles.english, roles.math, roles.social, roles.science, roles.reading] if c
    ]
    global_500 = global_500 if global_500 is not None else [c for c in [roles.score] if c]
    return dict.fromkeys(subjects_100, 100) | dict.fromkeys(global_500, 500)


def _columns(df: DataFrame, roles: Roles, subjects_100: list[str] | None, global_500: list[str] | None,
             text_cols: list[str] | None) -> tuple[list[str], list[str]]:
    """The text columns and the score columns that ``df`` has."""
    scores = [c for c in _ranges(roles, subjects_100, global_500) if c in df.columns]
    if text_cols is None:
        text_cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and f.name not in scores]
    return text_cols, scores


def _scored(df: DataFrame, roles: Roles, subjects_100: list[str] | None, global_500: list[str] | None) -> DataFrame:
    """Coerced and range-checked scores; numbers need no parsing."""
    top = _ranges(roles, subjects_100, global_500)
    number = lambda f: F.col(f.name).cast("double") if isinstance(f.dataType, NumericType) else to_number(f.name)
    return df.select(*[guard_range(number(f), 0, top[f.name]).alias(f.name) if f.name in top else F.col(f.name) for f in df.schema.fields])


def _folded(df: DataFrame, roles: Roles, text_cols: list[str]) -> DataFrame:
    """Folded texts, sentinels as nulls, the bilingual default."""
    out = null_sentinels(fold_columns(df, text_cols), text_cols)
    return fill_default(out, roles.bilingual, "N") if roles.bilingual else out


def _prepared(df: DataFrame, roles: Roles, subjects_100: list[str] | None, global_500: list[str] | None,
              text_cols: list[str] | None) -> tuple[DataFrame, list[str]]:
    """Folded, coerced and range-checked rows, and the score columns."""
    text_cols, scores = _columns(df, roles, subjects_100, global_500, text_cols)
    return _scored(_folded(df, roles, text_cols), roles, subjects_100, global_500), scores


def clean_scores(
    df: DataFrame,
    roles: Roles,
    subjects_100: list[str] | None = None,
    global_500: list[str] | None = None,
    text_cols: list[str] | None = None,
    order: list[Column | str] | None = None,
) -> DataFrame:
    """Fold text, sentinels, default, coerce, range, drop, de-dup.  The
    first row of a key is by ``order``, by default the record's place in its
    files where the reader has added it (``read_scores(..., record=True)``), else
    all columns in turn: tables without files have no first row of their own.
    Rows of a key are told apart before their texts are folded, so only kept
    rows are folded."""
    key = roles.student_id
    order = order or ([RECORD] if RECORD in df.columns else df.columns)
    text_cols, scores = _columns(df, roles, subjects_100, global_500, text_cols)
    scored = drop_incomplete(_scored(df, roles, subjects_100, global_500), scores)
    if key not in df.columns:
        return dedup(_folded(scored, roles, text_cols))
    if key in text_cols:  # keys are compared as they are cleaned
        scored = null_sentinels(fold_columns(scored, [key]), [key])
    return _folded(dedup(scored, key, order), roles, [c for c in text_cols if c != key])


def clean_audit(df: DataFrame, roles: Roles, subjects_100: list[str], global_500: list[str],
                key: str | None = None) -> DataFrame:
    """One row with the row count before cleaning, after dropping
    incomplete scores and after de-duplication as ``clean_scores`` does it
    (by the cleaned key; whole rows without one); one scan + one shuffle."""
    out, scores = _prepared(df, roles, subjects_100, global_500, None)
    key = key or roles.student_id
    ok = F.lit(True)
    for c in scores:
        ok = ok & F.col(c).isNotNull()
    keys = [F.col(key).alias("k")] if key in out.columns else [F.col(c).alias(f"k{i}") for i, c in enumerate(out.columns)]
    base = out.select(ok.alias("ok"), *keys)
    per_key = base.groupBy(*base.columns[1:]).agg(F.count("*").alias("n"), F.sum(F.col("ok").cast("long")).alias("n_ok"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_loaded"),
        F.coalesce(F.sum("n_ok"), F.lit(0)).cast("long").alias("rows_complete"),
        F.coalesce(F.sum(F.when(F.col("n_ok") > 0, 1).otherwise(0)), F.lit(0)).cast("long").alias("rows_deduplicated"),
    )


def modeling_frame(df: DataFrame, roles: Roles) -> DataFrame:
    """Derived features of the P3 modeling frame, one select."""

    def up(c):
        return py_strip(F.upper(F.col(c))) if c and c in df.columns else F.lit(None).cast("string")

    inet = L.yes_no_flag(roles.internet) if roles.internet in df.columns else F.lit(None).cast("int")
    comp = L.yes_no_flag(roles.computer) if roles.computer in df.columns else F.lit(None).cast("int")
    area = roles.zone if roles.zone in df.columns else roles.residence
    cols = [
        F.col(c) for c in df.columns
    ] + [
        inet.alias("internet_flag"),
        comp.alias("computador_flag"),
        L.tic_score(inet, comp).alias("tic_score"),
        L.tic_interaction(inet, comp).alias("tic_interaccion"),
        up(roles.stratum).alias("estrato_cat"),
        (L.zone_cabecera(area) if area and area in df.columns else F.lit(None).cast("string")).alias("zona"),
        (L.school_type(roles.school_type) if roles.school_type in df.columns else F.lit(None).cast("string"))
        .alias("tipo_colegio"),
        up(roles.shift).alias("jornada"),
        up(roles.gender).alias("genero"),
        up(roles.father_edu).alias("edu_padre"),
        up(roles.mother_edu).alias("edu_madre"),
        (L.yes_no_flag(roles.bilingual) if roles.bilingual in df.columns else F.lit(None).cast("int"))
        .alias("bilingue_flag"),
        (F.substring(F.col(roles.period).cast("string"), 1, 4).try_cast("int")
         if roles.period in df.columns else F.lit(None).cast("int")).alias("periodo_year"),
        up(roles.region).alias("municipio"),
    ]
    return df.select(*cols)


def residence_frame(df: DataFrame, roles: Roles) -> DataFrame:
    """C11 + F03 as the P1 pages load the table: the residence area column
    is preferred over the school's area when present; rows with a null /
    SIN INFORMACION / NAN area are removed, the rest are Urbano / Rural
    (``Desconocido`` when neither column exists); then unknown strata are
    dropped (``Sin Estrato`` kept)."""
    from equigap.operators.filters import known_stratum

    area = roles.residence if roles.residence and roles.residence in df.columns else (
        roles.zone if roles.zone and roles.zone in df.columns else None)
    out = df.where(L.zone_residence_keep(area)).withColumn("Area", L.zone_residence(area))
    if roles.region and roles.region in df.columns:
        out = out.withColumn(roles.region, py_strip(F.upper(F.col(roles.region))))
    if roles.stratum and roles.stratum in df.columns:
        out = known_stratum(out, roles.stratum)
    return out
