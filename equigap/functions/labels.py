"""Scalar recoding rules (projections).  All native Column expressions.

Each function returns a Column; none of them touches data on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from equigap.functions.text import py_strip


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _up(col: Column | str) -> Column:
    return py_strip(F.upper(_c(col)))


# ---------------------------------------------------------------- zones --

def zone_residence(col: Column | str | None) -> Column:
    """C11 (P1 rule): CABECERA or URBAN anywhere in the upper text -> Urbano,
    everything else -> Rural; no column -> Desconocido.  Rows to remove are
    picked by :func:`zone_residence_keep`."""
    if col is None:
        return F.lit("Desconocido")
    u = F.upper(_c(col))
    return F.when(u.contains("CABECERA") | u.contains("URBAN"), "Urbano").otherwise("Rural")


def zone_residence_keep(col: Column | str | None) -> Column:
    """C11 row filter: drop null / SIN INFORMACION / NAN areas."""
    if col is None:
        return F.lit(True)
    u = F.upper(_c(col))
    # Sentinels removed by the P1 zone rule.
    return _c(col).isNotNull() & ~u.isin("SIN INFORMACIÓN", "SIN INFORMACION", "NAN")


def zone_strict(col: Column | str) -> Column:
    """C12 (insights rule): RURAL -> RURAL, URB -> URBANO, else pass through."""
    u = _up(col)
    return F.when(u.contains("RURAL"), "RURAL").when(u.contains("URB"), "URBANO").otherwise(u)


def zone_cabecera(col: Column | str) -> Column:
    """C13 (P3 rule): C12 plus CABECERA -> URBANO."""
    u = _up(col)
    return (
        F.when(u.contains("RURAL"), "RURAL")
        .when(u.contains("URB") | u.contains("CABECERA"), "URBANO")
        .otherwise(u)
    )


# --------------------------------------------------------- school type --

def school_type(col: Column | str) -> Column:
    """C14: NO OFICIAL / PRIVAD -> PRIVADO is tested before OFICIAL / PUBLIC."""
    u = _up(col)
    return (
        F.when(u.contains("NO OFICIAL") | u.contains("PRIVAD"), "PRIVADO")
        .when(u.contains("OFICIAL") | u.contains("PUBLIC"), "PUBLICO")
        .otherwise(u)
    )


# P2 relabel of school type.
SCHOOL_RELABEL = {"OFICIAL": "Público", "NO OFICIAL": "Privado"}


def relabel(col: Column | str, mapping: Mapping[str, str]) -> Column:
    """Exact dictionary relabel; unmapped values kept."""
    c = _c(col)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == k, v) if out is None else out.when(c == k, v))
    return c if out is None else out.otherwise(c)


# ----------------------------------------------------------------- flags --

# Yes / no vocabularies of the flag rule.
YES_VALUES = ["SI", "S", "1", "TRUE", "T", "Y", "YES"]
NO_VALUES = ["NO", "N", "0", "FALSE", "F"]


def yes_no_flag(col: Column | str) -> Column:
    """Yes vocabulary -> 1, no vocabulary -> 0, anything else null."""
    u = _up(col)
    return F.when(u.isin(*YES_VALUES), F.lit(1)).when(u.isin(*NO_VALUES), F.lit(0)).cast("int")


def form_flag(col: Column | str) -> Column:
    """C17: SI -> 1 else 0 (null -> 0)."""
    return F.when(_up(col) == "SI", 1).otherwise(0).cast("int")


def access2(internet_flag: Column | str, computer_flag: Column | str) -> Column:
    """CON_ACCESO when either 0/1 flag is 1; null flags compare false."""
    i, c = _c(internet_flag), _c(computer_flag)
    has = F.coalesce(i == 1, F.lit(False)) | F.coalesce(c == 1, F.lit(False))
    return F.when(has, "CON_ACCESO").otherwise("SIN_ACCESO")


def access4(internet: Column | str, computer: Column | str) -> Column:
    """Exact, case-sensitive 'Si' on both raw answers."""
    i = _c(internet).eqNullSafe("Si")
    c = _c(computer).eqNullSafe("Si")
    return (
        F.when(i & c, "Internet y Computador")
        .when(i, "Solo Internet")
        .when(c, "Solo Computador")
        .otherwise("Sin Acceso TIC")
    )


def internet_label(col: Column | str) -> Column:
    """C20: 'Si' -> Con Internet, anything else (null too) -> Sin Internet."""
    return F.when(_c(col).eqNullSafe("Si"), "Con Internet").otherwise("Sin Internet")


def tic_score(f1: Column | str, f2: Column | str) -> Column:
    """Sum of non-null flags; null only when both are null."""
    a, b = _c(f1), _c(f2)
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    )


def tic_interaction(f1: Column | str, f2: Column | str) -> Column:
    """Product of flags, null when either is null."""
    return _c(f1) * _c(f2)


# ---------------------------------------------------------------- period --

def period_year(col: Column | str) -> Column:
    """First four characters as an int; non-numeric -> null."""
    s = F.substring(_c(col).cast("string"), 1, 4)
    return F.when(s.rlike("^[0-9]+$"), s.try_cast("int"))


def period_label(col: Column | str) -> Column:
    """20151 -> 2015-1; strings shorter than 5 characters unchanged."""
    s = _c(col).cast("string")
    return F.when(
        F.length(s) >= 5, F.concat(F.substring(s, 1, 4), F.lit("-"), s.substr(F.lit(5), F.length(s)))
    ).otherwise(s)


# --------------------------------------------------------------- stratum --

# Ordered stratum labels.
STRATA = ["Estrato 1", "Estrato 2", "Estrato 3", "Estrato 4", "Estrato 5", "Estrato 6", "Sin Estrato"]


def stratum_label(col: Column | str) -> Column:
    """Trim; 'Estrato n' and 'Sin Estrato' kept, bare 'n' -> 'Estrato n',
    anything else null (the row is then dropped by the caller)."""
    s = py_strip(_c(col).cast("string"))
    return (
        F.when(s.isin(*STRATA), s)
        .when(s.isin("1", "2", "3", "4", "5", "6"), F.concat(F.lit("Estrato "), s))
    )


def stratum_order(label: Column | str) -> Column:
    """C25 order column: 1..6, Sin Estrato = 7."""
    s = _c(label)
    return F.when(s == "Sin Estrato", 7).otherwise(F.substring(s, 9, 1).try_cast("int"))


# ----------------------------------------------------------------- bands --

def priority_band(score: Column | str, q25: Column | float, q75: Column | float) -> Column:
    """(-inf,q25] ALTA, (q25,q75] MEDIA, (q75,inf) BAJA, null -> null."""
    s = _c(score)
    q25 = q25 if isinstance(q25, Column) else F.lit(q25)
    q75 = q75 if isinstance(q75, Column) else F.lit(q75)
    return F.when(s.isNull(), F.lit(None)).when(s <= q25, "ALTA").when(s <= q75, "MEDIA").otherwise("BAJA")


def at_risk(score: Column | str, q25: Column | float) -> Column:
    """Strict score < q25; a null score counts as 0."""
    q25 = q25 if isinstance(q25, Column) else F.lit(q25)
    return F.coalesce(_c(score) < q25, F.lit(False)).cast("int")


def low_performance(score: Column | str, cut: float = 250.0) -> Column:
    """Score < fixed cut (null stays null)."""
    return (_c(score) < F.lit(cut)).cast("int")


def priority_label(score: Column | str, p25: Column | float) -> Column:
    """Score < training P25."""
    p25 = p25 if isinstance(p25, Column) else F.lit(p25)
    return (_c(score) < p25).cast("int")


# English performance levels in order.
ENGLISH_LEVELS = ["A-", "A1", "A2", "B1", "B+"]


def level_keep(col: Column | str) -> Column:
    """C30 filter: known English level."""
    return _c(col).isin(*ENGLISH_LEVELS)


def level_binary(col: Column | str) -> Column:
    """C30 binary target: B1 or B+."""
    return _c(col).isin("B1", "B+").cast("int")


def effect_label(d: Column | str) -> Column:
    """Cohen's magnitude on |d|."""
    a = F.abs(_c(d))
    return (
        F.when(a.isNull(), F.lit(None))
        .when(a < 0.2, "negligible")
        .when(a < 0.5, "small")
        .when(a < 0.8, "medium")
        .otherwise("large")
    )


def p_label(p: Column | str) -> Column:
    """Significance stars, else p=0.xxxx."""
    c = _c(p)
    return (
        F.when(c.isNull(), F.lit(None))
        .when(c < 0.001, "p<0.001 *** (altamente significativo)")
        .when(c < 0.01, "p<0.01 ** (muy significativo)")
        .when(c < 0.05, "p<0.05 * (significativo)")
        .otherwise(F.format_string("p=%.4f (no significativo al 5%%)", c))
    )


def scenario_label(proba: Column | str, cut: float = 0.5) -> Column:
    """C33."""
    return F.when(_c(proba) >= cut, "Prioridad ALTA").otherwise("Prioridad estándar")


def clip_pred(col: Column | str, lo: float, hi: float, digits: int) -> Column:
    """Clip to [lo, hi] then round half-even."""
    return F.bround(F.least(F.greatest(_c(col), F.lit(lo)), F.lit(hi)), digits)


def flag_significant(p: Column | str, alpha: float = 0.05) -> Column:
    """T11: 'Si' below alpha, else 'No'."""
    return F.when(_c(p) < alpha, "Si").otherwise("No")


# ------------------------------------------------------------- run names --

# Run-name prefixes, tried in this order, first match stripped.
RUN_PREFIXES = ["p2_clf_clf_", "p2_clf_", "clf_bin_", "clf_", "reg_"]


def _strip_prefix(c: Column, prefixes: list[str]) -> Column:
    out = None
    for p in prefixes:
        cut = F.substring(c, len(p) + 1, 1 << 20)
        out = F.when(c.startswith(p), cut) if out is None else out.when(c.startswith(p), cut)
    return out.otherwise(c)


def run_arch(name: Column | str, prefixes: list[str] | None = None) -> Column:
    """Strip the first matching prefix, keep what follows '_mlp_', '_' -> '-'."""
    stripped = _strip_prefix(_c(name), prefixes or RUN_PREFIXES)
    after = F.when(stripped.contains("_mlp_"), F.substring_index(stripped, "_mlp_", -1)).otherwise(stripped)
    return F.regexp_replace(after, "_", "-")


def run_task(name: Column | str) -> Column:
    """Model family of a run name."""
    c = _c(name)
    return (
        F.when(c.startswith("p2_clf_") | c.startswith("clf_bin_") | c.startswith("clf_"), "Clasificación binaria")
        .when(c.startswith("reg_"), "Regresión")
        .otherwise("")
    )


def run_var_lists(selected: Column | str, catalogue: list[str], labels: Mapping[str, str] | None = None):
    """(included, excluded) display strings of a comma-separated
    selected-variable list against the catalogue; N/D when nothing is known."""
    sel = F.filter(F.transform(F.split(F.coalesce(_c(selected), F.lit("")), ","), lambda x: F.trim(x)),
                   lambda x: x != "")
    cat = F.array(*[F.lit(v) for v in catalogue])
    excluded = F.filter(cat, lambda v: ~F.array_contains(sel, v))
    lab = (lambda arr: F.transform(arr, lambda v: label_map(v, labels))) if labels else (lambda arr: arr)
    empty = F.size(sel) == 0
    inc = F.when(empty, "N/D").otherwise(F.array_join(lab(sel), ", "))
    exc = F.when(empty, "N/D").otherwise(F.array_join(lab(excluded), ", "))
    return inc, exc


def label_map(col: Column | str, mapping: Mapping[str, str]) -> Column:
    """Display labels; unmapped kept."""
    return relabel(col, mapping)
