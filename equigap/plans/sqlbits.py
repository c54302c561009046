"""DuckDB SQL fragments mirroring the Column rules (oracle side only)."""

from __future__ import annotations


def up(c: str) -> str:
    return f"upper(trim({c}))"


def zone_strict(c: str) -> str:
    u = up(c)
    return f"(CASE WHEN {u} LIKE '%RURAL%' THEN 'RURAL' WHEN {u} LIKE '%URB%' THEN 'URBANO' ELSE {u} END)"


def zone_cabecera(c: str) -> str:
    u = up(c)
    return (f"(CASE WHEN {u} LIKE '%RURAL%' THEN 'RURAL' WHEN {u} LIKE '%URB%' OR {u} LIKE '%CABECERA%' "
            f"THEN 'URBANO' ELSE {u} END)")


def zone_residence(c: str) -> str:
    u = f"upper({c})"
    return f"(CASE WHEN {u} LIKE '%CABECERA%' OR {u} LIKE '%URBAN%' THEN 'Urbano' ELSE 'Rural' END)"


def school_type(c: str) -> str:
    u = up(c)
    return (f"(CASE WHEN {u} LIKE '%NO OFICIAL%' OR {u} LIKE '%PRIVAD%' THEN 'PRIVADO' "
            f"WHEN {u} LIKE '%OFICIAL%' OR {u} LIKE '%PUBLIC%' THEN 'PUBLICO' ELSE {u} END)")


def yes_no(c: str) -> str:
    u = up(c)
    return (f"(CASE WHEN {u} IN ('SI','S','1','TRUE','T','Y','YES') THEN 1 "
            f"WHEN {u} IN ('NO','N','0','FALSE','F') THEN 0 END)")


def access2(i: str, c: str) -> str:
    return f"(CASE WHEN coalesce({i} = 1, false) OR coalesce({c} = 1, false) THEN 'CON_ACCESO' ELSE 'SIN_ACCESO' END)"


def norm_key(c: str) -> str:
    # Python / Java upper-case 'ß' as 'SS'; DuckDB keeps it, so expand first
    return f"regexp_replace(strip_accents(upper(replace(trim({c}), 'ß', 'SS'))), '[^\\x00-\\x7F]', '', 'g')"


def fold(c: str) -> str:
    inner = f"trim(regexp_replace(strip_accents({c}), '[^\\x00-\\x7F]', '', 'g'), ' \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f')"
    return f"regexp_replace({inner}, '^\"([^\\n]*)\"$', '\\1')"


def r6(x: str) -> str:
    return f"round({x}, 6)"


def effect(d: str) -> str:
    return (f"(CASE WHEN {d} IS NULL THEN NULL WHEN abs({d}) < 0.2 THEN 'negligible' WHEN abs({d}) < 0.5 THEN 'small' "
            f"WHEN abs({d}) < 0.8 THEN 'medium' ELSE 'large' END)")
