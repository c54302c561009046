"""Role binding: which physical column plays which analytical role.

Roles are resolved once, on ``df.columns`` at plan time (never on data).  A
role maps to the first candidate present; the insights rule also allows a
substring fallback (``exact_only=False``).  A missing role is ``None`` and the
operators that need it return null columns instead of failing.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

# Candidate column names per role, in priority order.
CANDIDATES: dict[str, list[str]] = {
    "score": ["punt_global", "puntaje_global", "global"],
    "math": ["punt_matematicas", "matematicas", "matematicas_punt"],
    "reading": ["punt_lectura_critica", "punt_lectura", "lectura"],
    "science": ["punt_c_naturales", "punt_ciencias", "c_naturales", "ciencias"],
    "social": ["punt_sociales_ciudadanas", "punt_sociales", "sociales"],
    "english": ["punt_ingles", "ingles"],
    "zone": ["cole_area_ubicacion", "area_ubicacion", "ubicacion"],
    "residence": ["estu_areareside"],
    "school_type": ["cole_naturaleza", "naturaleza"],
    "stratum": ["fami_estratovivienda", "estrato"],
    "internet": ["fami_tieneinternet", "tiene_internet", "internet"],
    "computer": ["fami_tienecomputador", "tiene_computador", "computador"],
    "region": ["cole_mcpio_ubicacion", "mcpio_ubicacion", "municipio"],
    "region_code": ["cole_cod_mcpio_ubicacion"],
    "gender": ["estu_genero", "cole_genero", "genero", "sexo"],
    "period": ["periodo"],
    "student_id": ["estu_consecutivo"],
    "english_level": ["desemp_ingles"],
    "shift": ["cole_jornada"],
    "bilingual": ["cole_bilingue"],
    "mother_edu": ["fami_educacionmadre"],
    "father_edu": ["fami_educacionpadre"],
    "household": ["fami_personashogar"],
}


@dataclass(frozen=True)
class Roles:
    score: str | None = "punt_global"
    math: str | None = "punt_matematicas"
    reading: str | None = "punt_lectura_critica"
    science: str | None = "punt_c_naturales"
    social: str | None = "punt_sociales_ciudadanas"
    english: str | None = "punt_ingles"
    zone: str | None = "cole_area_ubicacion"
    residence: str | None = None
    school_type: str | None = "cole_naturaleza"
    stratum: str | None = "fami_estratovivienda"
    internet: str | None = "fami_tieneinternet"
    computer: str | None = "fami_tienecomputador"
    region: str | None = "cole_mcpio_ubicacion"
    region_code: str | None = "cole_cod_mcpio_ubicacion"
    gender: str | None = "estu_genero"
    period: str | None = "periodo"
    student_id: str | None = "estu_consecutivo"
    english_level: str | None = "desemp_ingles"
    shift: str | None = "cole_jornada"
    bilingual: str | None = "cole_bilingue"
    mother_edu: str | None = "fami_educacionmadre"
    father_edu: str | None = "fami_educacionpadre"
    household: str | None = "fami_personashogar"
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def subjects(self) -> list[str]:
        """The six metrics in the fixed order maths, reading, science,
        social, English, global (present ones only)."""
        cols = [self.math, self.reading, self.science, self.social, self.english, self.score]
        return [c for c in cols if c]

    def with_(self, **kw) -> "Roles":
        return replace(self, **kw)


def _first_present(columns: list[str], candidates: list[str], exact_only: bool) -> str | None:
    present = set(columns)
    for c in candidates:
        if c in present:
            return c
    if exact_only:
        return None
    for c in columns:
        low = c.lower()
        for cand in candidates:
            if cand.replace("_", "").lower() in low:
                return c
    return None


def resolve_roles(columns: list[str], exact_only: bool = True, **overrides: str | None) -> Roles:
    """Bind every role to the first candidate column present in ``columns``."""
    kw = {}
    for f in fields(Roles):
        if f.name == "extra":
            continue
        if f.name in overrides:
            kw[f.name] = overrides[f.name]
        else:
            kw[f.name] = _first_present(list(columns), CANDIDATES.get(f.name, []), exact_only)
    return Roles(**kw)
