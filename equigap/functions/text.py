"""Text folding on the JVM: NFKD compatibility decomposition, then ASCII only.

Spark has no Unicode normaliser, so the fold is derived *by rule* from the
Python ``unicodedata`` tables once on the driver and shipped as literals:

* one ``translate`` for every code point whose NFKD form keeps exactly one
  ASCII character (``é`` -> ``e``);
* a small char -> string map, applied only to strings that contain such a
  character, for code points that expand to several ASCII characters
  (``ﬁ`` -> ``fi``, ``½`` -> ``12``);
* a regex that drops everything still outside ASCII (combining marks,
  ``ß``, CJK ...).

Per-code-point decomposition followed by the ASCII filter equals whole-string
NFKD followed by the filter, because canonical reordering only moves
combining marks, which the filter drops anyway.  Everything stays inside
whole-stage codegen; no Python worker is involved.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() whitespace: Unicode White_Space plus \x1c-\x1f.
_WS = "[\\p{IsWhite_Space}\\x1C-\\x1F]"


@functools.lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    src, dst, multi = [], [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        decomp = unicodedata.normalize("NFKD", ch)
        if decomp == ch:
            continue  # no decomposition: non-ASCII, dropped by the final regex
        folded = decomp.encode("ascii", "ignore").decode("ascii")
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        elif len(folded) > 1:
            multi[ch] = folded
    return "".join(src), "".join(dst), multi


def ascii_fold(col: Column | str) -> Column:
    """NFKD + drop non-ASCII (no trimming)."""
    c = F.col(col) if isinstance(col, str) else col
    src, dst, multi = _fold_tables()
    keys = sorted(multi)
    mapping = F.create_map(*[x for k in keys for x in (F.lit(k), F.lit(multi[k]))])
    # detection by deletion: a string holds an expanding character iff
    # deleting all of them shortens it (a translate is ~25x cheaper than a
    # regex over a 400-character class)
    expanded = F.when(
        F.length(F.translate(c, "".join(keys), "")) < F.length(c),
        F.array_join(
            F.transform(F.regexp_extract_all(c, F.lit("(?s)(.)"), 1), lambda ch: F.coalesce(mapping[ch], ch)),
            "",
        ),
    ).otherwise(c)
    single = F.translate(expanded, src, dst)
    return F.regexp_replace(single, "[^\\x00-\\x7F]", "")


def py_strip(col: Column) -> Column:
    """Python ``str.strip()``."""
    return F.regexp_replace(col, f"^{_WS}+|{_WS}+$", "")


def fold_text(col: Column | str) -> Column:
    """NFKD -> ASCII -> strip -> remove one pair of enclosing quotes.

    The strip happens before the quote removal, so spaces inside the quotes
    stay.  ``[^\\n]*`` mirrors Python's ``.`` (which excludes only newline).
    """
    stripped = py_strip(ascii_fold(col))
    return F.regexp_replace(stripped, '^"([^\\n]*)"$', "$1")


def upper_key(col: Column | str) -> Column:
    """upper(trim(x)) as the reference's str.upper().str.strip()."""
    c = F.col(col) if isinstance(col, str) else col
    return py_strip(F.upper(c))


def normalize_key(col: Column | str) -> Column:
    """Strip + upper + NFKD + ASCII; null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    return ascii_fold(F.upper(py_strip(c)))
