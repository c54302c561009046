"""Registered queries: one per SURVEY section 2 operator that can run on the
driver tables, each with the DuckDB SQL that computes the same result.

Every query reads the whole bound tables (no id subsets, no row caps); the
only limits are the top-k reports that are the feature (A07, A19, A34, W02,
W03).  Floating outputs are rounded to 6 decimals in both engines so the
value hash is stable under summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _nudge_rounding(sql: str) -> str:
    """Rewrite every ``round(x, 6)`` (not ``round_even``) as
    ``round((x) + 1e-9, 6)``: the same tie rule as the Spark side's r6."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, last_comma = 1, j + 6, None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                last_comma = k
            k += 1
        inner = sql[j + 6:k - 1]
        if last_comma is not None and sql[last_comma + 1:k - 1].strip() == "6":
            arg = _nudge_rounding(sql[j + 6:last_comma])
            out.append(sql[i:j] + f"round(({arg}) + 1e-9, 6)")
        else:
            out.append(sql[i:j] + "round(" + _nudge_rounding(inner) + ")")
        i = k


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            from equigap.plans.tpch import duck

            ORACLE[name] = duck(_nudge_rounding(sql))
        return fn

    return deco


def _load_all():
    # importing the modules registers their queries
    from equigap.plans import q_functions, q_aggregates, q_stats, q_runs, q_ml, q_sources  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
