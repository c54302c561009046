"""Multiple OLS significance (T08) and partial F tests.

The design is never built: facts are only summed.  One aggregate gives means,
deviations and cross products of the numeric columns (of values shifted by
their means, so columns of 1e9 next to flags lose no digits); one more,
exploding each row into its pairs of categorical levels, gives the sparse
part: how often two levels meet and the numeric sums per level, combined
map-side.  What is collected is one row per pair of levels that occurs, no
more than the p x p matrix of the model itself.

Linear algebra runs on the correlation matrix of the centred, scaled columns:
its rank and pseudo-inverse do not depend on units.  Where columns depend on
each other (``tic_score = internet + computer``) the coefficients are those
of least norm in the columns' own units, as a pseudo-inverse of the design
would give.  The tests of all 2^N combinations are rows, evaluated in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigap.operators.quantiles import column_medians
from equigap.session import materialize
from equigap.stats.tails import f_sf, t_sf2

NO_VALUE = "SIN_INFO"
#: Eigenvalues of a correlation matrix below this are dependencies.
TOLERANCE = 1e-10


@dataclass
class OlsFit:
    names: list[str]          # design column names, "const" first
    beta: np.ndarray
    cov: np.ndarray           # of beta, for residual variance 1
    rss: float
    tss: float
    n: int
    rank: int

    @property
    def df_resid(self) -> float:
        return self.n - self.rank

    @property
    def sigma2(self) -> float:
        return self.rss / self.df_resid if self.df_resid > 0 else float("nan")

    @property
    def r2(self) -> float:
        return 1.0 - self.rss / self.tss if self.tss > 0 else float("nan")

    @property
    def adj_r2(self) -> float:
        return 1.0 - (1.0 - self.r2) * (self.n - 1) / self.df_resid if self.df_resid > 0 else float("nan")

    def t_table(self) -> list[tuple[str, float, float, float]]:
        se = np.sqrt(np.maximum(np.diag(self.cov) * self.sigma2, 0.0))
        out = []
        for i, nm in enumerate(self.names):
            t = self.beta[i] / se[i] if se[i] > 0 else float("nan")
            out.append((nm, float(self.beta[i]), float(t), t_sf2(float(t), float(self.df_resid))))
        return out

    def f_test(self, cols: list[str]) -> float | None:
        """Wald F p-value of H0: beta[cols] = 0."""
        place = {c: i for i, c in enumerate(self.names)}
        idx = [place[c] for c in cols if c in place]
        if not idx:
            return None
        size = np.sqrt(np.maximum(np.diag(self.cov)[idx], 0.0))
        used = [i for i, s in zip(idx, size) if s > 0]
        if not used:
            return None
        size = size[size > 0]
        b, r = self.beta[used] / size, self.cov[np.ix_(used, used)] / np.outer(size, size)  # of units 1
        value, vector = np.linalg.eigh(r)
        real = value > TOLERANCE * max(1.0, value[-1])
        part = vector[:, real].T @ b
        q = int(real.sum())
        return f_sf(float(part @ (part / value[real])) / q / self.sigma2, float(q), float(self.df_resid))


@dataclass
class Moments:
    """Means and centred cross products of the design columns (without the
    constant) and of y."""
    names: list[str]
    n: int
    mean: np.ndarray
    cross: np.ndarray
    y_mean: float
    y_cross: np.ndarray
    y_square: float


def moments(df: DataFrame, y: str, numeric: list[str], categorical: list[str]) -> tuple[Moments, dict[str, list[str]]]:
    """Moments of the design (numeric columns with their medians for nulls,
    drop-first dummies in lexicographic order), and each variable's columns."""
    used = list(dict.fromkeys([y, *numeric, *categorical]))
    # four passes follow: write the columns once instead of the joins below them each time
    base = materialize(df.where(F.col(y).try_cast("double").isNotNull()).select(*used), "ols")
    medians = column_medians(base, numeric)
    filled = [F.coalesce(F.col(c).try_cast("double"), F.lit(medians[c]).cast("double"), F.lit(0.0)) for c in numeric]
    level = [F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE)) for c in categorical]
    k, c = len(numeric), len(categorical)
    x = base.select(F.col(y).try_cast("double").alias("y"), *[e.alias(f"x{i}") for i, e in enumerate(filled)], *[e.alias(f"g{i}") for i, e in enumerate(level)])
    first = x.agg(F.count("*"), F.avg("y"), *[F.avg(f"x{i}") for i in range(k)]).first()
    n = int(first[0])
    if not n:
        return Moments(list(numeric), 0, np.zeros(k), np.zeros((k, k)), 0.0, np.zeros(k), 0.0), {v: [v] for v in numeric}
    means = np.array(first[1:], float)  # y, then the numeric columns
    shifted = [F.col("y") - F.lit(float(means[0])), *[F.col(f"x{i}") - F.lit(float(means[1 + i])) for i in range(k)]]
    z = x.select(*[s.alias(f"z{i}") for i, s in enumerate(shifted)], *[f"g{i}" for i in range(c)])
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    dense = z.agg(*[F.sum(F.col(f"z{i}") * F.col(f"z{j}")) for i, j in pairs]).first()
    core = np.zeros((k + 1, k + 1))
    for (i, j), v in zip(pairs, dense):
        core[i, j] = core[j, i] = v or 0.0

    groups = {v: [v] for v in numeric}
    names, met, sums = list(numeric), {}, {}
    if c:
        entry = lambda i, j: F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"g{i}").alias("a"), F.col(f"g{j}").alias("b"))
        each = z.select(*[f"z{i}" for i in range(k + 1)], F.explode(F.array(*[entry(i, j) for i in range(c) for j in range(i, c)])).alias("e"))
        own = F.col("e.i") == F.col("e.j")
        for r in each.groupBy("e").agg(F.count("*"), *[F.sum(F.when(own, F.col(f"z{i}"))) for i in range(k + 1)]).collect():
            met[r[0]] = r[1]
            if r[0].i == r[0].j:
                sums[r[0].i, r[0].a] = r[1:]
        for g in range(c):
            levels = sorted(a for i, a in sums if i == g)[1:]
            if levels:
                groups[categorical[g]] = [f"{categorical[g]}__{a}" for a in levels]
                names += groups[categorical[g]]
    at = {(g, a): k + p for p, (g, a) in enumerate((g, a) for g in range(c) for a in sorted(a for i, a in sums if i == g)[1:])}
    p = len(names)
    mean, cross, y_cross = np.zeros(p), np.zeros((p, p)), np.zeros(p)
    mean[:k], cross[:k, :k], y_cross[:k] = means[1:], core[1:, 1:], core[0, 1:]
    for (g, a), row in at.items():
        count, with_y, *with_x = sums[g, a]
        mean[row], y_cross[row] = count / n, with_y or 0.0
        cross[row, :k] = cross[:k, row] = np.array([v or 0.0 for v in with_x])
    dummies = range(k, p)
    cross[k:, k:] = -n * np.outer(mean[k:], mean[k:])  # pairs that never meet
    for e, count in met.items():
        i, j = at.get((e.i, e.a)), at.get((e.j, e.b))
        if i in dummies and j in dummies:
            cross[i, j] += count
            if i != j:
                cross[j, i] += count
    return Moments(names, n, mean, cross, float(means[0]), y_cross, float(core[0, 0])), groups


def fit(m: Moments, keep: list[str] | None = None) -> OlsFit:
    place = {c: i for i, c in enumerate(m.names)}
    idx = [place[c] for c in (m.names if keep is None else keep)]
    names, p = ["const", *(m.names[i] for i in idx)], len(idx)
    cross, y_cross, mean = m.cross[np.ix_(idx, idx)], m.y_cross[idx], m.mean[idx]
    size = np.sqrt(np.maximum(np.diag(cross), 0.0))
    flat = size <= 1e-12 * np.sqrt(max(m.n, 1)) * np.abs(mean)  # constant columns
    unit = np.where(flat, 1.0, size)
    r = cross / np.outer(unit, unit)
    r[flat, :] = r[:, flat] = 0.0
    value, vector = np.linalg.eigh(r) if p else (np.zeros(0), np.zeros((0, 0)))
    real = value > TOLERANCE * max(1.0, value[-1] if p else 1.0)
    scaled = np.where(flat, 0.0, y_cross / unit)
    part = vector[:, real].T @ scaled
    explained = float(part @ (part / value[real]))
    # In the columns' own units, with the intercept in front: beta = L b + (y_mean, 0..).
    back = np.vstack([-mean / unit, np.diag(1.0 / unit)]) if p else np.zeros((1, 0))
    beta = back @ (vector[:, real] @ (part / value[real]))
    beta[0] += m.y_mean
    half = back @ (vector[:, real] / np.sqrt(value[real]))
    cov = half @ half.T
    if m.n:
        cov[0, 0] += 1.0 / m.n
    if not real.all():  # least norm among the solutions
        null, _ = np.linalg.qr(back @ vector[:, ~real])
        off = np.eye(p + 1) - null @ null.T
        beta, cov = off @ beta, off @ cov @ off.T
    return OlsFit(names, beta, cov, max(m.y_square - explained, 0.0), m.y_square, m.n, int(real.sum()) + 1)


def ols(spark: SparkSession, df: DataFrame, y: str, numeric: list[str], categorical: list[str], selected: list[str]):
    """T08 + T10.  Returns (summary, t-tests, F-tests) as small DataFrames.

    * summary: n_obs, r2, adj_r2 of the model on the selected variables;
    * t-tests: coef, t, p, Si/No for each selected numeric variable;
    * F-tests: per variable on the full model (incluida Si/No), and every
      combination of 2..N selected variables joined with ' + '.
    """
    m, groups = moments(df, y, numeric, categorical)
    full, sel = fit(m), fit(m, list(dict.fromkeys(c for v in selected for c in groups.get(v, []))))
    summary = spark.createDataFrame([(int(m.n), float(sel.r2), float(sel.adj_r2), len(selected))], "n_obs long, r2 double, adj_r2 double, combo_vars int")
    yes = lambda p: "Si" if p is not None and p < 0.05 else "No"
    t = spark.createDataFrame([(nm, b, t, p, yes(p)) for nm, b, t, p in sel.t_table() if nm in numeric and nm in selected],
                              "variable string, coef double, t_stat double, p_value double, significativa string")

    singles, chosen = list(groups), [v for v in selected if v in groups]

    def test(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Row -1 - i: variable i of the full model; row r: the selected
        variables whose bits r has."""
        for part in parts:
            rows = []
            for r in part["id"]:
                own = [singles[-1 - r]] if r < 0 else [v for i, v in enumerate(chosen) if r >> i & 1]
                p = full.f_test([c for v in own for c in groups[v]])
                rows.append((" + ".join(own), p, "Si" if r >= 0 or own[0] in selected else "No", yes(p)))
            yield pd.DataFrame(rows, columns=["variable", "p_value", "incluida", "significativa"])

    ids = spark.range(-len(singles), 1 << len(chosen)).where("id < 0 or bit_count(id) >= 2")
    return summary, t, ids.mapInPandas(test, "variable string, p_value double, incluida string, significativa string")
