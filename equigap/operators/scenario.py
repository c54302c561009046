"""Scenarios and counterfactuals (X01-X08): batch scoring with fitted
pipelines.  A scenario is a row; many scenarios are one DataFrame, scored by
one ``transform`` (no per-scenario driver loop)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigap.functions import labels as L
from equigap.ml.training import detached
from equigap.operators.util import one_row


def score(model: PipelineModel, rows: DataFrame, kind: str = "regresion", lo: float = 0.0, hi: float = 500.0) -> DataFrame:
    """Score rows: regression -> clipped, rounded score; binary -> clipped
    probability + label (C33, C34)."""
    out = detached(model).transform(rows)
    if kind == "regresion":
        return out.withColumn("score", L.clip_pred("prediction", lo, hi, 1))
    proba = vector_to_array("probability")[1] if "probability" in out.columns else F.col("prediction")
    return out.withColumn("proba", L.clip_pred(proba, 0.0, 1.0, 4)).withColumn("etiqueta", L.scenario_label("proba"))


def score_scenarios(model: PipelineModel, scenarios: DataFrame, id_col: str = "scenario_id", side_col: str = "side",
                    kind: str = "regresion") -> DataFrame:
    """Score A and B rows of each scenario and report B - A deltas
    (the rows are scored once and paired by the scenario id)."""
    s = score(model, scenarios, kind)
    val = "score" if kind == "regresion" else "proba"
    side = lambda x: F.max(F.when(F.col(side_col) == x, F.col(val)))
    both = s.groupBy(id_col).agg(side("A").alias("a"), side("B").alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    return both.withColumn("delta", F.bround(F.col("b") - F.col("a"), 4))


def scenario_inputs(form: DataFrame, gdp: DataFrame | None = None, region_col: str = "municipio") -> DataFrame:
    """Scenario rows with derived TIC columns (C17, C21) and GDP from
    the J08 lookup table; unset values stay null (imputed by the model)."""
    out = form
    if "fami_tieneinternet" in form.columns and "fami_tienecomputador" in form.columns:
        i, c = L.form_flag("fami_tieneinternet"), L.form_flag("fami_tienecomputador")
        out = out.withColumn("internet_flag", i).withColumn("computador_flag", c).withColumn(
            "tic_score", L.tic_score(i, c)).withColumn("tic_interaccion", L.tic_interaction(i, c))
    if gdp is not None and region_col in form.columns:
        out = out.join(gdp, region_col, "left")  # one row per requested region
    return out


def flip(df: DataFrame, col: str, a: str, b: str, id_col: str = "scenario_id") -> DataFrame:
    """A = the rows as given, B = the same rows with ``col`` swapped
    between the two values; both from one row, under the key ``id_col``."""
    if id_col not in df.columns:
        raise ValueError(f"scenarios need a key: no column {id_col}")
    swapped = F.when(F.col(col) == a, b).when(F.col(col) == b, a).otherwise(F.col(col))
    sides = F.explode(F.array(F.struct(F.lit("A").alias("side"), F.col(col).alias("v")), F.struct(F.lit("B").alias("side"), swapped.alias("v"))))
    both = df.withColumn("__s", sides)
    return both.select(*[F.col("__s.v").alias(c) if c == col else F.col(c) for c in df.columns], F.col("__s.side").alias("side"))


def mean_impact(model: PipelineModel, df: DataFrame, set_a: dict, set_b: dict, kind: str = "regresion") -> DataFrame:
    """Average prediction difference when every row is set to
    ``set_b`` versus ``set_a``: each row carries both variants through one
    transform and one aggregate."""
    value = lambda v, c: F.col(c) if v is None else v if not isinstance(v, (str, int, float)) else F.lit(v)
    changed = list(dict.fromkeys([*set_a, *set_b]))
    variant = lambda side, own: F.struct(F.lit(side).alias("side"), *[value(own.get(c), c).cast(df.schema[c].dataType).alias(c) for c in changed])
    both = df.withColumn("__v", F.explode(F.array(variant(0, set_a), variant(1, set_b))))
    both = both.select(*[F.col(f"__v.{c}").alias(c) if c in changed else F.col(c) for c in df.columns], F.col("__v.side").alias("__side"))
    out = detached(model).transform(both)
    p = F.col("prediction") if kind == "regresion" else vector_to_array("probability")[1]
    mean = lambda side: F.avg(F.when(F.col("__side") == side, p))
    return out.agg((mean(1) - mean(0)).alias("impacto_medio"), F.count_if(F.col("__side") == 0).alias("n"))


def zone_impact(model: PipelineModel, df: DataFrame, zone_col: str = "Area", kind: str = "regresion") -> DataFrame:
    """Predict every complete row as Urbano and as Rural."""
    return mean_impact(model, df.dropna(), {zone_col: "Rural"}, {zone_col: "Urbano"}, kind)


def tic_impact(model: PipelineModel, df: DataFrame, kind: str = "regresion", features: list[str] | None = None) -> DataFrame:
    """Every row with complete ``features`` as observed, versus with the
    flags it has set to 1; an absent flag counts 0, so score and interaction
    follow from the flags present.  Not defined for multiclass."""
    flags = [c for c in ("internet_flag", "computador_flag") if c in df.columns]
    alt = {c: 1 for c in flags}
    if "tic_score" in df.columns:
        alt["tic_score"] = len(flags)
    if "tic_interaccion" in df.columns:
        alt["tic_interaccion"] = int(len(flags) == 2)
    return mean_impact(model, df.dropna(subset=features or df.columns), {}, alt, kind)


def adjusted_gap_table(models: dict[str, PipelineModel], grid: DataFrame, target_col: str = "target",
                       stratum: str = "fami_estratovivienda", group: str = "cole_naturaleza",
                       private: str = "NO OFICIAL", public: str = "OFICIAL") -> DataFrame:
    """Per target and stratum, private - public prediction on a fixed
    profile; predictions rounded 2 first, then the difference rounded 2."""
    parts = []
    for target, model in models.items():
        g = grid.where(F.col(target_col) == target)
        p = detached(model).transform(g).select(target_col, stratum, group, F.bround("prediction", 2).alias("pred"))
        parts.append(p)
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    t = allp.groupBy(target_col, stratum).agg(
        F.max(F.when(F.col(group) == public, F.col("pred"))).alias("pred_oficial"),
        F.max(F.when(F.col(group) == private, F.col("pred"))).alias("pred_privado"))
    return t.select(
        F.col(target_col).alias("target"),
        F.regexp_replace(F.col(target_col), "^punt_", "").alias("slug"),
        F.col(stratum).alias("estrato"),
        "pred_oficial", "pred_privado",
        F.bround(F.col("pred_privado") - F.col("pred_oficial"), 2).alias("brecha_ajustada"),
    )


def predicted_level(pred: DataFrame, labels: list[str], out: str = "nivel_predicho") -> DataFrame:
    """Arg-max class index -> label."""
    return IndexToString(inputCol="prediction", outputCol=out, labels=labels).transform(pred)


def result_facts(best: DataFrame, impacts: DataFrame) -> DataFrame:
    """Best metrics per task next to the impact estimates (one row per
    task; the impacts frame is one row)."""
    vals = one_row(impacts)  # the impact record is one row
    return best.select("*", *[F.lit(v).alias(k) for k, v in vals.items()])
