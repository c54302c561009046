"""Exact de-duplication through content-defined chunk recipes.

A text is cut where its own content says so: a chunk ends at the first line
end or sentence end after ``min_chars`` characters, at ``max_chars`` if there
is none.  Equal passages therefore give equal chunks wherever they stand; a
text without line or sentence ends (code, scripts without spaces) is cut every
``max_chars`` characters from where the last end was, so only its equal
beginnings share chunks (the outcome is the same).
Each document becomes a *recipe*, the ordered list of its chunks'
identifiers, and documents are equal when their recipes are.  The long texts
are read where they lie; what travels is 16 bytes a chunk, and each distinct
chunk's text once, to verify that no identifier names two texts.

Identifiers are digests.  Verification groups chunks by (digest, text) with
map-side combining, so a chunk that a third of all documents share is one row
per task.  Should a digest name two texts, both get an ordinal next to the
digest, and the recipes that hold it are rewritten: the outcome never rests
on the digest being free of collisions.

Defined cases: a null text equals the empty text, whose recipe is empty; all
such documents are one group.  Rows that repeat an id are rows of their own;
of equal texts exactly one row stays, the one with the largest id (null ids
lowest), and of rows tied on that any single one.  An empty table gives an
empty result.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import Scratch

MIN_CHARS, MAX_CHARS = 1024, 8192


def chunk_pattern(min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> str:
    return rf"(?s).{{{min_chars},{max_chars}}}?(?:\n|[.!?] )|.{{1,{max_chars}}}"


def chunks(text: Column, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> Column:
    """The text's chunks in order; joined they are the text."""
    return F.regexp_extract_all(text, F.lit(chunk_pattern(min_chars, max_chars)), F.lit(0))


def md5_digest(chunk: Column) -> Column:
    return F.unhex(F.md5(chunk))


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = MIN_CHARS,
                max_chars: int = MAX_CHARS, digest: Callable[[Column], Column] = md5_digest) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept,
    text_sha256, n_chunks."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "chunk-dedup")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    cut = chunks(F.col("text"), min_chars, max_chars)
    recipes = scratch.write(rows.select(
        F.monotonically_increasing_id().alias("row"), "id", F.sha2("text", 256).alias("sha"),
        F.transform(cut, digest).alias("recipe")), "recipes")

    # Verification: each distinct (digest, text) pair once.
    pairs = (rows.select(F.explode(cut).alias("chunk")).select(digest(F.col("chunk")).alias("d"), "chunk")
             .groupBy("d", "chunk").agg(F.count("*").alias("n")))
    clash = scratch.write(pairs.groupBy("d").agg(F.count("*").alias("texts")).where("texts > 1").select("d"), "clashes")
    if not clash.isEmpty():
        recipes = _renamed(scratch, rows, recipes, pairs, clash, cut, digest)

    by_id = recipes.groupBy("recipe", "id").agg(F.max("row").alias("row"), F.count("*").alias("n"))
    groups = scratch.write(by_id.groupBy("recipe").agg(
        F.max("id").alias("keep_id"), F.max_by("row", F.struct(F.col("id").isNotNull(), "id")).alias("keep_row"),
        F.sum("n").alias("group_size")), "groups")
    return recipes.join(groups, "recipe").select(
        F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long"), (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"), F.size("recipe").cast("long").alias("n_chunks"))


def _renamed(scratch: Scratch, rows: DataFrame, recipes: DataFrame, pairs: DataFrame, clash: DataFrame,
             cut: Column, digest: Callable[[Column], Column]) -> DataFrame:
    """Recipes in which every digest that names several texts carries the
    ordinal of the text meant."""
    ordinal = Window.partitionBy("d").orderBy("chunk")
    named = scratch.write(pairs.join(clash, "d", "left_semi").select("d", "chunk", F.row_number().over(ordinal).alias("k")), "named")
    # Equal texts have equal recipes, so a recipe is found again by its text's digest.
    placed = rows.select(F.sha2("text", 256).alias("f_sha"), F.posexplode(cut).alias("pos", "chunk"))
    placed = placed.select("f_sha", "pos", digest(F.col("chunk")).alias("d"), "chunk").join(named, ["d", "chunk"]).select("f_sha", "pos", "k").distinct()
    fixes = placed.groupBy("f_sha").agg(F.map_from_entries(F.collect_list(F.struct("pos", "k"))).alias("fix"))
    fixed = F.transform("recipe", lambda d, i: F.concat(
        d, F.coalesce(F.concat(F.lit("#"), F.element_at("fix", i).cast("string")), F.lit("")).cast("binary")))
    return scratch.write(recipes.join(fixes, F.expr("sha = f_sha"), "left").select(
        "row", "id", "sha", F.when(F.col("fix").isNull(), F.col("recipe")).otherwise(fixed).alias("recipe")), "renamed")
