"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share, by weight, of ``share`` times all words,
stopped at ``max_copies`` times its size; what is cut off is shared again
among the others.  Within a source a document of weight w is expected
min(max_copies, c * w) times, with c such that the expectation meets the
target.  The whole part of that is certain.  The rest is drawn: documents are
ranked by the odds of a random number over the odds of their inclusion
(Pareto order sampling), and taken in that order until the source's remaining
words are used up, so the sample's size is fixed and its inclusion
probabilities are unequal.  The document on the edge is in if that brings the
source nearer to its target.

The random number is a hash of seed, id and text, so reruns agree and a lost
task draws the same.  The edge is found by refinement, not by sorting a
source in one task: sizes are added up in 4,096 classes of the logarithm of
the rank, then in 4,096 classes within the class on the edge; only rows
within that last class are sorted.  A source with a third of all rows
costs as much per task as any other.

Defined cases: a null text has size 0; documents of size 0 are never taken; a
null source is a source of its own, ordered last; null ids and repeated rows
are rows of their own.  An empty table, or one without words, gives targets
of 0.  Other columns are not read by ``mix``, and kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import Scratch, fresh, small, word_count

WEIGHTS, SHARE, MAX_COPIES, SEED = (3, 1, 2), 1.5, 2, "mix-1"
#: Classes of the log rank: 64 to the unit between -32 and 32, then 4,096 in each.
UNIT, SPAN, FINE = 64, 32, 4096


def document_weight(size: Column) -> Column:
    """Weights of documents within a source, few integers: documents under 50
    words are half as likely as others."""
    return F.when(size < 50, 1).otherwise(2)


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the first 13 hex digits of a hash."""
    digits = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long")
    return (digits.cast("double") + 0.5) / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """``sizes``: a row per (source, level) with words.  Per source: its size
    and its target, by filling up the sources in the order in which they reach
    their stops.  The windows run over one row per source."""
    per = sizes.groupBy("source").agg(F.sum("words").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("stop", F.col("source_size").cast("double") * max_copies)
    order = Window.orderBy(F.col("stop") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()).cast("double") * share
    per = per.withColumn("level", (total - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("w").over(after))
    per = per.withColumn("free", F.col("level") * F.col("w") < F.col("stop"))
    level = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return per.select("source", "source_size", F.when(F.col("free"), level * F.col("w")).otherwise(F.col("stop")).alias("target"))


def expected_copies(sizes: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """Per (source, level): the expected copies of a document, and per source
    the words left to draw after the certain copies."""
    groups = sizes.join(targets, F.expr("source <=> t_source")).select(
        "source", "weight", "words", "source_size", "target").withColumn("ww", F.col("words") * F.col("weight"))
    order = Window.partitionBy("source").orderBy(F.col("weight").desc())
    above, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    c = (F.col("target") - max_copies * F.coalesce(F.sum("words").over(above), F.lit(0))) / F.nullif(F.sum("ww").over(rest), F.lit(0))
    groups = groups.withColumn("c", c).withColumn("free", F.col("c") * F.col("weight") < max_copies)
    groups = groups.withColumn("c", F.first(F.when(F.col("free"), F.col("c")), ignorenulls=True).over(whole))
    copies = F.when(F.col("words") == 0, 0.0).when(F.col("free"), F.col("c") * F.col("weight")).otherwise(float(max_copies))
    groups = groups.withColumn("copies", copies).withColumn("certain", F.floor("copies"))
    left = F.col("target") - F.sum(F.col("certain") * F.col("words")).over(Window.partitionBy("source"))
    return groups.select("source", "weight", "source_size", "target", "certain", (F.col("copies") - F.col("certain")).alias("p"), left.alias("left"))


def _edge(classes: DataFrame) -> DataFrame:
    """Of (source, class, words, left): each source's classes with the words
    before them, marked full (all taken) or edge."""
    upto = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = classes.withColumn("after", F.col("base") + F.sum("words").over(upto))
    c = c.withColumn("before", F.col("after") - F.col("words"))
    return c.select("source", "class", "before", (F.col("after") <= F.col("left")).alias("full"),
                    ((F.col("before") <= F.col("left")) & (F.col("after") > F.col("left"))).alias("edge"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights=WEIGHTS,
        share: float = SHARE, max_copies: int = MAX_COPIES, document_weight=document_weight, seed: str = SEED, row_col: str | None = None) -> DataFrame:
    """One row per input row: row (its number, ``row_col`` if there is one),
    ``id_col``, size, source_size, target, copies, taken."""
    scratch = Scratch(docs.sparkSession, "mix")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       word_count(text).alias("size"), uniform(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text)).alias("u"))
    rows = scratch.write(rows.withColumn("weight", document_weight(F.col("size")).cast("int")), "rows")

    sizes = scratch.write(rows.groupBy("source", "weight").agg(F.sum("size").alias("words")), "sizes")
    targets = source_targets(sizes, weights, share, max_copies).withColumnRenamed("source", "t_source")
    plan = scratch.write(expected_copies(sizes, targets, max_copies), "plan")

    p = plan.withColumnsRenamed({"source": "p_source", "weight": "p_weight"})
    odds = (F.col("u") / (1 - F.col("u"))) * ((1 - F.col("p")) / F.col("p"))
    ranked = rows.join(p, F.expr("source <=> p_source and weight = p_weight")).withColumn(
        "rank", F.when((F.col("p") > 0) & (F.col("size") > 0), odds))
    fine = F.floor((F.greatest(F.lit(-float(SPAN)), F.least(F.lit(SPAN - 1e-9), F.log("rank"))) + SPAN) * UNIT * FINE).cast("long")
    ranked = scratch.write(ranked.select("row", "id", "source", "size", "source_size", "target", "certain", "left", "rank",
                                         fine.alias("fine"), (fine / FINE).cast("long").alias("coarse")), "ranked")
    drawn = ranked.where("rank is not null")

    sums = drawn.groupBy("source", F.col("coarse").alias("class")).agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    coarse = scratch.write(_edge(sums.withColumn("base", F.lit(0))), "coarse")
    on_edge = coarse.where("edge").select(F.col("source").alias("e_source"), F.col("class").alias("e_class"), F.col("before").alias("base"))
    sums = (drawn.join(on_edge, F.expr("source <=> e_source and coarse = e_class"))
            .groupBy("source", F.col("fine").alias("class")).agg(F.sum("size").alias("words"), F.first("left").alias("left"), F.first("base").alias("base")))
    finer = scratch.write(_edge(sums), "finer")

    # Rows of the last class are taken one by one, in rank order.
    last = finer.where("edge").select(F.col("source").alias("e_source"), F.col("class").alias("e_class"), F.col("before").alias("base"))
    one = Window.partitionBy("source").orderBy("rank", "id", "row").rowsBetween(Window.unboundedPreceding, -1)
    near = (drawn.join(last, F.expr("source <=> e_source and fine = e_class"))
            .withColumn("taken_before", F.col("base") + F.coalesce(F.sum("size").over(one), F.lit(0)))
            .where(2 * F.col("taken_before") + F.col("size") <= 2 * F.col("left")).select(F.col("row").alias("n_row"), F.lit(True).alias("near")))
    near = scratch.write(near, "near")

    c = coarse.select(F.col("source").alias("c_source"), F.col("class").alias("c_class"), F.col("full").alias("c_full"))
    f = finer.where("full").select(F.col("source").alias("f_source"), F.col("class").alias("f_class"), F.lit(True).alias("f_full"))
    out = (ranked.join(c.where("c_full"), F.expr("source <=> c_source and coarse = c_class"), "left")
           .join(f, F.expr("source <=> f_source and fine = f_class"), "left").join(near, F.col("row") == F.col("n_row"), "left"))
    extra = F.coalesce(F.col("c_full"), F.col("f_full"), F.col("near"), F.lit(False)).cast("int")
    copies = F.when(F.col("size") > 0, F.col("certain") + extra).otherwise(0).cast("long")
    return out.select("row", F.col("id").alias(id_col), "size", F.col("source_size").cast("long"), "target",
                      copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as the mix takes it, with the
    input's columns."""
    row, t_row, copies = fresh(docs, "mix_row", "mix_t_row", "mix_copies")
    scratch = Scratch(docs.sparkSession, "mixed")
    placed = scratch.numbered(docs, row)
    taken = mix(placed, row_col=row, **options).where("copies > 0").select(F.col("row").alias(t_row), F.col("copies").alias(copies))
    placed = placed.join(small(scratch.write(taken, "taken"), 48), F.col(row) == F.col(t_row))
    each = F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))).alias(copies)
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], each).drop(copies)
