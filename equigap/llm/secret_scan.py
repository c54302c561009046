"""Secret scans: patterns, and strings that look random to a pair of character
Markov models.

Base spans come from three patterns (assignments to secret-like names, access
keys, hex strings).  The method adds spans: of every run of at least
``MIN_TOKEN`` token characters, the log-likelihood ratio of a model of random
strings to a model of ordinary identifiers is taken, character transition by
character transition, and runs whose ratio exceeds the prior odds against
secrets (``ODDS`` to 1) are added unless they overlap a base span.

Both models are trained here.  Labelled random: the distinct values of the
base spans of the whole table.  Labelled ordinary: the distinct words without
digits in a sample of about ``SAMPLE_DOCS`` documents, chosen by a hash of
their id and text (the sample's bound is the parameter).  Transitions are counted by
Spark; what reaches the driver is one row per pair of ALPHABET's characters,
and add-one smoothing makes the two tables one array of log ratios.

Positions are code points.  Spark's functions return matches and the text
between them, so a match's start is the running sum of the lengths before it,
taken per document over its matches only: what is shuffled is matches, not
texts.

Defined cases: a null text is empty and has no spans; rows that repeat an id
are rows of their own; an empty table gives an empty result, and without any
base span or word the models are uniform and add nothing.  Other columns are
not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import Scratch

# The base patterns and their least lengths.
NAMES = ("password", "passwd", "secret", "token", "api_?key")
ACCESS, HEX = r"AKIA[A-Z0-9]+", r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
MIN_TOKEN, MIN_WORD = 16, 6
ODDS, SAMPLE_DOCS = 1000, 2000


def either_case(name: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)


ASSIGN = rf"""({"|".join(map(either_case, NAMES))})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
TOKEN = rf"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}"
#: kind, pattern, group that holds the value, least length of the value.  A
#: run of hex digits or after AKIA is maximal, so the least length can stand in
#: the pattern; an assignment that is too short still uses up its text.
SEARCHES = (("assign", ASSIGN, 2, MIN_ASSIGN), ("access", f"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}", 0, MIN_ACCESS),
            ("hex", f"[0-9a-f]{{{MIN_HEX},}}", 0, MIN_HEX), ("markov", TOKEN, 0, MIN_TOKEN))


ENTRY = "array<struct<kind:int,k:int,gap:int,size:int,value:string>>"


def _entry(number: int):
    return lambda z, k: F.struct(F.lit(number).alias("kind"), k.alias("k"), z["g"].alias("gap"), F.length(z["m"]).alias("size"), z["v"].alias("value"))


def matches(rows: DataFrame) -> DataFrame:
    """``rows``: row, id, text.  Per row its row, id and matches, an array of: kind
    (its place in KINDS), k (its place among that kind's), gap (length of the
    text between it and the one before), size, value."""
    found = rows
    for kind, pattern, group, _ in SEARCHES:
        found = found.withColumn(f"{kind}_all", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
        if group:
            found = found.withColumn(f"{kind}_value", F.regexp_extract_all("text", F.lit(pattern), F.lit(group)))
    entries = []
    for number, (kind, pattern, group, _) in enumerate(SEARCHES):
        gaps = F.transform(F.split("text", pattern, -1), lambda g: F.length(g))
        zipped = F.arrays_zip(F.col(f"{kind}_all").alias("m"), F.col(f"{kind}_value" if group else f"{kind}_all").alias("v"),
                              F.slice(gaps, 1, F.size(f"{kind}_all")).alias("g"))
        entries.append(F.when(F.size(f"{kind}_all") > 0, F.transform(zipped, _entry(number))).otherwise(F.array().cast(ENTRY)))
    return found.select("row", "id", F.concat(*entries).alias("matches"))


def placed(found: DataFrame) -> DataFrame:
    """Exploded ``matches`` with start and end in place of gap and size; those too short
    are dropped once they have counted."""
    upto = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap").cast("long") + F.col("size")).over(upto)
    least = F.element_at(F.array(*[F.lit(n) for *_, n in SEARCHES]), F.col("kind") + 1)
    return found.withColumn("end", end).where(F.length("value") >= least).select("row", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "value")


def _transitions(strings: DataFrame) -> DataFrame:
    """How often each pair of ALPHABET's characters follows in ``value``s."""
    chars = strings.select(F.split("value", "").alias("c"))
    pairs = chars.select(F.explode(F.arrays_zip(F.col("c").alias("a"), F.slice("c", 2, F.greatest(F.size("c"), F.lit(1))).alias("b"))).alias("p"))
    place = [F.instr(F.lit(ALPHABET), F.col(f"p.{x}")) for x in "ab"]
    coded = pairs.where("p.b is not null and p.b != '' and p.a != ''").select(place[0].alias("a"), place[1].alias("b"))
    return coded.where("a > 0 and b > 0").groupBy("a", "b").agg(F.count("*").alias("n"))


def train(random: DataFrame, ordinary: DataFrame) -> list[float]:
    """Log ratios of the transition probabilities, row by row of ALPHABET;
    ``random`` and ``ordinary`` have a column value."""
    size, logs = len(ALPHABET), []
    for strings in (random, ordinary):
        counts = [[1.0] * size for _ in ALPHABET]
        for a, b, n in _transitions(strings).collect():  # at most a row per pair of characters
            counts[a - 1][b - 1] += n
        logs.append([math.log(c / sum(row)) for row in counts for c in row])
    return [x - y for x, y in zip(*logs)]


def log_ratio(value: Column, model: list[float]) -> Column:
    """The string's log-likelihood ratio, random to ordinary; in time linear in
    its length."""
    ratios = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")
    codes = F.transform(F.filter(F.split(value, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("last"))
    step = F.aggregate(codes, start, lambda s, c: F.struct((s["sum"] + F.when((s["last"] > 0) & (c > 0), F.element_at(
        ratios, (s["last"] - 1) * len(ALPHABET) + c)).otherwise(0.0)).alias("sum"), c.alias("last")))
    return step["sum"]


def spans(texts: DataFrame, found: DataFrame, scratch: Scratch, odds: float = ODDS, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``texts``: id, text; ``found``: their written ``matches``.  All spans: row,
    kind, start, end, value."""
    rows, n = texts, max(1, found.count())
    found = scratch.write(placed(found.select("row", F.explode("matches").alias("e")).select("row", "e.*")), "found")
    base = F.col("kind") < 3
    # By the data alone, not by the rows' places in files.
    chosen = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 40)) < int(min(1.0, sample_docs / n) * (1 << 40)))
    words = chosen.select(F.explode(F.regexp_extract_all("text", F.lit(rf"[A-Za-z_]{{{MIN_WORD},}}"), F.lit(0))).alias("value")).distinct()
    model = train(found.where(base).select("value").distinct(), words)

    # A candidate overlaps a base span that starts before its end and ends after its start.
    order = Window.partitionBy("row").orderBy("start", "kind")
    reach = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    scored = found.withColumn("ratio", F.when(~base, log_ratio(F.col("value"), model)))
    scored = scored.where(base | (F.col("ratio") > math.log(odds))).withColumn("reach", reach).withColumn("ahead", ahead)
    free = (F.coalesce("reach", F.lit(-1)) <= F.col("start")) & (F.coalesce("ahead", F.col("end")) >= F.col("end"))
    return scored.where(base | free).select("row", "kind", "start", "end", "value")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, odds: float = ODDS, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per input row: ``id_col``, n_assign, n_access, n_hex, n_markov,
    base_sha256, spans."""
    scratch = Scratch(docs.sparkSession, "secrets")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = scratch.write(matches(texts.withColumn("row", F.monotonically_increasing_id())), "rows")
    found = spans(texts, rows, scratch, odds, sample_docs)
    per = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("s"),
                                   *[F.count_if(F.col("kind") == i).alias(f"n_{k}") for i, k in enumerate(KINDS)])

    def joined(entries):
        name = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(F.transform(entries, lambda e: F.concat_ws(":", F.element_at(name, e["kind"] + 1), e["start"].cast("string"), e["end"].cast("string"))), ",")

    per = per.withColumn("spans", joined(F.col("s"))).withColumn("base", joined(F.filter("s", lambda e: e["kind"] < 3))).drop("s")
    per = scratch.write(per.withColumnRenamed("row", "s_row"), "per_row")
    out = rows.select("row", "id").join(per, F.expr("row = s_row"), "left")
    return out.select(F.col("id").alias(id_col), *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
                      F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
