"""Quality rules: per-text counts, and line frequency across the documents of
a host.

A line that many documents of one host share is its furniture, not its
content.  Lines are normalised (lower case, digit runs as 0, white space runs
as one space) and hashed; per host the distinct documents that hold a line
are counted; lines above the limit are removed, and a document left with less
than ``min_left`` of its words is rejected.  ``judge`` only counts what goes;
``clean`` hands on the kept documents without these lines.  The limit is the larger of
``min_docs`` documents and ``max_share`` of the host's, this share being
``max_docs`` documents at most, so that a line on many documents is furniture
on a host of any size.  Exact copies count
as one document: whether copies stay is for de-duplication to say, and their
lines are no furniture.

Line counts are added up map-side per (host, text, line) and again per (host,
line), so neither a common line nor a host with a third of all rows meets in
one task; what travels is hashes, never texts.  The per-text counts are made
with Arrow and numpy on slices of ``SLICE_BYTES`` of text.

Defined cases: a null text is empty, has no words and fails; null hosts are
one host; rows that repeat an id are judged each by its own text.  An empty
table gives an empty result; other columns are not read by ``judge`` and kept
by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import Scratch, fresh, plain_spaces, schema_with, small

MIN_DOCS, MAX_SHARE, MIN_LEFT = 20, 0.01, 0.5
#: Most documents that ``max_share`` of a host's may come to.
MAX_DOCS = 100
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SLICE_BYTES = 1 << 20
SYMBOLS = "[#*$%&|<>]"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weights=weights, minlength=n).astype(np.int64)


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lists' values in one array, and each value's list."""
    return lists.flatten(), np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A code for each pair of codes; equal codes for equal pairs."""
    if not len(a):
        return a.astype(np.int64)
    return pd.factorize(a.astype(np.int64) * (int(b.max()) + 1) + b)[0]


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of each text."""
    n, texts = len(texts), pc.fill_null(texts.cast(pa.large_string()), "")
    words, doc = _flat(pc.ascii_split_whitespace(texts))
    real = np.asarray(pc.greater(pc.binary_length(words), 0))
    words, doc = words.filter(pa.array(real)), doc[real]
    code = np.asarray(words.dictionary_encode().indices).astype(np.int64)
    repeated = np.zeros(len(code), dtype=bool)
    if len(code) > 2:
        start = np.flatnonzero(doc[2:] == doc[:-2])
        window = _pairs(doc[start], _pairs(_pairs(code[start], code[start + 1]), code[start + 2]))
        again = start[(np.bincount(window) >= 2)[window]] if len(start) else start
        for k in range(3):
            repeated[again + k] = True
    lines, of = _flat(pc.split_pattern(texts, "\n"))
    real = np.asarray(pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]"))
    lines, of = lines.filter(pa.array(real)), of[real]
    line = _pairs(of, np.asarray(lines.dictionary_encode().indices))
    firsts = np.unique(line, return_index=True)[1]
    return {"n_words": _per(doc, n), "word_chars": _per(doc, n, np.asarray(pc.utf8_length(words))),
            "n_symbols": np.asarray(pc.count_substring_regex(texts, SYMBOLS)).astype(np.int64),
            "n_dup_lines": _per(of, n) - _per(of[firsts], n), "n_repeat_words": _per(doc[repeated], n)}


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``most`` bytes of text,
    so that memory stays bounded whatever the texts' lengths."""
    for batch in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0)).astype(np.int64)
        part = np.concatenate([[0], np.cumsum(size)[:-1]]) // most if len(size) else size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(size)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def with_counts(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` without ``text``, with COUNTS."""
    keep = [c for c in rows.columns if c != text]

    def count(batches):
        for batch in slices(batches, text):
            got = text_counts(batch.column(text))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(got[c]) for c in COUNTS], names=[*keep, *COUNTS])

    return rows.mapInArrow(count, schema_with(rows.drop(text), **dict.fromkeys(COUNTS, "long")))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", *, min_docs: int = MIN_DOCS,
          max_share: float = MAX_SHARE, min_left: float = MIN_LEFT, max_docs: int = MAX_DOCS) -> DataFrame:
    """One row per input row: ``id_col``, COUNTS, base_failed, removed_words, kept."""
    judged, _ = _judged(Scratch(docs.sparkSession, "quality"), docs, id_col, text_col, host_col, min_docs, max_share, min_left, max_docs)
    return judged.drop("furnished", "host", "digest")


def _folded(text: Column) -> Column:
    """The text with its lines as they are compared, but for spaces at their ends."""
    return plain_spaces(F.regexp_replace(F.lower(text), "[0-9]+", "0"))


def _judged(scratch: Scratch, docs: DataFrame, id_col: str, text_col: str, host_col: str, min_docs: int, max_share: float,
            min_left: float, max_docs: int) -> tuple[DataFrame, DataFrame]:
    """``judge``'s rows with furnished, host and digest, and (host, digest, line) of
    the lines above the limit."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), text.alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5("text")))
    base = scratch.write(with_counts(rows, "text"), "base")

    # Texts are normalised before they are cut into lines, once each.
    lines = rows.select("host", "digest", _folded(F.col("text")).alias("text")).select("host", "digest", F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.select("host", "digest", F.trim("line").alias("line")).where("line != ''")
    words = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    lines = scratch.write(lines.select("host", "digest", F.xxhash64("line").alias("line"), words.cast("long").alias("words"))
                          .groupBy("host", "digest", "line").agg(F.max("words").alias("words"), F.count("*").alias("times")), "lines")
    copies = scratch.write(base.groupBy("host", "digest").agg(F.count("*").alias("copies")), "copies")

    hosts = copies.groupBy("host").agg(F.count("*").alias("host_docs")).withColumnRenamed("host", "h")
    often = lines.groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > min_docs)
    often = often.join(hosts, F.expr("host <=> h")).where(F.col("docs") > F.least(F.col("host_docs") * max_share, F.lit(float(max_docs))))
    often = scratch.write(often.select(F.col("host").alias("o_host"), F.col("line").alias("o_line")), "often")
    removed = (lines.join(often, F.expr("host <=> o_host and line = o_line"))
               .groupBy("host", "digest").agg(F.sum(F.col("words") * F.col("times")).alias("removed")))
    removed = scratch.write(removed.select(F.col("host").alias("r_host"), F.col("digest").alias("r_digest"), "removed"), "removed")
    removed = scratch.write(removed.join(copies, F.expr("host <=> r_host and digest = r_digest")).select(
        "r_host", "r_digest", (F.col("removed") / F.col("copies")).cast("long").alias("removed")), "per_copy")

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    gone = F.coalesce(F.col("removed"), F.lit(0))
    judged = base.join(removed, F.expr("host <=> r_host and digest = r_digest"), "left").select(
        F.col("id").alias(id_col), *COUNTS, failed.alias("base_failed"), gone.alias("removed_words"),
        (~failed & (F.col("n_words") - gone >= min_left * F.col("n_words"))).alias("kept"), (gone > 0).alias("furnished"), "host", "digest")
    holding = lines.join(often, F.expr("host <=> o_host and line = o_line")).select("host", "digest", "line")
    return judged, holding


def _furniture(judged: DataFrame, holding: DataFrame, scratch: Scratch) -> DataFrame:
    """A row per kept (host, text digest): host, digest, and lines, the hashes of its
    lines above the limit (null if it has none).  Rows of one host and text
    share one verdict, so no row needs a number."""
    of = holding.groupBy(F.col("host").alias("f_host"), F.col("digest").alias("f_digest")).agg(F.collect_set("line").alias("lines"))
    kept = judged.where("kept").select("host", "digest", "furnished").distinct()
    return kept.join(scratch.write(of, "furniture"), F.expr("furnished and host <=> f_host and digest = f_digest"), "left").select("host", "digest", "lines")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", *, min_docs: int = MIN_DOCS,
          max_share: float = MAX_SHARE, min_left: float = MIN_LEFT, max_docs: int = MAX_DOCS, chars_col: str = "n_chars") -> DataFrame:
    """The documents that the rules keep, with the input's columns: texts without
    the lines above the limit, in order, and ``chars_col``, if there is one,
    following texts that lose lines."""
    lines, host, digest, k_host, k_digest, k_lines = fresh(docs, "quality_lines", "quality_host", "quality_digest", "quality_k_host", "quality_k_digest",
                                                           "quality_gone")
    scratch = Scratch(docs.sparkSession, "quality")
    judged, holding = _judged(scratch, docs, id_col, text_col, host_col, min_docs, max_share, min_left, max_docs)
    kept = _furniture(judged, holding, scratch).select(F.col("host").alias(k_host), F.col("digest").alias(k_digest), F.col("lines").alias(k_lines))
    kept = scratch.write(kept, "kept")
    size = kept.agg(F.sum(F.coalesce(F.size(k_lines), F.lit(0)) * 8 + 96)).first()[0] or 0
    rows = docs.withColumns({host: F.col(host_col).cast("string"), digest: F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))})
    rows = rows.join(small(kept, size // max(1, kept.count()) + 1), F.col(host).eqNullSafe(F.col(k_host)) & (F.col(digest) == F.col(k_digest)))
    # Folding keeps line ends, so a line and its folded form have one number.
    text = F.col(text_col).cast("string")
    hashes = F.transform(F.split(_folded(text), "\n"), lambda x: F.xxhash64(F.trim(x)))
    parted = F.arrays_zip(F.split(text, "\n").alias("line"), hashes.alias("hash"))
    left = F.filter(parted, lambda x: ~F.array_contains(F.col(k_lines), x["hash"]))
    rows = rows.withColumn(lines, F.when(F.col(k_lines).isNotNull(), F.array_join(F.transform(left, lambda x: x["line"]), "\n")))
    out = {text_col: F.coalesce(lines, text_col), chars_col: F.coalesce(F.length(lines).cast(docs.schema[chars_col].dataType), chars_col)
           if chars_col in docs.columns else None}
    return rows.select(*[out[c].alias(c) if c in out else F.col(f"`{c}`") for c in docs.columns])
