"""Token counts by a separator scan of flat, unindexed token files.

A flat file is nothing but ids of two bytes, documents one after the other,
each ended by the end-of-document id.  It is read in blocks of ``BLOCK_IDS``
by byte range, any block by any task; numpy finds the end ids of a block at
once.  A document may begin blocks before the one it ends in: a prefix scan
over the block summaries carries the last end before each block (the running
maximum) and the number of documents before it (the running sum), per run of
``RUN`` blocks, over the runs of a file, and over the files.  No step holds
more than a block, and no window more than RUN blocks or a file's runs.

Files are written by Spark's text writer with the end id's two bytes as its
line separator, which makes exactly this format; a task's file is committed
whole.  The folder must be one that pyarrow's file systems can read (local or
mounted, HDFS, S3, GCS), as the scan reads byte ranges.

Defined cases: a null text is empty: an end id alone, a document of 0
tokens; a text of any length is scanned block by block; rows that repeat an id
(or have none) are documents of their own; ids after a file's last end id are
a document marked as not ended; empty files hold nothing; an empty table
gives an empty result.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .quality import slices
from .tokens import encoder
from .util import Scratch, in_file_order, shuffle_partitions

BLOCK_IDS, RUN, SLICE = 1 << 20, 1024, 4 << 20


def write_flat(docs: DataFrame, path: str, tokenizer: str, end_id: int, text_col: str = "text") -> None:
    """The documents' ids, each document followed by ``end_id``; a file per
    partition, in its rows' order."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))

    def encode(batches):
        code = encoder(tokenizer)
        for batch in slices(batches, "text", SLICE):
            ids, counts = code.encode(batch.column("text"))
            if len(ids) and (ids.max() > 0xFFFF or (ids == end_id).any()):
                raise ValueError("ids must fit two bytes, and the end id must end documents only")
            offsets = np.concatenate([[0], np.cumsum(2 * counts)]).astype(np.int64)
            values = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u2"))])
            yield pa.RecordBatch.from_arrays([values.cast(pa.binary())], names=["ids"])

    end = int(end_id).to_bytes(2, "little").decode("latin-1")
    (texts.mapInArrow(encode, "ids binary").select(F.col("ids").cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", end).text(path))


def _read(path: str, start: int, size: int) -> bytes:
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_file(name) as f:
        return f.read_at(size, start)


def block_ends(spark: SparkSession, path: str, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """A row per block: path, block, ends (places of the end ids in the file)
    and ids (the file's number of ids)."""
    # Only names and lengths are read here, not contents.
    files = spark.read.format("binaryFile").load(path).where("length >= 2").select("path", (F.col("length") / 2).cast("long").alias("ids"))
    last = ((F.col("ids") - 1) / block_ids).cast("long")
    blocks = files.select("path", "ids", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    blocks = blocks.repartition(shuffle_partitions(spark), "path", "block")

    def scan(batches):
        for batch in batches:
            for p, ids, block in zip(*(batch.column(c).to_pylist() for c in ("path", "ids", "block"))):
                low = block * block_ids
                found = np.frombuffer(_read(p, 2 * low, 2 * min(block_ids, ids - low)), "<u2") == end_id
                ends = pa.array([np.flatnonzero(found) + low], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([block]), pa.array([ids]), ends], names=["path", "block", "ids", "ends"])

    return blocks.mapInArrow(scan, "path string, block long, ids long, ends array<long>")


def scan_documents(spark: SparkSession, path: str, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """A row per document in file order: ordinal (over all files, by path),
    path, place (in its file), start, n_tokens (without the end id), ended."""
    scratch = Scratch(spark, "separators")
    blocks = scratch.write(block_ends(spark, path, end_id, block_ids), "blocks")
    summary = blocks.select("path", "block", "ids", (F.col("block") / RUN).cast("long").alias("run"),
                            F.size("ends").cast("long").alias("n"), F.array_max("ends").alias("last"))

    def before(window, column, how):
        return how(column).over(window.rowsBetween(Window.unboundedPreceding, -1))

    runs = summary.groupBy("path", "run").agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.max("ids").alias("ids"))
    files = runs.groupBy("path").agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.max("ids").alias("ids"))
    open_end = (F.coalesce("last", F.lit(-1)) < F.col("ids") - 1).cast("int")
    files = files.withColumn("n", F.col("n") + open_end)
    files = files.select("path", F.coalesce(before(Window.orderBy("path"), "n", F.sum), F.lit(0)).alias("file_base"))
    of_file, of_run = Window.partitionBy("path").orderBy("run"), Window.partitionBy("path", "run").orderBy("block")
    runs = runs.select("path", "run", F.coalesce(before(of_file, "n", F.sum), F.lit(0)).alias("run_base"), before(of_file, "last", F.max).alias("run_last"))
    carried = summary.select("path", "run", "block", F.coalesce(before(of_run, "n", F.sum), F.lit(0)).alias("own_base"), before(of_run, "last", F.max).alias("own_last"))
    carried = carried.join(runs, ["path", "run"]).join(files, "path").select(
        "path", "block", "file_base", (F.col("run_base") + F.col("own_base")).alias("base"), F.greatest("run_last", "own_last").alias("carry"))
    carried = scratch.write(carried, "carried")

    # A file's last block also closes what no end id closes.
    is_last = F.col("block") == ((F.col("ids") - 1) / block_ids).cast("long")
    stitched = blocks.join(carried, ["path", "block"]).withColumn("carry", F.coalesce("carry", F.lit(-1)).cast("long"))
    tail = F.greatest(F.coalesce(F.array_max("ends"), F.lit(-1)), F.col("carry"))
    ends = F.when(is_last & (tail < F.col("ids") - 1), F.concat("ends", F.array("ids"))).otherwise(F.col("ends"))
    starts = F.concat(F.array("carry"), "ends")
    out = stitched.select("path", "ids", "file_base", "base", starts.alias("starts"), F.posexplode(ends).alias("k", "end"))
    start = F.element_at("starts", F.col("k") + 1) + 1
    return out.select((F.col("file_base") + F.col("base") + F.col("k")).alias("ordinal"), "path", (F.col("base") + F.col("k")).alias("place"),
                      start.alias("start"), (F.col("end") - start).alias("n_tokens"), (F.col("end") < F.col("ids")).alias("ended"))


def document_counts(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents to flat files, scan these, and name the documents
    found by file and place: doc_id, part, start, n_tokens."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "flat")
    rows, path = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), scratch.path("files")
    if not in_file_order(rows):
        rows = scratch.write(rows, "rows")
    write_flat(rows, path, tokenizer, end_id)
    found = scan_documents(spark, path, end_id).withColumn("part", F.regexp_extract("path", r"part-(\d+)", 1).cast("long"))
    # The n-th row of partition p is the n-th document of file p.
    row = F.monotonically_increasing_id()
    names = rows.select("doc_id", F.shiftright(row, 33).alias("d_part"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("d_place"))
    found, names = scratch.write(found, "found"), scratch.write(names, "names")
    per_file = found.groupBy("part").agg(F.count("*").alias("n")).join(
        names.groupBy("d_part").agg(F.count("*").alias("d_n")), F.expr("part = d_part"), "full")
    if not per_file.where("not (n <=> d_n)").isEmpty():
        raise RuntimeError("the rows were dealt otherwise when they were read again: Spark sizes splits by its cores, which changed; run again")
    return names.join(found, F.expr("d_part = part and d_place = place")).select("doc_id", "part", "start", "n_tokens")
