"""Packing by concatenating and cutting.

All documents' ids, each document ended by an end id, are one long row of
tokens, cut every ``capacity`` tokens.  Nothing is padded: what is left behind
the last whole window is cut into windows of falling powers of two, which
need no padding either.

Two passes.  The first encodes the texts once and writes each document's ids
with its task and its place among that task's tokens.  The tasks' totals then
become global offsets by prefix sums, within runs of ``RUN`` tasks and over
the runs.  The second pass reads the written ids and cuts them: a document's
global place says which windows it touches, and each of them gets a boundary
record, a row with the part of the document that lies in it.  No task needs
another one's rows, so a document may span any number of windows, and a
window any number of tasks.

Memory per task is a slice of texts or a batch of ids; a lost executor costs
the tasks that encode or read again.

Defined cases: a null text is empty and holds the end id alone; a text of any
length is cut like any other; rows that repeat an id (or have none) are
documents of their own; an empty table gives an empty result.  Other columns,
whatever their names, are not read.  The documents' order is that of the
first pass.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quality import slices
from .tokens import encoder, with_end
from .util import Scratch, schema_with, small

CAPACITY, END_ID, SLICE, CACHE, RUN = 4096, 2, 8 << 20, 400_000, 1024


def encoded(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """doc_id, task, at (its first token among the task's), n, ids (two bytes each
    where the vocabulary allows, else four)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = schema_with(rows.select("doc_id"), task="int", at="long", n="long", ids="binary")

    def encode(batches):
        code, upto, task = encoder(tokenizer, CACHE), 0, TaskContext.get().partitionId()
        kind = np.dtype(id_type(max(code.tokenizer.get_vocab_size(), end_id + 1)))
        for batch in slices(batches, "text", SLICE):
            ids, n = with_end(*code.encode(batch.column("text")), end_id)
            ends = np.cumsum(n)
            offsets = np.concatenate([[0], ends * kind.itemsize]).astype(np.int64)
            blobs = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype(kind))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.full(len(n), task, np.int32)), pa.array(upto + ends - n), pa.array(n), blobs],
                                             names=schema.names)
            upto += int(ends[-1])

    return rows.mapInArrow(encode, schema)


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def bases(ids: DataFrame) -> DataFrame:
    """b_task, base: tokens of all tasks before it."""
    tasks = ids.groupBy("task").agg(F.sum("n").alias("n")).withColumn("run", (F.col("task") / RUN).cast("int"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = tasks.groupBy("run").agg(F.sum("n").alias("n")).select("run", before(Window.orderBy("run")).alias("run_base"))
    own = tasks.select("task", "run", before(Window.partitionBy("run").orderBy("task")).alias("own"))
    return own.join(runs, "run").select(F.col("task").alias("b_task"), (F.col("run_base") + F.col("own")).alias("base"))


class Windows:
    """Where the windows of ``total`` tokens begin and end."""

    def __init__(self, total: int, capacity: int):
        self.capacity, self.whole = capacity, total // capacity
        left = total % capacity
        self.tail = np.array([1 << b for b in reversed(range(left.bit_length())) if left >> b & 1], np.int64)  # falling powers of two
        self.tail_ends = self.whole * capacity + np.cumsum(self.tail)

    def of(self, place: np.ndarray) -> np.ndarray:
        """The window that holds the token at ``place``."""
        return np.where(place < self.whole * self.capacity, place // self.capacity, self.whole + np.searchsorted(self.tail_ends, place, side="right"))

    def start(self, window: np.ndarray) -> np.ndarray:
        if not len(self.tail):
            return window * self.capacity
        first = (self.tail_ends - self.tail)[np.clip(window - self.whole, 0, len(self.tail) - 1)]
        return np.where(window < self.whole, window * self.capacity, first)

    def end(self, window: np.ndarray) -> np.ndarray:
        if not len(self.tail):
            return (window + 1) * self.capacity
        return np.where(window < self.whole, (window + 1) * self.capacity, self.tail_ends[np.clip(window - self.whole, 0, len(self.tail) - 1)])


def packed(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *, capacity: int = CAPACITY, end_id: int = END_ID,
           keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start (in its document), length, ids_crc32,
    doc_tokens, sequence_id, offset (and ids, four bytes each)."""
    if capacity < 1:
        raise ValueError("a sequence holds a token at least")
    scratch = Scratch(docs.sparkSession, "concat-cut")
    ids = scratch.write(encoded(docs, tokenizer, id_col, text_col, end_id), "ids")
    offsets = scratch.write(bases(ids), "bases")
    windows = Windows(ids.agg(F.sum("n")).first()[0] or 0, capacity)
    based = ids.join(small(offsets, 32), F.expr("task = b_task")).select("doc_id", (F.col("base") + F.col("at")).alias("at"), "n", "ids")
    more = {"ids": "binary"} if keep_ids else {}
    schema = schema_with(ids.select("doc_id"), start="long", length="long", ids_crc32="long", doc_tokens="long", sequence_id="long", offset="long", **more)

    def cut(batches):
        for batch in batches:
            at, n = (np.asarray(batch.column(c)).astype(np.int64) for c in ("at", "n"))
            if not len(at):
                continue
            first = windows.of(at)
            many = windows.of(at + n - 1) - first + 1
            doc = np.repeat(np.arange(len(at)), many)
            window = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            low, high = np.maximum(windows.start(window), at[doc]), np.minimum(windows.end(window), (at + n)[doc])
            begin, end = low - at[doc], high - at[doc]
            crcs, own, held = [], [], -1
            for d, a, b in zip(doc.tolist(), begin.tolist(), end.tolist()):
                if d != held:
                    blob = batch.column("ids")[d].as_buffer()
                    held, data = d, memoryview(np.frombuffer(blob, f"<u{blob.size // int(n[d])}").astype("<u4").tobytes())
                crcs.append(zlib.crc32(data[4 * a:4 * b]))
                if keep_ids:
                    own.append(bytes(data[4 * a:4 * b]))
            columns = [batch.column("doc_id").take(pa.array(doc)), pa.array(begin), pa.array(end - begin), pa.array(crcs, pa.int64()), pa.array(n[doc]),
                       pa.array(window), pa.array(low - windows.start(window))]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(own, pa.binary())] if keep_ids else []), names=schema.names)

    return based.mapInArrow(cut, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """The sequences of pieces packed with their ids: sequence_id, ids, and the
    boundary records in order: doc_ids, starts (in their documents), lengths."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "start", "length")))
    part = lambda c: F.transform("own", lambda x: x[c]).alias(f"{c}s")
    return pieces.groupBy("sequence_id").agg(own.alias("own")).select(
        "sequence_id", F.aggregate("own", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"), part("doc_id"), part("start"), part("length"))
