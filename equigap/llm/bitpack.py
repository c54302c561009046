"""Token ids in fixed-width bit-packed files.

A file holds documents one after the other, every id in the least number of
bits that the vocabulary needs.  Layout, little-endian:

    magic "IDPK", version u16, bits u16, part u32, seq u32, documents u64,
    ids u64, ids per block u32, blocks u32
    document ids i64 * documents, whether they are set u8 * documents
    ids up to each document's end u64 * documents
    byte offset of each block in the payload u64 * (blocks + 1)
    payload: blocks of packed 64-bit words; 64 ids take ``bits`` words

Blocks are unpacked with numpy, 64 lanes at a time, and any range of ids by
the blocks it touches.  Spark writes the files (its text writer, a file per
row, which commits a task's files at once and ends each in a line feed) and
reads them back as binary files, so they may lie in any store Spark knows.

Documents are range-partitioned by id and sorted, so file order (part, then
seq) is id order; a global start is the prefix sum of the files' totals plus
the place within the file.  Memory per task is one file's ids
(``FILE_IDS``, or one document if that is longer) and a slice of texts.

Defined cases: a null text is empty and holds the end id alone; null ids come
first; rows that repeat an id keep a record each, in the order of their texts'
hashes; texts of any length are one record; an empty table gives no
file with documents and an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quality import slices
from .tokens import encoder, with_end
from .util import Scratch, shuffle_partitions

END_ID, FILE_IDS, BLOCK_IDS, SLICE, CACHE = 0, 4 << 20, 1 << 16, 7 << 20, 500_000
HEAD = struct.Struct("<4sHHIIQQII")
MAGIC, VERSION = b"IDPK", 1


def bits_for(vocabulary: int) -> int:
    """The least number of bits for ids 0 to vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    n = -(-len(ids) // 64)
    lanes = np.zeros(n * 64, np.uint64)
    lanes[:len(ids)] = ids
    lanes = np.ascontiguousarray(lanes.reshape(n, 64).T)
    words = np.zeros((bits, n), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        words[word] |= lanes[lane] << np.uint64(shift)
        if shift + bits > 64:
            words[word + 1] |= lanes[lane] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").tobytes()


def unpack(data: memoryview, bits: int, n: int) -> np.ndarray:
    words = np.ascontiguousarray(np.frombuffer(data, "<u8").reshape(-1, bits).T)
    out, mask = np.empty((words.shape[1], 64), np.uint32), np.uint64((1 << bits) - 1)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        value = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | words[word + 1] << np.uint64(64 - shift)
        out[:, lane] = value & mask
    return out.reshape(-1)[:n]


def write_file(doc_ids: list, counts: np.ndarray, ids: np.ndarray, bits: int, part: int = 0, seq: int = 0, block: int = BLOCK_IDS) -> bytes:
    blocks = [pack(ids[a:a + block], bits) for a in range(0, len(ids), block)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    known = np.array([d is not None for d in doc_ids], np.uint8)
    return b"".join([
        HEAD.pack(MAGIC, VERSION, bits, part, seq, len(doc_ids), len(ids), block, len(blocks)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), known.tobytes(), np.cumsum(counts).astype("<u8").tobytes(), offsets.tobytes(), *blocks])


class PackedFile:
    """Random access to one file's content."""

    def __init__(self, content: bytes):
        data = memoryview(content)
        magic, version, self.bits, self.part, self.seq, n, self.n_ids, self.block, blocks = HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a packed id file of this version")
        at = HEAD.size
        self.doc_ids, at = np.frombuffer(data, "<i8", n, at), at + 8 * n
        self.known, at = np.frombuffer(data, np.uint8, n, at), at + n
        self.ends, at = np.frombuffer(data, "<u8", n, at).astype(np.int64), at + 8 * n
        self.offsets, at = np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64), at + 8 * (blocks + 1)
        self.payload = data[at:]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop, from the blocks they touch."""
        first, out = start // self.block, []
        for b in range(first, -(-stop // self.block)):
            n = min(self.block, self.n_ids - b * self.block)
            out.append(unpack(self.payload[self.offsets[b]:self.offsets[b + 1]], self.bits, n))
        got = np.concatenate(out) if out else np.zeros(0, np.uint32)
        return got[start - first * self.block:stop - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(document id, start in the file, ids), block by block."""
        start, held, low = 0, np.zeros(0, np.uint32), 0
        for doc, known, end in zip(self.doc_ids.tolist(), self.known.tolist(), self.ends.tolist()):
            if end > low + len(held):
                more = min(self.n_ids, -(-end // self.block) * self.block)
                held, low = np.concatenate([held[start - low:], self.ids(low + len(held), more)]), start
            yield doc if known else None, start, held[start - low:end - low]
            start = end


def write_documents(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *, end_id: int = END_ID,
                    file_ids: int = FILE_IDS) -> None:
    """Encode the documents and write them to ``path`` in id order."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # Rows that share an id (null ids, say) may be spread over partitions, in the order of their texts' digests.
    order = [F.col("id").asc_nulls_first(), F.col("digest")]
    rows = rows.withColumn("digest", F.xxhash64("text"))
    rows = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)

    def files(batches):
        code, part, seq = encoder(tokenizer, CACHE), TaskContext.get().partitionId(), 0
        bits = bits_for(max(code.tokenizer.get_vocab_size(), end_id + 1))
        names, counts, ids, held = [], [], [], 0

        def blob():
            data = write_file(names, np.concatenate(counts), np.concatenate(ids), bits, part, seq)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["blob"])

        for batch in slices(batches, "text", SLICE):
            own, n = with_end(*code.encode(batch.column("text")), end_id)
            names += batch.column("id").to_pylist()
            counts, ids, held = [*counts, n], [*ids, own], held + len(own)
            if held >= file_ids:
                yield blob()
                names, counts, ids, held, seq = [], [], [], 0, seq + 1
        if names:
            yield blob()

    blobs = rows.mapInArrow(files, "blob binary").select(F.col("blob").cast("string").alias("value"))
    blobs.write.option("maxRecordsPerFile", 1).text(path)


def read_documents(spark, path: str) -> DataFrame:
    """Per document of the files under ``path``: doc_id, part, seq, start (in
    its file), n_tokens, ids_crc32."""

    def parse(batches):
        for batch in batches:
            for content in batch.column("content"):
                buffer = content.as_buffer()
                if buffer.size <= 1:
                    continue
                file = PackedFile(buffer)
                found = [(d, s, len(x), zlib.crc32(x.astype("<u4"))) for d, s, x in file.documents()]
                n = len(found)
                ids, starts, sizes, sums = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([file.part] * n, pa.int64()), pa.array([file.seq] * n, pa.int64()),
                     pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "part", "seq", "start", "n_tokens", "ids_crc32"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(
        parse, "doc_id long, part long, seq long, start long, n_tokens long, ids_crc32 long")


def with_global_starts(records: DataFrame) -> DataFrame:
    """``records`` with start counted over all files: totals per file, files
    added up within their part, parts added up."""
    scratch = Scratch(records.sparkSession, "packed-starts")
    records = scratch.write(records, "records")
    files = scratch.write(records.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n")), "files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("own", F.coalesce(F.sum("n").over(before), F.lit(0))).join(parts, "part")
    files = scratch.write(files.select("part", "seq", (F.col("base") + F.col("own")).alias("base")), "bases")
    return records.join(files, ["part", "seq"]).withColumn("start", F.col("start") + F.col("base")).drop("base", "part", "seq")


def packed(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write the documents, read the files back: doc_id, start, n_tokens,
    ids_crc32, per document."""
    spark, path = docs.sparkSession, Scratch(docs.sparkSession, "packed").path("files")
    write_documents(docs, path, tokenizer, id_col, text_col, **options)
    return with_global_starts(read_documents(spark, path))
