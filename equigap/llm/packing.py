"""Best-fit packing of documents into sequences, by swap-based local search.

How many bins a packing needs depends only on how many pieces there are of
each length, and lengths are whole numbers up to the capacity.  So the search
runs on the histogram, at most ``capacity`` rows whatever the size of the
corpus, over *patterns*: a multiset of lengths and the number of bins filled
that way.  It starts from best fit in decreasing length and then improves the
underfull bins: a document moves from one bin to another, one document is
exchanged for another, or two for one, always so that the sum of squared
fills grows, taking from the least filled bins until they are empty.  A step
changes all bins of a pattern at once.  It ends when no step helps, when the
number of bins is the least possible, or after ``STEPS`` steps.

The pieces then learn their places: a piece's rank among those of its length
(counted per task while the pieces are written, with the earlier tasks'
counts added) picks the bin, copy and offset.  A length that a third of all
pieces share is ranked by all tasks alike.

Defined cases: a null text is empty and holds the end id alone; rows that
repeat an id are packed each for itself; an empty table gives an empty
result.  Rows whose length is null or 0 get a null sequence, one longer than
the capacity is an error.  Other columns are not read by
``packed_documents`` and kept by ``pack``.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quality import slices
from .tokens import encoder, with_end
from .util import Scratch, fresh, schema_with

CAPACITY, END_ID, SLICE = 2048, 0, 4 << 20
STEPS = 4000

Patterns = Counter  # of tuples of lengths, longest first


def best_fit(lengths: dict[int, int], capacity: int) -> Patterns:
    """Best fit decreasing, bins of equal content together."""
    rooms: list[int] = []  # those that any open bin has, ascending
    open_: dict[int, Counter] = {}

    def put(pattern: tuple, count: int, room: int) -> None:
        if room not in open_:
            open_[room] = Counter()
            insort(rooms, room)
        open_[room][pattern] += count

    for size, n in sorted(lengths.items(), reverse=True):
        if not 0 < size <= capacity:
            raise ValueError(f"a piece of {size} does not fit a sequence of {capacity}")
        while n:
            i = bisect_left(rooms, size)
            if i == len(rooms):
                room, pattern, bins = capacity, (), n
            else:
                room = rooms[i]
                pattern, bins = open_[room].popitem()
            each = min(n, room // size)  # the bin stays the tightest until it is too full
            used = min(bins, n // each)
            if i < len(rooms):
                if bins > used:
                    open_[room][pattern] = bins - used
                elif not open_[room]:
                    del open_[room], rooms[i]
            put(pattern + (size,) * each, used, room - each * size)
            n -= used * each
    return Counter({p: c for group in open_.values() for p, c in group.items()})


def least_bins(patterns: Patterns, capacity: int) -> int:
    return -(-sum(sum(p) * c for p, c in patterns.items()) // capacity)


def local_search(patterns: Patterns, capacity: int, steps: int = STEPS) -> Patterns:
    """Moves and exchanges between underfull bins, each increasing the sum of
    squared fills."""
    done = Counter({p: c for p, c in patterns.items() if sum(p) == capacity})
    loose = Counter({p: c for p, c in patterns.items() if sum(p) < capacity})
    least = least_bins(patterns, capacity)
    stuck: set[tuple] = set()
    while steps and done.total() + loose.total() > least:
        donors = [p for p in loose if p not in stuck]
        if not donors:
            break
        giver = min(donors, key=lambda p: (sum(p), p))
        step = _best_step(giver, loose, capacity)
        if step is None:
            stuck.add(giver)
            continue
        taker, out, back = step
        times = loose[giver] // 2 if taker == giver else min(loose[giver], loose[taker])
        for old in (giver, taker):
            loose[old] -= times
            if not loose[old]:
                del loose[old]
        for old, lost, got in ((giver, out, back), (taker, back, out)):
            left = Counter(old)
            left.subtract(lost)
            new = tuple(sorted([*left.elements(), *got], reverse=True))
            if new:
                (done if sum(new) == capacity else loose)[new] += times
        stuck.clear()
        steps -= 1
    return done + loose


def _best_step(giver: tuple, loose: Counter, capacity: int):
    """(taker, lengths out, lengths back) that fills a bin at least as full as
    the giver the most; None if nothing does."""
    gifts: dict[int, tuple] = {}
    for i, x in enumerate(giver):
        for y in giver[i + 1:]:
            gifts.setdefault(x + y, (x, y))
    for x in giver:
        gifts[x] = (x,)
    sums = np.array(sorted(gifts))
    fill = sum(giver)
    takers = [p for p in loose if sum(p) >= fill and (p != giver or loose[p] > 1)]
    if not takers:
        return None
    offers = [(k, y) for k, p in enumerate(takers) for y in (0, *sorted(set(p)))]
    k, y = np.array([o[0] for o in offers]), np.array([o[1] for o in offers])
    room = capacity - np.array([sum(p) for p in takers])[k]
    best = np.searchsorted(sums, room + y, side="right") - 1
    gain = np.where(best >= 0, sums[best] - y, 0)
    i = int(np.lexsort((y, k, room - gain, -gain))[0])  # most gain, then least room left
    if gain[i] <= 0:
        return None
    return takers[k[i]], gifts[int(sums[best[i]])], (int(y[i]),) if y[i] else ()


def fit(lengths: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> Patterns:
    return local_search(best_fit(lengths, capacity), capacity, steps)


def slots(patterns: Patterns) -> dict[int, np.ndarray]:
    """Per length a table of its places: (first rank, first sequence, pieces of
    that length in a bin, offset of the first)."""
    table: dict[int, list] = {}
    upto: Counter = Counter()
    sequence = 0
    for pattern, count in sorted(patterns.items(), reverse=True):
        offset = 0
        for size, m in sorted(Counter(pattern).items(), reverse=True):
            table.setdefault(size, []).append((upto[size], sequence, m, offset))
            upto[size] += count * m
            offset += size * m
        sequence += count
    return {size: np.array(rows, np.int64).T for size, rows in table.items()}


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = CAPACITY, steps: int = STEPS) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    scratch = Scratch(pieces.sparkSession, "pack")
    part, rank, many, base = fresh(pieces, "pack_part", "pack_rank", "pack_many", "pack_base")

    def number(batches):
        """Rank among the task's pieces of that length."""
        seen, task = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            size = np.asarray(batch.column(length_col).fill_null(0)).astype(np.int64)
            if len(size) and size.max() > capacity:
                raise ValueError(f"a piece of {size.max()} does not fit a sequence of {capacity}")
            order = np.argsort(size, kind="stable")
            run = size[order]
            first = np.searchsorted(run, run)
            own = np.empty(len(size), np.int64)
            own[order] = np.arange(len(size)) - first + seen[run]
            seen += np.bincount(size, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(size), task)), pa.array(own)], names=[*batch.schema.names, part, rank])

    ranked = scratch.write(pieces.mapInArrow(number, schema_with(pieces, **{part: "long", rank: "long"})), "ranked")
    counts = scratch.write(ranked.groupBy(part, length_col).agg(F.count("*").alias(many)), "counts")
    histogram = {r[0]: r[1] for r in counts.where(F.col(length_col) > 0).groupBy(length_col).agg(F.sum(many)).collect()}  # capacity rows at most
    places = slots(fit(histogram, capacity, steps))

    before = Window.partitionBy(length_col).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = scratch.write(counts.select(F.col(part).alias("b_part"), F.col(length_col).alias("b_length"), F.coalesce(F.sum(many).over(before), F.lit(0)).alias(base)), "bases")
    based = ranked.join(bases, (F.col(part) == F.col("b_part")) & F.col(length_col).eqNullSafe(F.col("b_length"))).select(
        *[F.col(f"`{c}`") for c in pieces.columns], (F.col(rank) + F.col(base)).alias(rank))

    def place(batches):
        for batch in batches:
            size = np.asarray(batch.column(length_col).fill_null(0)).astype(np.int64)
            at = np.asarray(batch.column(rank))
            sequence, offset = np.full(len(size), -1, np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size[size > 0]):
                own = np.flatnonzero(size == s)
                first, start, m, low = places[int(s)]
                k = np.searchsorted(first, at[own], side="right") - 1
                within = at[own] - first[k]
                sequence[own] = start[k] + within // m[k]
                offset[own] = low[k] + within % m[k] * s
            none = sequence < 0
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence, mask=none), pa.array(offset, mask=none)],
                                             names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    return based.mapInArrow(place, schema_with(pieces, sequence_id="long", offset="long"))


def cut(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *, capacity: int = CAPACITY, end_id: int = END_ID,
        keep_ids: bool = False, slice_bytes: int = SLICE) -> DataFrame:
    """The documents' ids, ended by ``end_id``, in pieces of at most
    ``capacity``: doc_id, piece, start, length, ids_crc32, and ids if kept.
    A worker encodes ``slice_bytes`` of text at a time."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = schema_with(rows.select("doc_id"), piece="int", start="long", length="long", ids_crc32="long", **({"ids": "binary"} if keep_ids else {}))

    def pieces(batches):
        code = encoder(tokenizer)
        for batch in slices(batches, "text", slice_bytes):
            ids, counts = with_end(*code.encode(batch.column("text")), end_id)
            data = memoryview(ids.astype("<u4").tobytes())
            n = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, counts[doc] - start)
            low = (np.cumsum(counts) - counts)[doc] + start
            own = [data[4 * a:4 * b] for a, b in zip(low.tolist(), (low + length).tolist())]
            columns = [batch.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                       pa.array([zlib.crc32(x) for x in own], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array([bytes(x) for x in own], pa.binary())] if keep_ids else []), names=schema.names)

    return rows.mapInArrow(pieces, schema)


def packed_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *, capacity: int = CAPACITY,
                     end_id: int = END_ID, steps: int = STEPS, keep_ids: bool = False, slice_bytes: int = SLICE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset (and ids)."""
    pieces = cut(docs, tokenizer, id_col, text_col, capacity=capacity, end_id=end_id, keep_ids=keep_ids, slice_bytes=slice_bytes)
    return pack(pieces, "length", capacity, steps)


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences of pieces packed with their ids: sequence_id,
    ids (little-endian, 4 bytes each), doc_ids and lengths in order."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "length")))
    return packed.groupBy("sequence_id").agg(own.alias("own")).select(
        "sequence_id", F.aggregate("own", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.transform("own", lambda x: x["doc_id"]).alias("doc_ids"), F.transform("own", lambda x: x["length"]).alias("lengths"))
