"""SimHash near-duplicates with pivot distance tables.

A document's 64-bit fingerprint has each bit that is set in over half of its
word shingles' hashes.  Fingerprints within ``max_bits`` bits are linked, and
a group is a connected component of links.  Work is done on distinct
fingerprints, so copies cost one row.

Comparing all pairs does not scale, and distances to pivots alone cannot
index 64-bit fingerprints (two unrelated ones lie within 3 of each other on
nearly half of all pivots).  So fingerprints are first brought together
exactly: cut into ``blocks`` blocks, two that differ in at most ``max_bits``
bits agree on at least blocks - max_bits of them, so each fingerprint goes
into one cell per such choice of blocks (20 cells of about 32 bits).  Within
a cell the pivot tables work: distances to PIVOTS reference fingerprints are
computed once per fingerprint, pairs are discarded when any coordinate
differs by more than max_bits (the triangle inequality: no link is lost), and
the survivors are verified bit by bit.  A cell of more than ``CELL``
fingerprints is cut again by the blocks of the bits that are still free, as
often as needed; that is exact too.  A cell yields a star, not its pairs.

Defined cases: null and empty texts have fingerprint zero and are linked like
any other; fewer words than a shingle holds make one shingle.  Rows that
repeat an id are rows of their own; null ids count as largest where a group's
least id is taken.  An empty table gives an empty result.  Other columns are
not read by ``linked`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .quality import slices
from .util import Scratch, fresh, schema_with, shuffle_partitions, small

SHINGLE, MAX_BITS, BLOCKS, HASH_SEED = 3, 3, 6, 42
#: Reference fingerprints, and the largest cell compared as it is.
PIVOTS = np.random.default_rng(7).integers(0, 2**64, 16, dtype=np.uint64)
CELL = 512
#: Shingle hashes whose bits are counted at once; pairs compared at once.
AT_ONCE, PAIRS = 1 << 16, 1 << 21


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=HASH_SEED), grams), np.uint64, n)
    bits = np.zeros(64, np.int64)
    for a in range(0, n, AT_ONCE):
        part = hashes[a:a + AT_ONCE].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(rows: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """``rows`` without ``text``, with fp: the fingerprint's 64 bits as a long."""
    keep = [c for c in rows.columns if c != text]

    def mark(batches):
        for batch in slices(batches, text):
            texts = pc.fill_null(batch.column(text), "").cast(pa.large_binary())
            fps = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(fps)], names=[*keep, "fp"])

    return rows.mapInArrow(mark, schema_with(rows.drop(text), fp="long"))


def masks(blocks: int = BLOCKS, max_bits: int = MAX_BITS) -> list[int]:
    """The 64-bit masks of every choice of blocks - max_bits blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(block[i] for i in chosen) for chosen in combinations(range(blocks), blocks - max_bits)]


def links(fps: np.ndarray, cell: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of places in ``fps``, sorted by ``cell``, of the same cell."""
    start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[start, len(cell)])
    last = np.repeat(start + size, size)
    partners = last - np.arange(len(cell)) - 1  # those after it in its cell
    table = np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    found = []
    total = np.cumsum(partners)
    at = 0
    while at < len(cell):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS)))
        n = partners[at:to]
        a = np.repeat(np.arange(at, to), n)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        for p in range(len(PIVOTS)):
            near = np.abs(table[a, p] - table[b, p]) <= max_bits
            a, b = a[near], b[near]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
        found.append((a[near], b[near]))
        at = to
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (start[:0], start[:0])


def stars(fps: np.ndarray, cell: np.ndarray, free: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, least member) of each group of fingerprints linked within a
    cell; all in a cell agree on the bits outside ``free`` or are few."""
    a, b = links_in(fps, cell, free, max_bits)
    label = np.arange(len(fps))  # always a root: label[label] == label
    while len(a):
        high, low = np.maximum(label[a], label[b]), np.minimum(label[a], label[b])
        np.minimum.at(label, high, low)
        while (label != label[label]).any():
            label = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    far = np.flatnonzero(label != np.arange(len(fps)))
    return fps[far], fps[label[far]]


def links_in(fps: np.ndarray, cell: np.ndarray, free: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``links``; large cells are cut by blocks of the free bits first.  Of
    max_bits + 1 blocks at least one is equal in linked fingerprints."""
    sizes = np.bincount(np.unique(cell, return_inverse=True)[1]) if len(cell) else np.zeros(0, int)
    large = np.repeat(sizes > CELL, sizes)
    small = np.flatnonzero(~large)
    a, b = links(fps[small], cell[small], max_bits) if len(small) else (small, small)
    out = [(small[a], small[b])]
    places = [i for i in range(64) if free >> i & 1]
    for c in np.unique(cell[large]):
        at = np.flatnonzero(cell == c)
        if len(places) <= max_bits + 1:
            out.append(tuple(at[x] for x in links(fps[at], cell[at], max_bits)))
            continue
        for k in range(max_bits + 1):
            own = sum(1 << i for i in places[k::max_bits + 1])
            key = fps[at] & np.uint64(own)
            order = np.argsort(key, kind="stable")
            out.append(tuple(at[order][x] for x in links_in(fps[at][order], key[order], free & ~own, max_bits)))
    return tuple(np.concatenate(x) for x in zip(*out))


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, a star per linked group of
    each cell."""
    mask = masks(blocks, max_bits)
    signed = [m - (1 << 64) if m >> 63 else m for m in mask]
    cells = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("choice", "cell"))
    cells = cells.repartition(shuffle_partitions(distinct.sparkSession), "choice", "cell").sortWithinPartitions("choice", "cell")

    def compare(batches):
        def pairs(choice, cell, fp):
            """Of whole cells: cells of one are dropped at once."""
            first = np.r_[True, (cell[1:] != cell[:-1]) | (choice[1:] != choice[:-1])]
            number = np.cumsum(first)
            many = (np.bincount(number)[number] > 1) if len(number) else first
            for k in np.unique(choice[many]):
                own = many & (choice == k)
                a, b = stars(fp[own], number[own], ~mask[k] & (1 << 64) - 1, max_bits)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        kept = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        for batch in batches:
            new = [np.asarray(batch.column("choice")), np.asarray(batch.column("cell")), np.asarray(batch.column("fp")).view(np.uint64)]
            kept = [np.concatenate(x) for x in zip(kept, new)]
            if len(kept[0]):  # the last cell may go on in the next batch
                open_ = int(np.argmax((kept[0] == kept[0][-1]) & (kept[1] == kept[1][-1])))
                yield from pairs(*[x[:open_] for x in kept])
                kept = [x[open_:] for x in kept]
        yield from pairs(*kept)

    return cells.mapInArrow(compare, "a long, b long").distinct()


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
           blocks: int = BLOCKS, row_col: str | None = None) -> DataFrame:
    """One row per input row: row (its number, ``row_col`` if there is one), ``id_col``,
    fingerprint (16 hex digits), component (a fingerprint as a long),
    component_id (its least id)."""
    scratch = Scratch(docs.sparkSession, "simhash")
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = scratch.write(with_fingerprints(rows, "text", shingle), "rows")
    distinct = scratch.write(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(scratch.write(fingerprint_links(distinct.select("fp"), max_bits, blocks), "edges"), scratch)
    named = scratch.write(distinct.join(roots, F.expr("fp = node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("component")), "named")
    least = scratch.write(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    groups = scratch.write(named.join(least, "component").select(F.col("fp").alias("g_fp"), "component", "component_id"), "groups")
    return rows.join(groups, F.expr("fp = g_fp")).select(
        "row", F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents with one of each group: the one with the least id."""
    scratch, [row] = Scratch(docs.sparkSession, "near-dedup"), fresh(docs, "simhash_row")
    placed = scratch.numbered(docs, row)
    found = linked(placed, id_col, row_col=row, **options)
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), "row")
    stay = scratch.write(found.groupBy("component").agg(F.min(order).alias("o")).select(F.col("o.row").alias(row)), "stay")
    return placed.join(small(stay, 32), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
