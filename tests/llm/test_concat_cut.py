"""Concatenate and cut against the tokenizer itself."""

from collections import defaultdict

import brute
import numpy as np
import pytest
from conftest import table

from equigap.llm import concat_cut
from equigap.llm.queries import QUERIES, WORD_BPE, vocabulary


def check(got, rows, capacity):
    """Every document's ids once and in order, sequences gapless and full."""
    want = defaultdict(list)
    for (d, *_), ids in zip(rows, brute.token_ids([t for _, t, *_ in rows], WORD_BPE)):
        want[d].append([*ids, 2])
    total = sum(len(x) for xs in want.values() for x in xs)
    assert sum(r.length for r in got) == total and all(r.length > 0 for r in got)
    left = defaultdict(list)
    for r in got:
        left[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for d, docs in want.items():
        pieces = sorted(left.pop(d))
        for ids in docs:  # rows that share an id have the same cuts or different tokens
            start = 0
            while start < len(ids):
                match = next(p for p in pieces if p[0] == start and p[3] == len(ids) and p[2] == brute.crc(ids[start:start + p[1]]))
                pieces.remove(match)
                start += match[1]
        assert not pieces
    assert not left
    bins = defaultdict(int)
    brute.check_packing([(r.sequence_id, r.offset, r.length) for r in got], capacity)
    for r in got:
        bins[r.sequence_id] += r.length
    sizes = sorted(bins.values(), reverse=True)
    assert sizes[:total // capacity] == [capacity] * (total // capacity)
    tail = sizes[total // capacity:]
    assert all(x & (x - 1) == 0 for x in tail) and len(set(tail)) == len(tail)  # nothing is padded


@pytest.mark.parametrize("capacity", [4096, 64, 1, 100])
def test_awkward_rows(docs, rows, capacity):
    got = concat_cut.packed(docs, vocabulary(WORD_BPE), capacity=capacity).collect()
    if capacity == 100:  # no power of two: only the tail's windows are powers
        brute.check_packing([(r.sequence_id, r.offset, r.length) for r in got], capacity)
    own = rows if capacity > 1 else None
    if own:
        check(got, own, capacity)
    else:
        assert all(r.length == 1 and r.offset == 0 for r in got) and len({r.sequence_id for r in got}) == len(got)


def test_many_tasks_and_a_hot_one(spark, docs, rows):
    run, concat_cut.RUN = concat_cut.RUN, 3
    try:
        check(concat_cut.packed(docs.repartition(17, "source"), vocabulary(WORD_BPE)).collect(), rows, 4096)
    finally:
        concat_cut.RUN = run


def test_sequences_hold_the_ids(docs, rows):
    got = concat_cut.sequences(concat_cut.packed(docs, vocabulary(WORD_BPE), keep_ids=True)).collect()
    ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(got, key=lambda r: r.sequence_id)])
    assert len(ids) == sum(len(x) + 1 for x in brute.token_ids([t for _, t, _ in rows], WORD_BPE)) and (ids == 2).sum() >= len(rows)
    for r in got:
        assert len(np.frombuffer(r.ids, "<u4")) == sum(r.lengths) and len(r.doc_ids) == len(r.starts) == len(r.lengths)


@pytest.mark.parametrize("total", [0, 1, 4095, 4096, 4097, 3 * 4096 + 1234])
def test_windows(total):
    w = concat_cut.Windows(total, 4096)
    place = np.arange(total)
    of = w.of(place)
    assert (w.start(of) <= place).all() and (place < w.end(of)).all()
    assert of.tolist() == sorted(of.tolist())


def test_query(spark, tmp_path, rows):
    table(spark, rows, str(tmp_path / "documents.parquet"))
    check(QUERIES["op12_concat_cut"](spark, str(tmp_path)).collect(), rows, 4096)


def test_empty_table(nothing):
    assert concat_cut.packed(nothing, vocabulary(WORD_BPE)).collect() == []
