"""The manifest against a plain recursive tree."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import table
from pyspark.sql import functions as F

from equigap.llm import merkle
from equigap.llm.queries import QUERIES

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fan=3):
    """(root, each node's siblings by level as (left, right))."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(place):
            run = p // fan * fan
            paths[k].append((nodes[run:p], nodes[p + 1:run + fan]))
            place[k] = p // fan
        nodes = [h("".join(nodes[i:i + fan])) for i in range(0, len(nodes), fan)]
    return nodes[0], paths


def expected(rows):
    """rows: FIELDS' values."""
    groups = defaultdict(list)
    for r in rows:
        even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        text = r[4].replace("\n", "") if even and r[4] is not None else r[4]
        groups[r[1]].append((r[0], leaf(r), leaf((*r[:4], text))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        subs[s] = tree([x[1] for x in groups[s]])
    root, tops = tree([subs[s][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for (d, own, now), path in zip(groups[s], subs[s][1]):
            proof = ""
            for left, right in [*path, *tops[k]]:
                proof += "".join(left + right)
                now = h("".join([*left, now, *right]))
            out.append((d, own, subs[s][0], root, h(proof), now, now == root))
    return Counter(out)


def values(rows):
    return [(d, s, "en", len(t or ""), t) for d, t, s in rows]


def test_awkward_rows(spark, rows, tmp_path):
    table(spark, rows, str(tmp_path / "documents.parquet"))
    got = QUERIES["op11_merkle_climb"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == expected(values(rows))


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [1, 1], [81], [82], [243, 244], [729, 730, 1, 27, 28], [1] * 100, [5000]])
def test_shapes(spark, tmp_path, sizes):
    rng = random.Random(sum(sizes))
    rows = [(k * 10_000 + i, rng.choice(["a\nb", "c", None, "", "x\n" * 40]), f"s{k:03d}") for k, n in enumerate(sizes) for i in range(n)]
    rng.shuffle(rows)
    table(spark, rows, str(tmp_path / "documents.parquet"))
    assert Counter(map(tuple, QUERIES["op11_merkle_climb"](spark, str(tmp_path)).collect())) == expected(values(rows))


def test_untouched_rows_are_verified_and_a_lost_row_is_not(spark, docs):
    same = merkle.verified(docs, FIELDS).collect()
    assert all(r.verified for r in same) and len({r.root for r in same}) == 1
    touched = merkle.verified(docs, FIELDS, {"lang": F.when(F.col("doc_id") == 3, "xx").otherwise(F.col("lang"))}).collect()
    assert [r.doc_id for r in touched if not r.verified] == [3]
    assert merkle.verified(docs.where("not (doc_id <=> 4)"), FIELDS).first().root != same[0].root


def test_order_of_input_does_not_matter(docs):
    assert merkle.verified(docs.repartition(7, "text"), FIELDS).first().root == merkle.verified(docs.coalesce(1), FIELDS).first().root


def test_empty_table(nothing):
    assert merkle.verified(nothing, FIELDS).collect() == []


def test_oracle_on_awkward_rows(spark, rows, tmp_path):
    import duckdb

    from equigap.llm.queries import ORACLE

    path = str(tmp_path / "documents.parquet")
    table(spark, rows, path)
    sql = ORACLE["op11_merkle_climb"].replace("from documents", f"from '{path}/*.parquet'")
    assert Counter(duckdb.sql(sql).fetchall()) == expected(values(rows))
