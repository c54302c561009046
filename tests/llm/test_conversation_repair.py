"""The repair against a plain search over whole audits."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from equigap.llm import conversation_repair as C
from equigap.llm.queries import QUERIES, damaged

SCHEMA = "conv_id long, turn long, role string, text string, k string, pos string, code string"


def least(rows):
    """rows: (initial, role, text, fault).  The cheapest edits with the least audit,
    by keeping, for each role string's end, the best (cost, audit, rows) so far."""
    def follow(end, initial):
        return {"": "su", "s": "u", "u": "a", "a": "u"}[end].find(initial) >= 0 and initial in "sua" and initial != ""

    def with_inserts(states):
        out = dict(states)
        for _ in range(4):
            for end, (cost, audit, done) in list(out.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    if follow(end, initial):
                        new = (cost + 2, audit + "I", [*done, (role, "")])
                        out[initial] = min(out.get(initial, new), new)
        return out

    states = {"": (0, "", [])}
    for initial, role, text, fault in rows:
        found = {}

        def put(end, new):
            found[end] = min(found.get(end, new), new)

        for end, (cost, audit, done) in with_inserts(states).items():
            put(end, (cost + 3, audit + "D", done))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            if follow(end, initial):
                put(initial, (cost + more, audit + "K", [*done, (role, text)]))
            for i, r in (("u", "user"), ("a", "assistant")):
                if follow(end, i):
                    put(i, (cost + 2 + more, audit + "R", [*done, (r, text)]))
        states = found
    return min(v for end, v in with_inserts(states).items() if end in ("", "a"))


def expected(rows):
    """rows: (conv_id, turn, role, text) as they are before damage."""
    after, ids = defaultdict(list), {r[0] for r in rows}
    for conv, turn, role, text in rows:
        told = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        kind, role, text = zlib.crc32(f"{told[0]}:{told[1]}".encode()) % 20, told[2], told[3]
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            after[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv in ids:
        own = sorted(after[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32], hashlib.md5(r[2].encode()).digest()))
        seen, faults, told = set(), Counter(), []
        for _, role, text in own:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            told.append((role[:1], role, text, fault))
        turns = {t for t, *_ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(told, told[1:]))
        cost, audit, done = least(told)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha))
    return Counter(out)


def conversations(n=150, seed=3):
    rng = random.Random(seed)
    texts = ["Hello there.", "Yes!", "no end", " ", "", None, "Why?", "Done.\n", "é 😀.", "x" * 3000 + ".", "same."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "unknown"]
    rows = []
    for c in range(n):
        turn = 0
        for k in range(rng.randint(1, 12)):
            role = ["user", "assistant"][k % 2] if rng.random() < 0.7 else rng.choice(roles)
            turn += rng.choice([0, 1, 1, 1, 1, 3])
            rows.append((c, turn if rng.random() < 0.95 else None, role, f"{c} {k}." if rng.random() < 0.5 else rng.choice(texts)))
    return rows + [(None, 1, "user", "a."), (None, 2, "assistant", "b"), (None, None, None, None), (10_000, None, "user", "only."), (10_001, 5, "tool", "x.")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(4)


def report(spark, rows, **options):
    docs = frame(spark, rows)
    return Counter(map(tuple, C.Repair(damaged(docs), **options).report(docs).collect()))


@pytest.mark.parametrize("chunk", [C.CHUNK, 3, 1])
def test_against_brute_force(spark, chunk):
    rows = conversations()
    assert report(spark, rows, chunk=chunk) == expected(rows)


def test_query_and_columns(spark, tmp_path):
    rows = conversations(40, 8)
    frame(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    got = QUERIES["op13_hirschberg_repair"](spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert Counter(map(tuple, got.collect())) == expected(rows)


def test_one_conversation_with_most_rows(spark):
    rng = random.Random(5)
    rows = [(7, k, rng.choice(["user", "assistant", "assistant", "system"]), f"{rng.randint(0, 900)}{rng.choice(['.', '.', ''])}") for k in range(1500)]
    rows += conversations(20, 4)
    assert report(spark, rows, chunk=64) == expected(rows)


def test_every_code_string_up_to_four_rows():
    from itertools import product

    names = {0: "s", 1: "u", 2: "a", 3: "x"}
    faults = {C.SOUND: None, C.TRUNCATED: "truncated", C.GONE: "blank"}
    for n in range(1, 5):
        for codes in product(range(12), repeat=n) if n < 4 else random.Random(1).sample(list(product(range(12), repeat=4)), 1500):
            edits, q = C.solve(bytes(codes), C.NOTHING, None)
            cost, audit, _ = least([(names[c // 3], names[c // 3], str(i), faults[c % 3]) for i, c in enumerate(codes)])
            assert sum(e[0] for e in edits) + 2 * len(C.TAIL[q]) == cost
            assert "".join(e[1] for e in edits) + "I" * len(C.TAIL[q]) == audit


def test_repaired_rows_are_in_order(spark):
    repaired = C.Repair(frame(spark, conversations(60, 2))).repaired.orderBy("k", "pos", "part").collect()
    roles = defaultdict(str)
    for r in repaired:
        roles[r.k] += r.role[:1]
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in roles.values())


def test_empty_table(spark):
    assert report(spark, []) == Counter()


def test_oracle_on_awkward_rows(spark, tmp_path):
    import duckdb

    from equigap.llm.queries import ORACLE

    rows, path = conversations(60, 12), str(tmp_path / "conversations.parquet")
    frame(spark, rows).write.parquet(path)
    sql = ORACLE["op13_hirschberg_repair"].replace("from conversations", f"from '{path}/*.parquet'")
    assert Counter(duckdb.sql(sql).fetchall()) == expected(rows)
