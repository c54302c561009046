"""Every operator on awkward rows, against brute force."""

import hashlib
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from equigap.llm import bitpack, chunk_dedup, license_scan, line_dedup, mixing, packing, quality, secret_scan, simhash, token_files
from equigap.llm.queries import BYTE_BPE, FLAT_END_ID, WORD_BPE, vocabulary

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def key(x):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in x)


def same(got, want):
    got, want = sorted(map(tuple, got), key=key), sorted(map(tuple, want), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == b


def test_separator_scan(docs, rows):
    got = token_files.document_counts(docs, vocabulary(WORD_BPE), FLAT_END_ID).select("doc_id", "n_tokens").collect()
    same(got, [(d, len(x)) for (d, *_), x in zip(rows, brute.token_ids([t for _, t, _ in rows], WORD_BPE))])


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_separator_blocks(spark, tmp_path, block):
    import numpy as np

    files = {"a": [5, 9, 9, 1, 2, 3, 4, 5, 6, 9], "b": [], "c": [7, 7, 7, 7, 7, 7, 7, 7], "d": [9], "e": [1, 9, 2]}
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    want, n = [], 0
    for name, ids in sorted(files.items()):
        start = 0
        for place, end in enumerate([*(i for i, x in enumerate(ids) if x == 9), *([len(ids)] if ids and ids[-1] != 9 else [])]):
            want.append((n, name, place, start, end - start, end < len(ids)))
            start, n = end + 1, n + 1
    token_files_run, token_files.RUN = token_files.RUN, 2
    try:
        got = token_files.scan_documents(spark, str(tmp_path), 9, block).collect()
    finally:
        token_files.RUN = token_files_run
    same([(r.ordinal, r.path[-1], r.place, r.start, r.n_tokens, r.ended) for r in got], want)


def test_license_scan(spark, docs, rows):
    got = {(r.doc_id): r for r in license_scan.scan(docs.where("doc_id >= 300")).collect()}
    assert got[306].license_id == "Apache-2.0" and got[306].n_license_lines == 1
    assert got[307].license_id is None and got[307].line_licenses == "MIT" and got[307].n_license_lines == 1
    assert license_scan.scan(docs).count() == len(rows)


def test_license_canonical_form(spark):
    mit = license_scan.TEXTS["MIT"]
    texts = [mit, mit.upper(), mit.replace("the copyright holder", "2011 Somebody Else"), mit.replace("(the", "( the").replace(" ", "  "),
             mit.replace("License", "Licence"), mit.replace("free of charge", "for a fee"), "", None, "licence licence licence", "LICENSE license, license"]
    found = license_scan.matches(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"),
                                 license_scan.known_texts(spark)).orderBy("i").collect()
    assert [r.license_id for r in found] == ["MIT"] * 5 + [None] * 5
    assert found[8].canonical_sha256 == found[9].canonical_sha256


def test_packing(docs, rows):
    got = packing.packed_documents(docs, vocabulary(WORD_BPE)).collect()
    want = []
    for (d, *_), ids in zip(rows, brute.token_ids([t for _, t, _ in rows], WORD_BPE)):
        ids = [*ids, 0]
        want += [(d, a // 2048, a, len(ids[a:a + 2048]), brute.crc(ids[a:a + 2048])) for a in range(0, len(ids), 2048)]
    same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], want)
    bins = brute.check_packing([(r.sequence_id, r.offset, r.length) for r in got], 2048)
    assert bins == -(-sum(r.length for r in got) // 2048)


def test_sequences_hold_the_ids(docs):
    import numpy as np

    got = packing.packed_documents(docs, vocabulary(WORD_BPE), keep_ids=True).cache()
    for r in packing.sequences(got).collect():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == sum(r.lengths) <= 2048 and len(r.doc_ids) == len(r.lengths)


def test_quality(docs, rows):
    got = quality.judge(docs).select("doc_id", *quality.COUNTS, "base_failed", "kept").collect()
    want = [(d, *q) for (d, *_), q in zip(rows, brute.quality([(s, t) for _, t, s in rows]))]
    same(got, want)
    kept = quality.clean(docs)
    assert kept.columns == docs.columns
    same(kept.select("doc_id", "text").collect(), [(d, t) for (d, t, _), w in zip(rows, want) if w[-1]])


def test_line_frequency_rejects_furniture(spark, tmp_path):
    from conftest import table

    body = lambda i, n: " ".join("w" + "abcdefghij"[i % 10] * (1 + i // 10) + "y" * k for k in range(n))
    menu = "\n".join(" ".join(f"menu{m} item{k}" for k in range(10)) for m in range(3))
    rows = [(i, f"{menu}\n{body(i, 30)}", "hot") for i in range(60)] + [(100 + i, f"{menu}\n{body(i, 90)}", "hot") for i in range(5)]
    rows += [(200 + i, f"{menu}\n{body(0, 30)}", "copies") for i in range(60)] + [(300, f"{menu}\n{body(1, 30)}", None)]
    got = quality.judge(table(spark, rows, str(tmp_path / "documents.parquet"))).collect()
    assert {r.doc_id: r.kept for r in got} == {d: not d < 60 for d, *_ in rows}
    assert all(r.removed_words == 60 for r in got if r.doc_id < 200)


def test_mixing(docs, rows):
    got = mixing.mix(docs).collect()
    sizes, taken = Counter(), Counter()
    for _, t, s in rows:
        sizes[s] += len(brute.WORDS.findall(t or ""))
    same([(r.doc_id, r.size) for r in got], [(d, len(brute.WORDS.findall(t or ""))) for d, t, _ in rows])
    target, longest = brute.targets(sizes), defaultdict(int)
    place = {}
    for d, t, s in rows:
        place.setdefault((d, len(brute.WORDS.findall(t or "")), sizes[s]), s)
    for r in got:
        s = place[r.doc_id, r.size, r.source_size]
        assert r.target == pytest.approx(target[s]) and r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[s] += r.taken
        longest[s] = max(longest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6
    again = mixing.mix(docs.repartition(5)).select("doc_id", "size", "taken").collect()
    assert Counter(map(tuple, again)) == Counter((r.doc_id, r.size, r.taken) for r in got)
    copies = mixing.mixed(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r.copies for r in got)


def test_line_dedup(docs, rows):
    small = docs.where("doc_id is null or doc_id != 304")  # brute force compares all its lines
    got = line_dedup.deduped(small, counts=("n_lines", "n_removed"))
    own = [r for r in rows if r[0] != 304]
    want = [(d, *b) for (d, *_), b in zip(own, brute.line_dedup([(d, t) for d, t, _ in own]))]
    same([(r.doc_id, r.n_lines, r.n_removed, r.text or "") for r in got.collect()], want)
    assert line_dedup.deduped(docs).columns == docs.columns


def test_long_lines(spark, tmp_path):
    from conftest import table

    base = [f"word{k % 977}" for k in range(70_000)]
    edited = [w if k % 5000 else "edited" for k, w in enumerate(base)]
    rows = [(1, " ".join(base), "a"), (2, " ".join(edited), "a"), (3, " ".join(base[:3000]), "a"), (4, " ".join(reversed(base)), "a")]
    got = line_dedup.deduped(table(spark, rows, str(tmp_path / "documents.parquet")), counts=("n", "gone"))
    assert {r.doc_id: r.gone for r in got.collect()} == {1: 0, 2: 1, 3: 0, 4: 0}


def test_simhash(docs, rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    texts = [rows[i][1] for i in order]
    group = brute.simhash_groups(texts)
    want = [(rows[i][0], f"{brute.simhash(rows[i][1]):016x}", rows[order[g]][0]) for i, g in zip(order, group)]
    got = simhash.linked(docs)
    same(got.select("doc_id", "fingerprint", "component_id").collect(), want)
    one = simhash.one_of_each(docs)
    assert one.columns == docs.columns
    same([(r.doc_id,) for r in one.collect()], [(rows[order[g]][0],) for g in set(group)])


def test_bit_packing(docs, rows):
    got = bitpack.packed(docs, vocabulary(BYTE_BPE), file_ids=5000).orderBy("start").collect()
    want = Counter((d, len(x) + 1, brute.crc([*x, 0])) for (d, *_), x in zip(rows, brute.token_ids([t for _, t, _ in rows], BYTE_BPE)))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))


def test_secrets(docs, rows):
    got = secret_scan.scan(docs).collect()
    want = []
    for d, t, _ in rows:
        spans = brute.secrets(t)
        base = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        want.append((d, *(sum(k == i for _, k, _ in spans) for i in range(3)), hashlib.sha256(base.encode()).hexdigest(), base))
    base = [(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256,
             ",".join(s for s in r.spans.split(",") if s and not s.startswith("markov"))) for r in got]
    same(base, want)


def test_markov_models_on_held_out_strings(spark):
    import random
    import string

    rng = random.Random(4)
    letters = string.ascii_letters + string.digits + "+/"
    word = lambda: "".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(3, 6)))
    plain = lambda: rng.choice([lambda: word() + word() + word(), lambda: "_".join((word(), word(), word())), lambda: word() + word().title() + word().title()])()
    secret = lambda: "".join(rng.choices(letters, k=rng.randint(20, 40)))
    frame = lambda f, n: spark.createDataFrame([(f(),) for _ in range(n)], "value string")
    model = secret_scan.train(frame(secret, 2000), frame(plain, 3000))
    test = [(plain(), 0) for _ in range(500)] + [(secret(), 1) for _ in range(500)]
    test = [(s, y) for s, y in test if len(s) >= secret_scan.MIN_TOKEN]
    scored = spark.createDataFrame(test, "value string, y int").withColumn("r", secret_scan.log_ratio(F.col("value"), model)).collect()
    right = sum((r.r > brute.log_odds(secret_scan.ODDS)) == bool(r.y) for r in scored)
    assert right / len(scored) > 0.97
    # the ratio is the sum of the transitions' log ratios
    at, size = secret_scan.ALPHABET.index, len(secret_scan.ALPHABET)
    for r in scored[::100]:
        assert r.r == pytest.approx(sum(model[at(a) * size + at(b)] for a, b in zip(r.value, r.value[1:])))


def test_markov_adds_spans(spark, tmp_path):
    import random
    import string

    from conftest import table

    rng = random.Random(9)
    letters = string.ascii_letters + string.digits
    word = lambda: "".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(4))
    secret = lambda: "".join(rng.choices(letters, k=32))
    rows = [(i, " ".join(word() for _ in range(60)) + f" secret={secret()} " + word() * 3, "a") for i in range(200)]
    rows += [(1000 + i, f"{word()} 😀 {secret()} {word() * 4} {word()}", "a") for i in range(50)]
    got = {r.doc_id: r for r in secret_scan.scan(table(spark, rows, str(tmp_path / "documents.parquet"))).collect()}
    assert sum(got[1000 + i].n_markov for i in range(50)) >= 45  # letters like words may stay below the odds
    for i in range(50):
        assert got[1000 + i].spans in ("", f"markov:{11}:{43}")
    assert all(got[i].n_markov == 0 for i in range(200))


def test_chunk_recipes(docs, rows):
    best = {}
    for d, t, _ in rows:
        best.setdefault(t or "", []).append(d)
    got = chunk_dedup.dedup_exact(docs, min_chars=20, max_chars=60).collect()
    stay = {t: max((d for d in ds if d is not None), default=None) for t, ds in best.items()}
    same([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got],
         [(d, stay[t or ""], len(best[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for d, t, _ in rows])
    kept = [r for r in got if r.kept]
    assert len(kept) == len(best) and all(r.doc_id == r.keep_id for r in kept)


def test_chunk_recipes_survive_digest_collisions(docs):
    weak = lambda c: F.substring(F.unhex(F.md5(c)), 1, 1)  # noqa: E731  256 digests
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "n_chunks"]
    same(chunk_dedup.dedup_exact(docs, digest=weak).select(cols).collect(), chunk_dedup.dedup_exact(docs).select(cols).collect())


def test_chunks_join_to_the_text(docs):
    cut = docs.select("text", chunk_dedup.chunks(F.col("text"), 10, 30).alias("c")).where("text is not null").collect()
    assert all("".join(r.c) == r.text and all(len(x) <= 32 for x in r.c) for r in cut)


@pytest.mark.parametrize("run", [
    lambda d: token_files.document_counts(d, vocabulary(WORD_BPE), FLAT_END_ID), license_scan.scan, lambda d: packing.packed_documents(d, vocabulary(WORD_BPE)),
    quality.judge, quality.clean, mixing.mix, mixing.mixed, line_dedup.deduped, simhash.linked, simhash.one_of_each,
    lambda d: bitpack.packed(d, vocabulary(BYTE_BPE)), secret_scan.scan, chunk_dedup.dedup_exact], ids=range(13))
def test_empty_table(nothing, run):
    assert run(nothing).collect() == []
