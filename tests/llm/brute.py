"""Plain versions of the operators, for small inputs: rows are (doc_id, text)."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def groups(n: int, pairs) -> list[int]:
    """The least member of each one's group."""
    parent = list(range(n))
    for a, b in pairs:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return [find(parent, i) for i in range(n)]


def token_ids(texts, name: str) -> list[list[int]]:
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    tok.encode_special_tokens = True
    return [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def majority(hashes) -> int:
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(text: str | None) -> int:
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    return majority([xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]) if grams else 0


def near(fps: list[int], bits: int = 3):
    f = np.array(fps, np.uint64)
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= bits):
            yield i, i + 1 + int(j)


def simhash_groups(texts) -> list[int]:
    return groups(len(texts), near([simhash(t) for t in texts]))


def levenshtein(a: str, b: str) -> int:
    x, y = (np.array([ord(c) for c in s], np.int64) for s in (a, b))
    at = np.arange(len(y) + 1)
    last = at.copy()
    for i, c in enumerate(x):
        best = np.concatenate([[i + 1], np.minimum(last[:-1] + (y != c), last[1:] + 1)])
        last = np.minimum.accumulate(best - at) + at
    return int(last[-1])


def similarity(a: str, b: str) -> float:
    return 1 - levenshtein(a, b) / max(len(a), len(b), 1)


def line_dedup(rows) -> list[tuple[int, int, str]]:
    """(lines, removed lines, text left) of each row, by the edit similarity of all
    pairs of lines."""
    occurrences = []
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i)):
        for k, line in enumerate((rows[i][1] or "").split("\n")):
            line = re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ")
            if len(line.split(" ")) >= 5 or len(line) >= 30:
                occurrences.append((i, k, line))
    texts = list(dict.fromkeys(line for *_, line in occurrences))
    sizes = np.array([len(t) for t in texts])
    bags = [Counter(t) for t in texts]

    def near():
        for i, a in enumerate(texts):
            for j in np.flatnonzero(np.abs(sizes[i + 1:] - sizes[i]) <= 0.2 * np.maximum(sizes[i + 1:], sizes[i]) + 1e-9) + i + 1:
                most = int(0.2 * max(sizes[i], sizes[j]) + 1e-9)  # the letters that differ are a lower bound
                if max((bags[i] - bags[j]).total(), (bags[j] - bags[i]).total()) <= most and levenshtein(a, texts[j]) <= most:
                    yield i, int(j)

    group = groups(len(texts), near())
    place, seen, gone = {t: group[i] for i, t in enumerate(texts)}, set(), defaultdict(set)
    for i, k, line in occurrences:
        if place[line] in seen:
            gone[i].add(k)
        seen.add(place[line])
    out = []
    for i, (_, text) in enumerate(rows):
        lines = (text or "").split("\n")
        out.append((len(lines) if text is not None else 0, len(gone[i]), "\n".join(x for k, x in enumerate(lines) if k not in gone[i])))
    return out


def secrets(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans."""
    text = text or ""
    names = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in n) for n in ("password", "passwd", "secret", "token", "api_?key"))
    assign = rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n >= 2}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def quality(rows) -> list[tuple]:
    """rows: (host, text).  Counts, base_failed, kept."""
    def lines(text):
        found = [re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]+", "0", x.lower())).strip(" ") for x in (text or "").split("\n")]
        return [x for x in found if x]

    holders, hosts = defaultdict(set), defaultdict(set)
    for host, text in rows:
        hosts[host].add(text or "")
        for line in lines(text):
            holders[host, line].add(text or "")
    out = []
    for host, text in rows:
        c = counts(text)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        gone = sum(len(x.split(" ")) for x in lines(text) if len(holders[host, x]) > max(20, min(100, 0.01 * len(hosts[host]))))
        out.append((*c, failed, not failed and c[0] - gone >= 0.5 * c[0]))
    return out


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2) -> dict:
    """By sharing, stopping and sharing again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    free, left, target = set(names), share * sum(sizes.values()), {}
    while free:
        total = sum(weight[s] for s in free)
        stopped = [s for s in free if left * weight[s] / total >= most * sizes[s]]
        if not stopped:
            return target | {s: left * weight[s] / total for s in free}
        for s in stopped:
            target[s] = float(most * sizes[s])
            free.remove(s)
        left = share * sum(sizes.values()) - sum(target.values())
    return target


def check_packing(pieces, capacity: int) -> int:
    """pieces: (sequence, offset, length).  The number of sequences."""
    bins = defaultdict(list)
    for sequence, offset, length in pieces:
        bins[sequence].append((offset, length))
    for placed in bins.values():
        upto = 0
        for offset, length in sorted(placed):
            assert offset == upto
            upto += length
        assert upto <= capacity
    return len(bins)


def log_odds(n: float) -> float:
    return math.log(n)
