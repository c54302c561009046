"""Token ids of whole texts through the tokenizers library, each distinct
piece of text encoded once per worker.

Most of a text's words have been seen before, and byte-pair encoding never
merges across a word's start.  So texts are cut where the tokenizer itself
must cut, each distinct piece is encoded by the library, and the ids are
gathered with numpy.  Two kinds of tokenizer are known: those that drop white
space (cut at any space), and byte-level ones whose words carry the space
before them (cut before a single space or line end between two words).  A
text with other white space goes to the library whole, so the ids are always
those of encoding the whole text.

A piece that is a plain word, with at most a punctuation mark behind it,
skips the library's splitting rules, which would leave it as it is: its word
goes straight to the library's model.  Other pieces go through all of it.

The pieces kept are bounded by ``CACHE``; beyond it those that came once leave,
and the rarer ones of the others down to half of it.
"""

from __future__ import annotations

import json
import os
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE = 300_000
#: Texts that a byte-level tokenizer gets whole: white space other than single
#: spaces and line ends inside the text, by the widest definition.
ODD = (r"[ \n][ \n]|\A[ \n]|[ \n]\z|[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200d}"
       r"\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]")
#: Plain pieces are one word of these (a line end or HEAD before it, a mark behind it).
WORD = "A-Za-zÀ-ÖØ-öø-ÿ"
HEAD = "\r"  # stands before a text's first piece, which no space precedes


def byte_letters() -> dict[int, str]:
    """Byte-level tokenizers write a byte as a letter: itself if it prints in
    Latin-1, else the next one from 256 on.  Here of the letters that WORD has."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in prints]
    letter = {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


LETTERS, SPACE = byte_letters(), chr(256 + 32)

_encoders: dict[str, Encoder] = {}


def encoder(path: str, cache: int = CACHE) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, cache)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str, cache: int = CACHE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.cache = Tokenizer.from_file(path), cache
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        kind = json.loads(self.tokenizer.to_str())
        self.drops_space = "</w>" == kind["model"].get("end_of_word_suffix")
        before = kind["pre_tokenizer"]
        self.cuts = self.drops_space or (before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
                                         and kind["normalizer"] is None)
        one = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        self.marks = {m: one(m)[0] for m in ".,;:!?" if len(one(m)) == 1}
        self.mark_ids, self.line_end = np.full(256, -1, np.int32), one("\n")
        for m, found in self.marks.items():
            self.mark_ids[ord(m)] = found
        self.plain = rf"\A[\n\r]?[{WORD}]+[{''.join(self.marks)}]?\z"
        self._empty()

    def _empty(self) -> None:
        self.index: dict[str, int] = {}
        self.start, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool, self.used, self.slots = np.zeros(1 << 16, np.int32), 0, 0
        self.hits = np.zeros(1024, np.int64)

    def _forget(self) -> None:
        """Rare pieces leave; what stays counts half from here on."""
        hits = self.hits[:self.slots]
        piece_at = dict(zip(self.index.values(), self.index))  # a slot whose piece has a later one goes
        stay = np.flatnonzero(hits > 1)
        stay = stay[[k in piece_at for k in stay.tolist()]] if len(piece_at) < self.slots else stay
        if len(stay) > self.cache // 2:
            stay = np.sort(stay[np.argpartition(hits[stay], -(self.cache // 2))[-(self.cache // 2):]])
        ids, size = self._gather(stay)
        kept, pieces = hits[stay] >> 1, [piece_at[k] for k in stay.tolist()]
        self._empty()
        self._add(pieces, ids, size)
        self.hits[:self.slots] = kept

    def _add(self, pieces: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        n, m, total = self.slots, len(pieces), len(ids)
        while n + m > len(self.start):
            self.start, self.length, self.hits = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length, self.hits))
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + total] = ids
        self.start[n:n + m] = self.used + np.cumsum(size) - size
        self.length[n:n + m] = size
        self.used, self.slots = self.used + total, n + m
        self.index.update(zip(pieces, range(n, self.slots)))

    def _words(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of plain pieces in a row, and each one's number.  Each word is
        encoded once, whatever marks are behind it."""
        offsets, data = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset:][:len(pieces) + 1], np.frombuffer(pieces.buffers()[2], np.uint8)
        mark = self.mark_ids[data[offsets[1:] - 1]]
        words = pc.utf8_rtrim(pieces, "".join(self.marks))
        if self.drops_space:
            words = pc.utf8_lower(pc.utf8_ltrim(words, "\n\r"))
        coded, model = words.dictionary_encode(), self.tokenizer.model.tokenize
        inner = [w if w.isascii() else w.translate(LETTERS) for w in coded.dictionary.to_pylist()]
        if self.drops_space:
            found = [[t.id for t in model(w)] for w in inner]
        else:
            found = [self.line_end + [t.id for t in model(w[1:])] if w[0] == "\n" else [t.id for t in model(w[1:] if w[0] == HEAD else SPACE + w)] for w in inner]
        own = np.fromiter(map(len, found), np.int64, len(found))
        flat, first = np.fromiter(chain.from_iterable(found), np.int32, int(own.sum())), np.cumsum(own) - own
        at = np.asarray(coded.indices)
        size = own[at] + (mark >= 0)
        out = np.empty(int(size.sum()), np.int32)
        ends = np.cumsum(size)
        out[ends[mark >= 0] - 1] = mark[mark >= 0]
        n = own[at]
        run = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(ends - size, n) + run] = flat[np.repeat(first[at], n) + run]
        return out, size

    def _ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in a row, and each one's number."""
        plain = np.asarray(pc.match_substring_regex(pieces, self.plain))
        if plain.all():
            return self._words(pieces) if len(pieces) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        other = pieces.filter(pa.array(~plain)).to_pylist()
        texts = other if self.drops_space else [p if p[:1] == "\n" else p[1:] if p[:1] == HEAD else " " + p for p in other]
        found = [e.ids for a in range(0, len(texts), 20_000) for e in self.tokenizer.encode_batch_fast(texts[a:a + 20_000], add_special_tokens=False)]
        size = np.empty(len(pieces), np.int64)
        size[~plain] = np.fromiter(map(len, found), np.int64, len(found))
        words, size[plain] = self._words(pa.concat_arrays([pieces.filter(pa.array(plain))])) if plain.any() else (np.zeros(0, np.int32), 0)
        out, of = np.empty(int(size.sum()), np.int32), np.repeat(plain, size)
        out[of], out[~of] = words, np.fromiter(chain.from_iterable(found), np.int32)
        return out, size

    def _known(self, pieces: pa.Array) -> np.ndarray:
        """The place of each piece, encoded now if it is new."""
        if self.slots > self.cache:
            self._forget()
        names = pieces.to_pylist()
        at = np.fromiter(map(self.index.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(at < 0)
        at[new] = self.slots + np.arange(len(new))
        self._add([names[i] for i in new.tolist()], *self._ids(pieces.take(pa.array(new))))
        return at

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces at ``at`` in a row, and each piece's number."""
        size = self.length[at]
        ends = np.cumsum(size)
        where = np.repeat(self.start[at] - (ends - size), size)
        where += np.arange(len(where))
        return self.pool[where], size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: none) in a row, and each text's number."""
        n, texts = len(texts), pc.fill_null(texts.cast(pa.large_string()), "")
        if not n:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        odd = np.zeros(n, bool)
        if not self.cuts:
            odd[:] = True
        elif not self.drops_space:
            odd = np.asarray(pc.match_substring_regex(texts, ODD))
        cut = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        lists = pc.split_pattern(pc.replace_substring(cut, "\n", " " if self.drops_space else " \n"), " ")
        offsets = np.asarray(lists.offsets)
        coded = lists.flatten().dictionary_encode()
        place, pieces = np.asarray(coded.indices), coded.dictionary
        if self.drops_space:
            at = self._known(pieces)[place]
        else:
            head, none = (pa.scalar(x, pa.large_string()) for x in (HEAD, ""))
            heads = pc.binary_join_element_wise(head, pc.list_element(lists, 0), none)
            heads = heads.dictionary_encode()
            known = self._known(pa.concat_arrays([pieces, heads.dictionary]))
            at = known[:len(pieces)][place]
            at[offsets[:-1]] = known[len(pieces):][np.asarray(heads.indices)]
        self.hits += np.bincount(at, minlength=len(self.hits))
        ids, size = self._gather(at)
        upto = np.concatenate([[0], np.cumsum(size)])[offsets]
        counts = np.diff(upto)
        if not odd.any():
            return ids, counts
        whole = self.tokenizer.encode_batch_fast(texts.filter(pa.array(odd)).to_pylist(), add_special_tokens=False)
        own = iter(whole)
        parts = [np.array(next(own).ids, np.int32) if odd[i] else ids[upto[i]:upto[i + 1]] for i in range(n)]
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, n)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each document's."""
    return np.insert(ids, np.cumsum(counts), end), counts + 1
