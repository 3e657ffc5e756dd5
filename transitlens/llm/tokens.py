"""Token ids of whole texts with a public tokenizer, stretch by stretch.

A pre-token of the tokenizers used here never crosses a space or a line feed,
and a full stop or comma between an ASCII letter and white space (or the text's
end) is a pre-token of its own.  A text's ids are therefore those of its
stretches between such places, one after the other.  Stretches repeat a lot:
each Python worker keeps the ids of those it has met, in a bounded hash table
of numpy arrays, and runs the tokenizer on new ones only.  Stretches are looked
up by 64-bit hashes, a chunk of text at a time, without a Python object per
word.  Where the tokenizer folds ASCII case, stretches are folded first, unless
the chunk may hold a special token or a combining mark (which could compose
with a small letter alone).
"""
from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from transitlens.llm.common import WordHasher, text_buffers

U64 = np.uint64
_MARK = "\x01"
_HELD: dict[tuple[str, int], "WordCachedEncoder"] = {}


def encoder(path: str, end_id: int) -> WordCachedEncoder:
    """The encoder of this Python worker: tasks that run in it one after another share what it has met."""
    if (path, end_id) not in _HELD:
        _HELD[path, end_id] = WordCachedEncoder(path, end_id)
    return _HELD[path, end_id]


class HashTable:
    """uint64 key -> number of its first insertion; open addressing over arrays."""

    def __init__(self, bits: int = 16):
        self.bits, self.n = bits, 0
        self.keys, self.vals = np.zeros(1 << bits, U64), np.zeros(1 << bits, np.int32)

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> U64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each key, -1 if absent (keys are not 0)."""
        out = np.full(len(h), -1, np.int64)
        at, slot, mask = np.arange(len(h)), self._slot(h), (1 << self.bits) - 1
        while len(at):
            k = self.keys[slot]
            hit = k == h[at]
            out[at[hit]] = self.vals[slot[hit]]
            on = ~hit & (k != 0)
            at, slot = at[on], (slot[on] + 1) & mask
        return out

    def add(self, h: np.ndarray) -> None:
        """Number new, distinct keys on from n."""
        while (self.n + len(h)) * 2 > len(self.keys):
            self._grow()
        self._put(h, np.arange(self.n, self.n + len(h), dtype=np.int32))
        self.n += len(h)

    def _put(self, h: np.ndarray, v: np.ndarray) -> None:
        slot, mask = self._slot(h), (1 << self.bits) - 1
        while len(h):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = h[free]
            won = free & (self.keys[slot] == h)
            self.vals[slot[won]] = v[won]
            h, v, slot = h[~won], v[~won], (slot[~won] + 1) & mask

    def _grow(self) -> None:
        used = self.keys != 0
        h, v = self.keys[used], self.vals[used]
        self.bits += 1
        self.keys, self.vals = np.zeros(1 << self.bits, U64), np.zeros(1 << self.bits, np.int32)
        self._put(h, v)


class WordCachedEncoder:
    def __init__(self, path: str, end_id: int, most_words: int = 1_000_000, most_ids: int = 5_000_000):
        self.tok, self.end_id = Tokenizer.from_file(path), end_id
        self.most_words, self.most_ids = most_words, most_ids
        mark = self.ids(_MARK)
        self.mark = mark[0] if len(mark) == 1 else None
        upper = string.ascii_uppercase
        self.folds = all(self.ids(s) == self.ids(s.lower()) for s in [upper, *upper, *(f"{c}a{c}" for c in upper)])
        self.hasher = WordHasher()
        self._reset()

    def ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _reset(self) -> None:
        self.table = HashTable()
        # number 0 is the end id
        self.flat, self.at, self.len = (np.zeros(1 << 16, t) for t in (np.uint32, np.int32, np.int32))
        self.flat[0], self.len[0], self.used, self.words = self.end_id, 1, 1, 1

    def _learn(self, h: np.ndarray, words: list[str]) -> None:
        """Run the tokenizer on new stretches, many in one text, told apart by a character of its own."""
        self.table.add(h)
        for lo in range(0, len(words), 8192):
            part = words[lo:lo + 8192]
            ids = np.array(self.tok.encode_batch_fast([f"\n{_MARK}\n".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            mark = ids == self.mark
            if self.mark is None or np.count_nonzero(mark) != len(part) - 1:        # a stretch holds it: one by one
                one = [np.array(self.ids(w), np.uint32) for w in part]
                ids, no = np.concatenate(one), np.repeat(np.arange(len(part)), [len(o) for o in one])
            else:
                no = np.cumsum(mark)[~mark]
                ids = ids[~mark]
            size = np.bincount(no, minlength=len(part))
            base = self.words
            while base + len(part) > len(self.at):
                self.at, self.len = np.resize(self.at, 2 * len(self.at)), np.resize(self.len, 2 * len(self.len))
            while self.used + len(ids) > len(self.flat):
                self.flat = np.resize(self.flat, 2 * len(self.flat))
            self.flat[self.used:self.used + len(ids)] = ids
            self.at[base:base + len(part)] = self.used + np.cumsum(size) - size
            self.len[base:base + len(part)] = size
            self.used += len(ids)
            self.words += len(part)

    def chunk(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets), an end id after each text; texts are raw[off[i]:off[i+1]]."""
        n, docs = len(raw), len(off) - 1
        body = raw.tobytes()
        if self.folds and not any(b in body for b in (b"<|", b"\xcc", b"\xcd")):
            body = body.lower()
            raw = np.frombuffer(body, np.uint8)
        gap = (raw == 32) | (raw == 10)
        begin = np.zeros(n + 1, bool)                       # a text starts here, or the last one ends
        begin[off] = True
        after = np.ones(n + 1, bool)                        # white space or a text's start
        after[:n] = gap
        after |= begin
        letter = np.zeros(n, bool)
        letter[1:] = ((raw[:-1] | 32) >= 97) & ((raw[:-1] | 32) <= 122)
        lone = ((raw == 46) | (raw == 44)) & letter & after[1:] & ~begin[:n]
        first = lone | begin[:n]
        first[1:] |= gap[:-1]
        start = np.flatnonzero(first & ~gap)
        cut = after.copy()
        cut[:n] |= lone
        end = np.flatnonzero(~gap & cut[1:]) + 1
        h = self.hasher(raw, start, end)
        h[h == 0] = 1
        no = self.table.find(h)
        miss = np.flatnonzero(no < 0)
        if len(miss):
            new, at = np.unique(h[miss], return_index=True)
            if self.words + len(new) > self.most_words or self.used > self.most_ids:
                self._reset()
                miss = np.arange(len(h))
                new, at = np.unique(h, return_index=True)
            spot = miss[at]
            self._learn(new, [body[a:b].decode() for a, b in zip(start[spot].tolist(), end[spot].tolist())])
            no[miss] = self.table.find(h[miss])
        no += 1
        where = np.searchsorted(start, off[1:])
        no = np.insert(no, where, 0)
        size = self.len[no].astype(np.int64)
        stop = np.cumsum(size)
        ids = self.flat[np.repeat(self.at[no] - (stop - size), size) + np.arange(int(stop[-1]) if docs else 0)]
        return ids, np.concatenate(([0], stop[where + np.arange(docs)]))

    def encode(self, col: pa.Array, chunk: int = 1 << 19):
        """Ids of each row's text (null: empty), worked off in runs of about ``chunk`` bytes."""
        raw, off = text_buffers(col)
        lo, n = 0, len(off) - 1
        while lo < n:
            hi = max(lo + 1, min(n, int(np.searchsorted(off, off[lo] + chunk, side="right")) - 1))
            ids, cut = self.chunk(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                yield ids[a:b]
            lo = hi
