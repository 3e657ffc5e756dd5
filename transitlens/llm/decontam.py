"""Benchmark decontamination (operator 2).

The normalised words of all benchmark items form one generalised suffix
automaton.  Training words stream through it; at every word the automaton
knows the longest stretch, ending there, that occurs in some item.  Where that
stretch covers a whole window (``window`` consecutive item words, or an item
that has fewer) the words of the window are hit.  Spans of hit words are
removed; a document whose hit words reach ``1/coverage`` of its words is
contaminated and leaves as a whole.

Normalisation: A-Z to lower case, words are runs of 0-9, a-z and bytes from
0x80 up.  Document words that no item holds reset the automaton; stretches in
which not every pair of neighbours occurs in an item, or which are shorter than
the shortest window, cannot match and are stepped over in numpy.

Benchmark size: items are the stated query set.  They are cut into blocks of
about ``block_words`` words; each block gives one automaton, which is broadcast
(so the broadcast is bounded whatever the benchmark's size), and documents are
scanned once per block, uncut, one block after the other.  Hits depend on the
text alone, so those of all blocks are gathered per distinct text (its SHA-256)
and merged; coverage is judged and spans are cut once, on all of them.  The
number of blocks changes no result.

Defined cases: null or empty text has no words and no hits; an item without
words matches nothing; null item_ids are ignored as items; repeated items both
count (distinct item_ids); repeated documents are judged row by row; an empty
benchmark leaves every document clean; extra columns of documents are ignored
by ``scan`` and kept by ``remove_spans``.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from transitlens.llm.common import Scratch, hand_back, pieces, text_buffers

WINDOW = 13
COVERAGE = 20
_IS_WORD = np.zeros(256, bool)
_IS_WORD[list(range(0x30, 0x3A)) + list(range(0x41, 0x5B)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True
# lower-case A-Z, every byte outside words to a space
_FOLD = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if _IS_WORD[c] else 0x20 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class SuffixAutomaton:
    """Generalised suffix automaton over word ids, with the windows of each
    item marked on the state that stands for them."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.marks: dict[int, dict[int, set[str]]] = {}       # state -> window length -> items
        seqs = [(k, [self.vocab.setdefault(w, len(self.vocab)) for w in ws]) for k, ws in items if ws]
        for _, seq in seqs:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        for item, seq in seqs:
            size, state = min(window, len(seq)), 0
            for i, c in enumerate(seq):
                state = self.next[state][c]
                while self.length[self.link[state]] >= size if state else False:
                    state = self.link[state]
                if i + 1 >= size:
                    self.marks.setdefault(state, {}).setdefault(size, set()).add(item)
        self.shortest = min((min(window, len(s)) for _, s in seqs), default=0)
        pairs = {a * len(self.vocab) + b for _, s in seqs for a, b in zip(s, s[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.upward = self._marked_ancestors()

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, c, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        twin = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = twin
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = twin
            p = link[p]
        return twin

    def _marked_ancestors(self) -> list[int]:
        """For each state the nearest marked state on its suffix path (itself included), or -1."""
        out = [-1] * len(self.next)
        for s in sorted(range(len(self.next)), key=self.length.__getitem__):
            out[s] = s if s in self.marks else (out[self.link[s]] if s else -1)
        return out

    def scan(self, ids: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(end, window length, items) of every window occurrence in a stretch of known words."""
        state = run = 0
        nxt, link, length = self.next, self.link, self.length
        for i, c in enumerate(ids):
            while state and c not in nxt[state]:
                state = link[state]
                run = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                run += 1
            else:
                run = 0
            at = self.upward[state]
            while at != -1:
                for size, items in self.marks[at].items():
                    if size <= run:
                        yield i + 1, size, items
                at = self.upward[link[at]] if at else -1

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(maximal spans of hit words, items) of one document."""
        if len(words) < self.shortest or not self.vocab:
            return [], set()
        ids = np.array(list(map(self.vocab.get, words, (-1,) * len(words))), np.int64)
        known = ids >= 0
        if self.shortest > 1:
            joined = known[1:] & known[:-1]
            at = np.flatnonzero(joined)
            key = ids[at] * len(self.vocab) + ids[at + 1]
            spot = np.minimum(np.searchsorted(self.pairs, key), max(len(self.pairs) - 1, 0))
            joined[at] = (self.pairs[spot] == key) if len(self.pairs) else False
            edge = np.diff(np.concatenate(([False], joined, [False])).view(np.int8))
            runs = [(a, b + 1) for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())]
        else:
            edge = np.diff(np.concatenate(([False], known, [False])).view(np.int8))
            runs = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
        spans, found = [], set()
        for a, b in runs:
            if b - a < self.shortest:
                continue
            for end, size, items in self.scan(ids[a:b].tolist()):
                found |= items
                lo, hi = a + end - size, a + end
                while spans and spans[-1][1] >= lo:
                    lo = min(lo, spans.pop()[0])
                spans.append((lo, hi))
        return spans, found


SCAN_SCHEMA = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Blocks of items in item_id order, one at least."""
    held, size, any_full = [], 0, False
    rows = (benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
            .filter("item_id is not null").distinct().orderBy("item_id", "text"))
    for r in rows.toLocalIterator():
        words = words_of((r["text"] or "").encode())
        held.append((r["item_id"], words))
        size += len(words)
        if size >= block_words:
            yield held
            held, size, any_full = [], 0, True
    if held or not any_full:
        yield held


def _scan(shared):
    def scan(batches):
        auto = shared.value
        for batch in pieces(batches, 1):
            raw, off = text_buffers(batch.column(1))
            body = raw.tobytes().translate(_FOLD)
            n, spans, items = [], [], []
            for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                words = body[a:b].split()
                n.append(len(words))
                s, f = auto.hits(words)
                spans.append([{"start": x, "end": y} for x, y in s])
                items.append(sorted(f))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(spans, _SPAN),
                 pa.array(items, pa.list_(pa.string()))], names=["doc_id", "n_words", "spans", "items"])
    return scan


def _text_hits(shared):
    """(text_key, spans, items) of the texts with hits."""
    def hits(batches):
        auto = shared.value
        for batch in pieces(batches, 1):
            raw, off = text_buffers(batch.column(1))
            body = raw.tobytes().translate(_FOLD)
            at, spans, items = [], [], []
            for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
                s, f = auto.hits(body[a:b].split())
                if s:
                    at.append(i)
                    spans.append([{"start": x, "end": y} for x, y in s])
                    items.append(sorted(f))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())).cast(pa.string()), pa.array(spans, _SPAN),
                                              pa.array(items, pa.list_(pa.string()))], names=["text_key", "spans", "items"])
        hand_back()
    return hits


def _text_key() -> F.Column:
    return F.sha2(F.col("text").cast("string").cast("binary"), 256)


def _gathered(docs: DataFrame, blocks: Iterable[list[tuple[str, list[bytes]]]], window: int) -> DataFrame:
    """(text_key, spans, items): hits of all blocks in the uncut texts, a row per distinct text
    that has any.  Each block's hits are written before the next block is built."""
    spark = docs.sparkSession
    tmp = Scratch(spark, "decontam")
    base = docs.select(_text_key().alias("text_key"), F.col("text").cast("string").alias("text")).filter("text is not null")
    found = None
    for i, block in enumerate(blocks):
        shared = spark.sparkContext.broadcast(SuffixAutomaton(block, window))
        # copies of a text have the same hits: one row stays, with partial aggregation
        part = tmp.write(base.mapInArrow(_text_hits(shared), "text_key string, spans array<struct<start:long,end:long>>, items array<string>")
                         .dropDuplicates(["text_key"]), f"block-{i}")
        shared.unpersist()
        found = part if found is None else found.unionByName(part)
    merged = found.groupBy("text_key").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return merged.withColumn("spans", _merge_spans("spans"))


def _split(blocks: Iterator) -> tuple[list, Iterator | None]:
    """(first block, None) of a single block, else (first block, all blocks)."""
    first = next(blocks)
    second = next(blocks, None)
    return first, None if second is None else chain([first, second], blocks)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = 500_000) -> DataFrame:
    """(doc_id, n_words, spans, items), a row per document: spans are maximal
    ranges of hit word numbers, items the sorted item_ids whose windows occur."""
    spark = docs.sparkSession
    first, several = _split(_blocks(benchmark, block_words))
    base = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if several is None:
        return base.mapInArrow(_scan(spark.sparkContext.broadcast(SuffixAutomaton(first, window))), SCAN_SCHEMA)
    found = _gathered(docs, several, window)
    counted = base.withColumn("text_key", _text_key()).mapInArrow(_sizes, "doc_id long, text_key string, n_words long")
    return (counted.join(found, "text_key", "left")
            .select("doc_id", "n_words", *[F.coalesce(c, F.array().cast(found.schema[c].dataType)).alias(c) for c in ("spans", "items")]))


def _sizes(batches):
    for batch in pieces(batches, 1):
        raw, off = text_buffers(batch.column(1))
        body = raw.tobytes().translate(_FOLD)
        n = [len(body[a:b].split()) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2).cast(pa.string()), pa.array(n, pa.int64())],
                                         names=["doc_id", "text_key", "n_words"])


def _merge_spans(col: str) -> F.Column:
    """Union of sorted ranges."""
    kind = "array<struct<start:bigint,end:bigint>>"
    return F.expr(f"""aggregate({col}, cast(array() as {kind}), (a, s) -> if(size(a) > 0 and s.start <= element_at(a, -1).end,
        concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, s.end)))),
        concat(a, array(s))))""")


def judged(scanned: DataFrame, coverage: int = COVERAGE) -> DataFrame:
    """Adds n_hit, n_items and contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return (scanned.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * coverage >= F.col("n_words"))))


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """Text without the bytes from the first to the last letter of each span of words."""
    raw = np.frombuffer(text, np.uint8)
    edge = np.diff(np.concatenate(([False], _IS_WORD[raw], [False])).view(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:start[a]])
        at = int(end[b - 1])
    out.append(text[at:])
    return b"".join(out)


def _kept(batch: pa.RecordBatch, spans_of_row, coverage: int) -> pa.RecordBatch:
    """The batch without contaminated rows, spans cut from the text of the others.
    ``spans_of_row`` gives the spans of (row number, words)."""
    at = batch.schema.get_field_index("text")
    raw, off = text_buffers(batch.column(at))
    body = raw.tobytes().translate(_FOLD)
    keep, cut = [], {}
    for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        words = body[a:b].split()
        spans = spans_of_row(i, words)
        n_hit = sum(y - x for x, y in spans)
        if n_hit and coverage * n_hit >= len(words):
            continue
        keep.append(i)
        if spans:
            cut[i] = cut_words(raw[a:b].tobytes(), spans).decode()
    if cut:
        new = [cut.get(i, t) for i, t in enumerate(batch.column(at).to_pylist())]
        batch = batch.set_column(at, batch.schema.field(at).name, pa.array(new, batch.schema.field(at).type))
    return batch if len(keep) == len(batch) else batch.take(pa.array(keep, pa.int64()))


def _clean(shared, coverage: int):
    def clean(batches):
        auto = shared.value
        for batch in pieces(batches, "text"):
            yield _kept(batch, lambda _, words: auto.hits(words)[0], coverage)
        hand_back()
    return clean


def _clean_found(coverage: int):
    """As _clean, with the spans of a row in its last column, which goes."""
    def clean(batches):
        for batch in pieces(batches, "text"):
            spans = [[(s["start"], s["end"]) for s in row or ()] for row in batch.column(batch.num_columns - 1).to_pylist()]
            yield _kept(batch.select(batch.schema.names[:-1]), lambda i, _: spans[i], coverage)
        hand_back()
    return clean


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: int = COVERAGE,
                 block_words: int = 500_000) -> DataFrame:
    """Documents (all columns) without contaminated ones; hit spans of the
    others are cut from their text.  Judged row by row on all items."""
    first, several = _split(_blocks(benchmark, block_words))
    if several is None:
        return docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(SuffixAutomaton(first, window)), coverage), docs.schema)
    found = _gathered(docs, several, window).select(F.col("text_key").alias("__text_key"), F.col("spans").alias("__spans"))
    joined = docs.withColumn("__text_key", _text_key()).join(found, "__text_key", "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], "__spans").mapInArrow(_clean_found(coverage), docs.schema)
