"""Suffix-array dedup (operator 1).

Removes every byte that lies in a ``window``-byte string which also starts
earlier in the corpus.  Blockwise construction over a difference cover:

1. *Blocks.*  Documents are range-partitioned by doc_id and written once as
   blocks of about ``block_bytes``; blocks are numbered in doc_id order, so of
   two blocks the lower number starts earlier.  A document that equals an
   earlier one (128-bit digest of the text) is wholly covered by it, and takes
   no part in what follows.
2. *Cover ranks.*  Only suffixes at positions ``p`` with ``p mod v`` in a
   difference cover are sampled.  Any two equal windows have an offset below
   ``v`` at which both are sampled, and the samples agree on
   ``window - v + 1`` bytes.  Samples are dealt into suffix buckets (ranges of
   their fingerprints); each bucket is sorted on its own, which ranks its
   samples, and tells which ranks more than one suffix holds.
3. *Suffix buckets.*  A suffix can only tie with another over the whole window
   if a sample beside it has a shared rank; all others are settled without
   being sorted.  The rest are dealt into buckets, one bucket is sorted at a
   time, and ties give the earliest start.
4. *Cut.*  Each block learns which of its windows start earlier elsewhere and
   drops the bytes they cover.

Order inside a bucket is that of 64-bit fingerprints of the whole window, not
of its letters: the result depends on equality and earliest start alone.

What moves: a block sends each distinct fingerprint of a bucket once, sorted
and difference-coded (about 3 bytes a sample and 6 a window), and gets one bit
back for each.  A string that a third of all documents hold is therefore one
entry per block, never a group of rows.  Memory: a block and one bucket.

Defined cases: null text counts as empty (0 bytes, nothing removed); a text
shorter than the window is kept whole; null doc_id sorts last; rows that repeat
a doc_id are separate documents, ordered by their text; extra columns are ignored; empty table, empty result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from transitlens.llm.common import Scratch, mix64, release, text_buffers

U64 = np.uint64
# Perfect difference sets (every residue is a difference of two members).
COVERS = {
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
}
SAMPLE_BITS = 40
_SLICE = 1 << 17


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    v = max((v for v in COVERS if v <= 0.6 * window), default=None)
    if v is None:
        raise ValueError(f"window must be at least 12 bytes, got {window}")
    return v, COVERS[v]


def fingerprints(raw: np.ndarray, length: int) -> np.ndarray:
    """64-bit fingerprint of raw[p:p+length] for every p, by doubling widths.
    Worked off in slices that stay in the processor's cache."""
    n = len(raw) - length + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.empty(n, U64)
    for lo in range(0, n, _SLICE):
        hi = min(n, lo + _SLICE)
        part = raw[lo:hi + length - 1]
        width = 1
        if length >= 8:
            width, h = 8, np.empty(len(part) - 7, U64)
            for k in range(8):
                words = part[k:k + (len(part) - k) // 8 * 8]
                h[k::8] = np.frombuffer(words.tobytes(), U64)
            h = mix64(h)
        else:
            h = mix64(part.astype(U64) + U64(1))
        while width < length:
            step = min(width, length - width)
            h = h[:len(h) - step] * U64(0x9E3779B97F4A7C15) + h[step:]
            h ^= h >> U64(32)
            h *= U64(0xD6E8FEB86659FD93)
            h ^= h >> U64(29)
            width += step
        out[lo:hi] = h[:hi - lo]
    return out


def pack_sorted(keys: np.ndarray, planes: int) -> bytes:
    """Sorted uint64 keys as differences, one byte plane after another."""
    d = np.diff(keys, prepend=U64(0))
    d[0] = keys[0]
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes())


def unpack_sorted(blob: bytes, planes: int) -> np.ndarray:
    b = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(planes, -1)
    d = np.zeros((b.shape[1], 8), np.uint8)
    d[:, :planes] = b.T
    return np.cumsum(d.view(U64).ravel(), dtype=U64)


def _bits(flags: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(flags).tobytes())


def _unbits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8), count=n).astype(bool)


BLOCK_SCHEMA = "block long, ids array<long>, h1 array<long>, h2 array<long>, sizes array<long>, body binary"


def _to_blocks(block_bytes: int):
    """Rows (doc_id, text, h1, h2) in doc_id order to blocks."""
    def pack(batches):
        part, no, held, size = TaskContext.get().partitionId(), 0, [], 0
        longs = pa.list_(pa.int64())

        def block():
            ids, h1, h2, sizes, body = ([x for h in held for x in h[i]] for i in range(5))
            return pa.RecordBatch.from_pydict({
                "block": pa.array([(part << 24) | no], pa.int64()), "ids": pa.array([ids], longs), "h1": pa.array([h1], longs),
                "h2": pa.array([h2], longs), "sizes": pa.array([sizes], longs),
                "body": [zstandard.ZstdCompressor(level=3).compress(b"".join(body))]})

        for batch in batches:
            ids, h1, h2 = (batch.column(i).to_pylist() for i in (0, 2, 3))
            raw, off = text_buffers(batch.column(1))
            lo = 0
            while lo < len(ids):
                hi = max(lo + 1, int(np.searchsorted(off, off[lo] + block_bytes - size, side="right")) - 1)
                held.append((ids[lo:hi], h1[lo:hi], h2[lo:hi], np.diff(off[lo:hi + 1]).tolist(), [raw[off[lo]:off[hi]].tobytes()]))
                size += int(off[hi] - off[lo])
                lo = hi
                if lo < len(ids) or size >= block_bytes:
                    yield block()
                    held, size, no = [], 0, no + 1
        if held:
            yield block()
    return pack


class _Block:
    """One block's text with the start, in the block, of each document.
    ``replies``: what other steps found about the block (see REPLY)."""

    def __init__(self, row: dict, replies: list[dict]):
        self.no, self.ids = row["block"], row["ids"]
        self.sizes = np.array(row["sizes"], np.int64)
        self.raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["body"]), np.uint8)
        self.start = np.concatenate(([0], np.cumsum(self.sizes)))
        self.shared, self.later = ({r["bucket"]: r["bits"] for r in replies if r["kind"] == k} for k in (SHARED, LATER))
        self.copies = {r["bucket"] for r in replies if r["kind"] == COPY}
        self.own = [(s, n) for i, (s, n) in enumerate(zip(self.start[:-1].tolist(), row["sizes"])) if i not in self.copies]

    def valid(self, length: int) -> np.ndarray:
        """Positions at which ``length`` bytes of one document start."""
        ok = np.zeros(len(self.raw), bool)
        for s, n in self.own:
            if n >= length:
                ok[s:s + n - length + 1] = True
        return ok

    def samples(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, keys) of the cover sample."""
        v, cover = cover_for(window)
        length = window - v + 1
        member = np.zeros(v, bool)
        member[list(cover)] = True
        ok = self.valid(length)
        for s, n in self.own:
            ok[s:s + n] &= np.resize(member, n)
        pos = np.flatnonzero(ok)
        return pos, fingerprints(self.raw, length)[pos] >> U64(64 - SAMPLE_BITS) if len(pos) else np.zeros(0, U64)

    def candidates(self, window: int, n_buckets: int) -> np.ndarray:
        """Positions whose window holds a cover sample of shared rank."""
        v, _ = cover_for(window)
        pos, keys = self.samples(window)
        if not len(pos):
            return pos
        uniq, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        flag = counts > 1
        for b, lo, hi in _cuts(uniq, SAMPLE_BITS, n_buckets):
            if b in self.shared:
                flag[lo:hi] |= _unbits(self.shared[b], hi - lo)
        hit = pos[flag[inverse]]
        edge = np.zeros(len(self.raw) + 1, np.int32)      # windows that start within v-1 bytes before the sample
        np.add.at(edge, np.maximum(hit - (v - 1), 0), 1)
        np.add.at(edge, hit + 1, -1)
        return np.flatnonzero((np.cumsum(edge[:-1]) > 0) & self.valid(window))

    def windows(self, window: int, cand: np.ndarray):
        """Distinct fingerprints of the candidates: keys, first position, inverse."""
        if not len(cand):
            return np.zeros(0, U64), cand, cand
        return np.unique(fingerprints(self.raw, window)[cand], return_index=True, return_inverse=True)


def _cuts(keys: np.ndarray, bits: int, n_buckets: int):
    """(bucket, from, to) over sorted keys; a bucket is a range of keys."""
    if not len(keys):
        return
    step = -(-(1 << bits) // n_buckets)
    edges = np.searchsorted(keys, np.array([min(step * b, (1 << bits) - 1) for b in range(1, n_buckets)], U64))
    edges = np.concatenate(([0], edges, [len(keys)]))
    for b in range(n_buckets):
        if edges[b + 1] > edges[b]:
            yield b, int(edges[b]), int(edges[b + 1])


def _send_samples(window: int, n_buckets: int):
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            blk = _Block(row, right.to_pylist())
            keys = np.unique(blk.samples(window)[1])
            out += [(b, blk.no, pack_sorted(keys[lo:hi], SAMPLE_BITS // 8)) for b, lo, hi in _cuts(keys, SAMPLE_BITS, n_buckets)]
        return pa.Table.from_batches([_batch(out, KEYS, KEY_TYPES)])
    return send


KEYS, KEY_TYPES, KEY_SCHEMA = ("bucket", "block", "keys"), (pa.int32(), pa.int64(), pa.binary()), "bucket int, block long, keys binary"


def _batch(rows: list[tuple], names, types) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=list(names))


def _rank_samples(table: pa.Table) -> pa.Table:
    """Sort one bucket of samples; tell each block which of its ranks are shared."""
    rows = table.to_pylist()
    parts = [unpack_sorted(r["keys"], SAMPLE_BITS // 8) for r in rows]
    keys = np.sort(np.concatenate(parts))
    shared = keys[1:][keys[1:] == keys[:-1]]
    out = []
    for r, part in zip(rows, parts):
        if len(shared):
            at = np.minimum(np.searchsorted(shared, part), len(shared) - 1)
            flag = shared[at] == part
            if flag.any():
                out.append((r["block"], SHARED, r["bucket"], _bits(flag)))
    return pa.Table.from_batches([_batch(out, REPLY, REPLY_TYPES)])


# A reply: the block's samples of a bucket with shared rank, its windows of a bucket that
# start earlier elsewhere (one bit each), or (bucket: its place) a document that is a copy.
SHARED, LATER, COPY = 0, 1, 2
REPLY = ("block", "kind", "bucket", "bits")
REPLY_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
REPLY_SCHEMA = "block long, kind int, bucket int, bits binary"


def _send_windows(window: int, n_buckets: int):
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            blk = _Block(row, right.to_pylist())
            keys, _, _ = blk.windows(window, blk.candidates(window, n_buckets))
            out += [(b, blk.no, pack_sorted(keys[lo:hi], 8)) for b, lo, hi in _cuts(keys, 64, n_buckets)]
        return pa.Table.from_batches([_batch(out, KEYS, KEY_TYPES)])
    return send


def _earliest(table: pa.Table) -> pa.Table:
    """Sort one suffix bucket; tell each block which windows an earlier block starts."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    parts = [unpack_sorted(r["keys"], 8) for r in rows]
    keys = np.concatenate(parts)
    order = np.argsort(keys, kind="stable")                     # ties stay in block order
    k = keys[order]
    later = np.zeros(len(k), bool)
    later[order[1:]] = k[1:] == k[:-1]
    out, lo = [], 0
    for r, part in zip(rows, parts):
        flag = later[lo:lo + len(part)]
        lo += len(part)
        if flag.any():
            out.append((r["block"], LATER, r["bucket"], _bits(flag)))
    return pa.Table.from_batches([_batch(out, REPLY, REPLY_TYPES)])


SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
OUT_SCHEMA = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def _cut(window: int, n_buckets: int):
    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, sizes, spans, kept = [], [], [], []
        for row in left.to_pylist():
            blk = _Block(row, right.to_pylist())
            cand = blk.candidates(window, n_buckets)
            keys, first, inverse = blk.windows(window, cand)
            flag = np.zeros(len(keys), bool)
            for b, lo, hi in _cuts(keys, 64, n_buckets):
                if b in blk.later:
                    flag[lo:hi] = _unbits(blk.later[b], hi - lo)
            again = np.ones(len(cand), bool)
            again[first] = False                                  # a repeat inside the block
            hit = cand[again | flag[inverse]] if len(cand) else cand
            edge = np.zeros(len(blk.raw) + 1, np.int32)
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + window, -1)
            gone = np.cumsum(edge[:-1]) > 0
            for i, (s, n) in enumerate(zip(blk.start[:-1].tolist(), blk.sizes.tolist())):
                ids.append(blk.ids[i])
                sizes.append(n)
                if i in blk.copies:
                    spans.append([{"start": 0, "end": n}])
                    kept.append(b"")
                    continue
                g = gone[s:s + n]
                turn = np.flatnonzero(np.diff(np.concatenate(([False], g, [False])).view(np.int8))).tolist() if g.any() else []
                spans.append([{"start": a, "end": b} for a, b in zip(turn[::2], turn[1::2])])
                kept.append(blk.raw[s:s + n][~g].tobytes() if turn else blk.raw[s:s + n].tobytes())
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(sizes, pa.int64()),
                         "spans": pa.array(spans, SPAN), "kept": pa.array(kept, pa.binary())})
    return cut


def suffix_dedup(docs: DataFrame, window: int = 100, block_bytes: int = 8 << 20, bucket_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the removed byte ranges of each document
    and the bytes that stay.  ``bucket_bytes``: corpus bytes per suffix bucket."""
    spark = docs.sparkSession
    cover_for(window)
    tmp = Scratch(spark, "suffix-dedup")
    rows = (docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit("second"), "text")}))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = F.col("doc_id").asc_nulls_last()
    blocks = tmp.write(rows.repartitionByRange(max(1, -(-total // (2 * block_bytes))), order).sortWithinPartitions(order, "text")
                       .mapInArrow(_to_blocks(block_bytes), BLOCK_SCHEMA), "blocks")
    release(spark)
    each = blocks.select("block", F.posexplode(F.arrays_zip("h1", "h2", "sizes")).alias("at", "d")).filter(F.col("d.sizes") >= window)
    each = each.select("block", "at", "d.h1", "d.h2")
    first = each.groupBy("h1", "h2").agg(F.min(F.struct("block", "at")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    copies = tmp.write(each.join(first, ["h1", "h2"]).filter(F.struct("block", "at") != F.col("first"))
                       .select("block", F.lit(COPY).alias("kind"), F.col("at").alias("bucket"), F.lit(None).cast("binary").alias("bits")), "copies")
    n_buckets = int(max(16, -(-total // bucket_bytes)))
    ranks = tmp.write(blocks.groupBy("block").cogroup(copies.groupBy("block")).applyInArrow(_send_samples(window, n_buckets), KEY_SCHEMA)
                      .groupBy("bucket").applyInArrow(_rank_samples, REPLY_SCHEMA), "ranks").unionByName(copies)
    release(spark)
    later = tmp.write(blocks.groupBy("block").cogroup(ranks.groupBy("block")).applyInArrow(_send_windows(window, n_buckets), KEY_SCHEMA)
                      .groupBy("bucket").applyInArrow(_earliest, REPLY_SCHEMA), "later")
    release(spark)
    return (blocks.groupBy("block").cogroup(ranks.unionByName(later).groupBy("block"))
            .applyInArrow(_cut(window, n_buckets), OUT_SCHEMA))
