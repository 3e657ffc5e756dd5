"""Sequence packing (operator 4): bounded-space online best fit.

Each partition streams its documents' token ids.  Stretches of ``size`` ids
become full sequences at once.  The remainder of a document goes to the open
window with the least room that still holds it; a partition keeps
``open_windows`` windows.  If none fits and all are in use, the fullest is
emitted, filled to the brim with the head of the remainder, and the tail opens
a new window.  At the end of a partition its open windows are merged into full
sequences and one leftover; leftovers of ``fan_in`` partitions are merged by
one task, again and again, until one is left.  Only the very last sequence can
be short.

Leftovers carry their ids (at most ``size`` per partition); all other pieces
leave as numbers, so nothing but leftovers is shuffled.

Defined cases: null or empty text is one piece of the end id; an empty table
gives no rows; repeated and null doc_ids are packed row by row; extra columns
are ignored.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from transitlens.llm.common import Scratch, hand_back
from transitlens.llm.tokens import encoder

PIECE = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
         ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]
PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
                "ids binary, part long")


class Packer:
    """Open windows of one task.  A window is a list of (doc, start, ids, doc_tokens)."""

    def __init__(self, size: int, open_windows: int, first_sequence: int):
        self.size, self.most = size, open_windows
        self.windows: list[tuple[int, list]] = []         # (used, pieces)
        self.sequence = first_sequence
        self.out: list[tuple] = []

    def emit(self, pieces: list, last: bool = False) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            raw = ids.astype("<u4").tobytes()
            self.out.append((doc, start, len(ids), zlib.crc32(raw), total, self.sequence, at, raw if last else None))
            at += len(ids)
        self.sequence += 1

    def document(self, doc, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.size:
            self.emit([(doc, at, ids[at:at + self.size], total)])
            at += self.size
        if at < total:
            self.piece(doc, at, ids[at:], total)

    def piece(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        need, best, room = len(ids), -1, self.size + 1
        for i, (used, _) in enumerate(self.windows):
            if need <= self.size - used < room:
                best, room = i, self.size - used
        if best >= 0:
            used, pieces = self.windows[best]
            pieces.append((doc, start, ids, total))
            if need == room:
                self.emit(pieces)
                self.windows.pop(best)
            else:
                self.windows[best] = (used + need, pieces)
            return
        if len(self.windows) == self.most:
            i = max(range(self.most), key=lambda k: self.windows[k][0])
            used, pieces = self.windows.pop(i)
            head = self.size - used
            self.emit(pieces + [(doc, start, ids[:head], total)])
            start, ids = start + head, ids[head:]
        self.windows.append((len(ids), [(doc, start, ids, total)]))

    def merge(self) -> None:
        """Join the open windows into full sequences and at most one leftover, fullest first."""
        self.windows.sort(key=lambda w: -w[0])
        stream = [p for _, pieces in self.windows for p in pieces]
        self.windows, held, used = [], [], 0
        for doc, start, ids, total in stream:
            while len(ids):
                take = min(self.size - used, len(ids))
                held.append((doc, start, ids[:take], total))
                start, ids, used = start + take, ids[take:], used + take
                if used == self.size:
                    self.emit(held)
                    held, used = [], 0
        if held:
            self.emit(held, last=True)

    def batch(self, part: int) -> pa.RecordBatch:
        cols = list(zip(*self.out)) if self.out else [[] for _ in PIECE]
        arrays = [pa.array(list(c), t) for c, (_, t) in zip(cols, PIECE)] + [pa.array([part] * len(self.out), pa.int64())]
        self.out = []
        return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in PIECE] + ["part"])


def _pack(tokenizer: str, end_id: int, size: int, open_windows: int):
    def pack(batches):
        part = TaskContext.get().partitionId()
        packer, enc = Packer(size, open_windows, part << 36), encoder(tokenizer, end_id)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for doc, ids in zip(docs, enc.encode(batch.column(1))):
                packer.document(doc, ids)
            yield packer.batch(part)
        packer.merge()
        yield packer.batch(part)
        hand_back()
    return pack


def _merge(size: int, level: int):
    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["sequence_id"], r["offset"]))
        packer = Packer(size, 1, (1 << 62) | (level << 56) | (rows[0]["grp"] << 20))
        used: dict[int, int] = {}
        for r in rows:
            used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
        for seq in used:
            packer.windows.append((used[seq], [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"])
                                               for r in rows if r["sequence_id"] == seq]))
        part = rows[0]["grp"]
        packer.merge()
        return pa.Table.from_batches([packer.batch(part)])
    return merge


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, size: int = 2048, open_windows: int = 64, fan_in: int = 32) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), a row per piece."""
    tmp = Scratch(docs.sparkSession, "packing")
    packed = tmp.write(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                       .mapInArrow(_pack(tokenizer, end_id, size, open_windows), PIECE_SCHEMA), "packed")
    done = packed.filter("ids is null")
    left = packed.filter("ids is not null")
    parts = (left.agg(F.max("part")).first()[0] or 0) + 1
    level = 0
    while parts > 1:
        level += 1
        merged = tmp.write(left.withColumn("grp", F.expr(f"part div {fan_in}"))
                           .groupBy("grp").applyInArrow(_merge(size, level), PIECE_SCHEMA), f"merged-{level}")
        done = done.unionByName(merged.filter("ids is null"))
        left = merged.filter("ids is not null")
        parts = -(-parts // fan_in)
    return done.unionByName(left).drop("ids", "part")
