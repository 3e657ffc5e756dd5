"""Token ids in wavelet-matrix files (operator 5).

Documents are tokenised, sorted by doc_id over range partitions, and written as
binary files, one wavelet matrix per shard of about ``shard_tokens`` ids:

    magic "WMX1", then as little-endian unsigned 64-bit integers: bit planes,
    ids, documents, length of the compressed body; then the body (zstandard):
    doc_ids (int64), null marks (uint8), tokens per document (int64), zeros per
    plane (int64), and the planes, most significant bit first, each packed to
    bytes; the file ends in "WMXE" and a line feed.

A plane holds one bit of every id, in the order left by stably sorting on the
planes above it.  With a rank directory (set bits before every 512th bit, built
when a file is opened) one file answers access(i), rank(id, i), count(id) and
select(id, k) without unpacking the ids.

Files are written and read through Spark's own text and binary sources, so any
file system that Spark can reach works; rows hold a whole file, and the number
of ids in a file is bounded by ``shard_tokens`` plus one document.

Defined cases: null or empty text is the end id alone; null doc_id sorts last;
repeated doc_ids are separate rows in an order fixed by text; an empty table
writes no shard and reads back as no rows; extra columns are ignored.
"""
from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from transitlens.llm.common import Scratch
from transitlens.llm.tokens import encoder

MAGIC, END = b"WMX1", b"WMXE"
_HEAD = struct.Struct("<4sQQQQ")
_STEP = 512


class WaveletMatrix:
    """Succinct sequence of unsigned integers: one bit plane per bit."""

    def __init__(self, planes: list[np.ndarray], zeros: list[int], n: int):
        self.planes, self.zeros, self.n = planes, zeros, n
        self._dir = [None] * len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int | None = None) -> WaveletMatrix:
        ids = np.ascontiguousarray(ids)
        bits = bits or max(1, int(ids.max(initial=0)).bit_length())
        if bits <= 16:
            ids = ids.astype(np.uint16)
        planes, zeros = [], []
        for b in range(bits - 1, -1, -1):
            bit = (ids >> ids.dtype.type(b)).astype(np.uint8) & 1
            planes.append(np.packbits(bit))
            one = bit.view(bool)
            low = ids[~one]
            zeros.append(len(low))
            if b:
                ids = np.concatenate((low, ids[one]))
        return cls(planes, zeros, len(ids))

    def _bits(self, p: int) -> np.ndarray:
        return np.unpackbits(self.planes[p], count=self.n)

    def decode(self) -> np.ndarray:
        """All ids, in order: planes are undone from the last to the first."""
        out = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for p in range(len(self.planes) - 1, -1, -1):
            one = self._bits(p).view(bool)
            back = np.empty_like(out)
            back[~one] = out[:self.zeros[p]]
            back[one] = out[self.zeros[p]:] | out.dtype.type(1 << (len(self.planes) - 1 - p))
            out = back
        return out

    def _rank1(self, p: int, i: int) -> int:
        """Set bits among the first i of plane p."""
        if self._dir[p] is None:
            per = np.bitwise_count(self.planes[p]).astype(np.int64)
            self._dir[p] = np.concatenate(([0], np.cumsum(np.add.reduceat(per, np.arange(0, len(per), _STEP // 8)))))
        block = i // _STEP
        part = np.unpackbits(self.planes[p][block * _STEP // 8:(i + 7) // 8])[:i - block * _STEP]
        return int(self._dir[p][block]) + int(part.sum())

    def _bit(self, p: int, i: int) -> int:
        return int(self.planes[p][i >> 3]) >> (7 - (i & 7)) & 1

    def _check(self, i: int, n: int) -> None:
        if not 0 <= i < n:
            raise IndexError(i)

    def access(self, i: int) -> int:
        self._check(i, self.n)
        out = 0
        for p in range(len(self.planes)):
            bit = self._bit(p, i)
            out = out << 1 | bit
            r = self._rank1(p, i)
            i = self.zeros[p] + r if bit else i - r
        return out

    def _range(self, value: int, i: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` among the first i ids lie after the last plane."""
        lo, hi = 0, i
        if value >> len(self.planes):
            return 0, 0
        for p in range(len(self.planes)):
            a, b = self._rank1(p, lo), self._rank1(p, hi)
            lo, hi = (self.zeros[p] + a, self.zeros[p] + b) if value >> (len(self.planes) - 1 - p) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, value: int, i: int) -> int:
        """Occurrences of ``value`` among the first i ids."""
        self._check(i, self.n + 1)
        lo, hi = self._range(value, i)
        return hi - lo

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of ``value``."""
        lo, hi = self._range(value, self.n)
        self._check(k, hi - lo)
        at = lo + k
        for p in range(len(self.planes) - 1, -1, -1):
            bit = value >> (len(self.planes) - 1 - p) & 1
            at = self._select(p, bit, at - self.zeros[p] if bit else at)
        return at

    def _select(self, p: int, bit: int, k: int) -> int:
        self._rank1(p, 0)
        ones = self._dir[p]
        before = ones if bit else np.minimum(np.arange(len(ones)) * _STEP, self.n) - ones
        block = int(np.searchsorted(before, k, side="right")) - 1
        part = np.unpackbits(self.planes[p][block * _STEP // 8:(block + 1) * _STEP // 8])[:self.n - block * _STEP]
        return block * _STEP + int(np.flatnonzero(part == bit)[k - int(before[block])])


def write_file(doc_ids: np.ndarray, nulls: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    wm = WaveletMatrix.build(ids)
    body = b"".join([doc_ids.astype("<i8").tobytes(), nulls.astype(np.uint8).tobytes(), sizes.astype("<i8").tobytes(),
                     np.array(wm.zeros, "<i8").tobytes(), *[p.tobytes() for p in wm.planes]])
    packed = zstandard.ZstdCompressor(level=1).compress(body)
    return _HEAD.pack(MAGIC, len(wm.planes), wm.n, len(doc_ids), len(packed)) + packed + END


def read_file(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, WaveletMatrix]:
    """(doc_ids, null marks, tokens per document, wavelet matrix)."""
    magic, bits, n, docs, size = _HEAD.unpack_from(raw)
    if magic != MAGIC or raw[_HEAD.size + size:_HEAD.size + size + 4] != END:
        raise ValueError("not a wavelet-matrix file, or cut short")
    body = zstandard.ZstdDecompressor().decompress(raw[_HEAD.size:_HEAD.size + size])
    at, parts = 0, []
    for kind, k in (("<i8", docs), ("u1", docs), ("<i8", docs), ("<i8", bits)):
        part = np.frombuffer(body, kind, k, at)
        at += part.nbytes
        parts.append(part)
    step = (n + 7) // 8
    planes = [np.frombuffer(body, np.uint8, step, at + k * step) for k in range(bits)]
    return parts[0], parts[1].astype(bool), parts[2], WaveletMatrix(planes, parts[3].tolist(), n)


def _write(tokenizer: str, end_id: int, shard_tokens: int):
    def write(batches):
        enc = encoder(tokenizer, end_id)
        docs, nulls, ids, size = [], [], [], 0
        for batch in batches:
            for doc, one in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1))):
                docs.append(doc or 0)
                nulls.append(doc is None)
                ids.append(one)
                size += len(one)
                if size >= shard_tokens:
                    yield _file(docs, nulls, ids)
                    docs, nulls, ids, size = [], [], [], 0
        if docs:
            yield _file(docs, nulls, ids)
    return write


def _file(docs, nulls, ids) -> pa.RecordBatch:
    raw = write_file(np.array(docs, np.int64), np.array(nulls), np.array([len(i) for i in ids], np.int64), np.concatenate(ids))
    return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["value"])


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, shard_tokens: int = 4_000_000,
                 shard_bytes: int = 16 << 20) -> None:
    """Write the token files of all documents, in ascending doc_id order, under ``path``."""
    base = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    total = base.select(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // shard_bytes))
    (base.repartitionByRange(parts, F.col("doc_id").asc_nulls_last())
     .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), F.col("text"))
     .mapInArrow(_write(tokenizer, end_id, shard_tokens), "value binary")
     .select(F.col("value").cast("string"))                      # bytes pass the text sink unchanged
     .write.mode("overwrite").option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path))


READ_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long, file string, no long, file_tokens long"


def _read(batches):
    for batch in batches:
        for path, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            doc_ids, nulls, sizes, wm = read_file(raw.as_py())
            ids = wm.decode().astype("<u4")
            end = np.cumsum(sizes)
            crc = [zlib.crc32(ids[e - s:e]) for s, e in zip(sizes.tolist(), end.tolist())]
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if x else d for d, x in zip(doc_ids.tolist(), nulls.tolist())], pa.int64()),
                 pa.array(end - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64()),
                 pa.array([path] * n, pa.string()), pa.array(np.arange(n), pa.int64()), pa.array(np.full(n, wm.n), pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "file", "no", "file_tokens"])


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): every id is read back out of its
    bit planes.  ``start`` adds up the files before, first inside each range
    partition of the writer, then over partitions (one small row each)."""
    tmp = Scratch(spark, "wavelet-read")
    part = F.regexp_extract("file", r"part-(\d+)-", 1).cast("long")
    piece = F.regexp_extract("file", r"-c(\d+)\.[^/]*$", 1).cast("long")
    # two batches of files at most are held: a file is a row, and rows are few per task
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    docs = tmp.write(files.mapInArrow(_read, READ_SCHEMA).withColumns({"part": part, "piece": piece}), "docs")
    heads = docs.filter("no = 0").select("part", "piece", "file_tokens")
    in_part = Window.partitionBy("part").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = heads.groupBy("part").agg(F.sum("file_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    offsets = (heads.withColumn("inside", F.coalesce(F.sum("file_tokens").over(in_part), F.lit(0))).join(before, "part")
               .select("part", "piece", (F.col("before") + F.col("inside")).alias("base")))
    return (docs.join(offsets, ["part", "piece"])
            .select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"))
