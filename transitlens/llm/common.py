"""Helpers shared by the operators: scratch tables, Arrow text access, hashing."""
from __future__ import annotations

import ctypes
import gc
import time
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from transitlens.session import scratch_path

U64 = np.uint64
MASK64 = (1 << 64) - 1


class Scratch:
    """Intermediate Parquet tables of one operator call, in the shared folder
    that ``spark.checkpoint.dir`` names.  A written table cuts lineage: a lost
    executor re-reads it instead of recomputing the steps before it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, scratch_path(spark, f"{name}-{uuid.uuid4().hex}")

    def path(self, step: str) -> str:
        return f"{self.base}/{step}"

    def write(self, df: DataFrame, step: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(step))
        return self.read(step, df.schema)

    def read(self, step: str, schema=None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(step))

    def drop(self, *steps: str) -> None:
        """Delete tables that no returned DataFrame reads."""
        jvm = self.spark.sparkContext._jvm
        for step in steps:
            p = jvm.org.apache.hadoop.fs.Path(self.path(step))
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished steps now
    instead of at the driver's next garbage collection."""
    for _ in range(2):          # the first lets go of plans, the second of what only they held
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def hand_back() -> None:
    """Return freed memory of numpy (where the C library can) and Arrow to the system:
    Python workers outlive their task, beside those of the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string()).cast(pa.large_binary())
    else:
        col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batches, column: int | str, most: int = 1 << 20):
    """Slices of Arrow batches with about ``most`` bytes of text each (one row at least).
    Nothing is copied, so a task holds one batch and works on one slice."""
    for batch in batches:
        at = column if isinstance(column, int) else batch.schema.get_field_index(column)
        end = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0), np.int64))
        lo = 0
        while lo < len(batch):
            before = int(end[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(end, before + most, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def texts(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row; null counts as empty."""
    raw, off = text_buffers(col)
    b = raw.tobytes()
    return [b[i:j] for i, j in zip(off[:-1].tolist(), off[1:].tolist())]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser over uint64 (in place on a copy): spreads every input bit."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


_ODD = U64(0x9E3779B97F4A7C15)


def _powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), U64)
    have, step = 1, U64(base)
    while have < n:
        take = min(have, n - have)
        out[have:have + take] = out[:take] * step
        have += take
        step = U64(int(step) * int(step) & MASK64)
    return out[:n]


class WordHasher:
    """64-bit hashes of byte ranges of one buffer, vectorised: a polynomial
    prefix sum modulo 2**64, then a finaliser that takes in the length."""

    BASE = 0x5851F42D4C957F2D
    INV = pow(BASE, -1, 1 << 64)

    def __init__(self):
        self._p = self._q = np.ones(1, U64)

    def __call__(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(raw)
        if len(self._p) < n + 1:
            size = n + n // 8 + 1024
            self._p, self._q = _powers(size, self.BASE), _powers(size, self.INV)
        acc = np.zeros(n + 1, U64)
        np.cumsum((raw.astype(U64) + U64(1)) * self._p[:n], out=acc[1:])
        h = (acc[end] - acc[start]) * self._q[start]
        return mix64(h + (end - start).astype(U64) * _ODD)


def spans_of(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([False], is_word, [False])).view(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

