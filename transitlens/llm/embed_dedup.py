"""Embedding near-dedup over an inverted multi-index (operator 6).

Unit vectors are cut into halves; each half has its own codebook of K centroids
(k-means on a bounded sample), and a vector's cell is its nearest centroid pair
on the K x K grid.  Each vector visits cells by multi-sequence traversal: in the
order of the sum of its two half distances.  How many cells it visits is set by
measurement: ``queries`` sampled vectors are compared with all rows by brute
force, and the fewest cells are taken at which all true links of a share of
``recall`` of them (of those that have any) are met from either end; a group of
copies thus weighs no more than its vectors.  Where fewer than ``enough`` of them have
links, the cells are also taken that meet a share of ``planted_recall`` of planted pairs:
sampled vectors, each beside one at exactly the least cosine in a random direction, the
hardest link there is.  Every met pair is verified by cosine in double precision.

Only vectors with equal labels (and equal lengths) meet.  Equal vectors are one
class with a multiplicity.  Cells are worked off in blocks of at most about
``block`` vectors on either side, so a cell that holds a third of all rows is
many tasks; a block pair returns counts per vector and a spanning forest of its
links, never the links themselves.

Defined cases: null, empty and zero vectors, vectors with null or non-finite
components, null labels and null ids link with nothing (n_links 0, kept);
rows that repeat a vec_id are separate vectors for n_links and one vertex for
components; extra columns are ignored; empty table, no rows.
"""
from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from transitlens.llm.common import Scratch, release
from transitlens.llm.graph import components, forest


def unit_rows(col: pa.Array, dim: int) -> np.ndarray:
    """Rows as unit vectors in double precision, zero-padded to ``dim``."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.asarray(col.flatten(), np.float64)
    if len(size) and (size == dim).all():
        out = flat.reshape(-1, dim).copy()
    else:
        out = np.zeros((len(size), dim))
        at = 0
        for i, n in enumerate(size.tolist()):
            out[i, :n] = flat[at:at + n]
            at += n
    big = np.abs(out).max(axis=1, keepdims=True, initial=0)
    out /= np.where(big > 0, big, 1)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = _distances(x, c).argmin(axis=1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1)[None], 0)


def multi_sequence(d1: np.ndarray, d2: np.ndarray, visits: int) -> list[int]:
    """The ``visits`` nearest cells, i * len(d2) + j, in the order of d1[i] + d2[j]."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    a, b = d1[o1].tolist(), d2[o2].tolist()
    heap, seen, out = [(a[0] + b[0], 0, 0)], {(0, 0)}, []
    while heap and len(out) < visits:
        _, i, j = heapq.heappop(heap)
        out.append(int(o1[i]) * len(b) + int(o2[j]))
        for p in ((i + 1, j), (i, j + 1)):
            if p[0] < len(a) and p[1] < len(b) and p not in seen:
                seen.add(p)
                heapq.heappush(heap, (a[p[0]] + b[p[1]], *p))
    return out


class MultiIndex:
    """Codebooks of both halves."""

    def __init__(self, sample: np.ndarray, k: int):
        self.dim = sample.shape[1]
        self.cut = max(1, self.dim // 2)
        self.c1 = kmeans(sample[:, :self.cut], k)
        self.c2 = kmeans(sample[:, self.cut:], k) if self.cut < self.dim else np.zeros((1, 0))

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distances(x[:, :self.cut], self.c1), _distances(x[:, self.cut:], self.c2)

    def home(self, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        return d1.argmin(axis=1) * d2.shape[1] + d2.argmin(axis=1)


def _rank(d1: np.ndarray, d2: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """How many cells each row visits before its ``cell``."""
    k2 = d2.shape[1]
    near = np.sort(d2, axis=1)
    out = np.empty(len(cell), np.int64)
    for r in range(len(cell)):
        i, j = cell[r] // k2, cell[r] % k2
        below = d1[r, i] + d2[r, j] - d1[r]
        below[i] = d2[r, j]               # free of rounding for the cell itself
        out[r] = np.searchsorted(near[r], below).sum()
    return out


def planted_ranks(index: MultiIndex, x: np.ndarray, size: np.ndarray, least: float, seed: int = 11) -> np.ndarray:
    """Cells visited before each row of ``x`` meets, from either end, a vector at cosine ``least`` from it, in a
    random direction of its first ``size`` dimensions.  Rows of one dimension have no such vector and are left out."""
    x, size = x[size > 1], size[size > 1]
    u = np.random.default_rng(seed).normal(size=x.shape) * (np.arange(x.shape[1])[None] < size[:, None])
    u -= (u * x).sum(axis=1, keepdims=True) * x
    u /= np.maximum(np.sqrt((u * u).sum(axis=1, keepdims=True)), 1e-300)
    y = least * x + np.sqrt(1 - least * least) * u
    dx, dy = index.distances(x), index.distances(y)
    return np.minimum(_rank(*dx, index.home(*dy)), _rank(*dy, index.home(*dx)))


def _quantile(need: list, share: float) -> int:
    """Visits that reach ``share`` of the ranks ``need``."""
    need = sorted(need)
    return 1 + int(need[max(0, int(np.ceil(share * len(need))) - 1)]) if need else 1


def _measure(index, queries: np.ndarray, q_ids: np.ndarray, q_group: list, least: float):
    """(query, most visits needed before a true link of it) as far as one task's rows tell."""
    def measure(batches):
        ix = index.value
        qd1, qd2 = ix.distances(queries)
        q_home = ix.home(qd1, qd2)
        groups = {g: np.array([i for i, h in enumerate(q_group) if h == g]) for g in set(q_group)}
        most = np.full(len(queries), -1)
        for batch in batches:
            ids = np.array(batch.column(0), np.int64)
            grp = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            x = unit_rows(batch.column(3), ix.dim)
            d1, d2 = ix.distances(x)
            home = ix.home(d1, d2)
            rows: dict = {}
            for i, g in enumerate(grp):
                rows.setdefault(g, []).append(i)
            for g, at in rows.items():
                if g not in groups:
                    continue
                at, qs = np.array(at), groups[g]
                near = (queries[qs] @ x[at].T >= least) & (q_ids[qs][:, None] != ids[at][None])
                qi, ri = np.nonzero(near)
                if len(qi):
                    q, r = qs[qi], at[ri]
                    need = np.minimum(_rank(qd1[q], qd2[q], home[r]), _rank(d1[r], d2[r], q_home[q]))
                    np.maximum.at(most, q, need)
        at = np.flatnonzero(most >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(most[at], pa.int64())], names=["query", "visits"])
    return measure


PLACED = "label long, dim int, cell long, probe boolean, id long, m long, home long, embedding array<float>, visits array<long>"


def _place(index, visits: int):
    """A row at the vector's own cell, and one at every cell that it visits."""
    def place(batches):
        ix = index.value
        for batch in batches:
            d1, d2 = ix.distances(unit_rows(batch.column("embedding"), ix.dim))
            home = ix.home(d1, d2)
            cells = [multi_sequence(a, b, visits) for a, b in zip(d1, d2)]
            n = [len(c) for c in cells]
            again = pa.array(np.repeat(np.arange(len(n)), n))
            longs = pa.list_(pa.int64())
            for take, cell, probe, lists in (
                    (pa.array(np.arange(len(n))), pa.array(home, pa.int64()), False, pa.array(cells, longs)),
                    (again, pa.array([c for cs in cells for c in cs], pa.int64()), True, pa.nulls(len(again), longs))):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").take(take), batch.column("dim").take(take), cell, pa.array([probe] * len(take)),
                     batch.column("id").take(take), batch.column("m").take(take), pa.array(home, pa.int64()).take(take),
                     batch.column("embedding").take(take), lists],
                    names=["label", "dim", "cell", "probe", "id", "m", "home", "embedding", "visits"])
    return place


def _compare(dim: int, least: float):
    """All pairs of one block: (0, vector, links) counts and (1, vector, vector) forest edges.
    A pair met from both ends is counted at each end by its own visit only."""
    def compare(table: pa.Table) -> pa.Table:
        probe = np.array(table["probe"].combine_chunks())
        kinds, first, second = [], [], []
        P, H = np.flatnonzero(probe), np.flatnonzero(~probe)
        if len(P) and len(H):
            x = unit_rows(table["embedding"], dim)
            ids, m, home = (np.array(table[c].combine_chunks(), np.int64) for c in ("id", "m", "home"))
            near = x[P] @ x[H].T >= least
            near &= ids[P][:, None] != ids[H][None]
            p, h = np.nonzero(near)
            if len(p):
                homes, which = np.unique(home[P], return_inverse=True)
                visits = table["visits"].combine_chunks().take(pa.array(H))
                back = np.stack([np.isin(homes, np.array(v.as_py(), np.int64)) for v in visits], axis=1)
                here = near.astype(np.int64) @ m[H]
                there = (near & ~back[which]).astype(np.int64).T @ m[P]
                for who, n in ((ids[P], here), (ids[H], there)):
                    at = np.flatnonzero(n)
                    kinds += [0] * len(at)
                    first += who[at].tolist()
                    second += n[at].tolist()
                a, b = forest(ids[P][p], ids[H][h])
                kinds += [1] * len(a)
                first += a
                second += b
        return pa.table({"kind": pa.array(kinds, pa.int32()), "a": pa.array(first, pa.int64()), "b": pa.array(second, pa.int64())})
    return compare


def near_vectors(vectors: DataFrame, least: float = 0.93, recall: float = 0.995, sample: int = 20_000, queries: int = 4096, least_visits: int = 4,
                 cell_rows: int = 16, block: int = 1500, enough: int = 300, planted_recall: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per vector."""
    spark = vectors.sparkSession
    tmp = Scratch(spark, "multi-index")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>"), F.col("label").cast("long"))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
              & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
              & F.exists("embedding", lambda v: v != 0))
    rows = rows.withColumns({"ok": F.coalesce(usable, F.lit(False)), "h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit("second"), "embedding")})
    classes = tmp.write(rows.filter("ok").groupBy("label", "h1", "h2").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("m"), F.first("embedding").alias("embedding"))
        .withColumn("dim", F.size("embedding")), "classes")
    stat = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim")).agg(F.max("n"), F.max("dim")).first()
    links = comp = None
    if stat[0]:
        n, dim = stat                     # of the largest label: its cells are the fullest
        picked = classes.orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "label", "dim", "embedding").toArrow()
        x = unit_rows(picked["embedding"], dim)
        k = int(max(2, np.ceil(np.sqrt(n / cell_rows))))          # never more than the sample's distinct halves
        index = spark.sparkContext.broadcast(MultiIndex(x, k))
        few = min(queries, len(x))
        group = list(zip(picked["label"].to_pylist()[:few], picked["dim"].to_pylist()[:few]))
        ask = _measure(index, x[:few], np.array(picked["id"].combine_chunks(), np.int64)[:few], group, least)
        need = (classes.select("id", "label", "dim", "embedding").mapInArrow(ask, "query long, visits long")
                .groupBy("query").agg(F.max("visits").alias("visits")).collect())            # at most ``queries`` rows
        visits = max(least_visits, _quantile([r["visits"] for r in need], recall))
        if len(need) < enough:
            size = np.array(picked["dim"].combine_chunks(), np.int64)[:few]
            visits = max(visits, _quantile(planted_ranks(index.value, x[:few], size, least).tolist(), planted_recall))
        placed = classes.select("id", "m", "label", "dim", "embedding").mapInArrow(_place(index, visits), PLACED)
        placed = tmp.write(placed, "placed")
        cells = placed.groupBy("label", "dim", "cell").agg(
            F.ceil(F.sum(F.when(F.col("probe"), 0).otherwise(1)) / block).alias("hb"),
            F.ceil(F.sum(F.when(F.col("probe"), 1).otherwise(0)) / block).alias("pb")).filter("hb > 0 and pb > 0")
        dealt = placed.join(cells, ["label", "dim", "cell"])
        mine = lambda n: F.array(F.pmod(F.xxhash64("id"), F.col(n)).cast("long"))
        every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
        dealt = (dealt.withColumn("h", F.explode(F.when(F.col("probe"), every("hb")).otherwise(mine("hb"))))
                 .withColumn("p", F.explode(F.when(F.col("probe"), mine("pb")).otherwise(every("pb")))).drop("hb", "pb"))
        found = tmp.write(dealt.groupBy("label", "dim", "cell", "h", "p").applyInArrow(_compare(dim, least), "kind int, a long, b long"), "found")
        release(spark)
        links = found.filter("kind = 0").groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("links"))
        comp = components(found.filter("kind = 1").select("a", "b"), tmp, "comp")
    out = rows.select("vec_id", "label", "h1", "h2", "ok").join(
        classes.select("label", "h1", "h2", "id", "m", F.lit(True).alias("ok")), ["label", "h1", "h2", "ok"], "left")
    if links is not None:
        out = out.join(links, "id", "left").join(comp, "id", "left")
    else:
        out = out.withColumns({"links": F.lit(None).cast("long"), "component": F.lit(None).cast("long")})
    own = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "id", "vec_id"))
    return (out.withColumn("component_id", own)
            .select("vec_id", F.coalesce(F.coalesce("links", F.lit(0)) + F.col("m") - 1, F.lit(0)).cast("long").alias("n_links"), "component_id",
                    F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept")))
