"""Hard-negative mining over an STR-packed R-tree (operator 11).

Components become floor(256 * x), so scores are exact integers.  The rows are
tiled in Spark (sort-tile-recursive over the two widest coordinates: two range
partitionings, each with vec_id as its last key, so copies of one vector are
spread too), and every tile of about ``tile_rows`` rows becomes a packed tree:
leaves of ``LEAF`` rows of one label, tiled over the tile's own widest
coordinates, parents over ``FAN`` neighbours, each with its minimum bounding box.  The tree is a
table with a row per node, written once and read by both searches.

A box bounds the inner product with an anchor coordinate by coordinate: the sum
of max(a * low, a * high) from above and of min(a * low, a * high) from below.
A best-first queue takes nodes by their upper bound; a node goes unopened if its
interval misses every score window still open, or if its upper bound lies
strictly below the kth score so far.  Equal scores stay, for ties go by vec_id.

Anchors meet tiles in blocks (``block`` anchors and one tile in a task); a task
returns at most k rows per anchor and window, and a ranking window with Spark's
group limit joins the tiles' answers.  Positives come first; their scores give
the windows of the second search.  No anchor or row is capped or left out.

Defined cases: rows with a null vec_id, label or vector, or with a null or
non-finite component, take no part; vec_id names a row: rows that share one
count as one row, that of the smallest (label, vector); vectors of unlike length
count as padded with zeros; an empty vector scores 0; components whose 256-fold
exceeds a long are cut to it, and sums too large for exact doubles are computed
in whole numbers and cut to a long (windows follow the cut score); an anchor without positives, or a positive
without hard negatives, gives no row; extra columns are ignored; empty table, no
rows.
"""
from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from transitlens.llm.common import Scratch

LEAF, FAN = 32, 8
EXACT = float(1 << 53)
LONG = (1 << 63) - 1
NODE = "tile long, node long, low array<long>, high array<long>, first int, last int, ids array<long>, labels array<long>, vectors array<long>"
HITS = "anchor_id long, positive_id long, positive_score long, id long, score long"


# ------------------------------------------------------------------ numbers
def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as whole doubles, padded with zeros to ``dim``."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = col.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(col), dim), flat.dtype)
    if len(flat):
        out[np.repeat(np.arange(len(col)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where every sum of products is exact in doubles, else as whole numbers of any size."""
    top = [float(np.abs(x.astype(float)).max(initial=0)) for x in (a, b)]
    if top[0] * top[1] * max(a.shape[1], 1) < EXACT:
        return a.astype(float), b.astype(float)
    return a.astype(object), b.astype(object)


# ------------------------------------------------------------------ the tree
def tiles_of(v: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Sort-tile-recursive leaves: by label, then by the three widest coordinates."""
    wide = np.argsort(-v.astype(float).var(axis=0), kind="stable")[:3] if len(v) else []
    keys = [labels, *(v[:, d] for d in wide)]

    def cut(rows: np.ndarray, k: int) -> list[np.ndarray]:
        if k == len(keys) or k and len(rows) <= LEAF:
            return [rows[i:i + LEAF] for i in range(0, len(rows), LEAF)]
        rows = rows[np.argsort(keys[k][rows], kind="stable")]
        if k == 0:          # a leaf has one label
            edge = np.flatnonzero(np.diff(labels[rows])) + 1
            return [leaf for part in np.split(rows, edge) for leaf in cut(part, 1)]
        leaves = -(-len(rows) // LEAF)
        slabs = int(np.ceil(leaves ** (1 / (len(keys) - k))))
        size = LEAF * -(-leaves // slabs)
        return [leaf for i in range(0, len(rows), size) for leaf in cut(rows[i:i + size], k + 1)]

    return cut(np.arange(len(v)), 0)


def _pack(dim: int):
    """Node rows of the tree of one partition, a tile; the root has the highest number."""
    def pack(batches):
        batches = [b for b in batches if len(b)]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        tile = table["tile"][0].as_py()
        ids, labels = (table[c].to_numpy() for c in ("vec_id", "label"))
        v = matrix(table["v"], dim)
        rows, level = [], []
        for leaf in tiles_of(v, labels):
            level.append(len(rows))
            rows.append((v[leaf].min(axis=0), v[leaf].max(axis=0), None, None, ids[leaf], labels[leaf], v[leaf].ravel()))
        while len(level) > 1:
            above = []
            for i in range(0, len(level), FAN):
                kids = level[i:i + FAN]
                above.append(len(rows))
                rows.append((np.min([rows[k][0] for k in kids], axis=0), np.max([rows[k][1] for k in kids], axis=0),
                             kids[0], kids[-1] + 1, None, None, None))
            level = above
        low, high, first, last, kid, lab, vec = zip(*rows)
        longs = pa.list_(pa.int64())
        yield from pa.table({"tile": pa.array([tile] * len(rows), pa.int64()), "node": pa.array(range(len(rows)), pa.int64()),
                             "low": pa.array(low, longs), "high": pa.array(high, longs), "first": pa.array(first, pa.int32()),
                             "last": pa.array(last, pa.int32()), "ids": pa.array(kid, longs), "labels": pa.array(lab, longs),
                             "vectors": pa.array(vec, longs)}).to_batches(max_chunksize=1024)
    return pack


class Tree:
    """One tile's nodes, read back."""

    def __init__(self, nodes: pa.Table, dim: int):
        nodes = nodes.sort_by("node")
        self.low, self.high = matrix(nodes["low"], dim), matrix(nodes["high"], dim)
        self.first, self.last = nodes["first"].to_pylist(), nodes["last"].to_pylist()
        leaf = [i for i, f in enumerate(self.first) if f is None]
        self.begin, at = {}, 0
        held = nodes["ids"].combine_chunks()
        for i, n in zip(leaf, held.take(pa.array(leaf)).value_lengths().to_pylist()):
            self.begin[i] = (at, at + n)
            at += n
        self.ids, self.labels = (nodes[c].combine_chunks().flatten().to_numpy() for c in ("ids", "labels"))
        self.v = nodes["vectors"].combine_chunks().flatten().to_numpy().reshape(at, dim)

        self.label_of = {i: int(self.labels[b]) for i, (b, _) in self.begin.items()}     # a leaf has one label
        self._marked: dict = {}

    def _mark(self, key, leaf_ok) -> list[bool]:
        """For each node, whether a leaf below it passes."""
        if key not in self._marked:
            marked: list[bool] = []
            for i, f in enumerate(self.first):
                marked.append(leaf_ok(self.label_of[i]) if f is None else any(marked[f:self.last[i]]))
            self._marked[key] = marked
        return self._marked[key]

    def holding(self, label: int) -> list[bool]:
        return self._mark((True, label), lambda x: x == label)

    def holding_other(self, label: int) -> list[bool]:
        return self._mark((False, label), lambda x: x != label)

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest inner product of every anchor (row) with every node's box (column)."""
        up, down = np.where(anchors > 0, anchors, 0), np.where(anchors < 0, anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T


def best(tree: Tree, anchor: np.ndarray, low, high, open_, windows: list[tuple[int, int]], k: int, allowed=None) -> list[list[tuple]]:
    """For each score window [from, to] the first k (score, id), highest score first, then smallest id, of the
    rows of the nodes marked in ``open_`` that ``allowed`` admits; ``low`` and ``high`` bound the nodes' scores."""
    top: list[list[tuple]] = [[] for _ in windows]          # heaps of (score, -id): the kth best lies at [0]
    least, most = [a for a, _ in windows], [b for _, b in windows]
    floor, ceiling = np.array(least), np.array(most)

    def wanted(node: int) -> bool:
        h, lo = high[node], low[node]
        return open_[node] and any(h >= a and lo <= b and a <= b for a, b in zip(least, most))

    root = len(tree.first) - 1
    queue = [(-high[root], root)]
    while queue:
        _, node = heapq.heappop(queue)
        if not wanted(node):
            continue
        if tree.first[node] is not None:
            for child in range(tree.first[node], tree.last[node]):
                if wanted(child):
                    heapq.heappush(queue, (-high[child], child))
            continue
        begin, end = tree.begin[node]
        score = (tree.v[begin:end] @ anchor)[:, None]
        here = (score >= floor) & (score <= ceiling)
        if allowed is not None:
            here &= allowed(begin, end)[:, None]
        if not here.any():
            continue
        for i, w in zip(*(x.tolist() for x in np.nonzero(here))):
            hit, t = (int(score[i, 0]), -int(tree.ids[begin + i])), top[w]
            if len(t) < k:
                heapq.heappush(t, hit)
            elif hit > t[0]:
                heapq.heapreplace(t, hit)
            if len(t) == k:             # from now on nothing strictly below the kth counts
                least[w] = max(windows[w][0], t[0][0])
                floor[w] = least[w]
    return [[(s, -i) for s, i in sorted(t, reverse=True)] for t in top]


def window_of(positive_score: int, least: int, most: int) -> tuple[int, int]:
    """Whole scores n with least * positive_score <= 100 * n <= most * positive_score."""
    return -(-least * positive_score // 100), most * positive_score // 100


def _search(dim: int, k: int, same_label: bool, least: int, most: int):
    """Rows of HITS that one tile has for one block of anchors."""
    def search(nodes: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if len(nodes) and len(anchors):
            tree = Tree(nodes.select([c for c in nodes.column_names if c != "block"]), dim)
            who, label = anchors["anchor_id"].to_pylist(), anchors["label"].to_pylist()
            q, tree.v = exact(matrix(anchors["v"], dim), tree.v)
            tree.low, tree.high = tree.low.astype(q.dtype), tree.high.astype(q.dtype)
            low, high = tree.bounds(q)
            low, high = low.tolist(), high.tolist()
            positives = [None] * len(who) if same_label else anchors["positives"].to_pylist()
            for i, (a, own) in enumerate(zip(who, label)):
                if same_label:
                    found = best(tree, q[i], low[i], high[i], tree.holding(own), [(-float("inf"), float("inf"))], k,
                                 lambda b, e: tree.ids[b:e] != a)
                else:
                    windows = [window_of(p["score"], least, most) for p in positives[i]]
                    found = best(tree, q[i], low[i], high[i], tree.holding_other(own), windows, k)
                for n, hits in enumerate(found):
                    p = (None, None) if same_label else (positives[i][n]["id"], positives[i][n]["score"])
                    out += [(a, *p, row, max(-LONG - 1, min(LONG, s))) for s, row in hits]
        cols = list(zip(*out)) if out else [[]] * 5
        return pa.table({c.split()[0]: pa.array(x, pa.int64()) for c, x in zip(HITS.split(", "), cols)})
    return search


# ------------------------------------------------------------------ in Spark
def prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, a row per vec_id, components as whole numbers."""
    whole = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
             & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = (vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
            .filter(F.coalesce(whole, F.lit(False)))
            .select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x * 256.0)).alias("v")))
    if rows.groupBy("vec_id").count().filter("count > 1").isEmpty():
        return rows
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")


def _spread(batches):
    """Count, sum and sum of squares of every coordinate, of one task's rows."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        x = matrix(batch.column(0), max(batch.column(0).value_lengths().to_pylist(), default=0)).astype(float)
        for d, (s, ss) in enumerate(zip(x.sum(axis=0), (x * x).sum(axis=0))):
            total[d] = total.get(d, 0) + np.array([len(x), s, ss])
    at = sorted(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array([total[d][j] for d in at], pa.float64()) for j in range(3))],
                                     names=["d", "n", "s", "ss"])


def _tiled(rows: DataFrame, n: int, tile_rows: int) -> DataFrame:
    """``rows`` with the number of their tile: slabs along the widest coordinate, tiles along the next one within a slab."""
    moments = rows.select("v").mapInArrow(_spread, "d int, n double, s double, ss double").groupBy("d").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    wide = [r["d"] for r in moments.orderBy(F.desc(F.col("ss") / F.col("n") - F.pow(F.col("s") / F.col("n"), F.lit(2))), "d").limit(2).collect()]
    axis = [F.coalesce(F.get("v", F.lit(d)), F.lit(0)) for d in wide] + [F.lit(0)] * (2 - len(wide))
    tiles = -(-n // tile_rows)
    slabs = int(np.ceil(np.sqrt(tiles)))
    slabbed = rows.withColumns({"x": axis[0], "y": axis[1]}).repartitionByRange(slabs, "x", "vec_id").withColumn("slab", F.spark_partition_id())
    return slabbed.repartitionByRange(tiles, "slab", "y", "vec_id").withColumn("tile", F.spark_partition_id().cast("long")).drop("x", "y", "slab")


def _first(hits: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k hits of each group, with their ``rank``."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: Column | None = None, positives: int = 5, negatives: int = 10, least: int = 30,
                   most: int = 90, tile_rows: int = 8192, block: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor (``anchors``: a
    condition on vec_id; by default divisible by 100) and each of its first ``positives`` rows of equal label, the first
    ``negatives`` rows of another label with ``least`` to ``most`` percent of the positive's score."""
    spark = vectors.sparkSession
    tmp = Scratch(spark, "hard-negatives")
    anchors = F.col("vec_id") % 100 == 0 if anchors is None else anchors
    rows = tmp.write(prepared(vectors), "rows")
    n, asked, dim = rows.agg(F.count(F.lit(1)), F.count_if(anchors), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not asked:
        return empty
    tree = tmp.write(_tiled(rows, n, tile_rows).mapInArrow(_pack(dim), NODE), "tree")
    blocks = -(-asked // block)
    queries = rows.filter(anchors).select(F.col("vec_id").alias("anchor_id"), "label", "v", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"))
    tiles = tree.agg(F.max("tile")).first()[0] + 1
    parts = min(blocks * tiles, 100_000)

    def searched(asking: DataFrame, k: int, same_label: bool) -> DataFrame:
        """Every block of anchors against every tile."""
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        trees, dealt = tree.withColumn("block", every(blocks)), asking.withColumn("tile", every(tiles))
        keys = ["tile", "block"]
        return (trees.repartition(parts, *keys).groupBy(*keys).cogroup(dealt.repartition(parts, *keys).groupBy(*keys))
                .applyInArrow(_search(dim, k, same_label, least, most), HITS))

    near = tmp.write(_first(searched(queries, positives, True), ["anchor_id"], positives).select("anchor_id", "id", "score"), "positives")
    listed = near.groupBy("anchor_id").agg(F.collect_list(F.struct("id", "score")).alias("positives"))      # at most ``positives`` each
    hits = searched(queries.join(listed, "anchor_id"), negatives, False)
    return _first(hits, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
