"""Sharding by histogram sort (operator 12), in DataFrame operations only.

Rows are ordered by the key (hash of the text, doc_id, number of the row), so
equal texts lie side by side.  A splitter is the key at which a shard begins.
It is found without sorting: the weights (bytes, or rows) below candidate keys
are counted exactly, in one aggregate over all partitions; around every target
that no candidate meets, new candidates are laid between the smallest and the
largest key still in question; and so on until each splitter is within
``tolerance`` or stands beside a single row.  A hot text is one hash, so the
candidates soon lie between its doc_ids, and between row numbers where even
those repeat: no group is too large to be cut.  Then every row is exchanged
once, to its piece of a shard, and sorted there.  Pieces of about ``piece_bytes``
are found as splitters are, so a task's share does not grow with the shard.

The driver keeps the candidates and their counts: at most ``DIGITS`` in the first
round and ``probes`` + 2 per open splitter in the others, never rows.

A splitter misses its target by at most half the largest row (or the tolerance),
so a shard's bytes differ from the mean by one row at most; a row larger than a
shard leaves neighbours empty.  With ``law="rows"`` sizes are at most one apart.

Defined cases: null text counts as empty (16 bytes, crc32 0); a null doc_id sorts
first among equal texts; repeated rows are rows of their own, which of them goes
to which side of a splitter is open; an empty table gives no rows.  The columns
of the source travel inside one struct column ``row``, so no name can clash.
"""
from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from transitlens.llm.common import Scratch

DIGIT_BITS = 12
DIGITS = 1 << DIGIT_BITS
EXTRA_BYTES = 16
HALF, SPAN = 1 << 63, 1 << 64
KEY = ("h", "id", "tie")


def number(h: int, row_id: int, tie: int) -> int:
    """A key as one integer; keys and integers have the same order."""
    return ((h + HALF) * SPAN + row_id + HALF) * SPAN + tie + HALF


def key_of(n: int) -> tuple[int, int, int]:
    n, tie = divmod(n, SPAN)
    h, row_id = divmod(n, SPAN)
    return h - HALF, row_id - HALF, tie - HALF


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select(
        "row", "doc_id", (F.octet_length("text") + EXTRA_BYTES).cast("long").alias("size"), F.crc32("text").alias("text_crc32"),
        F.xxhash64("text").alias("h"), F.coalesce("doc_id", F.lit(-HALF)).alias("id"), F.monotonically_increasing_id().alias("tie"))


def _digit():
    return F.shiftright("h", 64 - DIGIT_BITS)


def _located(rows: DataFrame, cuts: list[int], name: str) -> DataFrame:
    """``rows`` with column ``name``: how many of the sorted ``cuts`` are not above the row's key.
    Joined by the leading bits of the hash to a table of ``DIGITS`` rows that hold the cuts among them."""
    table, at = [], 0
    for d in range(-DIGITS // 2, DIGITS // 2):
        end = bisect_left(cuts, number((d + 1) << (64 - DIGIT_BITS), -HALF, -HALF), at)
        table.append((d, at, [key_of(c) for c in cuts[at:end]]))
        at = end
    near = rows.sparkSession.createDataFrame(table, "digit long, first long, cuts array<struct<h:long,id:long,tie:long>>")
    below = F.size(F.filter("cuts", lambda c: (c["h"] < F.col("h")) | ((c["h"] == F.col("h")) & (
        (c["id"] < F.col("id")) | ((c["id"] == F.col("id")) & (c["tie"] <= F.col("tie")))))))
    return (rows.withColumn("digit", _digit()).join(F.broadcast(near), "digit")
            .withColumn(name, F.col("first") + below).drop("digit", "first", "cuts"))


def _histogram(rows: DataFrame, by: str) -> dict:
    """Weight, rows and the extent of every component of the key, by ``by``."""
    ends = [f(k).alias(f"{f.__name__}_{k}") for k in KEY for f in (F.min, F.max)]
    return {r[by]: r for r in rows.groupBy(by).agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("rows"), *ends).collect()}


def _extent(bin_, lo: int, hi: int) -> tuple[int, int]:
    """[lo, hi) drawn in to the keys that a bin holds."""
    if bin_["min_h"] != bin_["max_h"]:
        first, last = (bin_["min_h"], -HALF, -HALF), (bin_["max_h"], HALF - 1, HALF - 1)
    elif bin_["min_id"] != bin_["max_id"]:
        first, last = (bin_["min_h"], bin_["min_id"], -HALF), (bin_["min_h"], bin_["max_id"], HALF - 1)
    else:
        first, last = (bin_["min_h"], bin_["min_id"], bin_["min_tie"]), (bin_["min_h"], bin_["min_id"], bin_["max_tie"])
    return max(lo, number(*first)), min(hi, number(*last) + 1)


def splitters(keys: DataFrame, targets: list[int], allowed: int, probes: int = 32) -> list[int]:
    """For each weight of ``targets`` (ascending) a key, as an integer, with about that weight below it:
    off by at most ``allowed``, or else by half the row that lies across the target."""
    found: dict[int, int] = {}
    # Every open target lies in an interval of keys [lo, hi) with a known weight below lo.
    edges = [number(d << (64 - DIGIT_BITS), -HALF, -HALF) for d in range(-DIGITS // 2, DIGITS // 2)] + [SPAN ** 3]
    counts = {d + DIGITS // 2: r for d, r in _histogram(keys.withColumn("digit", _digit()), "digit").items()}
    intervals = [(0, range(DIGITS))]                # (weight below, numbers of the bins edges[j] .. edges[j + 1])
    while True:
        wanted: dict[tuple[int, int], int] = {}     # interval to look into: weight below it
        for base, bins in intervals:
            weights = [counts[j]["weight"] if j in counts else 0 for j in bins]
            below = list(accumulate(weights, initial=base))
            for t in targets[bisect_left(targets, base):bisect_right(targets, below[-1])]:
                if t in found:
                    continue
                i = min(bisect_right(below, t) - 1, len(weights) - 1)       # below[i] <= t <= below[i + 1]
                j = bins[i]
                near = min((t - below[i], edges[j]), (below[i + 1] - t, edges[j + 1]))
                if near[0] <= allowed or counts[j]["rows"] == 1:
                    found[t] = near[1]
                else:
                    wanted[_extent(counts[j], edges[j], edges[j + 1])] = below[i]
        if not wanted:
            return [found[t] for t in targets]
        edges, intervals = [], []
        for (lo, hi), base in sorted(wanted.items()):
            at = len(edges)
            edges += sorted({lo + (hi - lo) * k // (probes + 1) for k in range(probes + 2)})
            intervals.append((base, range(at, len(edges) - 1)))
        cuts = sorted(set(edges))
        first = {c: i for i, c in enumerate(cuts)}
        seen = _histogram(_located(keys, cuts, "bin"), "bin")       # bin n holds the keys from cuts[n - 1] on
        counts = {j: seen[first[e] + 1] for j, e in enumerate(edges) if first[e] + 1 in seen}


def plan(keys: DataFrame, shards: int, tolerance: float, piece_bytes: int, probes: int = 32) -> tuple[list[int], int]:
    """(splitters of all pieces but the first, pieces in a shard)."""
    weight, size = keys.agg(F.coalesce(F.sum("weight"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    each = max(1, -(-size // (shards * piece_bytes)))
    n = shards * each
    targets = [weight * i // n for i in range(1, n)]
    allowed = int(min(tolerance * weight / shards, 0.25 * weight / n))
    distinct = sorted(set(targets))
    cut = dict(zip(distinct, splitters(keys, distinct, allowed, probes))) if weight else {t: 0 for t in distinct}
    cuts = [cut[t] for t in targets]
    return list(accumulate(cuts, max)), each


def write_shards(docs: DataFrame, path: str, shards: int = 40, law: str = "bytes", tolerance: float = 0.001,
                 piece_bytes: int = 512 << 20) -> StructType:
    """Shards of ``docs`` as Parquet under ``path``/shard=N: ``row`` (all columns), ``doc_id``, ``size``, ``text_crc32``,
    ``piece`` and ``at`` (from 1 in the piece, in key order).  Returns the schema that ``read_shards`` takes."""
    if law not in ("bytes", "rows"):
        raise ValueError("law is bytes or rows")
    tmp = Scratch(docs.sparkSession, "histogram-sort")
    weight = F.col("size") if law == "bytes" else F.lit(1).cast("long")
    keys = tmp.write(_keyed(docs).select(*KEY, "size", weight.alias("weight")), "keys")
    cuts, each = plan(keys, shards, tolerance if law == "bytes" else 0.0, piece_bytes)
    placed = _located(_keyed(docs), cuts, "piece").withColumn("shard", F.floor(F.col("piece") / each).cast("int"))
    order = Window.partitionBy("shard", "piece").orderBy(*KEY)
    sorted_rows = (placed.repartition(shards * each, "piece").withColumn("at", F.row_number().over(order).cast("long"))
                   .select("row", "doc_id", "size", "text_crc32", "piece", "at", "shard"))
    sorted_rows.write.partitionBy("shard").parquet(path)
    tmp.drop("keys")
    return sorted_rows.schema


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The written rows, with ``slot``: their place in the shard, gapless from 0, in key order."""
    rows = spark.read.schema(schema).parquet(path)
    sizes = rows.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    first = sizes.select("shard", "piece", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(first, ["shard", "piece"]).withColumn("slot", F.col("before") + F.col("at") - 1).drop("before", "at", "piece")
