"""MinHash near-dedup with tensored banding (operator 9).

A document's set holds its distinct shingles of ``SHINGLE`` words (64-bit
hashes).  Two small collections of ``collection`` hashes, each of ``per_key``
minhashes, are computed; a table key is the pair of one hash from either
collection, which gives collection**2 tables of 2*per_key minhashes from
2*collection*per_key minhashes instead of collection**2*2*per_key.  A pair at
the threshold 0.75 meets in some table with probability
(1-(1-0.75**2)**10)**2 > 0.9994 for the defaults.

Candidates are verified on full sets.  No group is expanded into pairs:

* equal sets are one class, represented by its smallest doc_id;
* hashes of either collection that only one class has cannot make a shared
  table key and are dropped before keys are formed;
* every class is checked against one member ("pivot") of a table key it shares,
  the one it shares most keys with.  The pivot of a key is its most central class
  (most meetings over all keys), which in a group of copies is the text they come
  from; keys whose classes are joined by verified links are done;
* the shingles of the classes in the other keys are counted: only x of a class's
  shingles occur in another component at all.  A pair whose sets reach the
  threshold t shares at least t/(1+t) of the sum of their sizes, so a class with
  fewer than t of its shingles outside is out: copies of one text that differ too
  much for a link have shingles of their own and leave here, however many they
  are.  The rest meet block by block, on the hashes of the first collection: a
  task takes two blocks of at most about ``block`` classes, counts common shingles
  of all pairs by a matrix product, and returns a spanning forest of the links.
  No candidate pair stays untested unless its ends are connected already;
* components are computed once, over the links of both steps.

Defined cases: null or empty text, or text of white space, has an empty set and
links with nothing; fewer words than a shingle make one shingle; rows that
share a doc_id count as one document whose links are those of all its rows;
null doc_id: links with nothing, component_id null, kept; extra columns are
ignored by ``near_duplicates``; empty table, no rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from transitlens.llm.common import Scratch, WordHasher, hand_back, mix64, pieces, spans_of, texts
from transitlens.llm.graph import components, forest

U64 = np.uint64
SHINGLE = 5
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_A = U64(0x9E3779B97F4A7C15)


def shingle_sets(docs: list[bytes], hasher: WordHasher, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): sorted distinct shingle hashes of each document."""
    body = b" ".join(docs).lower()
    raw = np.frombuffer(body, np.uint8)
    size = np.array([len(d) for d in docs], np.int64)
    begin = np.cumsum(size + 1) - size - 1
    start, end = spans_of(~_SPACE[raw])
    word = hasher(raw, start, end)
    doc = np.searchsorted(begin, start, side="right") - 1
    n_words = np.bincount(doc, minlength=len(docs))
    first = np.cumsum(n_words) - n_words
    if len(word) >= k:
        n = len(word) - k + 1
        h = word[:n].copy()
        for j in range(1, k):
            h = h * _A + word[j:n + j]
        ok = doc[:n] == doc[k - 1:]
        h, owner = mix64(h[ok]), doc[:n][ok]
    else:
        h, owner = np.zeros(0, U64), np.zeros(0, np.int64)
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):
        extra = []
        for d in short.tolist():
            x = int(n_words[d])
            for w in word[first[d]:first[d] + n_words[d]].tolist():
                x = (x * int(_A) + w) & ((1 << 64) - 1)
            extra.append(x)
        h = np.concatenate((h, mix64(np.array(extra, U64) + U64(1))))
        owner = np.concatenate((owner, short))
        order = np.argsort(owner, kind="stable")
        h, owner = h[order], owner[order]
    count = np.bincount(owner, minlength=len(docs))
    off = np.concatenate(([0], np.cumsum(count)))
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[keep], owner[keep]
    return h, np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(docs)))))


def collections(h: np.ndarray, off: np.ndarray, collection: int, per_key: int) -> np.ndarray:
    """Hashes of both collections, a row of 2*collection for each non-empty set."""
    n = 2 * collection * per_key
    rng = np.random.Generator(np.random.PCG64(20240229))
    salt = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    mult = rng.integers(0, 1 << 63, n, dtype=np.uint64) * U64(2) + U64(1)
    starts = off[:-1][np.diff(off) > 0]
    out = np.empty((len(starts), 2 * collection), U64)
    for i in range(2 * collection):
        key = np.full(len(starts), i + 1, U64)
        for j in range(i * per_key, (i + 1) * per_key):
            key = mix64(key * _A + np.minimum.reduceat((h ^ salt[j]) * mult[j], starts))
        out[:, i] = key
    return out


SIGNATURE = "doc_id long, n_shingles long, d1 long, d2 long, u array<long>, v array<long>"


def _sign(collection: int, per_key: int):
    def sign(batches):
        hasher = WordHasher()
        for batch in pieces(batches, 1):
            ids, docs = batch.column(0), texts(batch.column(1))
            h, off = shingle_sets(docs, hasher)
            n = np.diff(off)
            full = np.flatnonzero(n)
            d1, d2 = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
            u = v = [None] * len(docs)
            if len(full):
                at = off[:-1][full]
                d1[full] = np.add.reduceat(mix64(h + U64(7)), at).view(np.int64)
                d2[full] = np.add.reduceat(mix64(h ^ U64(0xA5A5A5A5A5A5A5A5)), at).view(np.int64)
                keys = collections(h, off, collection, per_key).view(np.int64)
                u, v = [None] * len(docs), [None] * len(docs)
                for i, row in zip(full.tolist(), keys.tolist()):
                    u[i], v[i] = row[:collection], row[collection:]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(n, pa.int64()), pa.array(d1), pa.array(d2), pa.array(u, longs), pa.array(v, longs)],
                names=["doc_id", "n_shingles", "d1", "d2", "u", "v"])
        hand_back()
    return sign


def _sets(batches):
    hasher = WordHasher()
    for batch in pieces(batches, 1):
        h, off = shingle_sets(texts(batch.column(1)), hasher)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(np.diff(off), pa.int64()),
             pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(h.view(np.int64)))],
            names=["id", "n", "set"])
    hand_back()


def _verify(percent: int):
    def verify(batches):
        for batch in batches:
            a, b = [], []
            for x, y, s, t in zip(*[batch.column(i) for i in range(4)]):
                both = np.concatenate((s.values.to_numpy(), t.values.to_numpy()))
                both.sort(kind="stable")
                same = int(np.count_nonzero(both[1:] == both[:-1]))
                if 100 * same >= percent * (len(both) - same):
                    a.append(x.as_py())
                    b.append(y.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return verify


def table_keys(classes: DataFrame) -> DataFrame:
    """(key, id) of every class in every table in which it could meet another."""
    sided = F.concat(F.transform("u", lambda h: F.struct(h.alias("h"), F.lit(0).alias("side"))),
                     F.transform("v", lambda h: F.struct(h.alias("h"), F.lit(1).alias("side"))))
    half = classes.select("id", F.explode(sided).alias("k")).select("id", "k.h", "k.side")
    met = half.groupBy("h", "side").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h", "side")
    shared = (half.join(met, ["h", "side"]).groupBy("id")
              .agg(F.collect_list(F.when(F.col("side") == 0, F.col("h"))).alias("u"), F.collect_list(F.when(F.col("side") == 1, F.col("h"))).alias("v")))
    return (shared.select("id", F.explode("u").alias("hu"), "v").select("id", "hu", F.explode("v").alias("hv"))
            .select(F.xxhash64("hu", "hv").alias("key"), "id"))


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("set").alias("sa")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("set").alias("sb")), "b")
    return (both.filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").select("a", "b", "sa", "sb")
            .mapInArrow(_verify(percent), "a long, b long"))


def _followed(pointers: DataFrame) -> DataFrame:
    """(a, b) with b moved on to where b itself points, if it does."""
    on = pointers.select(F.col("a").alias("b"), F.col("b").alias("next"))
    return pointers.join(on, "b", "left").select("a", F.coalesce("next", "b").alias("b"))


def _shared_outside(open_ids: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, c, n, x): x of the n shingles occur in another component's classes as well."""
    each = sets.join(open_ids, "id").select("id", "c", "n", F.explode("set").alias("s"))
    wide = each.groupBy("s").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("s")
    return each.join(wide, "s").groupBy("id", "c", "n").agg(F.count(F.lit(1)).alias("x"))


def _meet(shared: DataFrame, reps: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links (a, b) that span those of all classes of ``shared`` with a common hash of the first collection."""
    rows = shared.select("id", "c").join(reps, "id").select("id", "c", F.explode("u").alias("hu"))
    size = (rows.groupBy("hu").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
            .filter("lo <> hi").select("hu", "blocks"))
    mine = F.pmod(F.xxhash64("id"), F.col("blocks"))
    dealt = (rows.join(size, "hu").withColumn("own", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("id", "c", "hu", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own"))
    return dealt.join(sets, "id").groupBy("hu", "i", "j").applyInArrow(_common(percent), "a long, b long").distinct()


def _common(percent: int):
    def common(table: pa.Table) -> pa.Table:
        ids, c, n, own = (np.array(table[k].combine_chunks(), np.int64) for k in ("id", "c", "n", "own"))
        col = table["set"].combine_chunks()
        owner = np.repeat(np.arange(len(ids)), col.value_lengths().to_numpy())
        _, at, seen = np.unique(col.flatten().to_numpy(), return_inverse=True, return_counts=True)
        often = seen > 1                                # a shingle of one class alone is in no intersection
        owner, at = owner[often[at]], (np.cumsum(often) - 1)[at[often[at]]]
        both = np.zeros((len(ids), len(ids)), np.float32)
        order = np.argsort(at, kind="stable")
        owner, at = owner[order], at[order]
        for lo in range(0, int(often.sum()), 4096):
            part = slice(*np.searchsorted(at, [lo, lo + 4096]))
            has = np.zeros((len(ids), 4096), np.float32)
            has[owner[part], at[part] - lo] = 1
            both += has @ has.T
        link = ((100 + percent) * both.astype(np.int64) >= percent * (n[:, None] + n[None])) & (c[:, None] < c[None])
        if (own != own[0]).any():
            link &= own[:, None] != own[None]
        a, b = forest(*(ids[k] for k in np.nonzero(link))) if link.any() else ([], [])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return common


def near_duplicates(docs: DataFrame, percent: int = 75, collection: int = 10, per_key: int = 2, pivot_rounds: int = 1, block: int = 400) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per document.  ``pivot_rounds`` 0 leaves out the pivots:
    all candidates meet in blocks."""
    spark = docs.sparkSession
    tmp = Scratch(spark, "minhash")
    base = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = tmp.write(base.mapInArrow(_sign(collection, per_key), SIGNATURE), "signed")
    some = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = tmp.write(some.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("id")), "classes")
    reps = some.join(classes.select(F.col("id").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "u", "v")
    reps = tmp.write(reps, "reps")
    keys = table_keys(reps)
    shared = keys.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("met")).filter("lo <> hi")
    met = tmp.write(keys.join(shared.select("key", "met"), "key").distinct(), "met")
    central = met.groupBy("id").agg(F.sum("met").alias("central"))
    members = central.select(F.col("id").alias("doc_id"))
    sets = tmp.write(base.join(members, "doc_id", "left_semi").mapInArrow(_sets, "id long, n long, set array<long>"), "sets")
    # every class against the most central class of the keys it shares, most shared first
    tables = met.select("key", "id").join(central, "id")
    first = (tables.groupBy("key").agg(F.min(F.struct(-F.col("central"), F.col("id"))).alias("p")).select("key", F.col("p.id").alias("pivot")))
    asked = (tables.join(first, "key").filter("id <> pivot").groupBy("id", "pivot").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("id").agg(F.max_by("pivot", F.struct("n", "pivot")).alias("b")).select(F.col("id").alias("a"), "b"))
    stars = tmp.write(_checked(asked if pivot_rounds else asked.limit(0), sets, percent), "stars")
    # a pivot comes before its classes in one order of all classes, so following pivots ends: four steps join most of a group
    up = _followed(_followed(stars))
    rows = met.select("key", "id").join(up.select(F.col("a").alias("id"), "b"), "id", "left").select("key", "id", F.coalesce("b", "id").alias("c"))
    still = rows.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("key")
    left = tmp.write(_shared_outside(rows.join(still, "key", "left_semi").select("id", "c").distinct(), sets)
                     .filter(f"100 * x >= {percent} * n").select("id", "c"), "left")
    blocks = tmp.write(_meet(left, reps, sets, percent, block), "blocks")
    comp = components(stars.unionByName(blocks), tmp, "comp")
    out = signed.select("doc_id", "n_shingles", "d1", "d2").join(classes, ["n_shingles", "d1", "d2"], "left")
    out = out.join(comp, "id", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id"))
    return (out.withColumn("component_id", own)
            .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept")))
