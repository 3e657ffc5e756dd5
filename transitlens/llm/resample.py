"""Target-distribution importance resampling (operator 13).

Words are what is left of a text's UTF-8 bytes after one ``bytes.translate``
(a 256-byte table lower-cases A-Z and blanks every separator) and one
``bytes.split``.  A feature is a run of 1 to ``grams`` consecutive words; its
bucket is the crc32 of the words joined by one space, built by passing the
crc32 of the shorter run as the seed of the next one.  Counters reduce the words
of a slice before any bucket is computed, each task emits one row per bucket it
met, and Spark adds them up: the driver receives ``buckets`` rows, never more.

A document's weight is the floored mean of its features' gains (how much likelier
a bucket is in the target than in the corpus, in thousandths of a nat); its score
adds Gumbel noise derived from its doc_id, so the highest scores are a draw
without replacement in proportion to the importance weights.  The draw needs no
global sort: scores are integers in a bounded range, their counts give the score
of the last one drawn, and only rows from that score on are range-partitioned,
sorted and numbered.

Defined cases: null or empty text, or text without words, has no features and
weight 0, and can't be drawn unless ``least_words`` is 0; a null doc_id hashes as
an empty id and comes last among equal scores; rows that share a doc_id are
documents of their own (equal rows get neighbouring ranks); empty corpus: no
rows; empty target: T and every t are 0; extra columns are ignored.
"""
from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from transitlens.llm.common import Scratch, pieces, texts

BUCKETS = 10_000
SEED = "2024"
WORD_BYTES = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
TABLE = bytes(c if c in WORD_BYTES else 0x20 for c in bytes(range(256)).lower())
MOST_CACHED = 200_000       # words whose gain a task remembers at once


def words(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def longer_runs(found: list[bytes], grams: int):
    """crc32 of every run of 2 to ``grams`` words, each from the crc32 of the run one word shorter."""
    for i in range(len(found) - 1):
        crc = zlib.crc32(found[i])
        for w in found[i + 1:i + grams]:
            crc = zlib.crc32(w, zlib.crc32(b" ", crc))
            yield crc


def n_features(n_words: int, grams: int) -> int:
    return sum(max(0, n_words - g + 1) for g in range(1, grams + 1))


def _count(grams: int, buckets: int):
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in pieces(batches, 0):
            single: Counter = Counter()
            for t in texts(batch.column(0)):
                found = words(t)
                single.update(found)
                if grams > 1:
                    for b, n in Counter(crc % buckets for crc in longer_runs(found, grams)).items():
                        total[b] += n
            for w, n in single.items():
                total[zlib.crc32(w) % buckets] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])
    return count


def bucket_counts(docs: DataFrame, grams: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket."""
    each = docs.select(F.col("text").cast("string")).mapInArrow(_count(grams, buckets), "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, grams: int = 1, buckets: int = BUCKETS) -> list[int]:
    """floor(1000 * ln(target share / corpus share)) of every bucket, with one feature added to each bucket."""
    counts = []
    for table in (corpus, target):
        n = [0] * buckets
        for r in bucket_counts(table, grams, buckets).collect():       # at most ``buckets`` rows
            n[r["bucket"]] = r["n"]
        counts.append(n)
    s, t = counts
    S, T = float(sum(s) + buckets), float(sum(t) + buckets)
    return [math.floor(1000 * math.log((y + 1.0) * S / ((x + 1.0) * T))) for x, y in zip(s, t)]


class _Gain(dict):
    """Gain of a word, computed when first asked for."""

    def __init__(self, gain: list[int]):
        self.gain = gain

    def __missing__(self, word: bytes) -> int:
        g = self.gain[zlib.crc32(word) % len(self.gain)]
        if len(word) <= 64:             # what is remembered stays small
            if len(self) >= MOST_CACHED:
                self.clear()
            self[word] = g
        return g


def _weigh(gain, grams: int):
    def weigh(batches):
        by_word = _Gain(gain.value)
        of_word, by_bucket = by_word.__getitem__, gain.value
        for batch in pieces(batches, 1):
            n_words, n_feat, weight = [], [], []
            for t in texts(batch.column(1)):
                found = words(t)
                total = sum(map(of_word, found))
                if grams > 1:
                    total += sum(by_bucket[crc % len(by_bucket)] for crc in longer_runs(found, grams))
                n = n_features(len(found), grams)
                n_words.append(len(found))
                n_feat.append(n)
                weight.append(total // n if n else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_feat, pa.int64()), pa.array(weight, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"])
    return weigh


def noise(doc_id, seed: str = SEED):
    """Gumbel noise of a document in thousandths, from the first 32 bits of sha256(``seed:doc_id``)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _numbered(drawn: DataFrame, tmp: Scratch) -> DataFrame:
    """``drawn`` with rank 1, 2, ... by falling score, then doc_id: a range-partitioned sort, numbered by partition."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("tie")]
    rows = drawn.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("no", F.monotonically_increasing_id())
    rows = tmp.write(rows.withColumns({"part": F.shiftright("no", 33), "at": F.col("no").bitwiseAND((1 << 33) - 1)}).drop("no"), "ranked")
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))           # a row per partition
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    first = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(F.broadcast(first), "part").withColumn("rank", F.col("before") + F.col("at") + 1).drop("part", "at", "before")


def resample(corpus: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, grams: int = 1,
             buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), a row per document; rank is null for documents not drawn."""
    spark = corpus.sparkSession
    tmp = Scratch(spark, "resample")
    gain = spark.sparkContext.broadcast(gains(corpus, target, grams, buckets))      # ``buckets`` integers
    weighed = corpus.select("doc_id", F.col("text").cast("string")).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _weigh(gain, grams), "doc_id long, n_words long, n_features long, weight long")
    scored = tmp.write(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
                       .withColumn("able", F.col("n_words") >= least_words).drop("n_words"), "scored")
    # integer scores: gains lie within about 45,000 of 0 and the noise between -3,200 and 23,000, so the distinct scores are bounded
    by_score = scored.filter("able").groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()
    draw = percent * sum(r["n"] for r in by_score) // 100
    cut, have = None, 0
    for score, n in sorted(map(tuple, by_score), reverse=True):
        if have >= draw:
            break
        cut, have = score, have + n
    columns = ["doc_id", "n_features", "weight", "score"]
    undrawn = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return scored.select(*columns, undrawn)
    above = F.col("able") & (F.col("score") >= cut)
    # equal rows take ranks in any order: their number in the written table splits them between partitions
    ranked = _numbered(scored.filter(above).select(*columns, F.monotonically_increasing_id().alias("tie")), tmp)
    return scored.filter(~above).select(*columns, undrawn).unionByName(
        ranked.select(*columns, F.when(F.col("rank") <= draw, F.col("rank")).cast("long").alias("rank")))
