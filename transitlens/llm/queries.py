"""Queries of the operators over the given tables, and their SQL where SQL can state them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from transitlens.llm import (decontam, embed_dedup, hard_negatives, license_scan, line_dedup, minhash, packing, resample, sharding, suffix_dedup,
                             toxicity, warc, wavelet)
from transitlens.llm.common import Scratch

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark, sf_dir):
    """Suffix-array dedup of whole documents at 100 bytes."""
    cut = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op2_decontaminate(spark, sf_dir):
    """Benchmark windows of 13 words in whole documents."""
    found = decontam.judged(decontam.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP2_SQL = """
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
d AS (SELECT row_number() OVER () AS r, doc_id,
  coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents),
dw AS (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT dw.r, dw.s, dw.n, iw.item_id FROM dw JOIN iw USING (n, g)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS k FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(k, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""


def op3_toxicity(spark, sf_dir):
    """Toxicity of every whole text, learnt from labels outside the held-out fold."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_wavelet(spark, sf_dir):
    """Token ids of all documents, written to wavelet-matrix files and read back."""
    path = Scratch(spark, "wavelet").path("shards")
    wavelet.write_shards(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return wavelet.read_shards(spark, path)


def op6_embedding_dedup(spark, sf_dir):
    """Near-duplicate vectors of equal label, cosine at least 0.93."""
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_license_scan(spark, sf_dir):
    """Licence of every document; its path is source/lang/doc_id."""
    docs = table(spark, sf_dir, "documents")
    return license_scan.scan_licenses(docs.select("doc_id", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"), "text"))


def op8_warc(spark, sf_dir):
    """All pages, written to WARC archives and read back."""
    path = Scratch(spark, "warc").path("archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path)


OP8_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d"""


def op9_minhash(spark, sf_dir):
    """Near-duplicate documents, Jaccard at least 0.75 on 5-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark, sf_dir):
    """Passages of three lines or more that occur earlier."""
    cut = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP10_SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
c AS (SELECT doc_id, i, line FROM l WHERE regexp_replace(line, '[ \\t\\x0B\\f\\r]', '', 'g') <> ''),
w AS (SELECT doc_id, i, lead(i) OVER o AS j, lead(i, 2) OVER o AS k,
  line || chr(10) || lead(line) OVER o || chr(10) || lead(line, 2) OVER o AS g FROM c WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS no FROM w WHERE g IS NOT NULL),
drops AS (SELECT DISTINCT doc_id, unnest([i, j, k]) AS i FROM r WHERE no > 1),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS t FROM l ANTI JOIN drops USING (doc_id, i) GROUP BY l.doc_id),
nl AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id),
nd AS (SELECT doc_id, count(*) AS n FROM drops GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(nl.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(nd.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN nl USING (doc_id) LEFT JOIN nd USING (doc_id)"""


def op11_hard_negatives(spark, sf_dir):
    """Hard negatives of every anchor; every seventh vector first takes the next label."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")))


OP11_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""


def op12_histogram_shards(spark, sf_dir):
    """All documents in 40 shards of near equal bytes, written and read back."""
    path = Scratch(spark, "histogram-shards").path("shards")
    schema = sharding.write_shards(table(spark, sf_dir, "documents"), path)
    return sharding.read_shards(spark, path, schema).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_resample(spark, sf_dir):
    """A tenth of the documents, drawn towards the words of the benchmark."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = """
WITH RECURSIVE step(b, k, c) AS (
  SELECT b, 0, CAST(b AS BIGINT) FROM range(256) r(b)
  UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS tab FROM step WHERE k = 8),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
i AS (SELECT coalesce(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM benchmark),
dw AS (SELECT r, unnest(w) AS g FROM d),
iw AS (SELECT unnest(w) AS g FROM i),
v AS (SELECT g, hex(encode(g)) AS x FROM (SELECT g FROM dw UNION SELECT g FROM iw)),
b AS (SELECT g, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(range(len(x) // 2), lambda j: CAST('0x' || substr(x, 2 * j + 1, 2) AS BIGINT))),
    lambda c, y: xor(c >> 8, tab[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS bucket FROM v, crc),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN b USING (g) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM iw JOIN b USING (g) GROUP BY bucket),
gain AS (SELECT k AS bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM iw) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM range(10000) q(k) LEFT JOIN s ON s.bucket = k LEFT JOIN t ON t.bucket = k),
w AS (SELECT r, count(*) AS n, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
  FROM dw JOIN b USING (g) JOIN gain USING (bucket) GROUP BY r),
u AS (SELECT d.r, doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (r)),
o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM u WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM u LEFT JOIN o USING (r)"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_dedup, op2_decontaminate, op3_toxicity, op4_packing, op5_wavelet, op6_embedding_dedup,
                            op7_license_scan, op8_warc, op9_minhash, op10_line_dedup, op11_hard_negatives, op12_histogram_shards,
                            op13_resample)}
ORACLE = {"op2_decontaminate": OP2_SQL, "op8_warc": OP8_SQL, "op10_line_dedup": OP10_SQL, "op11_hard_negatives": OP11_SQL,
          "op13_resample": OP13_SQL}
