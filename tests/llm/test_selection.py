"""Hard negatives (11), histogram sort (12) and importance resampling (13)."""
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.test_operators import ODD, frame, texts_of, tuples
from transitlens.llm import hard_negatives, queries, resample, sharding

VEC = "vec_id long, embedding array<double>, label int, tile string, score long, v int, block int"


# ------------------------------------------------------------------ 11
def negatives_brute(rows, every=100, n_pos=5, n_neg=10, least=30, most=90):
    rows = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
            if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, v, lab in rows:
        if i % every:
            continue
        scored = sorted((-dot(v, w), j, m) for j, w, m in rows if j != i)
        for s, j in [(-s, j) for s, j, m in scored if m == lab][:n_pos]:
            hard = [(t, k) for t, k, m in scored if m != lab and least * s <= -100 * t <= most * s][:n_neg]
            out += [(i, j, r + 1, k, s, -t) for r, (t, k) in enumerate(hard)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 2, 3) for r in rows], VEC)


@pytest.mark.parametrize("seed", range(3))
def test_hard_negatives_equal_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 7)) + 0.6
    rows = [(int(i), (centres[(c := int(rng.integers(6)))] + 0.3 * rng.normal(size=7)).round(2).tolist(), c % 4) for i in range(700)]
    rows += [(700 + i, rows[3][1], int(i % 2)) for i in range(200)]            # copies of one vector: ties by vec_id
    rows += [(901, None, 1), (902, [1.0, None] + [0.0] * 5, 1), (903, [float("nan")] * 7, 1), (904, [float("inf")] + [0.0] * 6, 2),
             (905, [0.5] * 7, None), (None, [0.5] * 7, 1), (-100, [0.1, 0.2], 1), (906, [], 2), (1000, [0.0] * 7, 3)]
    got = hard_negatives.hard_negatives(vectors(spark, rows), tile_rows=150, block=4)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert tuples(got) == negatives_brute(rows)


def test_hard_negatives_of_any_condition_and_size(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=5).tolist(), int(i % 3)) for i in range(60)]
    got = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 7 == 0, positives=2, negatives=3, least=-50, most=120, tile_rows=10, block=2)
    assert tuples(got) == negatives_brute(rows, 7, 2, 3, -50, 120)


def test_hard_negatives_repeated_rows_huge_components_and_empty(spark):
    rows = [(i, [float(i % 5), 1.0], i % 2) for i in range(1, 220)] + [(200, [0.0, 1.0], 0)] * 3 + [(7, [9.0, 9.0], 5)]
    first = {}
    for r in rows:
        first[r[0]] = min(first.get(r[0], r), r, key=lambda x: (x[2], x[1]))
    assert tuples(hard_negatives.hard_negatives(vectors(spark, rows), tile_rows=50)) == negatives_brute(first.values())
    big = [(i, [1e6 + i, 1e4 * i], i % 2) for i in range(100, 130)]        # sums beyond exact doubles
    assert tuples(hard_negatives.hard_negatives(vectors(spark, big), tile_rows=9)) == negatives_brute(big)
    vast = [(i, [1e30, -1e30 + i], i % 2) for i in range(100, 110)]
    assert hard_negatives.hard_negatives(vectors(spark, vast)).count() >= 0
    assert tuples(hard_negatives.hard_negatives(vectors(spark, []))) == []
    assert tuples(hard_negatives.hard_negatives(vectors(spark, [(100, [1.0], 1)]))) == []


def test_boxes_bound_scores_and_search_leaves_nodes_unopened():
    rng = np.random.default_rng(4)
    v = np.floor(256 * (rng.normal(size=(1000, 3)) + 5 * rng.integers(0, 4, 1000)[:, None])).astype(np.int64)
    leaves = hard_negatives.tiles_of(v, np.zeros(1000, np.int64))
    assert sorted(np.concatenate(leaves).tolist()) == list(range(1000)) and max(map(len, leaves)) <= hard_negatives.LEAF
    two = hard_negatives.tiles_of(v[:20], np.arange(20) % 2)
    assert all(len(set(x % 2)) == 1 for x in two)
    tree = object.__new__(hard_negatives.Tree)
    tree.low, tree.high = (np.array([f(v[x], axis=0) for x in leaves], float) for f in (np.min, np.max))
    a = np.array([[3.0, -7.0, 2.0]])
    low, high = tree.bounds(a)
    for i, x in enumerate(leaves):
        s = v[x] @ a[0]
        assert low[0, i] <= s.min() and s.max() <= high[0, i]


# ------------------------------------------------------------------ 12
def sharded(spark, docs, tmp_path, **kw):
    path = str(tmp_path / f"s{random.random()}")
    return sharding.read_shards(spark, path, sharding.write_shards(docs, path, **kw))


def check_shards(got, sizes, shards, law="bytes"):
    rows = got.select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(sizes)
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append((r["slot"], r["size"]))
    assert all(0 <= s < shards for s in by)
    assert all(sorted(n for n, _ in x) == list(range(len(x))) for x in by.values())
    total = sum(s[1] for s in sizes)
    if law == "rows":
        counts = [len(by[s]) for s in range(shards)]
        assert max(counts) - min(counts) <= 1
    else:
        most = max(s[1] for s in sizes)
        assert all(abs(sum(x for _, x in by[s]) - total / shards) <= most + 0.002 * total / shards + 1 for s in range(shards))
    return rows


def expected(rows):
    out = []
    for d, t in rows:
        b = (t or "").encode()
        out.append((d, len(b) + 16, zlib.crc32(b)))
    return out


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_shards_of_the_given_documents(spark, tmp_path, law):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sharded(spark, docs.repartition(5), tmp_path, law=law, shards=7, piece_bytes=5000)
    rows = check_shards(got, expected(texts_of(docs)), 7, law)
    again = sharded(spark, docs.repartition(3), tmp_path, law=law, shards=7, piece_bytes=5000)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again.select("doc_id", "size", "text_crc32", "shard", "slot").collect()))
    place = {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    groups = defaultdict(list)
    for d, t in texts_of(docs):
        groups[t].append(place[d])
    order = {p: i for i, p in enumerate(sorted(place.values()))}
    for g in groups.values():                                   # equal texts lie side by side
        at = sorted(order[p] for p in g)
        assert at == list(range(at[0], at[0] + len(at)))
    assert {(r["doc_id"], r["row"]["text"]) for r in got.collect()} == set(texts_of(docs))


def test_a_hot_text_with_one_doc_id_is_split(spark, tmp_path):
    texts = ["copy of a text"] * 900 + [f"text {i} " * (i % 9) for i in range(600)] + ODD + ["x" * 3000]
    ids = [5] * 500 + list(range(400)) + list(range(1000, 1000 + len(texts) - 900))
    docs = frame(spark, texts, ids)
    got = sharded(spark, docs, tmp_path, shards=11, piece_bytes=700)
    check_shards(got, expected(zip(ids, texts)), 11)
    assert got.select("row.copies", "row.spans", "row.key").distinct().count() == 1


def test_shards_of_null_ids_few_rows_and_none(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a", 1), (None, "a", 2), (3, None, 3)], "doc_id long, text string, shard int")
    check_shards(sharded(spark, docs, tmp_path, shards=5, law="rows"), expected([(None, "a"), (None, "a"), (3, None)]), 5, "rows")
    assert sharded(spark, docs.limit(0), tmp_path).collect() == []
    with pytest.raises(ValueError):
        sharding.write_shards(docs, str(tmp_path / "no"), law="weight")


def test_keys_keep_their_order_as_numbers():
    keys = sorted((random.choice([-1 << 63, -5, 0, 9, (1 << 63) - 1]), random.randrange(-9, 9), random.randrange(5)) for _ in range(99))
    assert [sharding.key_of(sharding.number(*k)) for k in keys] == keys
    assert sorted(sharding.number(*k) for k in keys) == [sharding.number(*k) for k in keys]


# ------------------------------------------------------------------ 13
def resample_brute(docs, items, percent=10, least=20, grams=1, buckets=10_000):
    def features(t):
        w = brute.words2(t)
        return len(w), [zlib.crc32(" ".join(w[i:i + g]).encode()) % buckets for g in range(1, grams + 1) for i in range(len(w) - g + 1)]
    found = [(d, *features(t)) for d, t in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for _, x in items for b in features(x)[1])
    S, T = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * S / ((s[b] + 1) * T))) for b in range(buckets)]
    out = []
    for d, n_words, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words >= least])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


MESSY = ODD + ["The quick BROWN fox; jumps-over the lazy dog " * 4, "ÄÖ straße été 漢字かな " * 9, "a b—c " * 30, "w" * 70 + " tail " * 40]


@pytest.mark.parametrize("grams,buckets", [(1, 10_000), (3, 50)])
def test_resample_equals_brute_force(spark, grams, buckets):
    rng = random.Random(grams)
    texts = MESSY + [" ".join(rng.choices(["alpha", "Beta", "gamma9", "x_y", "9"], k=rng.randrange(60))) for _ in range(200)] + ["same words " * 15] * 60
    ids = list(range(len(texts) - 30)) + [7] * 28 + [None] * 2
    items = ["alpha beta", None, "the quick brown fox", ""]
    target = spark.createDataFrame([(str(i), t) for i, t in enumerate(items)], "item_id string, text string")
    got = resample.resample(frame(spark, texts, ids).repartition(3), target, percent=25, grams=grams, buckets=buckets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == resample_brute(list(zip(ids, texts)), list(enumerate(items)), 25, grams=grams, buckets=buckets)


def test_resample_of_no_documents_no_target_and_everything(spark):
    none = spark.createDataFrame([], "item_id string, text string")
    assert resample.resample(frame(spark, []), none).collect() == []
    texts = ["one two three " * 10] * 5 + ["few"]
    got = resample.resample(frame(spark, texts), none, percent=100)
    assert sorted(map(tuple, got.collect()), key=str) == resample_brute(list(enumerate(texts)), [], 100)
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == [1, 2, 3, 4, 5]


def test_the_draw_leans_to_the_target(spark):
    texts = ["alpha beta gamma delta " * 8] * 300 + ["omega sigma kappa tau " * 8] * 300
    target = spark.createDataFrame([("1", "alpha beta gamma delta " * 50)], "item_id string, text string")
    drawn = [r["doc_id"] for r in resample.resample(frame(spark, texts), target).filter("rank is not null").collect()]
    assert len(drawn) == 60 and sum(d < 300 for d in drawn) > 55
