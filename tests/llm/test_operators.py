import hashlib
import io
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import brute
from transitlens.llm import decontam, embed_dedup, license_scan, line_dedup, minhash, packing, suffix_dedup, toxicity, warc, wavelet
from transitlens.llm.queries import tokenizer_path
from transitlens.llm.tokens import HashTable, WordCachedEncoder

DOCS = "doc_id long, text string, copies string, block long, n long, id long, key long, spans int"
ODD = [None, "", " ", "\n\n\n", "a", "a b c d", "ä. b,", "x" * 300, "x" * 300, "word " * 400, "<|endoftext|> A.B", "l1\nl2\nl3\nl4\n\nl1\nl2\nl3"]


def frame(spark, texts, ids=None):
    rows = [(i, t, "c", 1, 2, 3, 4, 5) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS)


def tuples(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# ------------------------------------------------------------------ 1
def cut(df, **kw):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return tuples(suffix_dedup.suffix_dedup(df, **kw).select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)))


def test_covers_are_difference_covers():
    for v, d in suffix_dedup.COVERS.items():
        assert {(a - b) % v for a in d for b in d} == set(range(v))


def test_fingerprints_tell_equal_from_different():
    raw = np.frombuffer(b"abcdefghij" * 30 + b"abcdefghik" * 30, np.uint8)
    for n in (3, 8, 44, 100):
        seen = {}
        for p, f in enumerate(suffix_dedup.fingerprints(raw, n).tolist()):
            assert seen.setdefault(f, raw[p:p + n].tobytes()) == raw[p:p + n].tobytes()
        assert len(seen) == len({raw[p:p + n].tobytes() for p in range(len(raw) - n + 1)})


def test_suffix_dedup_equals_brute_force(spark, documents):
    want = brute.suffix([(d, (t or "").encode()) for d, t in texts_of(documents)])
    assert cut(documents.repartition(3), block_bytes=100_000, bucket_bytes=200_000) == want


@pytest.mark.parametrize("window", [12, 30, 100])
def test_suffix_dedup_small_windows(spark, window):
    rng = np.random.default_rng(window)
    texts = ["".join(rng.choice(list("ab"), 60)) + "shared passage of some length " * (i % 4) for i in range(30)] + ODD
    got = cut(frame(spark, texts), window=window, block_bytes=700, bucket_bytes=500)
    assert got == brute.suffix([(i, (t or "").encode()) for i, t in enumerate(texts)], window)


def test_suffix_dedup_empty_and_null_ids(spark):
    assert cut(frame(spark, [])) == []
    got = suffix_dedup.suffix_dedup(frame(spark, ["y" * 150, "y" * 150], [7, None])).select("doc_id", F.length("kept")).collect()
    assert {(r[0], r[1] == 0) for r in got} == {(7, False), (None, True)}


# ------------------------------------------------------------------ 2
def judged(docs, items, **kw):
    return tuples(decontam.judged(decontam.scan(docs, items, **kw)).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256), "contaminated"))


def test_decontamination_equals_brute_force(spark, documents):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    want = brute.decontam(texts_of(documents), [(r["item_id"], r["text"]) for r in bench.collect()])
    assert any(w[5] for w in want)
    assert judged(documents, bench) == want
    assert judged(documents, bench, block_words=200) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc ", max_size=30), max_size=5), st.lists(st.text("abcd ", max_size=60), min_size=1, max_size=4), st.integers(1, 4))
def test_automaton_hits(items, docs, window):
    auto = decontam.SuffixAutomaton([(str(i), decontam.words_of(t.encode())) for i, t in enumerate(items)], window)
    want = brute.decontam(list(enumerate(docs)), list(enumerate(items)), window)
    for (_, n, hit, k, sha, _), t in zip(want, docs):
        spans, found = auto.hits(decontam.words_of(t.encode()))
        assert (sum(b - a for a, b in spans), len(found)) == (hit, k)
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_decontamination_odd_inputs(spark):
    items = spark.createDataFrame([(1, "A b c"), (2, None), (3, ""), (None, "a"), (1, "zz"), (4, "word " * 13)], "item_id long, text string")
    docs = frame(spark, ODD + ["x a B, c y", "zz"])
    plain = [(1, "A b c"), (1, "zz"), (4, "word " * 13)]
    assert judged(docs, items) == brute.decontam(list(enumerate(ODD + ["x a B, c y", "zz"])), plain)
    assert all(r[2] == 0 for r in judged(docs, items.limit(0)))
    assert judged(docs.limit(0), items) == []
    kept = decontam.remove_spans(docs, items)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in kept.collect()} == {5, 9, 12, 13}


@pytest.mark.parametrize("block_words", [200, 500_000])
def test_spans_of_all_blocks_are_judged_and_cut_once(spark, block_words):
    items = [(i, " ".join(f"i{i}w{k}" for k in range(100))) for i in range(6)]       # three blocks of two items at 200 words
    shared = " ".join(f"s{k}" for k in range(20))
    items += [(10, shared + " " + " ".join(f"x{k}" for k in range(180))), (11, " ".join(f"y{k}" for k in range(180)) + " " + shared)]
    word = lambda i, a, n: " ".join(f"i{i}w{k}" for k in range(a, a + n))
    own = lambda t, n: " ".join(f"{t}{k}" for k in range(n))
    both = own("p", 200) + " " + word(0, 5, 13) + " " + own("q", 200) + " " + word(4, 50, 13) + " " + own("r", 80)     # 13 + 13 of 506
    one = own("p", 300) + " " + word(0, 5, 13) + " " + own("q", 200)                                                # 13 of 513
    split = own("p", 200) + " " + word(2, 0, 7) + " " + word(0, 5, 13) + " " + word(2, 7, 13) + " " + own("q", 800)    # neighbours only after a cut
    lap = own("p", 900) + " y175 y176 y177 y178 y179 " + shared + " x0 x1 x2 " + own("q", 900)                       # spans of two blocks overlap
    rows = [(1, both), (2, one), (3, split), (4, lap), (2, lap), (2, "plain words"), (2, one), (None, both), (None, one), (None, None), (5, "")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, row long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    words, wins = {}, {tuple(w[i:i + 13]) for _, t in items for w in [t.split()] for i in range(len(w) - 12)}
    for i, (_, t) in enumerate(rows):
        w = (t or "").split()
        hit = {p for k in range(len(w) - 12) if tuple(w[k:k + 13]) in wins for p in range(k, k + 13)}
        if not hit or 20 * len(hit) < len(w):
            words[i] = [x for p, x in enumerate(w) if p not in hit]
    assert set(words) == {1, 2, 3, 4, 5, 6, 8, 9, 10} and len(words[2]) == 1007 and len(words[3]) == 1800
    got = {r["row"]: r for r in decontam.remove_spans(docs, bench, block_words=block_words).collect()}
    assert {i: (r["text"] or "").split() for i, r in got.items()} == words
    assert got[9]["text"] is None and got[5]["text"] == "plain words"
    scanned = decontam.judged(decontam.scan(docs, bench, block_words=block_words))
    want = [brute.decontam([(0, t)], items)[0][1:] for _, t in rows]
    assert sorted((r["doc_id"] or -1, r["n_words"], r["n_hit"], r["n_items"], hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r["contaminated"])
                  for r in scanned.collect()) == sorted((r[0] or -1, *x) for r, x in zip(rows, want))


def test_spans_are_cut():
    assert decontam.cut_words(b"One, two three; four.", [(1, 3)]) == b"One, ; four."


# ------------------------------------------------------------------ 3
def test_gradients():
    rng = np.random.default_rng(1)
    words = [b"alpha", b"beta", b"gamma", b"delta"]
    m = toxicity.Model({b"alpha": 1, b"beta": 2}, rng.normal(0, 1, (3, toxicity.D)), rng.normal(0, 1, (toxicity.BUCKETS, toxicity.D)))
    idx, size = np.array([[0, 1, 2], [3, 1, 1]]), np.array([3, 2])
    y, w = np.array([1, 0], np.float32), np.array([0.7, 1.3], np.float32)
    _, g = m.gradients(words, idx, size, y, w)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    for k, v in m.p.items():
        at = np.unravel_index(np.abs(g[k]).argmax(), v.shape)
        old, eps = v[at], 1e-3
        v[at] = old + eps
        up = m.gradients(words, idx, size, y, w)[0]
        v[at] = old - eps
        down = m.gradients(words, idx, size, y, w)[0]
        v[at] = old
        assert (up - down) / (2 * eps) == pytest.approx(float(g[k][at]), rel=0.03, abs=2e-3), k


def test_windows_overlap_and_cover():
    for n in (0, 1, 64, 65, 200):
        seen = {i for s, k in toxicity.windows_of(n) for i in range(s, s + k)}
        assert seen == set(range(n))


def test_toxicity_held_out(spark):
    rng = np.random.default_rng(5)
    plain = ["table", "river", "stone", "house", "green", "walk", "music", "paper"]
    bad = ["vilefoo", "vilebar", "vilebaz", "vilequx"]
    rows = []
    for i in range(600):
        w = list(rng.choice(plain, 120))
        if i % 3 == 0:
            w[rng.integers(120)] = str(rng.choice(bad)) + str(rng.choice(["a", "o", "u"]))
        rows.append((i, " ".join(w), int(i % 3 == 0)))
    docs = spark.createDataFrame(rows + [(1000, None, None), (1001, "", None), (None, "river", None)], "doc_id long, text string, toxic int")
    got = toxicity.toxicity(docs, docs.filter("toxic is not null")).collect()
    assert len(got) == 603
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 1000]
    assert sum(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in held) > 0.95 * len(held)
    one = toxicity.toxicity(docs, docs.filter("toxic = 0")).collect()
    assert {r["score"] for r in one} == {0.0}
    assert toxicity.toxicity(docs.limit(0), docs).count() == 0
    model = toxicity.fit(docs, docs)
    assert toxicity.keep_clean(docs, model).columns == docs.columns


def test_every_ngram_of_a_long_run_is_read():
    rng = np.random.default_rng(2)
    grams = lambda ws: set(toxicity.ngrams(ws)[0].tolist())
    for n in (40, 41, 52, 53, 200, 1000):
        run = bytes(rng.integers(0x80, 0x100, n).tolist())
        words = toxicity.words_of(b"a " + run + b" b")
        assert words[0] == b"a" and words[-1] == b"b" and (words[1] == run) == (n <= 40)
        assert {run[i:i + 5] for i in range(n - 4)} <= {w[i:i + 5] for w in words for i in range(len(w) - 4)}
        assert len(grams([run])) > 0.8 * 3 * n and grams([b"z" * 45]) != grams([b"z" * 45 + b"y"])


def test_stretches_have_the_windows_of_the_whole(monkeypatch):
    monkeypatch.setattr(toxicity, "STRETCH", 128)
    for n in (0, 1, 64, 191, 192, 193, 250, 320, 1000, 1023):
        words = list(range(n))
        whole = sorted(tuple(words[s:s + k]) for s, k in toxicity.windows_of(n))
        assert sorted(tuple(p[s:s + k]) for p in toxicity._stretches(words) for s, k in toxicity.windows_of(len(p))) == whole


def test_toxicity_of_text_without_spaces(spark):
    rng = np.random.default_rng(6)
    letters = [chr(c) for c in range(0x4E00, 0x4F00)]
    rows = []
    for i in range(900):
        t = "".join(rng.choice(letters, 400))
        if i % 3 == 0:
            at = rng.integers(60, 340)
            t = t[:at] + "鼁鼂鼃鼄" + t[at:]
        rows.append((i, t, int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    held = toxicity.toxicity(docs, docs).filter("held_out").collect()
    assert sum(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in held) > 0.9 * len(held)


# ------------------------------------------------------------------ 4, 5
@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("aAéHI .,\n'<|>\x01\x85̱́sSt1\U0001F600ßΣ\t", max_size=40), max_size=6))
def test_encoder_equals_tokenizer(tokenizer, texts):
    enc = ENC.setdefault(0, WordCachedEncoder(tokenizer_path(), 2))
    import pyarrow as pa
    for t, ids in zip(texts, enc.encode(pa.array(texts, pa.string()))):
        assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [2]


ENC: dict = {}


def test_encoder_forgets_but_stays_right(tokenizer):
    import pyarrow as pa
    enc = WordCachedEncoder(tokenizer_path(), 1, most_words=50)
    texts = [f"word{i} and other{i % 7}, end." for i in range(200)] + ODD
    for t, ids in zip(texts, enc.encode(pa.array(texts), chunk=300)):
        assert ids.tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids + [1]


def test_hash_table():
    rng = np.random.default_rng(2)
    t, keys = HashTable(3), np.unique(rng.integers(1, 1 << 62, 5000).astype(np.uint64))
    for part in np.array_split(keys, 9):
        t.add(part)
    assert t.find(keys).tolist() == list(range(len(keys)))
    assert (t.find(keys + np.uint64(1)) == -1).all()


@pytest.mark.parametrize("parts,size", [(1, 2048), (30, 2048), (7, 16)])
def test_packing_covers_every_id_once(spark, documents, tokenizer, parts, size):
    docs = documents.select("doc_id", "text").unionByName(frame(spark, ODD, range(1000, 1000 + len(ODD))).select("doc_id", "text"))
    rows = packing.pack(docs.repartition(parts), tokenizer_path(), size=size, open_windows=4, fan_in=3).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for d, t in texts_of(docs):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    short = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
        short += at < size
    assert short <= 1


def test_packing_empty(spark):
    assert packing.pack(frame(spark, []), tokenizer_path()).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 70000), min_size=1, max_size=2000))
def test_wavelet_matrix(values):
    ids = np.array(values, np.uint32)
    wm = wavelet.WaveletMatrix.build(ids)
    assert wm.decode().tolist() == values
    for i in {0, len(values) // 2, len(values) - 1}:
        v = values[i]
        assert wm.access(i) == v
        where = [k for k, x in enumerate(values) if x == v]
        assert wm.count(v) == len(where) and wm.rank(v, i) == sum(x == v for x in values[:i])
        assert [wm.select(v, k) for k in range(len(where))] == where
    assert wm.count(1 << 20) == 0
    with pytest.raises(IndexError):
        wm.access(len(values))


def test_wavelet_file_round_trip_and_damage():
    raw = wavelet.write_file(np.array([3, 9]), np.array([False, True]), np.array([2, 3]), np.array([5, 6, 7, 7, 49407], np.uint32))
    docs, nulls, sizes, wm = wavelet.read_file(raw)
    assert (docs.tolist(), nulls.tolist(), sizes.tolist(), wm.decode().tolist()) == ([3, 9], [False, True], [2, 3], [5, 6, 7, 7, 49407])
    with pytest.raises(ValueError):
        wavelet.read_file(raw[:-6])


def test_wavelet_shards(spark, documents, tokenizer, tmp_path):
    docs = documents.select("doc_id", "text").unionByName(frame(spark, ODD, [*range(1000, 999 + len(ODD)), None]).select("doc_id", "text"))
    wavelet.write_shards(docs, str(tmp_path / "s"), tokenizer_path(), shard_tokens=20_000, shard_bytes=100_000)
    got = {r["doc_id"]: r for r in wavelet.read_shards(spark, str(tmp_path / "s")).collect()}
    at = 0
    for d, t in sorted(texts_of(docs), key=lambda x: (x[0] is None, x[0])):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert tuple(got[d][1:]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    wavelet.write_shards(docs.limit(0), str(tmp_path / "e"), tokenizer_path())
    assert wavelet.read_shards(spark, str(tmp_path / "e")).count() == 0


# ------------------------------------------------------------------ 6
@pytest.mark.parametrize("pairs", [0, 1, 5, 300])
def test_embeddings_with_rare_links_meet_planted_pairs(spark, pairs):
    """The few vectors that are measured (here 40 of 6,000 to 6,300) have hardly any links, one label holds nearly all rows."""
    r = np.random.default_rng(3)
    x = r.normal(size=(6000, 32))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    u = r.normal(size=(pairs, 32))
    u -= (u * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs]
    u /= np.sqrt((u * u).sum(axis=1, keepdims=True))
    y = 0.931 * x[:pairs] + np.sqrt(1 - 0.931 ** 2) * u
    rows = [(i, v.tolist(), 0 if i < 5900 else i) for i, v in enumerate(x)] + [(10_000 + i, v.tolist(), 0) for i, v in enumerate(y)]
    got = embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), queries=40).filter("n_links > 0").collect()
    found = {g.vec_id: g.component_id for g in got}
    assert all(found[10_000 + i] == i for i in range(pairs) if 10_000 + i in found) and len(found) <= 2 * pairs
    assert len(found) >= 2 * 0.9 * pairs


def test_planted_ranks_count_the_cells_before_the_meeting():
    r = np.random.default_rng(4)
    x = r.normal(size=(300, 16))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    index = embed_dedup.MultiIndex(x, 12)
    d1, d2 = index.distances(x)
    cells = r.integers(0, d1.shape[1] * d2.shape[1], len(x))
    want = [embed_dedup.multi_sequence(a, b, 10_000).index(c) for a, b, c in zip(d1, d2, cells)]
    assert embed_dedup._rank(d1, d2, cells).tolist() == want
    near = embed_dedup.planted_ranks(index, x, np.full(300, 16), 0.9999)
    far = embed_dedup.planted_ranks(index, x, np.full(300, 16), 0.8)
    assert np.median(near) == 0 and far.mean() > near.mean()
    assert len(embed_dedup.planted_ranks(index, x, np.where(np.arange(300) < 5, 1, 16), 0.93)) == 295


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(0, 1, (40, 16))
    rows = []
    for i in range(500):
        v = (base[i % 40 if i % 2 else 0] + rng.normal(0, 0.12, 16)).astype(np.float32).tolist()
        rows.append((i, v, i % 3, "x"))
    rows += [(500, None, 1, "x"), (501, [], 1, "x"), (502, [0.0] * 16, 1, "x"), (503, [float("nan")] + [1.0] * 15, 1, "x"), (504, rows[0][1], None, "x"),
             (505, rows[0][1], 0, "x"), (506, rows[0][1], 0, "x"), (507, [None] + [1.0] * 15, 1, "x"), (508, [1.0, 2.0], 1, "x"), (509, [2.0, 4.0], 1, "x"),
             (510, [float("inf")] + [1.0] * 15, 1, "x")]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, m string")
    got = tuples(embed_dedup.near_vectors(v, block=40))
    assert got == brute.embeddings([r[:3] for r in rows])
    assert embed_dedup.near_vectors(v.limit(0)).collect() == []
    nulls = embed_dedup.near_vectors(spark.createDataFrame([(None, rows[0][1], 1), (None, rows[0][1], 1)], "vec_id long, embedding array<float>, label int")).collect()
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in nulls] == [(0, None, True)] * 2


def test_multi_sequence_order():
    rng = np.random.default_rng(0)
    a, b = rng.random(6), rng.random(5)
    order = sorted(range(30), key=lambda c: a[c // 5] + b[c % 5])
    assert embed_dedup.multi_sequence(a, b, 30) == order and embed_dedup.multi_sequence(a, b, 7) == order[:7]


# ------------------------------------------------------------------ 7
def test_license_scan(spark):
    rows = [(1, "a/b/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.txt", "plain text\nof nothing"), (3, "a/y.txt", None),
            (4, "a/b/z.txt", "words here\nLicensed under the Apache License, Version 2.0.\n" + "more words " * 30), (5, None, "nothing"),
            (6, "a/b/c/d/COPYING", "This work is licensed under the GNU General Public License, version 3."), (7, "a/b/c/d/e/f.txt", ""), (8, "top", "x")]
    docs = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, path string, text string, dir string")
    got = {r["doc_id"]: tuple(r[1:]) for r in license_scan.scan_licenses(docs).collect()}
    assert got == {1: ("MIT", "file", None), 2: ("MIT", "inherited", "a/b"), 3: (None, None, None), 4: ("Apache-2.0", "header", None), 5: (None, None, None),
                   6: ("GPL-3.0", "file", None), 7: ("GPL-3.0", "inherited", "a/b/c/d"), 8: (None, None, None)}
    assert license_scan.scan_licenses(docs.limit(0)).collect() == []


def test_license_cosine_equals_plain_arithmetic():
    df = {"": 100, "license": 3, "the": 80}
    m = license_scan.Matcher(df)
    line = license_scan.terms(b"Released under the MIT License today")
    idf = lambda t: np.log(101 / (df.get(t, 0) + 1)) + 1 if t.encode() in license_scan._VOCAB else np.log(101 / 2) + 1
    mine = {t.decode(): line.count(t) * idf(t.decode()) for t in line}
    other = {t: license_scan.TEMPLATES["MIT"].split().count(t) * idf(t) for t in license_scan.TEMPLATES["MIT"].split()}
    cos = sum(mine.get(t, 0) * x for t, x in other.items()) / np.sqrt(sum(x * x for x in mine.values()) * sum(x * x for x in other.values()))
    got, name = m.best(line)
    assert name == "MIT" and got == pytest.approx(cos)


# ------------------------------------------------------------------ 8
def test_warc_round_trip(spark, tmp_path):
    big = "<p>ü" * 5000
    rows = [(5, "u", big), (3, "u\r\nx", big), (9, None, big), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (7, "u", "WARC/1.1\r\n\r\n" * 30),
            (3, "u", big), (None, "u", big), (None, "u", "y" * 120)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    warc.write_archives(pages, str(tmp_path / "w"), segment_bytes=3000, chunk_bytes=700, records_per_file=4)
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        ref = 3 if h == big and i != 3 else None
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if ref else "response", ref))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    warc.write_archives(pages.limit(0), str(tmp_path / "e"))
    assert warc.read_archives(spark, str(tmp_path / "e")).collect() == []


def test_warc_damage_is_an_error():
    import pyarrow as pa
    payload = b"0123456789" * 50
    recs = warc.records(1, 0, "u", payload, hashlib.sha256(payload).hexdigest(), None, 200, 64)
    stream = io.BytesIO(b"".join(r + b"\r\n\r\n" for r in recs))
    segs = [(int(h[b"warc-segment-number"]), h.get(b"warc-segment-total-length"), b) for h, b in warc.parse(stream)]
    assert [s[0] for s in segs] == list(range(1, len(recs) + 1))

    def table(rows):
        return pa.table({"origin": ["o"] * len(rows), "page_id": pa.array([1] * len(rows), pa.int64()), "segment": [s for s, _, _ in rows],
                         "total_length": pa.array([int(t) if t else None for _, t, _ in rows], pa.int64()), "block": [b for _, _, b in rows]})
    assert warc._reassemble(table(segs[::-1]))["payload_digest"][0].as_py() == hashlib.sha256(payload).hexdigest()
    for bad in (segs[:-1], segs[1:], segs[:1] + segs[2:], [*segs[:-1], (segs[-1][0], segs[-1][1], b"x")]):
        with pytest.raises(warc.WarcError):
            warc._reassemble(table(bad))
    assert warc.unchunk(warc.chunked(b"", 5)) == b"" and warc.unchunk(b"3;e=1\r\nabc\r\n0\r\n\r\n") == b"abc"


# ------------------------------------------------------------------ 9
def test_minhash_equals_brute_force(spark, documents):
    assert tuples(minhash.near_duplicates(documents)) == brute.near(texts_of(documents))


def test_minhash_chains_and_dense_groups(spark):
    rng = np.random.default_rng(8)
    vocab = [f"w{i}" for i in range(5000)]
    base = list(rng.choice(vocab, 150))
    texts = []
    for i in range(160):                                  # one text, changed more and more: links and near misses
        w = list(base)
        for p in rng.choice(150, i % 9, replace=False):
            w[p] = f"n{i}x{p}"
        texts.append(" ".join(w))
    walk = list(rng.choice(vocab, 120))
    for i in range(30):                                   # a chain whose ends do not link
        walk[(4 * i) % 120] = f"s{i}"
        texts.append(" ".join(walk))
    texts += ODD + ["a b c d", "A  B\tc\nd"]
    got = tuples(minhash.near_duplicates(frame(spark, texts), block=25))
    assert got == brute.near(list(enumerate(texts)))
    assert tuples(minhash.near_duplicates(frame(spark, texts), block=25, pivot_rounds=0)) == got


def test_minhash_odd_tables(spark):
    assert minhash.near_duplicates(frame(spark, [])).collect() == []
    rows = minhash.near_duplicates(frame(spark, ["a b", "a b", "a b"], [4, 4, None])).collect()
    assert sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in rows) == [("4", 4, True), ("4", 4, True), ("None", None, True)]


# ------------------------------------------------------------------ 10
def line_brute(docs, size=3):
    seen, drops, lines = set(), defaultdict(set), {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        lines[d] = (t or "").split("\n")
        idx = [i for i, l in enumerate(lines[d]) if l.strip(" \t\x0b\f\r")]
        for k in range(len(idx) - size + 1):
            w = tuple(lines[d][i] for i in idx[k:k + size])
            if w in seen:
                drops[d].update(idx[k:k + size])
            seen.add(w)
    return sorted((d, sum(bool(l.strip(" \t\x0b\f\r")) for l in ls), len(drops[d]), "\n".join(l for i, l in enumerate(ls) if i not in drops[d])) for d, ls in lines.items())


def test_line_dedup_equals_brute_force(spark, documents):
    rng = np.random.default_rng(3)
    texts = ["\n".join(rng.choice(["a", "b", "", " \t", "c"], 12)) for _ in range(60)] + ODD[1:]
    for docs in (documents, frame(spark, texts)):
        got = tuples(line_dedup.line_dedup(docs).select("doc_id", "n_lines", "n_removed", "text"))
        assert got == line_brute(texts_of(docs))


def test_line_dedup_odd_rows(spark):
    df = line_dedup.line_dedup(frame(spark, [None, "a\nb\nc", "a\nb\nc", "a\nb\nc"], [1, 5, 5, None]))
    assert {"copies", "block", "key", "spans"} <= set(df.columns)
    got = sorted((str(r["doc_id"]), r["n_lines"], r["n_removed"], r["text"]) for r in df.collect())
    assert got == [("1", 0, 0, None), ("5", 3, 0, "a\nb\nc"), ("5", 3, 0, "a\nb\nc"), ("None", 3, 3, "")]
    assert line_dedup.line_dedup(frame(spark, [])).collect() == []


# ------------------------------------------------------------------ rows that share an id, paths, bounds
def test_warc_pages_that_share_an_id(spark, tmp_path):
    rows = [(1, "A" * 200), (1, "B" * 300), (2, "A" * 200), (3, "B" * 300), (3, "A" * 200), (4, "C" * 50), (4, "C" * 50), (None, "B" * 300)]
    pages = spark.createDataFrame([(i, f"http://x/{i}", h) for i, h in rows], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, h in rows:
        first = min(j for j, g in rows if g == h and j is not None)
        again = len(h) >= 100 and i != first
        want.append((i, len(h), sha(h), "revisit" if again else "response", first if again else None))
    got = warc.read_archives(spark, str(tmp_path / "w")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def inherited_brute(own):
    """own: (path, license, cosine, is_file).  (path, license, dir) of the paths without a licence of their own."""
    def folder(p):
        steps = [s for s in p.split("/") if s]
        return ("/" if p.startswith("/") else "", tuple(steps if p.endswith("/") else steps[:-1]))
    best = {}
    for p, lic, cos, is_file in own:
        if is_file:
            best[folder(p)] = min(best.get(folder(p), (0, "~", None)), (-round(cos, 9), p, lic))
    out = {}
    for p, lic, _, _ in own:
        if lic is None:
            root, steps = folder(p)
            at = next(((root, steps[:n]) for n in range(len(steps), -1, -1) if (root, steps[:n]) in best), None)
            out[p] = (best[at][2], root + "/".join(at[1])) if at else (None, None)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_licences_are_inherited_from_the_nearest_folder(spark, seed):
    import random
    rng = random.Random(seed)
    mit, apache = "Released under the MIT license.", "Licensed under the Apache License, Version 2.0."
    paths = set()
    while len(paths) < 120:
        paths.add(rng.choice(["", "/", "//"]) + "/".join(rng.choice("abc") for _ in range(rng.randrange(4))).replace("a/b", "a//b") + rng.choice(["/", ""]) + rng.choice(
            ["LICENSE", "x.py", "COPYING", "y/"]))
    rows = [(i, p, rng.choice([mit, apache]) if "x.py" not in p and "y/" not in p and rng.random() < 0.5 else "nothing here at all") for i, p in enumerate(sorted(paths))]
    docs = spark.createDataFrame(rows, "doc_id long, path string, text string")
    own = {r["path"]: r for r in license_scan.own_licenses(docs).collect()}
    is_file = lambda p: own[p]["license"] is not None
    want = inherited_brute([(p, own[p]["license"], own[p]["cosine"], is_file(p)) for _, p, _ in rows])
    got = {rows[r["doc_id"]][1]: (r["license"], r["license_dir"]) for r in license_scan.scan_licenses(docs).collect()}
    assert sum(v[0] is not None for v in want.values()) > 10
    assert {p: got[p] for p in want} == want


def test_toxicity_sample_is_bounded_in_rows(spark):
    rows = [(1, f"good words number {i}", 0) for i in range(300)] + [(2, "bad words", 1)] * 300 + [(2, f"bad words {i}", 1) for i in range(40)]
    rows = [(i + (0 if zlib.crc32(str(i).encode()) % 5 else 10), t, y) for i, t, y in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", "toxic").distinct()
    model = toxicity.fit(docs, labels, sample_docs=10)
    assert isinstance(model, toxicity.Model)
    assert len(model.vocab) < 60        # ten rows a class, not all that share the drawn ids
    assert toxicity.fit(docs, labels.filter("toxic = 1")) == 1.0
    assert toxicity.fit(docs.limit(0), labels) == 0.0
