"""Toxicity scores from a bidirectional GRU with attention pooling (operator 3).

Each word enters the network as a learned word vector (words the training
sample holds often enough, one vector for all others) beside a character vector
(the mean of learned vectors of all the word's hashed byte 3- to 5-grams, with
word bounds).  A run of word bytes longer than ``LONG`` (text without spaces,
glued words) enters as consecutive pieces of ``PIECE`` bytes, each a word of its
own; pieces share ``LAP`` bytes, so that every n-gram of the run lies in one of
them.  GRUs read a window of ``WINDOW`` words in both directions; attention
over their states gives one vector, a linear layer the window's logit.  A
document's score is the sigmoid of its highest window; windows overlap by half
and cover every word.

Training is in numpy, by Adam on back-propagated gradients, in one task.  It uses
a bounded sample of labelled rows (``sample_docs`` rows and ``class_bytes`` of
text per class at most, texts of at most ``sample_bytes``; smallest hashes first;
a repeated row counts once).  The label belongs to the document, so
each epoch first scores all windows and then learns from each document's highest
one.  The first coordinate of word and n-gram vectors starts as the smoothed
log-odds of the sample.

Rows whose crc32(doc_id as text) mod 5 is 0 are held out.  Scores see text only.

Defined cases: null or empty text, or text without words, is scored as a window
of no states (the bias alone); a null label is no label; a doc_id labelled more
than once counts each label; null doc_id is never trained on and counts as
held_out false; without labels of both classes all scores are the share of toxic
labels; extra columns are ignored; empty table, no rows.
"""
from __future__ import annotations


import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from transitlens.llm.common import Scratch, hand_back, mix64, pieces, text_buffers, texts
from transitlens.llm.decontam import _FOLD

WINDOW, STRIDE = 64, 32
D, H, A = 8, 8, 8                  # width of word and character vectors, states per direction, attention
BUCKETS = 16384
GATES = 3 * H
LONG, PIECE, LAP = 40, 16, 4       # longest run taken as one word; bytes of a piece of a longer one, and those it shares with the next
STRETCH = 1 << 16                  # words of a document that are scored at a time
U64 = np.uint64


def _dealt(words: list[bytes]) -> list[bytes]:
    """The words, runs longer than LONG as overlapping pieces."""
    if max(map(len, words), default=0) <= LONG:
        return words
    out = []
    for w in words:
        if len(w) <= LONG:
            out.append(w)
        else:
            out += [w[i:i + PIECE] for i in range(0, len(w) - LAP, PIECE - LAP)]
    return out


def words_of(text: bytes) -> list[bytes]:
    return _dealt(text.translate(_FOLD).split())


def _stretches(words: list[bytes]) -> list[list[bytes]]:
    """Stretches of a document that have the same windows together as the whole."""
    out, lo = [], 0
    while len(words) - lo >= STRETCH + WINDOW:
        out.append(words[lo:lo + STRETCH + WINDOW - STRIDE])
        lo += STRETCH
    return [*out, words[lo:]] if out else [words]


def ngrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, owner) of the byte n-grams of each word, bounds included."""
    raw = np.frombuffer(b"".join([b"<" + w + b">" for w in words]), np.uint8).astype(U64)
    size = np.array([len(w) + 2 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(raw))      # bytes up to the end of the word
    out, who = [], []
    h = raw.copy()
    for n in range(2, 6):
        h = h[:-1] * U64(0x100000001B3) + raw[n - 1:] if len(raw) >= n else h[:0]
        if n >= 3:
            ok = left[:len(h)] >= n
            out.append(mix64(h[ok] * U64(n)) % U64(BUCKETS))
            who.append(owner[:len(h)][ok])
    return np.concatenate(out).astype(np.int64), np.concatenate(who)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


class Model:
    """Parameters and passes. ``p`` maps names to float32 arrays."""

    def __init__(self, vocab: dict[bytes, int], word: np.ndarray, gram: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        r = lambda *s, k=0.3: rng.normal(0, k, s).astype(np.float32)
        self.vocab = vocab
        self.p = {"word": word.astype(np.float32), "gram": gram.astype(np.float32),
                  "att": r(2 * H, A), "att_v": r(A), "out": r(2 * H), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"in_{d}": r(2 * D, GATES), f"rec_{d}": r(H, GATES), f"b_{d}": np.zeros(GATES, np.float32)}

    # -- inputs
    def inputs(self, words: list[bytes], hidden: np.ndarray | None = None):
        """(vectors, word rows, n-gram buckets, owners, weights) of distinct words; ``hidden`` ones pass as unknown."""
        rows = np.array([self.vocab.get(w, 0) for w in words], np.int64)
        if hidden is not None:
            rows[hidden] = 0
        bucket, owner = ngrams(words)
        weight = (1 / np.maximum(np.bincount(owner, minlength=len(words)), 1)).astype(np.float32)
        chars = np.stack([np.bincount(owner, self.p["gram"][bucket, k], len(words)) for k in range(D)], 1).astype(np.float32) * weight[:, None]
        return np.concatenate((self.p["word"][rows], chars), 1), rows, bucket, owner, weight

    # -- one direction: steps go over axis 1 of idx (windows x words), -1 never read
    def _gru(self, proj: np.ndarray, idx: np.ndarray, rec: np.ndarray, keep: bool):
        n, t = idx.shape
        h = np.zeros((n, H), np.float32)
        states, saved = np.empty((t, n, H), np.float32), []
        rz, rc = np.ascontiguousarray(rec[:, :2 * H]), np.ascontiguousarray(rec[:, 2 * H:])
        for s in range(t):
            x = proj[idx[:, s]]
            g = _sigmoid(x[:, :2 * H] + h @ rz)
            z, q = g[:, :H], g[:, H:]
            c = np.tanh(x[:, 2 * H:] + (q * h) @ rc)
            if keep:
                saved.append((h, z, q, c))
            h = h + z * (c - h)
            states[s] = h
        return states, saved

    def _gru_back(self, grad: np.ndarray, saved, rec: np.ndarray):
        """Gradients of the projected inputs (steps x windows x gates) and of the recurrent matrix."""
        t, n, _ = grad.shape
        d_in, d_rec, dh = np.empty((t, n, GATES), np.float32), np.zeros_like(rec), np.zeros((n, H), np.float32)
        for s in range(t - 1, -1, -1):
            h, z, q, c = saved[s]
            dh = dh + grad[s]
            dc = dh * z * (1 - c * c)
            dz = dh * (c - h) * z * (1 - z)
            dqh = dc @ rec[:, 2 * H:].T
            dq = dqh * h * q * (1 - q)
            d_in[s] = np.concatenate((dz, dq, dc), 1)
            d_rec[:, :2 * H] += h.T @ d_in[s][:, :2 * H]
            d_rec[:, 2 * H:] += (q * h).T @ dc
            dh = dh * (1 - z) + dqh * q + d_in[s][:, :2 * H] @ rec[:, :2 * H].T
        return d_in, d_rec

    def logits(self, table: np.ndarray | tuple, idx: np.ndarray, size: np.ndarray, keep: bool = False):
        """Window logits. ``table``: input vectors, or their projections for both directions;
        idx: windows x words, rows of the table; size: words in each window."""
        p = self.p
        proj = table if isinstance(table, tuple) else (table @ p["in_f"] + p["b_f"], table @ p["in_b"] + p["b_b"])
        n, t = idx.shape
        at = np.arange(t)[None]
        turn = np.clip(size[:, None] - 1 - at, 0, t - 1)                 # the same words, last first
        back_idx = np.take_along_axis(idx, turn, 1)
        f, saved_f = self._gru(proj[0], idx, p["rec_f"], keep)
        b, saved_b = self._gru(proj[1], back_idx, p["rec_b"], keep)
        rows = np.arange(n)[:, None]
        states = np.concatenate((f.transpose(1, 0, 2), b[turn, rows]), 2)
        u = np.tanh(states @ p["att"])
        e = np.where(at < size[:, None], u @ p["att_v"], np.float32(-1e9))
        e = np.exp(e - e.max(1, keepdims=True))
        a = e / e.sum(1, keepdims=True)
        ctx = (a[:, None] @ states)[:, 0]
        out = ctx @ p["out"] + p["bias"][0]
        return (out, (idx, back_idx, turn, rows, saved_f, saved_b, states, u, a, ctx)) if keep else out

    def gradients(self, words: list[bytes], idx: np.ndarray, size: np.ndarray, y: np.ndarray, weight: np.ndarray, hidden: np.ndarray | None = None):
        """(loss, gradients) of weighted cross-entropy."""
        p = self.p
        x, rows, bucket, owner, inv = self.inputs(words, hidden)
        out, (idx, back_idx, turn, at, sf, sb, states, u, a, ctx) = self.logits(x, idx, size, keep=True)
        prob = _sigmoid(out)
        loss = float((weight * (np.logaddexp(0, out) - y * out)).sum())
        d = (weight * (prob - y)).astype(np.float32)
        g = {"bias": np.array([d.sum()], np.float32), "out": ctx.T @ d}
        dctx = d[:, None] * p["out"][None]
        ds = a[:, :, None] * dctx[:, None]
        da = (states @ dctx[:, :, None])[:, :, 0]
        de = a * (da - (a * da).sum(1, keepdims=True))
        g["att_v"] = np.einsum("nt,nta->a", de, u)
        du = de[:, :, None] * p["att_v"] * (1 - u * u)
        g["att"] = np.einsum("nth,nta->ha", states, du)
        ds += du @ p["att"].T
        dx = np.zeros_like(x)
        grad_b = np.zeros((turn.shape[1], turn.shape[0], H), np.float32)
        np.add.at(grad_b, (turn, at), ds[:, :, H:])
        for d_, ix, saved, grad in (("f", idx, sf, ds[:, :, :H].transpose(1, 0, 2)), ("b", back_idx, sb, grad_b)):
            d_in, g[f"rec_{d_}"] = self._gru_back(np.ascontiguousarray(grad), saved, p[f"rec_{d_}"])
            flat, where = d_in.reshape(-1, GATES), ix.T.ravel()
            g[f"b_{d_}"] = flat.sum(0)
            per = np.stack([np.bincount(where, flat[:, k], len(x)) for k in range(GATES)], 1).astype(np.float32)
            g[f"in_{d_}"] = x.T @ per
            dx += per @ p[f"in_{d_}"].T
        g["word"] = np.stack([np.bincount(rows, dx[:, k], len(p["word"])) for k in range(D)], 1).astype(np.float32)
        dc = dx[:, D:] * inv[:, None]
        g["gram"] = np.stack([np.bincount(bucket, dc[owner, k], BUCKETS) for k in range(D)], 1).astype(np.float32)
        return loss, g


def windows_of(n: int) -> list[tuple[int, int]]:
    """(start, size) of windows that overlap by half and cover n words."""
    if n <= WINDOW:
        return [(0, n)] if n else []
    starts = list(range(0, n - WINDOW, STRIDE)) + [n - WINDOW]
    return [(s, WINDOW) for s in starts]


def _grid(docs: list[np.ndarray]):
    """(idx, size, doc) of all windows of documents given as arrays of word rows."""
    starts, size, doc, base = [], [], [], 0
    for i, d in enumerate(docs):
        for s, n in windows_of(len(d)):
            starts.append(base + s)
            size.append(n)
            doc.append(i)
        base += len(d)
    if not starts:
        return np.zeros((0, 1), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat, size = np.concatenate(docs).astype(np.int32), np.array(size)
    at = np.array(starts, np.int32)[:, None] + np.minimum(np.arange(size.max())[None], size[:, None] - 1).astype(np.int32)
    return flat[at], size, np.array(doc)


def _highest(logit: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Index of each document's highest window (-1: none)."""
    best = np.full(n, -1)
    order = np.argsort(logit, kind="stable")
    best[doc[order]] = order
    return best


def _log_odds(pos: np.ndarray, seen: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smoothed log-odds of features that ``seen`` documents hold, ``pos`` of them positive."""
    return np.log((pos + 0.5) / (y.sum() + 1)) - np.log((seen - pos + 0.5) / ((1 - y).sum() + 1))


def train(docs: list[bytes], y: np.ndarray, epochs: int = 10, batch: int = 96, most_words: int = 20_000, least_docs: int = 3,
          word_dropout: float = 0.0, seed: int = 11) -> Model:
    number: dict[bytes, int] = {}
    rows = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int32) for t in docs]
    names = list(number)
    seen, pos = np.zeros(len(names), np.int64), np.zeros(len(names))
    gram_n, gram_pos = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r, label in zip(rows, y):
        own = np.unique(r)
        if len(own):
            seen[own] += 1
            pos[own] += label
            b = np.unique(ngrams([names[i] for i in own])[0])
            gram_n[b] += 1
            gram_pos[b] += label
    kept = sorted((w for w, n in zip(names, seen.tolist()) if n >= least_docs), key=lambda w: (-seen[number[w]], w))[:most_words]
    vocab = {w: i + 1 for i, w in enumerate(kept)}
    rng = np.random.default_rng(seed)
    word = rng.normal(0, 0.1, (len(vocab) + 1, D))
    gram = rng.normal(0, 0.1, (BUCKETS, D))
    at = np.array([number[w] for w in kept], np.int64)
    word[1:, 0] = 0.5 * _log_odds(pos[at], seen[at], y)
    word[0, 0] = 0
    gram[:, 0] = 0.5 * _log_odds(gram_pos, gram_n, y)
    model = Model(vocab, word, gram, seed)
    idx, size, doc = _grid(rows)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    step, share = 0, np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    table = lambda: np.concatenate([model.inputs(names[i:i + 20_000])[0] for i in range(0, len(names), 20_000)] or [np.zeros((0, 2 * D), np.float32)])
    for epoch in range(epochs):
        x = table()
        if epoch == 0:      # before the network has learnt, the window with the most telling words
            first_two, logit = x[:, 0] + x[:, D], np.empty(len(idx))
            for i in range(0, len(idx), 8192):
                known = np.where(np.arange(idx.shape[1])[None] < size[i:i + 8192, None], first_two[idx[i:i + 8192]], 0)
                logit[i:i + 8192] = np.sort(known, axis=1)[:, -3:].sum(1)
        else:
            logit = np.concatenate([model.logits(x, idx[i:i + 1024], size[i:i + 1024]) for i in range(0, len(idx), 1024)])
        best = _highest(logit, doc, len(docs))
        have = np.flatnonzero(best >= 0)
        rng.shuffle(have)
        for lo in range(0, len(have), batch):
            d = have[lo:lo + batch]
            w = best[d]
            used, local = np.unique(idx[w], return_inverse=True)
            weight = (share[d] * len(docs) / len(d)).astype(np.float32)
            hidden = rng.random(len(used)) < word_dropout
            _, g = model.gradients([names[i] for i in used], local.reshape(idx[w].shape), size[w], y[d].astype(np.float32), weight, hidden)
            step += 1
            rate = 0.01 * min(1, 2 * (1 - epoch / epochs)) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            for k, v in g.items():
                v = v / max(1.0, norm / 5)
                first[k] += np.float32(0.1) * (v - first[k])
                second[k] += np.float32(0.001) * (v * v - second[k])
                model.p[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return model


class Scorer:
    """Scores texts; keeps the projected inputs of a bounded number of words it has met."""

    def __init__(self, model: Model, most_words: int = 150_000):
        self.model, self.most = model, most_words
        self._reset()

    def _reset(self) -> None:
        self.no: dict[bytes, int] = {}
        self.f, self.b = np.zeros((1 << 14, GATES), np.float32), np.zeros((1 << 14, GATES), np.float32)

    def _learn(self, words: list[bytes]) -> None:
        p = self.model.p
        for lo in range(0, len(words), 20_000):
            part = words[lo:lo + 20_000]
            x = self.model.inputs(part)[0]
            base = len(self.no)
            while base + len(part) > len(self.f):
                self.f, self.b = np.resize(self.f, (2 * len(self.f), GATES)), np.resize(self.b, (2 * len(self.b), GATES))
            self.f[base:base + len(part)] = x @ p["in_f"] + p["b_f"]
            self.b[base:base + len(part)] = x @ p["in_b"] + p["b_b"]
            self.no.update(zip(part, range(base, base + len(part))))

    def __call__(self, docs: list[list[bytes]]) -> np.ndarray:
        best = np.full(len(docs), -np.inf)
        part, held = [], 0                  # stretches (document, words) of a bounded number of words
        for i, d in enumerate(docs):
            for s in _stretches(d):
                if held + len(s) > 8 * STRETCH and part:
                    self._raise(best, part)
                    part, held = [], 0
                part.append((i, s))
                held += len(s)
        if part:
            self._raise(best, part)
        best[np.isneginf(best)] = self.model.p["bias"][0]
        return 1 / (1 + np.exp(-best))

    def _raise(self, best: np.ndarray, part: list[tuple[int, list[bytes]]]) -> None:
        """Raise ``best`` to the highest window logit of each document's stretches."""
        owner, docs = np.array([i for i, _ in part]), [s for _, s in part]
        new = set().union(*docs).difference(self.no)
        if len(self.no) + len(new) > self.most:
            self._reset()
            new = set().union(*docs)
        if new:
            self._learn(sorted(new))
        rows = [np.fromiter(map(self.no.__getitem__, d), np.int64, len(d)) for d in docs]
        idx, size, doc = _grid(rows)
        for lo in range(0, len(idx), 512):
            at = slice(lo, lo + 512)
            np.maximum.at(best, owner[doc[at]], self.model.logits((self.f, self.b), idx[at], size[at]).astype(np.float64))


def _scores(scorer: Scorer | None, prior, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    if scorer is None:
        return np.full(len(off) - 1, float(prior))
    body = raw.tobytes().translate(_FOLD)
    return scorer([_dealt(body[a:b].split()) for a, b in zip(off[:-1].tolist(), off[1:].tolist())])


def _score(shared):
    def score(batches):
        scorer = Scorer(shared.value) if isinstance(shared.value, Model) else None
        for batch in pieces(batches, 1):
            raw, off = text_buffers(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(_scores(scorer, shared.value, raw, off), pa.float64())],
                                             names=["doc_id", "score"])
        hand_back()
    return score


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _trained(batches):
    """The pickled model of the sample's rows (toxic, text), all in this task."""
    y, body = [], []
    for batch in batches:
        y += batch.column(0).to_pylist()
        body += texts(batch.column(1))
    y = np.array(y, np.float64)
    if not len(y) or y.min() == y.max():
        model: Model | float = float(y.mean()) if len(y) else 0.0
    else:
        model = train(body, y)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])
    del model, body
    hand_back()


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = 2000, sample_bytes: int = 65_536, class_bytes: int = 32 << 20) -> Model | float:
    """Train, in one task, on the bounded sample: ``sample_docs`` rows of each class and ``class_bytes`` of their text
    at most.  Without both classes: the share of toxic labels."""
    spark = docs.sparkSession
    marked = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1) and doc_id is not null")
    marked = marked.filter(~held_out()).distinct()
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter(F.octet_length("text").between(1, sample_bytes))
    rows = rows.withColumn("h", F.xxhash64("text"))
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("h")]
    # numbers only, and a row once however often it is repeated: texts follow for the sample alone
    known = rows.groupBy("doc_id", "h").agg(F.max(F.octet_length("text")).alias("size")).join(marked, "doc_id")
    pick = [known.filter(F.col("toxic") == k).orderBy(*order).limit(sample_docs) for k in (0, 1)]
    some = (pick[0].unionByName(pick[1]).withColumn("sum", F.sum("size").over(Window.partitionBy("toxic").orderBy(*order)))
            .filter(F.col("sum") <= class_bytes).select("doc_id", "h", "toxic"))
    sample = rows.join(F.broadcast(some), ["doc_id", "h"]).dropDuplicates(["doc_id", "h", "toxic"])
    one = sample.repartition(1).sortWithinPartitions("toxic", F.xxhash64("doc_id"), "text").select("toxic", "text")
    path = Scratch(spark, "toxicity-model")
    found = path.write(one.mapInArrow(_trained, "model binary"), "model").first()         # written: trained once
    return pickle.loads(found["model"]) if found else 0.0


def toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = 2000, sample_bytes: int = 65_536) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row per document."""
    model = fit(docs, labels, sample_docs, sample_bytes)
    return score_with(docs, model)


def score_with(docs: DataFrame, model: Model | float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_score(shared), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _keep(shared):
    def keep(batches):
        scorer = Scorer(shared.value) if isinstance(shared.value, Model) else None
        for batch in pieces(batches, "text"):
            raw, off = text_buffers(batch.column(batch.schema.get_field_index("text")))
            yield batch.filter(pa.array(_scores(scorer, shared.value, raw, off) < 0.5))
        hand_back()
    return keep


def keep_clean(docs: DataFrame, model: Model | float) -> DataFrame:
    """The rows (all columns) whose score is below 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_keep(shared), docs.schema)
