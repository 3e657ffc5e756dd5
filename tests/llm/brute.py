"""Plain-Python answers on small inputs, written from the contracts."""
import hashlib
import re
from collections import defaultdict


def suffix(rows, window=100):
    """rows: (doc_id, bytes). One result per row: doc_id, n_bytes, n_removed, n_spans, sha256."""
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    first, out = {}, {}
    for i in order:
        t = rows[i][1]
        gone = bytearray(len(t))
        for p in range(len(t) - window + 1):
            w = t[p:p + window]
            if first.setdefault(w, (i, p)) != (i, p):
                gone[p:p + window] = b"\1" * window
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out[i] = (rows[i][0], len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(out.values())


WORDS2 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words2(text):
    return WORDS2.findall((text or "").translate(LOWER))


def decontam(docs, items, window=13):
    wins = defaultdict(set)
    for k, t in items:
        w = words2(t)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins[tuple(w[i:i + window])].add(str(k))
    sizes = sorted({len(w) for w in wins})
    out = []
    for d, t in docs:
        w = words2(t)
        hit, found = set(), set()
        for s in sizes:
            for i in range(len(w) - s + 1):
                f = wins.get(tuple(w[i:i + s]))
                if f:
                    found |= f
                    hit.update(range(i, i + s))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def near(docs, percent=75):
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}
    at = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            at[x].append(d)
    for d, s in sets.items():
        common = defaultdict(int)
        for x in s:
            for o in at[x]:
                if o < d:
                    common[o] += 1
        for o, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[o]) - n):
                a, b = find(parent, d), find(parent, o)
                parent[max(a, b)] = min(a, b)
    return sorted((d, len(s), find(parent, d), find(parent, d) == d) for d, s in sets.items())


def embeddings(rows, least=0.93):
    """rows: (vec_id, vector or None, label). Double-precision cosine, all pairs of a label."""
    import numpy as np
    links = {r[0]: set() for r in rows}
    by = defaultdict(list)
    for i, v, l in rows:
        if l is None or v is None or any(x is None for x in v):
            continue
        a = np.array(v, float)
        if len(a) and np.isfinite(a).all() and a.any():
            by[l, len(a)].append((i, a / np.sqrt((a * a).sum())))
    for vs in by.values():
        ids, m = [i for i, _ in vs], np.array([a for _, a in vs])
        for x, y in zip(*np.nonzero(m @ m.T >= least - 1e-12)):
            if x != y:
                links[ids[x]].add(ids[y])
    parent = {i: i for i in links}
    for i, ls in links.items():
        for j in ls:
            a, b = find(parent, i), find(parent, j)
            parent[max(a, b)] = min(a, b)
    return sorted((i, len(ls), find(parent, i), find(parent, i) == i) for i, ls in links.items())
