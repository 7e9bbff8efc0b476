"""Plain versions of the operators over lists of (doc_id, text), written from their contracts."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import regex
import xxhash


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def bits(hashes):
    if not hashes:
        return 0
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def simhash(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    return bits([xxhash.xxh64_intdigest(s, seed=42) for s in shingles])


def components(rows):
    """[(doc_id, fingerprint, least reachable id)] in the order of rows."""
    fps = [simhash(t) for _, t in rows]
    s = Sets()
    for i, a in enumerate(fps):
        s.find(i)
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 3:
                s.join(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = s.find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, format(f, "016x"), least.get(s.find(i))) for i, ((d, _), f) in enumerate(zip(rows, fps))]


def repeated(rows, size=100):
    """{doc_id: (bytes, removed, spans, sha256, kept)} for distinct ids."""
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - size + 1):
            w = b[p:p + size]
            if w in seen:
                gone[p:p + size] = True
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if len(b) else 0
        out[d] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def normalised(line):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", line.lower()) if w]


def gone_lines(rows):
    """{(doc_id, position)} that fuzzy line dedup removes."""
    places = {}
    for d, t in rows:
        for p, line in enumerate((t or "").split("\n")):
            if w := normalised(line):
                places.setdefault(" ".join(w), set()).add((d is None, d, p))
    names = sorted(places)
    fps = [bits([xxhash.xxh64_intdigest(w.encode(), seed=42) for w in set(n.split(" "))]) for n in names]
    s = Sets()
    for i, a in enumerate(names):
        s.find(i)
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                far = int(np.floor(0.2 * max(len(a), len(names[j])) + 1e-9))
                if abs(len(a) - len(names[j])) <= far and distance(a, names[j]) <= far:
                    s.join(i, j)
    groups = {}
    for i, n in enumerate(names):
        groups.setdefault(s.find(i), set()).update(places[n])
    return {(d, p) for g in groups.values() for (_, d, p) in g - {min(g)}}


def without(text, gone):
    return "\n".join(x for p, x in enumerate(text.split("\n")) if p not in gone)


def rule_counts(text):
    words = regex.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    cover = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if regex.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(regex.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(cover))


def top(rows, k=10, step=100):
    """[(query, rank, id, score)] over (id, vector) rows."""
    usable = [(i, [int(np.floor(1024 * np.float64(x))) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in {i: v for i, v in usable if i % step == 0}.items():
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)
