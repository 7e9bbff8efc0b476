"""Toxicity: a support vector machine on a subsequence string kernel, with Nystrom landmarks.

The kernel compares words by the subsequences of `GRAM` characters that they share, found within `SPAN`
characters and damped by `DECAY` for every character skipped; so `id*iot`, `i-d-i-o-t` and `idiiot` stay close
to `idiot`. Words carry marks at both ends; single characters in a row ("i d i o t") are read as one word. A
sentence is the sum of its words, its kernel with another the sum over pairs of words. The kernel with each
landmark word gives the Nystrom map, on which a linear support vector machine is trained over labelled
sentences. Only documents are labelled, so training starts with every sentence of a toxic document as
positive and then keeps those that it finds most toxic.

As the map is linear in the subsequences, the trained machine folds into one weight per subsequence, and a
word's score is a sum of table look-ups. A logistic layer over a document's highest word scores gives the
score from 0 to 1.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.llm import common, folds
from wearline.session import stored

GRAM, SPAN, DECAY = 4, 7, 0.7
#: Size of the character alphabet; 0 pads.
ALPHABET = 40
EDGE_CODES = (27, 28)
#: Landmark words: those most typical of toxic documents, and frequent others.
TOXIC_LANDMARKS, OTHER_LANDMARKS = 320, 60
#: Bounds of the sample that the machine is fitted on.
FIT_PER_CLASS, FIT_SENTENCES = 2000, 30
#: Scores of a document that the logistic layer sees.
TOP = 4
#: Words whose score a worker remembers before it starts afresh.
REMEMBERED = 400_000

PATTERNS = [(0, *p) for p in combinations(range(1, SPAN), GRAM - 1)]
_SPACED = re.compile(r"(?<!\S)(?:\S ){2,}\S(?!\S)")
_EDGES = ".,;:!?\"'()[]{}*%$#&|<>-_~+=/\\"
_SIGNS = {ord(c): None for c in _EDGES}


def words_of(text: str) -> list[str]:
    """Lower-cased words; single characters in a row become one word."""
    text = text.lower()
    if _SPACED.search(text):
        text = _SPACED.sub(lambda m: m[0].replace(" ", ""), text)
    return text.split()


def _codes(words: list[str]) -> np.ndarray:
    """[word, position] character codes with edge marks, padded with zeros; signs inside a word are left out."""
    marked = ["\x01" + (w.translate(_SIGNS) or w) + "\x02" for w in words]
    width = max(map(len, marked))
    points = np.array(marked, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)
    letter = (points >= 97) & (points <= 122)
    out = np.where(letter, points - 96, np.where(points >= 128, 29 + points % 10, 39))
    out = np.where(points == 1, EDGE_CODES[0], np.where(points == 2, EDGE_CODES[1], out))
    return np.where(points == 0, 0, out).astype(np.int64)


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    """Indices of words of about the same length, few enough for one step."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    level = np.ceil(np.log2(np.maximum(size, 4))).astype(int)
    for k in np.unique(level):
        own = np.flatnonzero(level == k)
        step = max(1, (1 << 17) >> int(k))
        for a in range(0, len(own), step):
            yield own[a:a + step]


def grams(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Per pattern: gram code at every start, whether it is whole, and the weight of the pattern."""
    n, width = codes.shape
    padded = np.zeros((n, width + SPAN), dtype=np.int64)
    padded[:, :width] = codes
    for p in PATTERNS:
        parts = [padded[:, k:k + width] for k in p]
        whole = parts[-1] > 0  # padding only follows
        code = parts[0]
        for x in parts[1:]:
            code = code * ALPHABET + x
        yield code, whole, DECAY ** (p[-1] + 1 - GRAM)


class Kernel:
    """The landmark words as sums over subsequences."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        rows: list[Counter] = [Counter() for _ in landmarks]
        norms = np.ones(len(landmarks))
        for i, w in enumerate(landmarks):
            total = 0.0
            for code, whole, weight in grams(_codes([w])):
                for c in code[whole].tolist():
                    rows[i][c] += weight
                total += weight ** 2 * whole.sum()
            norms[i] = np.sqrt(total or 1.0)
        self.codes = np.array(sorted(set().union(*rows)) if rows else [], dtype=np.int64)
        at = {c: k for k, c in enumerate(self.codes.tolist())}
        self.weights = np.zeros((len(self.codes), len(landmarks)), dtype=np.float32)
        for i, r in enumerate(rows):
            for c, v in r.items():
                self.weights[at[c], i] = v / norms[i]

    def with_landmarks(self, words: list[str]) -> np.ndarray:
        """[word, landmark] kernel values; both sides are scaled by the root of their squared gram weights, which is
        the kernel's own norm unless a gram occurs twice in a word."""
        look = np.full(ALPHABET ** GRAM, -1, dtype=np.int32)
        look[self.codes] = np.arange(len(self.codes))
        out = np.zeros((len(words), len(self.landmarks)), dtype=np.float32)
        for own in _by_length(words):
            norm = np.zeros(len(own))
            hits: dict[float, list[np.ndarray]] = {}
            for code, whole, weight in grams(_codes([words[i] for i in own])):
                norm += weight ** 2 * whole.sum(axis=1)
                hits.setdefault(weight, []).append(np.where(whole, look[code], -1))
            for weight, parts in hits.items():
                hit = np.sort(np.concatenate(parts, axis=1), axis=1)[:, ::-1]  # what was found comes first
                counts = (hit >= 0).sum(axis=1)
                order = np.argsort(-counts, kind="stable")
                hit, counts = hit[order], counts[order]
                total = np.zeros((len(own), out.shape[1]), dtype=np.float32)
                for j in range(int(counts[0]) if len(counts) else 0):
                    n = np.searchsorted(-counts, -j)
                    total[:n] += self.weights[hit[:n, j]]
                out[own[order]] += np.float32(weight) * total
            out[own] /= np.sqrt(np.maximum(norm, 1e-9))[:, None]
        return out


class WordScores(dict):
    """Score of each word under a machine folded into one weight per subsequence."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray):
        super().__init__()
        self.look = np.zeros(ALPHABET ** GRAM, dtype=np.float32)
        self.look[codes] = weights

    def learn(self, words: list[str]) -> None:
        if len(self) + len(words) > REMEMBERED:
            self.clear()
        for own in _by_length(words) if words else ():
            total, norm = np.zeros(len(own)), np.zeros(len(own))
            chosen = [words[i] for i in own]
            for code, whole, weight in grams(_codes(chosen)):
                norm += weight ** 2 * whole.sum(axis=1)
                total += weight * np.where(whole, self.look[code], 0.0).sum(axis=1)
            self.update(zip(chosen, (total / np.sqrt(np.maximum(norm, 1e-9))).tolist()))

    def features(self, texts: list[str]) -> np.ndarray:
        """[document, TOP + 2]: highest word scores, sum of the positive ones, logarithm of the word count."""
        docs = [words_of(t) for t in texts]
        seen: set[str] = set().union(*docs) if docs else set()
        new = [w for w in seen if w not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list(seen)
        self.learn(new)
        out = np.zeros((len(texts), TOP + 2))
        get = self.__getitem__
        for i, words in enumerate(docs):
            if not words:
                continue
            scores = np.fromiter(map(get, words), dtype=np.float64, count=len(words))
            best = np.sort(np.partition(scores, max(0, len(scores) - TOP))[-TOP:])[::-1]
            out[i, :len(best)] = best
            out[i, TOP] = np.log1p(np.maximum(scores - 0.5, 0.0).sum())
            out[i, TOP + 1] = np.log1p(len(words))
        return out


def _machine(x: np.ndarray, y: np.ndarray, steps: int = 120, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, classes weighted alike."""
    w, b = np.zeros(x.shape[1], dtype=np.float32), np.float32(0)
    y = y.astype(np.float32)
    cost = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    moment, spread = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        slack = np.maximum(0.0, 1 - y * (x @ w + b))
        g = -2 * cost * slack * y
        slope = np.r_[x.T @ g + ridge * w, g.sum()]
        moment = 0.9 * moment + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope ** 2
        move = 0.1 * (moment / (1 - 0.9 ** t)) / (np.sqrt(spread / (1 - 0.99 ** t)) + 1e-8)
        w, b = w - move[:-1].astype(np.float32), b - np.float32(move[-1])
    return w, float(b)


def _landmarks(docs: list[set[str]], y: np.ndarray) -> list[str]:
    toxic: Counter = Counter()
    clean: Counter = Counter()
    for words, label in zip(docs, y):
        (toxic if label else clean).update(words)
    a, b = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    gain = {w: n / a - clean[w] / b for w, n in toxic.items() if n >= 3 and len(w) >= 3}
    typical = sorted(gain, key=lambda w: (-gain[w], w))[:TOXIC_LANDMARKS]
    others = [w for w in sorted(clean, key=lambda w: (-clean[w], w)) if len(w) >= 3 and w not in set(typical)]
    return typical + others[:OTHER_LANDMARKS]


def _mapped(kernel: Kernel, sentences: list[list[str]]) -> np.ndarray:
    """[sentence, landmark]: kernel values summed over the words of each sentence."""
    names = sorted(set().union(*sentences))
    at = {w: k for k, w in enumerate(names)}
    values = kernel.with_landmarks(names)
    return np.stack([values[[at[w] for w in words]].sum(axis=0) for words in sentences])


def fit(found: DataFrame, sizes: dict[int, int]) -> dict | None:
    """The folded machine and its logistic layer, or None when there are not two classes.

    `found` has doc_id, label and text of a bounded sample; at most FIT_SENTENCES sentences of each of its
    documents, chosen by hash, reach the driver. The logistic layer is fitted on whole texts.
    """
    parts = F.filter(F.split(F.col("text"), r"[.!?]+\s+|\n"), lambda s: F.length(F.trim(s)) > 0)
    pairs = F.transform(F.array_distinct(parts), lambda s: F.struct(F.xxhash64(s).alias("h"), s.alias("s")))
    chosen = F.slice(F.array_sort(pairs), 1, FIT_SENTENCES)
    rows = found.select("doc_id", "label", F.coalesce(F.transform(chosen, lambda p: p["s"]),
                                                      F.array().cast("array<string>")).alias("s")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["s"]))
    y = np.array([r["label"] for r in rows], dtype=float)
    if not (y == 1).any() or not (y == 0).any():
        return None
    sentences, owner = [], []
    for i, r in enumerate(rows):
        for s in r["s"]:
            words = [w.strip(_EDGES) or w for w in words_of(s)]
            if words:
                sentences.append(words)
                owner.append(i)
    owner = np.array(owner, dtype=np.int64)
    per_doc: list[set[str]] = [set() for _ in rows]
    for i, words in zip(owner, sentences):
        per_doc[i].update(words)
    kernel = Kernel(_landmarks(per_doc, y))
    if not len(kernel.codes):
        return None
    own = kernel.with_landmarks(kernel.landmarks).astype(np.float64)
    d, u = np.linalg.eigh((own + own.T) / 2)
    root = u @ np.diag(1 / np.sqrt(np.maximum(d, 1e-3))) @ u.T
    x = np.concatenate([_mapped(kernel, sentences[a:a + 4000]) @ root.astype(np.float32)
                        for a in range(0, len(sentences), 4000)])
    label = np.where(y[owner] > 0, 1.0, -1.0)
    use = np.ones(len(sentences), dtype=bool)
    for _ in range(3):
        w, b = _machine(x[use], label[use])
        scores = x @ w + b
        best = np.full(len(rows), -np.inf)
        np.maximum.at(best, owner, scores)
        use = (label < 0) | (scores > 0) | (scores >= best[owner])
    fold = kernel.weights.astype(np.float64) @ (root @ w)
    # Sums depend on the order of their terms in the last digits, and rows come in any order.
    found_scores = sorted(document_features(found, kernel.codes, fold.astype(np.float32), "label").collect(),
                          key=lambda r: (r["label"], r["f"]))
    z = np.array([r["f"] for r in found_scores])
    t = np.array([r["label"] for r in found_scores], dtype=float)
    beta, base = folds.logistic(z, t, folds.class_weights(t, sizes))
    return {"codes": kernel.codes, "weights": fold.astype(np.float32), "beta": beta, "base": base}


_LOADED: dict[str, WordScores] = {}


def _scores(codes: np.ndarray, weights: np.ndarray) -> WordScores:
    """One table for each worker and machine."""
    key = f"{hash(codes.tobytes())}/{hash(weights.tobytes())}"
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordScores(codes, weights)
    return _LOADED[key]


def document_features(docs: DataFrame, codes: np.ndarray, weights: np.ndarray, extra: str) -> DataFrame:
    """(`extra`, f): the features of each whole text."""
    kind = dict(docs.dtypes)[extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scores(codes, weights)
        for batch in batches:
            for part in common.slices(batch):
                f = scores.features([t or "" for t in part.column(1).to_pylist()])
                yield pa.record_batch([part.column(0), pa.array(list(f), type=pa.list_(pa.float64()))],
                                      names=[extra, "f"])

    return docs.select(extra, "text").mapInArrow(run, f"{extra} {kind}, f array<double>")


def score(docs: DataFrame, labels: DataFrame, parts: int | None = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, learnt from labels outside the held-out rows.

    Null and empty texts get the score of a text without words. Repeated rows are scored alike, as often as
    they occur. Without labels of both classes every score is the share of label 1 (0.5 without labels). No
    documents give no rows; a null doc_id is never held out.
    """
    rows = stored(folds.labelled(labels, "toxic", parts, held), "labels")
    found, sizes = folds.sample(docs, rows, FIT_PER_CLASS)
    model = fit(found, sizes)
    ids = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    if model is None:
        total = sum(sizes.values())
        done = ids.select("doc_id", F.lit(sizes.get(1, 0) / total if total else 0.5).alias("score"))
    else:
        z = F.lit(float(model["base"]))
        for i, b in enumerate(model["beta"]):
            z = z + F.element_at("f", i + 1) * F.lit(float(b))
        done = (document_features(ids, model["codes"], model["weights"], "doc_id")
                .select("doc_id", (1 / (1 + F.exp(-z))).alias("score")))
    out = F.coalesce(common.remainder(F.col("doc_id"), parts) == held, F.lit(False)) if parts else F.lit(False)
    return done.select("doc_id", out.alias("held_out"), "score",
                       F.when(F.col("score") >= folds.CUT, 1).otherwise(0).alias("predicted"))
