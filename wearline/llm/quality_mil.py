"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of `PASSAGE_WORDS` words. Each passage is encoded by a small network from its
writing statistics; gated attention weighs the passages, and the weighted passage representation is scored.
Encoder, attention and score are learnt together from document labels by gradient steps. Every passage of
every document is encoded and weighed when scoring.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.llm import common, folds
from wearline.session import stored

PASSAGE_WORDS = 48
#: Bounds of the sample that the network is fitted on.
FIT_PER_CLASS, FIT_PASSAGES = 1500, 32
HIDDEN, GATE, EPOCHS, RATE, DECAY, SEED = 16, 8, 250, 0.02, 1e-4, 11

_CLASSES = {
    "symbols": b"#*$%&|<>", "upper": bytes(range(65, 91)), "marks": b"!?", "digits": bytes(range(48, 58)),
    "stops": b".,;:", "wide": bytes(range(0xC0, 0x100)), "lines": b"\n", "other": b"@=_~^+\\/{}[]()-\"'",
}
FEATURES = (*_CLASSES, "word_length", "short", "long", "distinct", "stutter", "n_words")
_MIX = np.random.default_rng(5).integers(1, 1 << 62, size=(2, 1024), dtype=np.uint64) | np.uint64(1)


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features [passage, FEATURES] and the text each passage belongs to; a text without words is one passage."""
    n = len(texts)
    data, _, ends = common.joined(texts, b"\n")
    a, b = common.word_bounds(data)
    doc = np.searchsorted(ends, a, side="right")
    per_doc = np.bincount(doc, minlength=n)
    inside = np.arange(len(a)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    counts = np.maximum(-(-per_doc // PASSAGE_WORDS), 1)
    first = np.cumsum(counts) - counts
    passage = first[doc] + inside // PASSAGE_WORDS
    total = int(counts.sum())
    out = np.zeros((total, len(FEATURES)))
    owner = np.repeat(np.arange(n), counts)
    if not len(a):
        return out, owner
    words = np.bincount(passage, minlength=total).astype(float)
    low, high = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.int64)
    head = np.flatnonzero(np.r_[True, np.diff(passage) > 0])
    low[passage[head]] = a[head]
    high[passage[head]] = b[np.r_[head[1:] - 1, len(b) - 1]]
    w = np.maximum(words, 1.0)
    for k, members in enumerate(_CLASSES.values()):
        mask = np.zeros(256, dtype=np.int32)
        mask[np.frombuffer(members, dtype=np.uint8)] = 1
        upto = np.r_[0, np.cumsum(mask[data])]
        out[:, k] = (upto[high] - upto[low]) / w
    size = (b - a).astype(float)
    k = len(_CLASSES)
    out[:, k] = np.bincount(passage, size, total) / w
    out[:, k + 1] = np.bincount(passage, size <= 3, total) / w
    out[:, k + 2] = np.bincount(passage, size >= 12, total) / w
    name = _names(data, a, b)
    order = np.lexsort((name, passage))
    fresh = np.r_[True, (np.diff(passage[order]) > 0) | (np.diff(name[order].view(np.int64)) != 0)]
    out[:, k + 3] = np.bincount(passage[order], fresh, total) / w
    same = np.r_[False, (name[1:] == name[:-1]) & (passage[1:] == passage[:-1])]
    out[:, k + 4] = np.bincount(passage, same, total) / w
    out[:, k + 5] = np.log1p(words)
    return out, owner


def _names(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit name of every word."""
    size = b - a
    at = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    place = (at - np.repeat(a, size)) % 1024
    part = (_MIX[0][data[at]] ^ (_MIX[0][data[at]] >> np.uint64(29))) * _MIX[1][place]
    name = np.add.reduceat(part, np.cumsum(size) - size)
    return name ^ (name >> np.uint64(31))


def train(x: np.ndarray, mask: np.ndarray, y: np.ndarray, w: np.ndarray) -> dict[str, np.ndarray]:
    """The network from bags x [bag, passage, feature] with a mask of real passages, labels and bag weights."""
    real = x[mask]
    mean, scale = real.mean(axis=0), real.std(axis=0) + 1e-6
    x = np.clip((x - mean) / scale, -8, 8) * mask[..., None]
    rng = np.random.default_rng(SEED)
    f = x.shape[2]
    p = {"W": rng.normal(0, f ** -0.5, (f, HIDDEN)), "b": np.zeros(HIDDEN),
         "V": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)), "U": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
         "g": rng.normal(0, GATE ** -0.5, GATE), "c": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "d": np.zeros(1)}
    moment = {k: np.zeros_like(v) for k, v in p.items()}
    spread = {k: np.zeros_like(v) for k, v in p.items()}
    for t in range(1, EPOCHS + 1):
        h = np.tanh(x @ p["W"] + p["b"])
        v, u = np.tanh(h @ p["V"]), folds.sigmoid(h @ p["U"])
        e = np.where(mask, (v * u) @ p["g"], -np.inf)
        e = np.exp(e - e.max(axis=1, keepdims=True))
        a = e / e.sum(axis=1, keepdims=True)
        z = np.einsum("bk,bkh->bh", a, h)
        dz0 = w * (folds.sigmoid(z @ p["c"] + p["d"]) - y) / w.sum()
        dz = dz0[:, None] * p["c"]
        da = np.einsum("bkh,bh->bk", h, dz)
        de = a * (da - (a * da).sum(axis=1, keepdims=True))
        dvu = de[..., None] * p["g"]
        dv, du = dvu * u * (1 - v ** 2), dvu * v * u * (1 - u)
        dh = a[..., None] * dz[:, None, :] + dv @ p["V"].T + du @ p["U"].T
        dq = dh * (1 - h ** 2) * mask[..., None]
        slope = {"W": np.tensordot(x, dq, ([0, 1], [0, 1])), "b": dq.sum(axis=(0, 1)),
                 "V": np.tensordot(h, dv, ([0, 1], [0, 1])), "U": np.tensordot(h, du, ([0, 1], [0, 1])),
                 "g": np.einsum("bk,bkg->g", de, v * u), "c": z.T @ dz0, "d": dz0.sum(keepdims=True)}
        for k in p:
            s = slope[k] + DECAY * p[k]
            moment[k] = 0.9 * moment[k] + 0.1 * s
            spread[k] = 0.99 * spread[k] + 0.01 * s ** 2
            p[k] = p[k] - RATE * (moment[k] / (1 - 0.9 ** t)) / (np.sqrt(spread[k] / (1 - 0.99 ** t)) + 1e-8)
    return p | {"mean": mean, "scale": scale}


def evaluate(p: dict[str, np.ndarray], x: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Score of each of n texts whose passages x belong to `owner` (ascending, none missing)."""
    h = np.tanh(np.clip((x - p["mean"]) / p["scale"], -8, 8) @ p["W"] + p["b"])
    e = (np.tanh(h @ p["V"]) * folds.sigmoid(h @ p["U"])) @ p["g"]
    head = np.flatnonzero(np.r_[True, np.diff(owner) > 0])
    e = np.exp(e - np.maximum.reduceat(e, head)[owner])
    z = np.add.reduceat(e[:, None] * h, head, axis=0) / np.bincount(owner, e, n)[:, None]
    return folds.sigmoid(z @ p["c"] + p["d"])


def fit(found: DataFrame, sizes: dict[int, int]) -> dict[str, np.ndarray] | None:
    """The network from a bounded sample; of a long document FIT_PASSAGES evenly spread passages reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                x, owner = passages(common.encoded(part.column("text")))
                rows = []
                for i in range(part.num_rows):
                    own = x[owner == i]
                    chosen = np.unique(np.linspace(0, len(own) - 1, min(FIT_PASSAGES, len(own))).astype(int))
                    rows.append(own[chosen].ravel())
                yield pa.record_batch([part.column("doc_id"), part.column("label"),
                                       pa.array(rows, type=pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    rows = found.select("doc_id", "label", "text").mapInArrow(
        run, "doc_id long, label int, x array<double>").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    y = np.array([r["label"] for r in rows], dtype=float)
    if not (y == 1).any() or not (y == 0).any():
        return None
    f = len(FEATURES)
    x = np.zeros((len(rows), FIT_PASSAGES, f))
    mask = np.zeros((len(rows), FIT_PASSAGES), dtype=bool)
    for i, r in enumerate(rows):
        own = np.array(r["x"]).reshape(-1, f)
        x[i, :len(own)], mask[i, :len(own)] = own, True
    return train(x, mask, y, folds.class_weights(y, sizes))


def _learnt(docs: DataFrame, labels: DataFrame, parts: int | None, held: int):
    """The network (None without two classes) and the counts by class."""
    rows = stored(folds.labelled(labels, "quality", parts, held), "labels")
    found, sizes = folds.sample(docs, rows, FIT_PER_CLASS)
    return fit(found, sizes), sizes


def _scored(rows: DataFrame, key: str, model: dict | None, sizes: dict[int, int]) -> DataFrame:
    """(`key`, score) of rows with columns `key` and text."""
    if model is None:
        total = sum(sizes.values())
        return rows.select(key, F.lit(sizes.get(1, 0) / total if total else 0.5).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                x, owner = passages(common.encoded(part.column("text")))
                yield pa.record_batch([part.column(key), pa.array(evaluate(model, x, owner, part.num_rows))],
                                      names=[key, "score"])

    return rows.select(key, "text").mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, score double")


def score(docs: DataFrame, labels: DataFrame, parts: int | None = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, learnt from labels outside the held-out rows.

    Null and empty texts are one passage without words. Repeated rows are scored alike, as often as they
    occur. Without labels of both classes every score is the share of label 1 (0.5 without labels). No
    documents give no rows; a null doc_id is never held out.
    """
    model, sizes = _learnt(docs, labels, parts, held)
    ids = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    out = F.coalesce(common.remainder(F.col("doc_id"), parts) == held, F.lit(False)) if parts else F.lit(False)
    return _scored(ids, "doc_id", model, sizes).select(
        "doc_id", out.alias("held_out"), "score",
        F.when(F.col("score") >= folds.CUT, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, parts: int | None = 5, held: int = 0) -> DataFrame:
    """The rows of `docs`, with all their columns, whose score is at least folds.CUT.

    Only texts go to Python and only scores come back; the other columns wait in the JVM. Rows that repeat are
    decided alike; null and empty texts are one passage without words; no documents give no rows.
    """
    model, sizes = _learnt(docs, labels, parts, held)
    if model is None:
        total = sum(sizes.values())
        return docs.where(F.lit(sizes.get(1, 0) / total if total else 0.5) >= folds.CUT)

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = []
            for part in common.slices(pa.record_batch([batch], names=["text"])):
                x, owner = passages(common.encoded(part.column("text")))
                found.append(evaluate(model, x, owner, part.num_rows))
            yield pa.array(np.concatenate(found) if found else np.empty(0))

    return docs.where(scored(docs["text"]) >= folds.CUT)
