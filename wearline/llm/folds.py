"""Labelled rows for fitting, and small models fitted on bounded samples of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.llm.common import remainder
from wearline.session import stored

#: Score from which a document counts as predicted.
CUT = 0.3


def labelled(labels: DataFrame, label: str, parts: int | None, held: int) -> DataFrame:
    """(doc_id, label) that may be learnt from: not in the held-out remainder, neither column null.

    A document labelled more than once counts once, with its largest label.
    """
    rows = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
    rows = rows.where("doc_id is not null and label in (0, 1)")
    if parts:
        rows = rows.where(remainder(F.col("doc_id"), parts) != held)
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))


def sample(docs: DataFrame, rows: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label, text) of at most `per_class` labelled documents of each class, and all counts by class.

    The choice follows a hash of the id, so it does not depend on order or partitioning. Written to the
    shared folder, as several fitting steps read it.
    """
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # two rows at most
    parts = [rows.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
             for k in (0, 1)]
    # At most 2 * per_class ids.
    chosen = F.broadcast(parts[0].unionAll(parts[1]).withColumnRenamed("doc_id", "labelled_id"))
    ids = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    found = ids.join(chosen, F.col("doc_id") == F.col("labelled_id")).select("doc_id", "label", "text")
    return stored(found, "labelled"), sizes


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def class_weights(y: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    """Weights that give each class its share among all labelled rows, not that of the sample."""
    w = np.ones(len(y))
    for k in (0, 1):
        own = y == k
        if own.any():
            w[own] = sizes.get(k, 0) / own.sum()
    return w / w.mean()


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-2, steps: int = 60
             ) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by Newton steps on centred, scaled columns; gives weights and intercept."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    beta = np.zeros(z.shape[1])
    penalty = np.r_[np.full(x.shape[1], ridge * len(x)), 1e-6]
    for _ in range(steps):
        p = sigmoid(z @ beta)
        slope = z.T @ (w * (p - y)) + penalty * beta
        curve = (z * (w * p * (1 - p))[:, None]).T @ z + np.diag(penalty) + 1e-8 * np.eye(len(beta))
        move = np.linalg.solve(curve, slope)
        beta -= move * min(1.0, 5.0 / (np.abs(move).max() + 1e-12))
        if np.abs(move).max() < 1e-6:
            break
    weights = beta[:-1] / scale
    return weights, float(beta[-1] - weights @ mean)
