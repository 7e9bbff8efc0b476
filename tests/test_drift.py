"""PSI and KS against a plain NumPy statement of the formulas, and the known edge cases."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
import pytest

from wearline.operators import drift

NAN = float("nan")


def psi_of(edges, b, c):
    """PSI from counts by rank: how many values lie below each edge, the last edge included; others are outside."""
    def shares(values):
        values = sorted(values)
        below = [bisect_left(values, e) for e in edges[:-1]] + [bisect_right(values, edges[-1])]
        counts = [y - x for x, y in zip(below, below[1:])]
        return [n / (sum(counts) or 1) for n in counts]

    return sum((p - q) * math.log((p + 1e-6) / (q + 1e-6)) for p, q in zip(shares(b), shares(c)))


def ks_np(b, c):
    b, c = np.sort(b), np.sort(c)
    at = np.concatenate([b, c])
    return float(np.abs(np.searchsorted(b, at, "right") / len(b) - np.searchsorted(c, at, "right") / len(c)).max())


def frames(spark, baseline: dict, current: dict):
    def one(d):
        rows = pd.DataFrame({k: pd.Series(v, dtype=float) for k, v in d.items()})
        schema = ", ".join(f"{k} double" for k in d)
        return spark.createDataFrame([tuple(r) for r in rows.itertuples(index=False)], schema)
    return one(baseline), one(current)


def test_random_columns(spark):
    rng = np.random.default_rng(3)
    n, m = 3000, 700
    base = {"normal": rng.normal(size=n), "ties": rng.integers(0, 40, n).astype(float),
            "few": rng.integers(0, 4, n).astype(float), "heavy": np.where(rng.random(n) < 0.4, 5.0, rng.gamma(2, 3, n)),
            "wide": np.exp(rng.normal(0, 6, n)), "const": np.full(n, 7.0), "same": rng.normal(size=n)}
    cur = {"normal": rng.normal(0.2, 1.1, m), "ties": rng.integers(5, 45, m).astype(float),
           "few": rng.integers(0, 3, m).astype(float), "heavy": np.where(rng.random(m) < 0.2, 5.0, rng.gamma(2, 3, m)),
           "wide": np.exp(rng.normal(0.5, 6, m)), "const": np.full(m, 7.0), "same": base["same"][:m]}
    b, c = frames(spark, base, cur)
    got = {r.feature: r for r in drift.drift_scores(b, c, list(base)).collect()}
    edges = {r.feature: r.edges for r in drift.quantile_bins(b, list(base)).collect()}
    for f in base:
        assert got[f].psi == pytest.approx(psi_of(edges[f], base[f], cur[f]), abs=1e-9), f
        assert got[f].ks == pytest.approx(ks_np(base[f], cur[f]), abs=1e-12), f
    assert edges["normal"] == pytest.approx(list(np.quantile(base["normal"], np.arange(11) / 10)), abs=1e-12)
    assert edges["few"] == pytest.approx(list(np.linspace(0, 3, 11)), abs=1e-12)


@pytest.mark.parametrize("base,cur,want", [
    ([5.0] * 9, [5.0] * 4, 0.0),
    ([5.0] * 9, [6.0] * 4, 13.815511),
    ([5.0] * 9, [5.0, 6.0, 7.0], 0.0),
    (list(np.arange(20.0)), [100.0, 200.0], 11.512935),
    (list(np.arange(20.0)), [], 11.512935),
    (list(np.arange(20.0)), [NAN, 3.0, 3.0, NAN], None),
    (list(np.arange(20.0)), list(np.arange(20.0)), 0.0),
])
def test_psi_edge_cases(spark, base, cur, want):
    b, c = frames(spark, {"x": base}, {"x": cur})
    got = drift.psi_per_feature(b, c, ["x"]).collect()
    if want is None:
        want = (0.1 - 1.0) * math.log((0.1 + 1e-6) / (1.0 + 1e-6)) + 9 * 0.1 * math.log((0.1 + 1e-6) / 1e-6)  # all in one tenth
    assert got[0].psi == pytest.approx(want, abs=1e-6)


def test_empty_baseline_gives_no_row(spark):
    b, c = frames(spark, {"x": []}, {"x": [1.0]})
    assert drift.psi_per_feature(b, c, ["x"]).count() == 0
    assert drift.ks_per_feature(b, c, ["x"]).count() == 0


def test_dropped_cells(spark):
    b, _ = frames(spark, {"x": [1.0, NAN, 2.0], "y": [1.0, 2.0, 3.0]}, {"x": [], "y": []})
    assert {r.feature: r.dropped for r in drift.dropped_cells(b, ["x", "y"]).collect()} == {"x": 1, "y": 0}


def test_decision_at_the_threshold(spark):
    scores = spark.createDataFrame([("a", 0.1, 0.0), ("b", 0.1, 0.0)], "feature string, psi double, ks double")
    rmse = spark.createDataFrame([(1.0, 1.0)], "current_rmse double, baseline_rmse double")
    row = drift.drift_gauges(drift.evaluate_drift(scores, rmse)).first()
    assert row.should_retrain is True and row.psi_flag == 0.0
    assert row.psi_warn_features == ["a", "b"] and row.psi_alert_features == []
    none = spark.createDataFrame([(9.0, 0.0)], "current_rmse double, baseline_rmse double")
    calm = spark.createDataFrame([("a", 0.0, 0.0)], "feature string, psi double, ks double")
    assert drift.evaluate_drift(calm, none).first().should_retrain is False
