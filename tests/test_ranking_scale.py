"""Rank correlations by packed cells, by joined ranks and by pandas."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest

from wearline.operators import ranking


def table():
    rng = np.random.default_rng(5)
    n = 3000
    y = rng.integers(0, 40, n).astype(float)
    pdf = pd.DataFrame({"y": y, "near": y + rng.normal(size=n), "ties": np.round(y / 7) - 0.0, "same": 4.25,
                        "big": rng.normal(size=n) * 1e200, "void": np.nan})
    pdf.loc[rng.random(n) < 0.1, "near"] = np.nan
    pdf.loc[rng.random(n) < 0.05, "y"] = np.nan
    pdf.loc[5, "big"] = np.inf
    return pdf


@pytest.mark.parametrize("most", [1024, 0])
def test_packed_and_joined_sums_give_the_correlations_of_pandas(spark, monkeypatch, most):
    pdf = table()
    names = ["near", "ties", "same", "big", "void"]
    monkeypatch.setattr(ranking, "TARGET_VALUES", most)
    monkeypatch.setattr(ranking, "PACK_ROWS", 500)
    df = spark.createDataFrame(pdf.itertuples(index=False), ", ".join(f"{c} double" for c in pdf.columns)).repartition(3)
    got = {r.feature: r.rho for r in ranking.spearman(df, names, "y").collect()}
    assert set(got) == {"near", "ties", "same", "big"} and got["same"] is None
    for c in ("near", "ties", "big"):
        both = pdf[[c, "y"]].dropna().rank()
        assert math.isclose(got[c], np.corrcoef(both[c], both["y"])[0, 1], rel_tol=1e-9)


def test_packed_cells_come_back(spark):
    arrays = np.array([-1e300, 0.5, np.inf]), np.array([0, 1023, 7]), np.array([1, 2, 4_000_000_000])
    for a, b in zip(ranking._unpack(ranking._pack(*arrays)), arrays):
        assert np.array_equal(a, b)


def test_cells_of_a_target_of_few_values_are_shuffled_packed(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "x double, y double")
    assert "FlatMapGroupsInArrow" in ranking.spearman(df, ["x"], "y")._jdf.queryExecution().executedPlan().toString()
