"""What drift statistics move and repeat."""

from __future__ import annotations

import numpy as np

from wearline.operators import drift, ladder


def test_quantiles_order_few_rows_and_stay_exact(spark, monkeypatch):
    rng = np.random.default_rng(3)
    v = np.r_[rng.normal(size=6000), np.full(3000, 0.25), rng.exponential(1e6, 3000)]
    df = spark.createDataFrame([(float(x), 1.0) for x in v], "a double, same double")
    ordered = []
    plain = ladder.count_values

    def spied(*args):
        out = plain(*args)
        ordered.append(out.count())
        return out

    monkeypatch.setattr(drift, "KS_ROWS", 60)
    monkeypatch.setattr(ladder, "count_values", spied)
    got = {r.feature: r.quantiles for r in drift.quantiles(df, ["a", "same"], 10).collect()}
    assert got["same"] == [1.0] * 11
    assert np.array_equal(got["a"], np.quantile(v, np.arange(11) / 10))
    assert ordered and max(ordered) <= 60 + 22  # before: every distinct value of the ranks' 256th parts


def test_scores_are_worked_out_once_for_a_report(spark):
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([("a", 0.3, 0.1), ("b", 0.0, 0.0)], "feature string, psi double, ks double")
    scores = rows.mapInArrow(run, rows.schema)
    errors = spark.createDataFrame([(1.0, 2.0)], "current_rmse double, baseline_rmse double")
    report = drift.drift_gauges(drift.evaluate_drift(scores, errors)).first()
    assert report.psi_alert_features == ["a"] and report.psi_scores == {"a": 0.3, "b": 0.0}
    assert seen.value == 2


def test_scores_of_like_samples_read_the_rows_few_times(spark, monkeypatch):
    """Both statistics share their passes, closed buckets are not cut again, and values no cut can part end the cutting."""
    rng = np.random.default_rng(11)
    sides = [(rng.normal(size=n), rng.integers(0, 300, n) * 0.1, np.full(n, 4.0)) for n in (6000, 5000)]
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    schema = "smooth double, steps double, same double"
    b, c = (spark.createDataFrame([tuple(map(float, r)) for r in zip(*side)], schema).mapInArrow(run, schema) for side in sides)
    monkeypatch.setattr(drift, "KS_ROWS", 60)
    monkeypatch.setattr(drift, "KS_CUTS", 1200)
    got = {r.feature: r for r in drift.drift_scores(b, c, ["smooth", "steps", "same"]).collect()}
    assert seen.value <= 8 * 11_000  # before: eight rounds of cutting for the distances alone
    for k, name in enumerate(("smooth", "steps", "same")):
        own, other = np.sort(sides[0][k]), np.sort(sides[1][k])
        at = np.concatenate([own, other])
        gaps = np.searchsorted(own, at, "right") / len(own) - np.searchsorted(other, at, "right") / len(other)
        assert abs(got[name].ks - np.abs(gaps).max()) < 1e-12, name
        edges = np.quantile(own, np.arange(11) / 10)
        if len(np.unique(edges)) == 11:
            p, q = (np.histogram(v, edges)[0] / np.histogram(v, edges)[0].sum() for v in (own, other))
            assert abs(got[name].psi - ((p - q) * np.log((p + 1e-6) / (q + 1e-6))).sum()) < 1e-9, name
    assert got["same"].psi == 0.0
