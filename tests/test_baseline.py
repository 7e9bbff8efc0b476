"""Kept baseline statistics, the check that uses them, and the stream of checks."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearline.operators import drift
from wearline.plans import retrain
from wearline.plans.drift_check import Baseline, baseline_of_runs, drift_check
from wearline.spec import TelemetrySpec
from wearline.streaming.feedback import drift_check_stream

SPEC = TelemetrySpec(settings=(), sensors=("s_1", "s_2", "s_3"))
NAMES = list(SPEC.sensors)
START = datetime(2024, 1, 1)


def rows(spark, units, cycles, seed, shift=0.0):
    rng = np.random.default_rng(seed)
    out = [(1, u, c, float(rng.normal(shift)), float(rng.integers(0, 4)), 5.0 if rng.random() < 0.7 else float(rng.random()))
           for u in range(units) for c in range(cycles)]
    return spark.createDataFrame(out, "subset int, unit_number long, time_cycles long, s_1 double, s_2 double, s_3 double")


def feedback(spark, times, units):
    out = [(u, 10.0, 12.0, t) for t in times for u in units]
    return spark.createDataFrame(out, "engine_id long, actual_rul double, predicted_rul double, feedback_timestamp timestamp")


@pytest.fixture(scope="module")
def tables(spark):
    return rows(spark, 40, 60, 1), rows(spark, 40, 1, 2, 0.3)


def test_kept_statistics_give_the_same_scores(spark, tables, tmp_path, monkeypatch):
    train, last = tables
    want = {r.feature: (r.psi, r.ks) for r in drift.drift_scores(train, last, NAMES).collect()}
    kept = drift.keep_statistics(train, NAMES, str(tmp_path / "kept"), levels=4)
    got = {r.feature: (r.psi, r.ks) for r in drift.scores_against(kept, last).collect()}
    assert got.keys() == want.keys()
    for f in want:
        assert got[f] == pytest.approx(want[f], abs=1e-12)
    assert drift.load_statistics(spark, str(tmp_path / "nothing"), NAMES) is None


def test_ks_of_like_samples_is_cut_further_and_exact(spark, tables, monkeypatch):
    train, _ = tables
    other = rows(spark, 40, 60, 3)
    monkeypatch.setattr(drift, "KS_ROWS", 10**9)
    whole = {r.feature: r.ks for r in drift.ks_per_feature(train, other, NAMES).collect()}
    monkeypatch.setattr(drift, "KS_ROWS", 50)
    monkeypatch.setattr(drift, "KS_PARTS", 8)
    cut = {r.feature: r.ks for r in drift.ks_per_feature(train, other, NAMES).collect()}
    assert cut == pytest.approx(whole, abs=1e-15) and cut["s_1"] > 0
    assert all(r.ks == 0 for r in drift.ks_per_feature(train, train, NAMES).collect())


def test_second_check_does_not_read_the_training_table(spark, tables, tmp_path):
    train, last = tables
    recent = feedback(spark, [START], [1, 2, 3, 30])
    first = drift_check(recent, Baseline(train, 0.5, 1.0, version="1.0", store=str(tmp_path)), last, NAMES, SPEC).first()
    broken = train.withColumn("s_1", F.raise_error(F.lit("read"))).withColumn("unit_number", F.raise_error(F.lit("read")).cast("long"))
    second = drift_check(recent, Baseline(broken, 0.5, 1.0, version="1.0", store=str(tmp_path)), last, NAMES, SPEC).first()
    plain = drift_check(recent, Baseline(train, 0.5, 1.0), last, NAMES, SPEC).first()
    assert first == second
    assert (first.avg_psi, first.avg_ks, first.retrain_on) == pytest.approx((plain.avg_psi, plain.avg_ks, plain.retrain_on))
    assert first.should_retrain and first.psi_scores.keys() == set(NAMES) == first.ks_scores.keys()
    nothing = drift_check(recent.limit(0), Baseline(broken, 0.5, 1.0, version="2.0", store=str(tmp_path)), last, NAMES, SPEC).first()
    assert (nothing.n_feedback, nothing.avg_psi, nothing.should_retrain) == (0, 0.0, False)


def test_stream_of_checks_over_several_batches(spark, tables, tmp_path):
    train, last = tables
    at = [START + timedelta(hours=h) for h in (0, 1, 30)]
    for k, t in enumerate(at):
        feedback(spark, [t, t - timedelta(seconds=50)], [k, k + 1]).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    feedback(spark, [datetime(2999, 1, 1)], [5]).coalesce(1).write.parquet(str(tmp_path / "in/3"))
    logged = {}
    for k in range(4):  # one file a batch, in order
        (tmp_path / "seen").mkdir(exist_ok=True)
        source = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in/0")).schema).parquet(str(tmp_path / "seen"))
        for f in (tmp_path / f"in/{k}").glob("*.parquet"):
            (tmp_path / "seen" / f"{k}-{f.name}").write_bytes(f.read_bytes())
        writer = drift_check_stream(source, str(tmp_path / "store"), str(tmp_path / "log"), str(tmp_path / "state"),
                                    lambda: Baseline(train, 1.0, 1.0, version="1.0", store=str(tmp_path / "kept")), last, NAMES, 60,
                                    event_time=True, keep_hours=2, spec=SPEC)
        writer.trigger(availableNow=True).start().awaitTermination()
        logged[k] = len([p for p in (tmp_path / "store").iterdir() if p.name.startswith("hour=")])
    log = {r.check_time: r.n_feedback for r in spark.read.parquet(str(tmp_path / "log")).collect()}
    assert log == {t: 4 for t in at}  # the record from the future checks nothing and moves nothing
    assert spark.read.parquet(str(tmp_path / "store-future")).count() == 1
    assert logged[1] == 3 and logged[2] == 2  # hours before the window and its two hours are gone


def test_retraining_waits_for_the_cooldown(spark, monkeypatch, tmp_path):
    started = []
    monkeypatch.setattr(retrain, "retrain_job", lambda *a: started.append(a[6]) or "ran")
    report = spark.createDataFrame([(True, 0.75)], "should_retrain boolean, retrain_on double")
    calm = spark.createDataFrame([(False, None)], "should_retrain boolean, retrain_on double")
    monkeypatch.setattr(retrain, "newest_run", lambda *a: {"logged_at": START})

    def act(r, seconds):
        return retrain.retrain_on_drift(spark, r, None, None, NAMES, str(tmp_path), now=START + timedelta(seconds=seconds))

    assert act(report, 29) is None and act(calm, 99) is None and started == []
    assert act(report, 30) == "ran" and started == [0.75]


def test_baseline_before_the_first_run(spark, tables, tmp_path):
    b = baseline_of_runs(spark, str(tmp_path), tables[0])
    assert (b.rmse, b.fraction, b.version) == (0.0, 0.1, "")
