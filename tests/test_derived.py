"""Ready tables derived when read against ready tables written."""

from __future__ import annotations

from pathlib import Path

import pytest

from wearline.bindings import fixtures as fx
from wearline.operators import drift, ladder
from wearline.operators.features import feature_names
from wearline.operators.select import row_prefix_fraction
from wearline.plans.drift_check import Baseline, kept_baseline
from wearline.plans.prepare import prepare_derived, prepare_ready

SMALL = "/root/testdata/sf0.001"


def rows(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_derived_rows_are_the_written_rows_and_only_narrow_ones_are_stored(spark, tmp_path):
    train, test = fx.split_of(spark, SMALL, "train"), fx.split_of(spark, SMALL, "test")
    labels = fx.rul_labels(spark, SMALL)
    written = prepare_ready(spark, train, test, labels, str(tmp_path / "ready"))
    derived = prepare_derived(spark, train, test, labels, str(tmp_path / "labelled"))
    names = feature_names()
    columns = ["subset", "unit_number", "time_cycles", "RUL", *names]
    assert rows(written.train, columns) == rows(derived.train(names), columns)
    assert rows(written.test, columns) == rows(derived.test(names), columns)
    assert rows(written.test_last_rows, columns) == rows(derived.test_last_rows, columns)
    assert len(derived.labelled_train.columns) == 28

    def size(name):
        return sum(f.stat().st_size for f in Path(tmp_path, name).rglob("*.parquet") if "last_rows" not in str(f))
    assert 4 * size("labelled") < size("ready")


def test_deriving_again_moves_no_rows_between_tasks(spark, tmp_path):
    train, test = fx.split_of(spark, SMALL, "train"), fx.split_of(spark, SMALL, "test")
    derived = prepare_derived(spark, train, test, fx.rul_labels(spark, SMALL), str(tmp_path / "labelled"))
    for names in (["s_7"], ["setting_1_x_s_3", "s_2_roll_5"], feature_names()):
        plan = derived.train(names)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    assert "MapInArrow" not in derived.train(["s_7"])._jdf.queryExecution().executedPlan().toString()


def test_a_baseline_of_derived_tables_keeps_narrow_rows_and_gives_the_same_scores(spark, tmp_path, monkeypatch):
    train, test = fx.split_of(spark, SMALL, "train"), fx.split_of(spark, SMALL, "test")
    derived = prepare_derived(spark, train, test, fx.rul_labels(spark, SMALL), str(tmp_path / "labelled"))
    names = ["s_7", "s_2_roll_20", "setting_3_delta", "setting_1_x_s_3", "temp_compression_ratio"]
    wanted, plain = [], ladder.count_values

    def spied(rows, cuts, of=None):
        wanted.append(of)
        return plain(rows, cuts, of)

    monkeypatch.setattr(ladder, "count_values", spied)
    base = Baseline(derived.train(names), 0.37, 1.0, version="1.0", store=str(tmp_path / "store"), source=derived)
    kept_baseline(base, names)
    assert wanted and None not in wanted  # before: every value of the trained part was shuffled and kept
    kept, units = kept_baseline(base, names)
    assert rows(units, units.columns) == sorted(set(rows(derived.train(()), units.columns)))
    part = row_prefix_fraction(derived.train(names), 0.37)
    again = kept.derive(spark.read.parquet(f"{kept.path}/rows"), names)
    assert rows(again, names) == rows(part, names)
    assert len(spark.read.parquet(f"{kept.path}/rows").columns) == len(derived.labelled_train.columns)
    want = {r.feature: (r.psi, r.ks) for r in drift.drift_scores(part, derived.test_last_rows, names).collect()}
    for limit in (drift.KS_ROWS, 20):
        monkeypatch.setattr(drift, "KS_ROWS", limit)
        got = {r.feature: (r.psi, r.ks) for r in drift.scores_against(kept, derived.test_last_rows).collect()}
        assert got.keys() == want.keys() == set(names)
        for f in names:
            assert got[f] == pytest.approx(want[f], abs=1e-12)
