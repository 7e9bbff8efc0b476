"""Cut series give the same rows as whole ones."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from wearline.operators import features, labels, select
from wearline.operators.series import add_position, add_running_total, plan_series
from wearline.spec import TelemetrySpec

SPEC = TelemetrySpec(settings=("setting_1",), sensors=("s_1", "s_2"))


@pytest.fixture(scope="module")
def skewed(spark):
    """One unit holds most rows; its cycles have gaps and a dense cluster."""
    rng = random.Random(5)
    rows = []
    cycles = sorted(rng.sample(range(1, 400), 300)) + sorted(rng.sample(range(10_000, 12_000), 200)) + [90_000, 90_001]
    for c in cycles:
        rows.append((1, 7, c))
    for u in range(1, 6):
        rows += [(2, u, c) for c in range(1, 31)]
    out = []
    for g, u, c in rows:
        v = None if rng.random() < 0.1 else math.nan if rng.random() < 0.1 else rng.randint(0, 50) / 4
        out.append((g, u, c, float(rng.randint(0, 9)), v, float(c % 13)))
    return spark.createDataFrame(out, "subset int, unit_number long, time_cycles long, setting_1 double, s_1 double, s_2 double").repartition(4)


def as_set(df):
    cols = sorted(df.columns)
    return sorted(repr(tuple(r)) for r in df.select(*cols).collect())


@pytest.mark.parametrize("rows_per_block", [7, 40, 250])
def test_cut_windows_equal_whole(skewed, rows_per_block):
    whole = plan_series(skewed, SPEC.keys, SPEC.order)
    cut = plan_series(skewed, SPEC.keys, SPEC.order, rows_per_block=rows_per_block)
    assert not whole.is_cut and cut.is_cut
    for op in (lambda lay: features.rolling_mean(skewed, (3, 5, 20), spec=SPEC, layout=lay),
               lambda lay: features.delta(skewed, spec=SPEC, layout=lay),
               lambda lay: labels.label_rul_train(skewed, SPEC, lay),
               lambda lay: add_position(skewed, lay, [SPEC.order], "rn"),
               lambda lay: add_running_total(skewed, lay, "s_2", "before")):
        assert as_set(op(whole)) == as_set(op(cut))


def test_cut_series_keep_rows_with_null_keys(spark):
    rows = [(1, 1, c) for c in range(1, 31)] + [(1, None, c) for c in range(1, 4)] + [(None, 2, 1), (None, None, 5)]
    df = spark.createDataFrame(rows, "subset int, unit_number long, time_cycles long")
    whole = plan_series(df, SPEC.keys, SPEC.order)
    cut = plan_series(df, SPEC.keys, SPEC.order, rows_per_block=7)
    assert cut.is_cut and not whole.is_cut
    assert as_set(labels.label_rul_train(df, SPEC, cut)) == as_set(labels.label_rul_train(df, SPEC, whole))
    assert labels.label_rul_train(df, SPEC, cut).count() == len(rows)


def test_blocks_are_bounded(skewed):
    cut = plan_series(skewed, SPEC.keys, SPEC.order, rows_per_block=50)
    per_block = cut.slices.groupBy(*SPEC.keys, "_block").agg(F.sum("_n").alias("n")).collect()
    assert len(per_block) > 3
    dense = skewed.filter("subset = 2").withColumn("unit_number", F.lit(1)).withColumn(
        "time_cycles", F.monotonically_increasing_id())
    assert plan_series(dense, SPEC.keys, SPEC.order, rows_per_block=1000).is_cut is False


def test_row_prefix_of_skewed_table(skewed):
    want = [tuple(r) for r in skewed.orderBy("subset", "unit_number", "time_cycles")
            .select("subset", "unit_number", "time_cycles").collect()]
    for f in (0.0, 0.3, 0.777, 0.9, 1.0):
        got = select.row_prefix_fraction(skewed, f, SPEC,).select("subset", "unit_number", "time_cycles").collect()
        assert sorted(tuple(r) for r in got) == want[:int(len(want) * f)]


def test_no_extra_shuffle_when_nothing_is_cut(skewed):
    plan = features.create_features(
        skewed, features.FeatureSwitches(setting_sensor=False, setting_pairs=False, temperature=False, pressure=False,
                                         speed=False, fuel_air=False, cross_system=False),
        SPEC, plan_series(skewed, SPEC.keys, SPEC.order))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in plan
