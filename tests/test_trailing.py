"""Trailing means and differences by batches against window functions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wearline.functions import clean
from wearline.operators.features import create_features, delta, feature_names, rolling_mean, switches_for
from wearline.operators.series import plan_series
from wearline.spec import SPEC, FeatureSwitches, TelemetrySpec

SMALL = TelemetrySpec(settings=("a",), sensors=("b",))


def series(spark):
    rng = random.Random(7)
    odd = [None, float("nan"), float("inf"), -0.0, 1e300]
    rows = [(g, u, t, rng.choice(odd) if rng.random() < 0.1 else rng.random() * 10 ** rng.randint(-3, 6), rng.random(), f"x{t}")
            for g in (1, 2) for u in range(1, 8) for t in range(1, rng.choice([2, 4, 30, 90]))]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "subset int, unit_number long, time_cycles long, a double, b double, note string")


def bits(df):
    return sorted([tuple(float(v).hex() if isinstance(v, float) else v for v in r) for r in df.collect()], key=repr)


@pytest.mark.parametrize("rows_per_block", [2_000_000, 10])
@pytest.mark.parametrize("batch", [10_000, 7])
def test_means_and_differences_equal_window_functions_to_the_last_bit(spark, rows_per_block, batch):
    df = series(spark).repartition(3)
    layout = plan_series(df, SMALL.keys, SMALL.order, rows_per_block=rows_per_block)
    w = Window.partitionBy(*SMALL.keys).orderBy(SMALL.order)
    plain = df.select("*", *[F.avg(clean(c)).over(w.rowsBetween(1 - n, 0)).alias(f"{c}_roll_{n}") for n in (3, 20) for c in "ba"],
                      *[F.coalesce(clean(c) - F.lag(clean(c)).over(w), F.lit(0.0)).alias(f"{c}_delta") for c in "ab"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = delta(rolling_mean(df, (3, 20), spec=SMALL, layout=layout), spec=SMALL, layout=layout)
        assert got.columns == plain.columns
        assert bits(got) == bits(plain)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_frame_is_replayed_row_by_row(spark):
    """A plan with a window function per mean adds every row up as often as frames hold it."""
    plan = rolling_mean(series(spark), (3, 20), spec=SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "avg(" not in plan and "MapInArrow" in plan


def test_switches_for_names_only_their_blocks():
    assert switches_for(["s_7"]) == FeatureSwitches(None, *[False] * 8)
    some = switches_for(["s_1_roll_5", "setting_1_x_s_3", "fuel_to_cooling"])
    assert (some.rolling_windows, some.delta, some.setting_sensor, some.setting_pairs, some.fuel_air) == ((5,), False, True, False, True)
    assert switches_for(feature_names()) == FeatureSwitches()
