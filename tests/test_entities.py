"""Entities by (group, entity): fleets of any size, numbering by ranges, exact samples."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from wearline.operators import folds, select, series

UNITS = 5000


@pytest.fixture(scope="module")
def fleet(spark):
    """Two groups of 5,000 units whose ids collide, one or two rows each."""
    df = spark.range(2 * UNITS).select((1 + F.col("id") % 2).cast("int").alias("subset"), F.floor(F.col("id") / 2).alias("unit_number"))
    rows = df.withColumn("time_cycles", F.explode(F.sequence(F.lit(1), 1 + (F.col("unit_number") % 3 == 0).cast("int"))))
    return rows.withColumn("s_1", F.col("unit_number") * 1.0)


def pairs(df):
    return {(r.subset, r.unit_number) for r in df.select("subset", "unit_number").collect()}


def test_ten_operators_on_a_large_fleet(spark, fleet):
    every = {(g, u) for g in (1, 2) for u in range(UNITS)}
    some = fleet.filter("subset = 2 and unit_number >= 4000")
    fb = spark.createDataFrame([(1, 4321), (2, 77), (2, 77)], "subset int, engine_id long")
    assert pairs(select.distinct_units(fleet)) == every and select.distinct_units(fleet).count() == 2 * UNITS
    assert pairs(select.common_units(fleet, some)) == {(2, u) for u in range(4000, UNITS)}
    assert pairs(select.semi_join_entities(fleet, some)) == {(2, u) for u in range(4000, UNITS)}
    assert pairs(select.recent_entities(fleet, fb)) == {(1, 4321), (2, 77)}
    assert pairs(select.units_upto(fleet, (2, 10))) == {p for p in every if p <= (2, 10)}
    assert select.retrain_fraction(fleet, fb).first().fraction == sum(p <= (2, 77) for p in every) / len(every)
    first, _ = select.entity_prefix_fraction(fleet, some, 0.6)
    assert pairs(first) == set(sorted(every)[:int(2 * UNITS * 0.6)])
    a, b = select.slice_baseline_current(fleet, some, select.distinct_units(fleet).filter("subset = 1"), ["subset", "unit_number"])
    assert pairs(a) == pairs(some) and pairs(b) == {(1, u) for u in range(UNITS)}
    fold = folds.group_kfold(fleet, 5)
    assert pairs(fold) == every and {r["count"] for r in fold.groupBy("fold").count().collect()} == {2 * UNITS // 5}
    train, valid = folds.group_holdout(fleet, 0.1)
    order = sorted(every, key=lambda p: hashlib.md5(f"45:{p[0]}:{p[1]}".encode()).hexdigest())
    assert pairs(valid) == set(order[:UNITS // 5]) and pairs(train) == every - pairs(valid)


@pytest.mark.parametrize("block", [97, 1000, 10**6])
def test_numbers_by_ranges_with_ties(spark, block):
    df = spark.range(5000).select((F.col("id") % 3).alias("tie"), F.col("id")).repartition(7)
    got = series.number_rows(df, ["tie", "id"], "n", block).collect()
    assert [r.n for r in sorted(got, key=lambda r: (r.tie, r.id))] == list(range(1, 5001))


def test_samples_have_their_exact_size(spark, monkeypatch):
    df = spark.range(2000).repartition(5)
    for digits in (1, 4):
        monkeypatch.setattr(select, "PREFIX", digits)
        for f in (0.0, 0.0013, 0.25, 1.0):
            got = {r.id for r in select.sample_fraction(df, f, 42, ["id"]).collect()}
            want = sorted(range(2000), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())[:round(2000 * f)]
            assert got == set(want)


def test_blocks_of_bursts_and_outliers_are_bounded(spark):
    """Most rows in one second, one row far off: equal widths would give one slice almost all rows."""
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.when(F.col("id") == 0, 1e15).otherwise(F.col("id") / 1e4).alias("at"))
    cut = series.plan_series(df, ("k",), "at", rows_per_block=1000)
    sizes = [r.n for r in cut.slices.groupBy("_block").agg(F.sum("_n").alias("n")).collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 1500
    numbered = series.add_position(df, cut, ["at"], "n").orderBy("at").collect()
    assert [r.n for r in numbered] == list(range(1, 20_001))
