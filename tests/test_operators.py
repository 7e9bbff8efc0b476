"""Hand-made cases with exact results."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.functions import ieee_div, iso_timestamp
from wearline.operators import features, labels, metrics, ranking, select, windows
from wearline.plans.retrain import pool_ratios
from wearline.sources import requests as rq
from wearline.sources.models import next_model_version
from wearline.spec import TelemetrySpec
from wearline.streaming.retrain import accepted_triggers

ONE = TelemetrySpec(settings=(), sensors=("s_1",))


def series(spark, values, unit=1, group=1):
    rows = [(group, unit, i + 1, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "subset int, unit_number long, time_cycles long, s_1 double")


def column(df, name):
    return [r[name] for r in df.orderBy("time_cycles").collect()]


def test_train_and_test_labels(spark):
    df = series(spark, [1.0, 2.0, 3.0])
    assert column(labels.label_rul_train(df, ONE), "RUL") == [2, 1, 0]
    lines = spark.createDataFrame([(1, 1, 10)], "subset int, line_no long, rul long")
    assert column(labels.label_rul_test(df, lines, ONE), "RUL") == [12, 11, 10]


def test_label_lines_follow_unit_order(spark):
    df = series(spark, [0.0], unit=30).union(series(spark, [0.0], unit=4)).union(series(spark, [0.0], unit=100))
    lines = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (1, 3, 30)], "subset int, line_no long, rul long")
    got = {r.unit_number: r.RUL for r in labels.label_rul_test(df, lines, ONE).collect()}
    assert got == {4: 10, 30: 20, 100: 30}


def test_rolling_and_delta_with_missing_values(spark):
    df = series(spark, [1.0, None, 3.0, math.nan])
    assert column(features.rolling_mean(df, (2,), ("s_1",), ONE), "s_1_roll_2") == [1.0, 1.0, 3.0, 3.0]
    assert column(features.delta(df, ("s_1",), ONE), "s_1_delta") == [0.0, 0.0, 0.0, 0.0]
    all_missing = series(spark, [None, None])
    assert column(features.rolling_mean(all_missing, (2,), ("s_1",), ONE), "s_1_roll_2") == [None, None]


def test_window_of_one_is_identity_and_deltas_telescope(spark):
    df = series(spark, [4.0, 7.5, 1.25, 9.0])
    assert column(features.rolling_mean(df, (1,), ("s_1",), ONE), "s_1_roll_1") == [4.0, 7.5, 1.25, 9.0]
    assert sum(column(features.delta(df, ("s_1",), ONE), "s_1_delta")) == 5.0


def test_feature_names(spark):
    names = features.feature_names()
    assert len(names) == len(set(names)) == 225
    assert names[24] == "s_1_roll_3" and names[-1] == "engine_load_indicator"


def test_ieee_division(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (-1.0, 0.0), (6.0, 3.0), (math.nan, 0.0)], "a double, b double")
    got = [r.d for r in df.select(ieee_div(F.col("a"), F.col("b")).alias("d")).collect()]
    assert got[0] == math.inf and math.isnan(got[1]) and got[2] == -math.inf and got[3] == 2.0 and math.isnan(got[4])


def test_rekey_refuses_ids_beyond_the_stride(spark):
    df = series(spark, [0.0], 1001, 1).union(series(spark, [0.0], 1, 2))
    with pytest.raises(Exception, match="does not fit the stride 1000"):
        labels.rekey_units(df, ONE, 1000).collect()
    assert labels.unit_stride(df, spec=ONE) == 10_000  # the least that fits, where none is stated
    assert sorted(r.unit_number for r in labels.rekey_units(df, ONE).collect()) == [11_001, 20_001]


def test_unlabelled_units_keep_their_rows(spark):
    df = series(spark, [0.0, 0.0], 1).union(series(spark, [0.0], 2))
    lines = spark.createDataFrame([(1, 1, 10)], "subset int, line_no long, rul long")
    assert sorted(((r.unit_number, r.RUL) for r in labels.label_rul_test(df, lines, ONE).collect()), key=repr) == [
        (1, 10), (1, 11), (2, None)]
    assert labels.check_label_count(df, lines, ONE).filter("not matches").count() == 1


def test_feedback_ids_tell_records_apart(spark):
    from wearline.streaming.feedback import feedback_enrich, split_future
    rows = [("a", 1, 1.0, 2.0), ("a", 1, 1.5, 2.0), (None, 1, 1.0, 2.0), (None, 2, 1.0, 2.0), ("a", 1, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "prediction_id string, engine_id long, actual_rul double, predicted_rul double")
    df = df.withColumn("feedback_timestamp", F.lit("2024-01-01").cast("timestamp"))
    assert len({r.feedback_id for r in feedback_enrich(df).collect()}) == 4
    later = df.withColumn("feedback_timestamp", F.lit("2999-01-01").cast("timestamp"))
    now, future = split_future(df.union(later))
    assert (now.count(), future.count()) == (5, 5)


def test_rekey_leaves_other_groups(spark):
    df = series(spark, [0.0], 5, 2).union(series(spark, [0.0], 5, 9))
    assert sorted(r.unit_number for r in labels.rekey_units(df, ONE).collect()) == [5, 2005]


def test_entity_prefix_truncates_doubles(spark):
    df = spark.range(1, 23).select(F.col("id").alias("unit_number"))
    assert int(22 * (15 / 22)) == 14
    assert select.entity_prefix(df, 15 / 22).count() == 14
    assert [r.unit_number for r in select.entity_prefix(df, 0.001).collect()] == [1]


def test_retrain_fraction(spark):
    train = spark.range(1, 11).select(F.col("id").alias("unit_number"))
    fb = spark.createDataFrame([(4,), (7,)], "engine_id long")
    assert select.retrain_fraction(train, fb).first().fraction == 0.7
    assert select.retrain_fraction(train.limit(0), fb).first().fraction == 1.0


def test_versions(spark):
    df = spark.createDataFrame([(None,), ("1.0",), ("x",), ("1.2.3",), ("4.7",), ("2.y",)], "version string")
    assert [r.next_version for r in next_model_version(df).collect()] == ["1.0", "2.0", "1.0", "1.0", "5.7", "1.0"]


def test_iso_times(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00Z",), ("2024-01-01T10:00:00",), ("2024-01-01T12:00:00+02:00",),
                                ("2024",), ("soon",), ("",), (None,)], "t string")
    got = [r.u for r in df.select(F.unix_seconds(iso_timestamp(F.col("t"))).alias("u")).collect()]
    assert got == [1704103200, 1704103200, 1704103200, None, None, None, None]


def test_accuracy_of_nothing(spark):
    row = metrics.accuracy_summary(spark.createDataFrame([], "actual_rul double, predicted_rul double")).first()
    assert row.total_feedback_entries == 0 and row.message == "No feedback data available" and row.max_error is None


@pytest.mark.parametrize("times,cooldown,want", [
    ([0, 10, 29, 30, 45, 61], 30, [0, 30, 61]),
    ([0, 0, 1], 30, [0]),
    ([5, 100, 131, 140, 161], 30, [5, 100, 131, 161]),
    (list(range(0, 300, 7)), 30, None),
])
def test_cooldown(spark, times, cooldown, want):
    df = spark.createDataFrame([("a", t) for t in times] + [("b", 3)], "model_key string, s long").select(
        "model_key", F.timestamp_seconds("s").alias("ts"))
    if want is None:
        want, ready = [], -1
        for t in times:
            if t >= ready:
                want.append(t)
                ready = t + cooldown
    got = accepted_triggers(df, cooldown_s=cooldown).select("model_key", F.unix_seconds("ts").alias("s")).collect()
    assert sorted(r.s for r in got if r.model_key == "a") == want
    assert [r.s for r in got if r.model_key == "b"] == [3]


def test_window_edges_are_half_open(spark):
    df = spark.createDataFrame([(0, 1.0), (60, 2.0)], "s long, v double").select(F.timestamp_seconds("s").alias("ts"), "v")
    out = windows.sliding(df, "ts", 60, 60, (), {"n": F.lit(1)}).orderBy("window_start").collect()
    assert [r.n for r in out] == [1, 1]
    twice = windows.sliding(df, "ts", 60, 30, (), {"n": F.lit(1)})
    assert twice.agg(F.sum("n")).first()[0] == 4


def test_alert_intervals(spark):
    flags = [0, 1, 1, 0, None, 1, 0, 0, 1, 1]
    log = spark.createDataFrame([("m", i, f) for i, f in enumerate(flags)], "k string, s long, f int").select(
        "k", F.timestamp_seconds("s").alias("ts"), "f")
    got = windows.alert_intervals(log, "k", "ts", "f").select(F.unix_seconds("started"), F.unix_seconds("ended")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 2), (5, 5), (8, 9)]


def test_spearman_with_ties_and_missing(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"y": rng.integers(0, 20, 400).astype(float), "c": 3.0})
    pdf["a"] = pdf.y * 2 + rng.normal(0, 5, 400)
    pdf["b"] = -np.round(pdf.y / 3)
    pdf.loc[::7, "a"] = np.nan
    got = {r.feature: r.rho for r in ranking.spearman(spark.createDataFrame(pdf), ["a", "b", "c"], "y").collect()}
    for f in ("a", "b"):
        both = pdf[[f, "y"]].dropna().rank()
        assert got[f] == pytest.approx(both[f].corr(both["y"]), abs=1e-12)
    assert got["c"] is None


def test_request_classes(spark):
    rows = [(None, "bad_input"), ("[1]", "validation_error"), ('{"rows": 3}', "validation_error"), ('{"rows": []}', "validation_error"),
            ('{"rows": [{"a": 1}]}', "missing_features"), ('{"rows": [{"a": 1}, {"b": 2}]}', "success"),
            ('{"rows": [{"a": "x", "b": 2}]}', "validation_error"), ('{"rows": [{"a": 1, "b": 2, "z": 0}]}', "success")]
    df = spark.createDataFrame(rows, "value string, want string")
    for r in rq.classify_requests(df, ["a", "b"]).collect():
        assert r.outcome == r.want, r
    none = rq.classify_requests(df, ["a", "b"], has_model=False).filter("value is not null")
    assert {r.outcome for r in none.collect()} == {"no_model"}


def test_payload_rows(spark):
    df = spark.createDataFrame([(1, '{"rows": [{"a": 1.5, "x": 2}, {"a": null}]}')], "id int, value string")
    got = rq.rows_payload_to_df(df, T.StructType([T.StructField("a", T.DoubleType())]), keep=("id",)).collect()
    assert [r.a for r in got] == [1.5, None]
    assert rq.missing_columns(df, ["id", "q", "p"]) == ["p", "q"]


def test_pool_ratios():
    ratios = pool_ratios()
    assert ratios[:2] == [0.1, 0.125] and len(ratios) == 37 and ratios[-1] == 1.0


def test_terminal_rows(spark):
    good = series(spark, [1.0, 2.0]).withColumn("RUL", F.lit(2) - F.col("time_cycles"))
    assert labels.check_terminal_row(good, ONE).count() == 0
    tied = good.withColumn("RUL", F.lit(0))
    assert labels.check_terminal_row(tied, ONE).first().n_min_rul == 2
    assert column(labels.last_row_per_unit(good, ONE), "s_1") == [2.0]
