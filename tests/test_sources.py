"""Files in and out."""

from __future__ import annotations

import json

import pytest

from wearline.sources import feedback as fb
from wearline.sources import models, telemetry
from wearline.spec import TelemetrySpec

SPEC = TelemetrySpec(settings=("setting_1",), sensors=("s_1", "s_2"))


def test_text_and_labels(spark, tmp_path):
    (tmp_path / "train_FD002.txt").write_text(" 1   1  0.5 \t 10.0 20.0  \n\n1 2 -1e-3 11 21 99 98\n2 1 0.25 7.5\n")
    rows = {(r.unit_number, r.time_cycles): r for r in telemetry.read_telemetry_text(spark, str(tmp_path), SPEC).collect()}
    assert len(rows) == 3 and {r.subset for r in rows.values()} == {2}
    assert rows[1, 1].s_2 == 20.0 and rows[1, 2].setting_1 == -0.001 and rows[1, 2].s_2 == 21.0 and rows[2, 1].s_2 is None
    folder = tmp_path / "labels"
    folder.mkdir()
    (folder / "RUL_FD003.txt").write_text("112 \n98\n\n69\n")
    got = sorted(tuple(r) for r in telemetry.read_rul_labels(spark, str(folder), SPEC).collect())
    assert got == [(3, 1, 112), (3, 2, 98), (3, 3, 69)]


def test_label_lines_over_several_splits(spark, tmp_path):
    (tmp_path / "RUL_FD001.txt").write_text("".join(f"{i * 3}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = telemetry.read_rul_labels(spark, str(tmp_path), SPEC)
        assert df.filter("rul != (line_no - 1) * 3").count() == 0 and df.count() == 5000
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_text_that_is_no_number_fails(spark, tmp_path):
    (tmp_path / "train_FD001.txt").write_text("1 1 0.5 x 20\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        telemetry.read_telemetry_text(spark, str(tmp_path), SPEC).collect()


def test_feedback_lines(spark, tmp_path):
    def rec(**kw):
        return json.dumps({"prediction_id": "p", "predicted_rul": 1.0, "actual_rul": 2, "engine_id": "7",
                           "prediction_timestamp": "2024-01-01T00:00:00", "metadata": {"u": 1, "t": True}} | kw)
    lines = ["", "{broken", rec(), rec(feedback_timestamp="yesterday"), rec(feedback_timestamp="2024-01-01T00:00:00Z"),
             rec(feedback_timestamp="2024-01-01T00:00:01")]
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    kept = fb.read_feedback_lenient(spark, str(tmp_path)).orderBy("feedback_timestamp").collect()
    assert [r.engine_id for r in kept] == [7, 7] and kept[0].metadata == {"u": "1", "t": "true"}
    reasons = sorted(r.reason for r in fb.feedback_rejects(spark, str(tmp_path)).collect())
    assert reasons == ["bad_json", "bad_timestamp", "no_timestamp"]
    with pytest.raises(Exception):
        fb.read_feedback_strict(spark, str(tmp_path)).collect()


def test_named_error_without_a_model(spark, tmp_path):
    with pytest.raises(models.ModelNotFound):
        models.load_model_bundle(spark, str(tmp_path), "none")
    assert models.version_after(models.read_registry(spark, str(tmp_path)), "none") == "1.0"
