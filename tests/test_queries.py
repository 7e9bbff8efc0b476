"""The registered queries: consistent registration, and a cross-section against DuckDB at the smallest scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SMALL = "/root/testdata/sf0.001"
SECTION = ("label_rul_test", "last_row_per_unit", "row_prefix_fraction", "entity_prefix_fraction", "rolling_mean",
           "ks", "psi", "trailing_window_rmse", "trailing_window_rmse_stream", "retrain_trigger", "alert_intervals",
           "read_feedback_lenient", "classify_requests", "group_kfold", "check_terminal_row")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
@pytest.mark.parametrize("name", SECTION)
def test_against_sql(spark, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    assert compare(got, connect(SMALL).execute(entry.oracle_sql()[name]).df()) is None
