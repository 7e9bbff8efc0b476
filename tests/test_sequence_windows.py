"""Fixed-length windows against a plain loop, and without a list that is filled anew for every row."""

from __future__ import annotations

import math

from wearline.operators.sequences import sequence_windows
from wearline.operators.series import plan_series
from wearline.spec import TelemetrySpec

SPEC = TelemetrySpec(settings=(), sensors=("s_1", "s_2"))


def test_windows_are_those_of_a_loop(spark):
    rows = [(1, u, t, None if (u + t) % 7 == 0 else float(u * 100 + t), math.nan if t % 11 == 5 else -float(t))
            for u, n in ((1, 1), (2, 3), (3, 4), (4, 700)) for t in range(1, n + 1)]
    df = spark.createDataFrame(rows, "subset int, unit_number long, time_cycles long, s_1 double, s_2 double").repartition(3)
    by = {(r[1], r[2]): list(r[3:]) for r in rows}
    for layout in (None, plan_series(df, SPEC.keys, SPEC.order, rows_per_block=100)):
        out = sequence_windows(df, SPEC.sensors, 4, -1.0, SPEC, layout)
        assert out.columns == [*df.columns, "sequence"]
        # A cut layout lists the few blocks that follow a slice.
        assert layout or "collect_list" not in out._jdf.queryExecution().toString()
        got = out.collect()
        assert len(got) == len(rows)
        for r in got:
            want = [by.get((r.unit_number, t), [-1.0, -1.0]) for t in range(r.time_cycles - 3, r.time_cycles + 1)]
            assert str(r.sequence) == str(want)  # NaN and NULL differ
    assert sequence_windows(df.limit(0), SPEC.sensors, 4, 0.0, SPEC).collect() == []
