"""Monitoring queries: rates, counts and distributions over event logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.operators.metrics import DEFAULT_BOUNDS, error_histogram
from wearline.operators.windows import sliding

RATE_SECONDS = 30
EVENT_SECONDS = 10


def event_rate(log: DataFrame, ts: str, by: Sequence[str], amount: str | None = None, window_s: int = RATE_SECONDS,
               slide_s: int | None = None) -> DataFrame:
    """Events (or the sum of `amount`) per second in each window and key."""
    each = F.lit(1) if amount is None else F.col(amount)
    out = sliding(log, ts, window_s, slide_s or window_s, by, {"events": each})
    return out.withColumn("rate", F.col("events") / F.lit(float(window_s)))


def prediction_rate_by_version(calls: DataFrame, window_s: int = RATE_SECONDS, slide_s: int | None = None) -> DataFrame:
    """Predicted rows per second of successful calls, by model version."""
    return event_rate(calls.filter("status = 'success'"), "ts", ("model_version",), "n_rows", window_s, slide_s)


def success_call_rate(calls: DataFrame, window_s: int = RATE_SECONDS, slide_s: int | None = None) -> DataFrame:
    return event_rate(calls.filter("status = 'success'"), "ts", (), None, window_s, slide_s)


def error_rate_by_type(calls: DataFrame, window_s: int = RATE_SECONDS, slide_s: int | None = None) -> DataFrame:
    return event_rate(calls.filter("error_type is not null"), "ts", ("error_type",), None, window_s, slide_s)


def retrain_events(runs: DataFrame, ts: str, window_s: int = EVENT_SECONDS) -> DataFrame:
    """Windows in which at least one training run was logged."""
    return sliding(runs, ts, window_s, window_s, (), {"n_runs": F.lit(1)}).filter(F.col("n_runs") > 0)


def drift_series(log: DataFrame, gauges: Sequence[str], ts: str = "check_time", window_s: int = 15) -> DataFrame:
    """Least value of each gauge per window."""
    return sliding(log, ts, window_s, window_s, (), minima={g: F.col(g) for g in gauges})


def model_reload_log(log: DataFrame, ts: str = "ts") -> DataFrame:
    """Reloads and the last reload time by status and version."""
    return log.groupBy("status", "model_version").agg(F.count(F.lit(1)).alias("n_reloads"), F.max(ts).alias("last_reload"))


def latency_histogram(calls: DataFrame, duration: str, bounds: Sequence[float] = DEFAULT_BOUNDS) -> DataFrame:
    """Cumulative duration counts per version."""
    return error_histogram(calls, F.col(duration), bounds, ("model_version",))


def latency_summary(calls: DataFrame, duration: str, points: Sequence[float] = (0.5, 0.95, 0.99),
                    accuracy: int = 10_000) -> DataFrame:
    """Count, sum and approximate percentiles of the duration per version."""
    return calls.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("n_calls"), F.sum(duration).alias("total_seconds"),
        *[F.percentile_approx(duration, p, accuracy).alias(f"p{round(p * 100)}") for p in points])
