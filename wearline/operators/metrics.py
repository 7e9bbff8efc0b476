"""Accuracy metrics, counts and histograms as grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearline.functions import absolute_error, rmse
from wearline.spec import SPEC, TelemetrySpec

# Default upper bounds of a duration or error histogram.
DEFAULT_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0, float("inf"))

# Fixed value: the message of an accuracy summary without records.
NO_FEEDBACK = "No feedback data available"


def rmse_by(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(rmse(actual, predicted).alias("rmse"))


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and R2. The spread of the actual values is taken around their mean, found first."""
    y, p = F.col(actual), F.col(predicted)
    means = df.groupBy(*by).agg(F.avg(y).alias("_mean"))
    rows = df.join(means, list(by)) if by else df.crossJoin(F.broadcast(means))  # one row of means without keys
    out = rows.groupBy(*by).agg(
        rmse(actual, predicted).alias("rmse"), F.avg(F.abs(y - p)).alias("mae"),
        F.sum((y - p) * (y - p)).alias("_rss"), F.sum((y - F.col("_mean")) * (y - F.col("_mean"))).alias("_tss"),
        F.count(F.lit(1)).alias("n"))
    return out.withColumn("r2", 1 - F.try_divide("_rss", "_tss")).drop("_rss", "_tss")


def accuracy_summary(df: DataFrame, actual: str = "actual_rul", predicted: str = "predicted_rul") -> DataFrame:
    """Feedback accuracy; an empty input gives one row with a message and NULL metrics."""
    err = absolute_error(actual, predicted)
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("total_feedback_entries"), F.avg(err).alias("mean_absolute_error"), F.max(err).alias("max_error"),
        F.min(err).alias("min_error"),
        F.avg(F.when(err <= 0.1 * F.abs(F.col(actual)), 1.0).otherwise(0.0)).alias("accuracy_within_10_percent"),
        F.when(n == 0, NO_FEEDBACK).alias("message"))


def error_histogram(df: DataFrame, value: Column, bounds: Sequence[float] = DEFAULT_BOUNDS,
                    by: Sequence[str] = ()) -> DataFrame:
    """Cumulative counts of `value` up to each bound: one pass, one short array per group."""
    counts = F.array(*[F.struct(F.lit(float(b)).alias("le"), F.count_if(value <= b).alias("n")) for b in bounds])
    return (df.groupBy(*by).agg(counts.alias("_h")).select(*by, F.explode("_h").alias("_b"))
            .select(*by, "_b.le", "_b.n"))


def entity_counts(df: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    """Distinct entities and rows per group: entities are combined before the distinct count."""
    per_entity = df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_entity.groupBy(spec.group).agg(F.count(F.lit(1)).alias("n_units"), F.sum("_n").alias("n_rows"))


def split_shares(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows and columns per split and the test percentage."""
    a = train.agg(F.count(F.lit(1)).alias("train_rows"))
    b = test.agg(F.count(F.lit(1)).alias("test_rows"))
    total = F.col("train_rows") + F.col("test_rows")
    return a.crossJoin(b).select(
        "train_rows", "test_rows", F.lit(len(train.columns)).alias("train_columns"),
        F.lit(len(test.columns)).alias("test_columns"),
        (F.try_divide(F.col("test_rows"), total) * 100).alias("test_share"))


def backtest_summary(points: DataFrame) -> DataFrame:
    """Least, greatest and last RMSE of a backtest, and its length."""
    return points.agg(F.min("rmse").alias("min_rmse"), F.max("rmse").alias("max_rmse"),
                      F.max_by("rmse", "ratio").alias("final_rmse"), F.count(F.lit(1)).alias("n_points"))


def pair_actual_predicted(predictions: DataFrame, actuals: DataFrame, key: str = "prediction_id") -> DataFrame:
    """Predictions with the actual values that arrive for them; `paired` is false where either side is missing."""
    a, b = predictions.withColumn("_p", F.lit(True)), actuals.withColumn("_a", F.lit(True))
    return (a.join(b, key, "full")
            .withColumn("paired", F.coalesce(F.col("_p") & F.col("_a"), F.lit(False))).drop("_p", "_a"))
