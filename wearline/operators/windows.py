"""Sliding time windows over event tables, and gaps-and-islands over gauge logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearline.operators.series import add_position, add_windows, plan_series

SUM, MAX, MIN = F.sum, F.max, F.min


def sliding(df: DataFrame, ts: str, window_s: int, slide_s: int, by: Sequence[str], sums: dict[str, Column] | None = None,
            maxima: dict[str, Column] | None = None, minima: dict[str, Column] | None = None) -> DataFrame:
    """Sums, maxima and minima per [start, end) window aligned to the slide.

    Rows are combined per slide first, and only those few pane rows are copied into their windows.
    `window_s` must be a multiple of `slide_s`.
    """
    if window_s % slide_s:
        raise ValueError("the window must be a multiple of the slide")
    parts = [(F.sum, sums or {}), (F.max, maxima or {}), (F.min, minima or {})]
    pane = pane_start(F.col(ts), slide_s)
    panes = df.groupBy(*by, pane.alias("_pane")).agg(*[f(c).alias(n) for f, cols in parts for n, c in cols.items()])
    starts = F.array(*[F.col("_pane") - F.lit(i * slide_s) for i in range(window_s // slide_s)])
    copies = panes.withColumn("_start", F.explode(starts))
    out = copies.groupBy(*by, "_start").agg(*[f(n).alias(n) for f, cols in parts for n in cols])
    return out.select(F.timestamp_seconds("_start").alias("window_start"),
                      F.timestamp_seconds(F.col("_start") + window_s).alias("window_end"),
                      *by, *[n for _, cols in parts for n in cols])


def pane_start(ts: Column, slide_s: int) -> Column:
    """Start of the slide a timestamp falls in, in epoch seconds."""
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(slide_s * 1_000_000)) * slide_s


def trailing_window_rmse(feedback: DataFrame, window_s: int = 60, slide_s: int = 15) -> DataFrame:
    """RMSE of the feedback in each window: the batch twin of the streaming aggregate."""
    err = F.col("actual_rul") - F.col("predicted_rul")
    out = sliding(feedback, "feedback_timestamp", window_s, slide_s, (),
                  {"n_feedback": F.lit(1), "_sse": err * err}, {"max_engine": F.col("engine_id")})
    return out.withColumn("rmse", F.sqrt(F.col("_sse") / F.col("n_feedback"))).drop("_sse")


def trailing_window_entities(feedback: DataFrame, window_s: int = 60, slide_s: int = 15) -> DataFrame:
    """The distinct engines of each window, one row per (window, engine), which other tables can join."""
    seen = sliding(feedback, "feedback_timestamp", window_s, slide_s, ("engine_id",), {"n_feedback": F.lit(1)})
    return seen.select("window_start", "window_end", "engine_id")


def change_points(log: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """Rows whose value differs from the row before it in its key's time order."""
    layout = plan_series(log, (key,), ts)
    previous = add_windows(log, layout, 1, lambda rows, w: rows.withColumn("previous", F.lag(value).over(w)))
    return previous.filter(F.col("previous") != F.col(value))


def alert_intervals(log: DataFrame, key: str, ts: str, flag: str) -> DataFrame:
    """Runs of consecutive raised flags: first and last time of each run, per key.

    The n-th rise and the n-th fall of a key belong together; a run still raised at the end of the
    log ends at its last row. Only the rises and falls are numbered, not the log.
    """
    raised = F.coalesce(F.col(flag) > 0, F.lit(False))
    rows = log.select(key, F.col(ts).alias("_ts"), raised.alias("_on"))
    steps = add_windows(rows, plan_series(rows, (key,), "_ts"), 1, lambda r, w: r.withColumns(
        {"_was": F.coalesce(F.lag("_on").over(w), F.lit(False)), "_before": F.lag("_ts").over(w)}))
    rises = steps.filter(F.col("_on") & ~F.col("_was")).select(key, "_ts")
    falls = steps.filter(~F.col("_on") & F.col("_was")).select(key, F.col("_before").alias("_ts"))
    last = rows.groupBy(key).agg(F.max_by("_on", "_ts").alias("_on"), F.max("_ts").alias("_ts"))
    falls = falls.unionByName(last.filter("_on").select(key, "_ts"))

    def numbered(df: DataFrame, name: str) -> DataFrame:
        return add_position(df, plan_series(df, (key,), "_ts"), ["_ts"], "_run").withColumnRenamed("_ts", name)

    return numbered(rises, "started").join(numbered(falls, "ended"), [key, "_run"]).drop("_run")
