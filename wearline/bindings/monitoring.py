"""Queries over time windows, logs and trigger gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.bindings import fixtures as fx
from wearline.bindings.registry import oracle, query
from wearline.functions import rounded
from wearline.operators import monitor, windows
from wearline.streaming.feedback import feedback_enrich, feedback_late_and_bad
from wearline.streaming.retrain import accepted_triggers

DAY, QUARTER = 86_400, 21_600


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the oracle returns them."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp"
                       else F.col(f.name) for f in df.schema])


def windowed_sql(source: str, ts: str, by: str, aggregates: str, window_s: int = DAY, slide_s: int = QUARTER) -> str:
    """[start, end) windows aligned to the slide, each row copied into its windows."""
    keys = f"{by}, " if by else ""
    return f"""
select start as window_start, start + to_seconds({window_s}) as window_end, {keys}{aggregates}
from (select *, unnest(list_transform(range(0, {window_s // slide_s}), lambda i:
        make_timestamp((epoch_us({ts}) // {slide_s * 1_000_000}) * {slide_s * 1_000_000} - i * {slide_s * 1_000_000}))) as start
      from {source}) w
group by start{', ' + by if by else ''}"""


RMSE_SQL = "sqrt(sum((actual_rul - predicted_rul) * (actual_rul - predicted_rul)) / count(*))"


@query("trailing_window_rmse", oracle(windowed_sql(
    "feedback", "feedback_timestamp", "",
    f"count(*) as n_feedback, max(engine_id) as max_engine, round({RMSE_SQL}, 6) as rmse"), "feedback"))
def _trailing_rmse(spark, sf):
    out = windows.trailing_window_rmse(fx.feedback(spark, sf), DAY, QUARTER)
    return plain_times(out.withColumn("rmse", rounded("rmse")))


@query("trailing_window_entities", oracle(
    f"select window_start, window_end, engine_id from ({windowed_sql('feedback', 'feedback_timestamp', 'engine_id', 'count(*) as n')}) t",
    "feedback"))
def _trailing_entities(spark, sf):
    return plain_times(windows.trailing_window_entities(fx.feedback(spark, sf), DAY, QUARTER))


@query("feedback_enrich", oracle(f"""
select prediction_id, engine_id, feedback_timestamp, {fx.RECORD_ID_SQL} as feedback_id,
       abs(predicted_rul - actual_rul) as error from feedback""", "feedback"))
def _enrich(spark, sf):
    return plain_times(feedback_enrich(fx.feedback(spark, sf)).select(
        "prediction_id", "engine_id", "feedback_timestamp", "feedback_id", "error"))


@query("feedback_late_and_bad", f"""
select event_id, cast(ts as timestamp) as feedback_timestamp
from events where event_id % 10 > 2""")
def _late_and_bad(spark, sf):
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zoned = F.concat(stamp, F.when(F.col("event_id") % 2 == 0, "Z").otherwise(""))
    k = F.col("event_id") % 10
    text = F.when(k == 1, "soon").when(k == 2, "2024-13-40T00:00:00Z").when(k > 2, zoned)
    kept, _ = feedback_late_and_bad(fx.table(spark, sf, "events").select("event_id", text.alias("feedback_timestamp")))
    return plain_times(kept)


@query("feedback_dropped", """
select case when event_id % 10 = 0 then 'missing' else 'unparsable' end as reason, count(*) as n_dropped
from events where event_id % 10 <= 2 group by 1""")
def _dropped(spark, sf):
    k = F.col("event_id") % 10
    text = F.when(k == 1, "soon").when(k == 2, "2024-13-40T00:00:00Z").when(k > 2, "2024-01-01T00:00:00")
    _, dropped = feedback_late_and_bad(fx.table(spark, sf, "events").select("event_id", text.alias("feedback_timestamp")))
    return dropped


@query("retrain_trigger", oracle("select * from accepted", "triggers", recursive=True, ctes=("""
accepted as (
  select model_key, min(ts) as ts from triggers group by 1
  union all
  select t.model_key, min(t.ts) as ts from accepted a join triggers t
    on t.model_key = a.model_key and t.ts >= a.ts + interval 6 hours group by t.model_key)""",)))
def _retrain_trigger(spark, sf):
    return plain_times(accepted_triggers(fx.triggers(spark, sf), cooldown_s=QUARTER))


# -- monitoring ------------------------------------------------------------------------------

def _rate_sql(where: str, by: str, amount: str) -> str:
    body = windowed_sql(f"(select * from requests where {where}) s", "ts", by,
                        f"cast({amount} as bigint) as events, {amount} / 86400.0::double as rate")
    return oracle(body, "requests")


def _rates(df):
    return plain_times(df)


@query("prediction_rate_by_version", _rate_sql("status = 'success'", "model_version", "sum(n_rows)"))
def _prediction_rate(spark, sf):
    return _rates(monitor.prediction_rate_by_version(fx.requests(spark, sf), DAY, QUARTER))


@query("success_call_rate", _rate_sql("status = 'success'", "", "count(*)"))
def _success_rate(spark, sf):
    return _rates(monitor.success_call_rate(fx.requests(spark, sf), DAY, QUARTER))


@query("error_rate_by_type", _rate_sql("error_type is not null", "error_type", "count(*)"))
def _error_rate(spark, sf):
    return _rates(monitor.error_rate_by_type(fx.requests(spark, sf), DAY, QUARTER))


@query("retrain_events", oracle(windowed_sql("registry", "trained_at", "", "count(*) as n_runs", DAY, DAY), "registry"))
def _retrain_events(spark, sf):
    return plain_times(monitor.retrain_events(fx.registry(spark, sf), "trained_at", DAY))


DRIFT_LOG_CTES = (
    f"windows as ({windowed_sql('feedback', 'feedback_timestamp', '', f'{RMSE_SQL} as rmse')})", """
drift_log as (select 'all' as log, window_start as check_time, rmse as current_rmse, 15.0::double as baseline_rmse,
                     case when rmse > 15 * 1.1::double then 1.0::double else 0.0 end as rmse_flag from windows)""")


def drift_log(spark, sf):
    """Checks over sliding feedback windows, one row each."""
    w = windows.trailing_window_rmse(fx.feedback(spark, sf), DAY, QUARTER)
    return w.select(F.lit("all").alias("log"), F.col("window_start").alias("check_time"),
                    F.col("rmse").alias("current_rmse"), F.lit(15.0).alias("baseline_rmse"),
                    F.when(F.col("rmse") > F.lit(15.0) * 1.1, 1.0).otherwise(0.0).alias("rmse_flag"))


@query("drift_series", oracle(windowed_sql(
    "drift_log", "check_time", "", "round(min(current_rmse), 6) as current_rmse, min(baseline_rmse) as baseline_rmse, "
    "min(rmse_flag) as rmse_flag", DAY, DAY), "feedback", ctes=DRIFT_LOG_CTES))
def _drift_series(spark, sf):
    out = monitor.drift_series(drift_log(spark, sf), ("current_rmse", "baseline_rmse", "rmse_flag"), window_s=DAY)
    return plain_times(out.withColumn("current_rmse", rounded("current_rmse")))


@query("alert_intervals", oracle("""
select log, min(check_time) as started, max(check_time) as ended
from (select *, row_number() over (order by check_time) - row_number() over (partition by rmse_flag order by check_time) as island
      from drift_log) t where rmse_flag > 0 group by log, island""", "feedback", ctes=DRIFT_LOG_CTES))
def _alert_intervals(spark, sf):
    return plain_times(windows.alert_intervals(drift_log(spark, sf), "log", "check_time", "rmse_flag"))


@query("model_change_points", oracle("""
select request_id, ts, model_version, previous
from (select *, lag(model_version) over (order by ts) as previous from requests) t
where previous <> model_version""", "requests"))
def _change_points(spark, sf):
    log = fx.requests(spark, sf).withColumn("service", F.lit("prediction"))
    return plain_times(windows.change_points(log, "service", "ts", "model_version").select(
        "request_id", "ts", "model_version", "previous"))


@query("model_reload_log", oracle("""
select status, model_version, count(*) as n_reloads, max(ts) as last_reload from requests group by 1, 2""", "requests"))
def _reloads(spark, sf):
    return plain_times(monitor.model_reload_log(fx.requests(spark, sf)))


@query("latency_summary", oracle("""
select model_version, count(*) as n_calls, round(sum(duration_seconds), 6) as total_seconds,
       quantile_disc(duration_seconds, 0.5) as p50, quantile_disc(duration_seconds, 0.95) as p95,
       quantile_disc(duration_seconds, 0.99) as p99 from requests group by 1""", "requests"))
def _latency(spark, sf):
    return monitor.latency_summary(fx.requests(spark, sf), "duration_seconds").withColumn(
        "total_seconds", rounded("total_seconds"))


@query("latency_histogram", oracle("""
select model_version, le, count(*) filter (duration_seconds <= le) as n
from requests cross join (select unnest([0.01, 0.05, 0.1, 0.25]::double[]) as le) b group by 1, 2""", "requests"))
def _latency_histogram(spark, sf):
    return monitor.latency_histogram(fx.requests(spark, sf), "duration_seconds", (0.01, 0.05, 0.1, 0.25))
