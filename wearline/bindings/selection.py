"""Queries over entity sets, prefixes, samples, counts and accuracy."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearline.bindings import fixtures as fx
from wearline.bindings.registry import oracle, query
from wearline.functions import absolute_error, rounded
from wearline.operators import metrics, select
from wearline.spec import SPEC

ROW = "subset, unit_number, time_cycles"
GROUPS = (1, 2, 3, 4)


@query("split_by_subset", oracle("select subset as part, unit_number, time_cycles, s_2 from telemetry where split = 'train'",
                                 "telemetry"))
def _split(spark, sf):
    parts = select.split_by_subset(fx.split_of(spark, sf, "train"), GROUPS)
    return select.union_subsets(*[p.select(F.lit(g).alias("part"), "unit_number", "time_cycles", "s_2") for g, p in parts.items()])


@query("union_subsets", oracle(f"select {ROW} from telemetry where split = 'train'", "telemetry"))
def _union(spark, sf):
    parts = select.split_by_subset(fx.split_of(spark, sf, "train"), GROUPS)
    return select.union_subsets(*parts.values()).select(*SPEC.keys, "time_cycles")


@query("units_upto", oracle(f"select {ROW} from telemetry where split = 'test' and (subset, unit_number) <= (2, 10)", "telemetry"))
def _upto(spark, sf):
    return select.units_upto(fx.split_of(spark, sf, "test"), (2, 10)).select(*SPEC.keys, "time_cycles")


@query("recent_entities", oracle(f"""
select {ROW} from telemetry where split = 'test' and (subset, unit_number) in (
  select (subset, engine_id) from grouped_feedback where feedback_timestamp >= timestamp '2024-01-30 00:00:00')""",
                                 "telemetry", "grouped_feedback"))
def _recent(spark, sf):
    fb = fx.grouped_feedback(spark, sf).filter(F.col("feedback_timestamp") >= F.lit("2024-01-30 00:00:00").cast("timestamp"))
    return select.recent_entities(fx.split_of(spark, sf, "test"), fb).select(*SPEC.keys, "time_cycles")


@query("semi_join_entities", oracle(f"""
select {ROW} from telemetry where split = 'test' and (subset, unit_number) in (
  select (subset, unit_number) from telemetry where split = 'train')""", "telemetry"))
def _semi(spark, sf):
    train, test = fx.split_of(spark, sf, "train"), fx.split_of(spark, sf, "test")
    return select.semi_join_entities(test, train).select(*SPEC.keys, "time_cycles")


_SIDE_COLUMNS = ", ".join(SPEC.base)


@query("slice_baseline_current", oracle(f"""
select case when unit_number <= 5 then 'baseline' else 'current' end as side, {_SIDE_COLUMNS}
from telemetry where split = 'train'""", "telemetry"))
def _slices(spark, sf):
    train = fx.split_of(spark, sf, "train")
    units = select.distinct_units(train)
    low = F.col("unit_number") <= 5
    base, cur = select.slice_baseline_current(train, units.filter(low), units.filter(~low), SPEC.base)
    return base.select(F.lit("baseline").alias("side"), "*").unionByName(cur.select(F.lit("current").alias("side"), "*"))


@query("input_example", oracle("""
select setting_1, setting_2, s_2, s_7 from telemetry where split = 'train' order by subset, unit_number, time_cycles limit 1""",
                               "telemetry"))
def _example(spark, sf):
    return select.input_example(fx.split_of(spark, sf, "train"), ["setting_1", "setting_2", "s_2", "s_7"])


@query("select_model_features", oracle("select s_9, setting_1, s_2 from telemetry where split = 'test'", "telemetry"))
def _model_features(spark, sf):
    return select.select_model_features(fx.split_of(spark, sf, "test"), ["s_9", "setting_1", "s_2"])


@query("distinct_units", oracle("select distinct subset, unit_number from telemetry where split = 'train'", "telemetry"))
def _distinct(spark, sf):
    return select.distinct_units(fx.split_of(spark, sf, "train"))


@query("common_units", oracle("""
select subset, unit_number from telemetry where split = 'train'
intersect select subset, unit_number from telemetry where split = 'test'""", "telemetry"))
def _common(spark, sf):
    return select.common_units(fx.split_of(spark, sf, "train"), fx.split_of(spark, sf, "test"))


@query("row_prefix_fraction", oracle(f"""
select {ROW} from (
  select *, row_number() over (order by subset, unit_number, time_cycles) as rn, count(*) over () as n
  from telemetry where split = 'train') t
where rn <= floor(n * cast(0.37 as double))""", "telemetry"))
def _prefix(spark, sf):
    df = fx.split_of(spark, sf, "train")
    return select.row_prefix_fraction(df, 0.37, layout=fx.layout_of(df)).select(*SPEC.keys, "time_cycles")


@query("entity_prefix_fraction", oracle(
    "select split, subset, unit_number, time_cycles from telemetry join first_units using (subset, unit_number)", "telemetry",
    ctes=("""
units as (select subset, unit_number, row_number() over (order by subset, unit_number) as rn, count(*) over () as n
          from (select distinct subset, unit_number from telemetry where split = 'train') d),
first_units as (select subset, unit_number from units where rn <= greatest(1, floor(n * cast(0.29 as double))))""",)))
def _entity_prefix(spark, sf):
    a, b = select.entity_prefix_fraction(fx.split_of(spark, sf, "train"), fx.split_of(spark, sf, "test"), 0.29)
    both = a.withColumn("split", F.lit("train")).unionByName(b.withColumn("split", F.lit("test")))
    return both.select("split", *SPEC.keys, "time_cycles")


@query("retrain_fraction", oracle("""
select t.version, count(*) filter ((u.subset, u.unit_number) <= t.top) / cast(count(*) as double) as fraction
from (select distinct subset, unit_number from telemetry where split = 'train') u
cross join (
  select 'all' as version, max((subset, engine_id)) as top from grouped_feedback
  union all
  select 'first day', max((subset, engine_id)) from grouped_feedback where feedback_timestamp < timestamp '2024-01-02 00:00:00'
  union all
  select 'last hour', max((subset, engine_id)) from grouped_feedback where feedback_timestamp >= timestamp '2024-01-30 23:00:00') t
group by 1""", "telemetry", "grouped_feedback"))
def _retrain_fraction(spark, sf):
    train, fb = fx.split_of(spark, sf, "train"), fx.grouped_feedback(spark, sf)
    at = F.col("feedback_timestamp")
    spans = {"all": F.lit(True), "first day": at < F.lit("2024-01-02 00:00:00").cast("timestamp"),
             "last hour": at >= F.lit("2024-01-30 23:00:00").cast("timestamp")}
    return select.union_subsets(*[select.retrain_fraction(train, fb.filter(c)).withColumn("version", F.lit(v)) for v, c in spans.items()])


@query("sample_fraction", oracle(f"""
select {ROW} from (
  select *, row_number() over (order by md5(concat_ws(':', '42', subset, unit_number, time_cycles)), subset, unit_number, time_cycles) as rn,
         count(*) over () as n
  from telemetry where split = 'test') t
where rn <= round_even(n * cast(0.25 as double), 0)""", "telemetry"))
def _sample(spark, sf):
    return select.sample_fraction(fx.split_of(spark, sf, "test"), 0.25, 42, [*SPEC.keys, "time_cycles"]).select(
        *SPEC.keys, "time_cycles")


# -- counts and accuracy ------------------------------------------------------------------------

@query("entity_counts", oracle("""
select subset, count(distinct unit_number) as n_units, count(*) as n_rows from telemetry where split = 'train' group by 1""",
                               "telemetry"))
def _entity_counts(spark, sf):
    return metrics.entity_counts(fx.split_of(spark, sf, "train"))


@query("split_shares", oracle("""
select count(*) filter (split = 'train') as train_rows, count(*) filter (split = 'test') as test_rows,
       27 as train_columns, 27 as test_columns,
       count(*) filter (split = 'test') / cast(count(*) as double) * 100 as test_share from telemetry""", "telemetry"))
def _shares(spark, sf):
    return metrics.split_shares(fx.split_of(spark, sf, "train"), fx.split_of(spark, sf, "test"))


@query("rmse", oracle("""
select model_version, round(sqrt(avg((actual_rul - predicted_rul) * (actual_rul - predicted_rul))), 6) as rmse
from feedback group by 1""", "feedback"))
def _rmse(spark, sf):
    return metrics.rmse_by(fx.feedback(spark, sf), "actual_rul", "predicted_rul", ["model_version"]).withColumn(
        "rmse", rounded("rmse"))


@query("regression_metrics", oracle("""
select model_version, round(sqrt(avg((y - p) * (y - p))), 6) as rmse, round(avg(abs(y - p)), 6) as mae,
       round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 6) as r2, count(*) as n
from (select model_version, actual_rul as y, predicted_rul as p, avg(actual_rul) over (partition by model_version) as m
      from feedback) t group by 1""", "feedback"))
def _regression(spark, sf):
    out = metrics.regression_metrics(fx.feedback(spark, sf), "actual_rul", "predicted_rul", ["model_version"])
    return out.withColumns({c: rounded(c) for c in ("rmse", "mae", "r2")})


@query("accuracy_summary", oracle("""
select count(*) as total_feedback_entries, round(avg(e), 6) as mean_absolute_error, round(max(e), 6) as max_error,
       round(min(e), 6) as min_error, round(avg(case when e <= 0.1 * abs(actual_rul) then 1.0 else 0.0 end), 6)
         as accuracy_within_10_percent
from (select abs(predicted_rul - actual_rul) as e, actual_rul from feedback) t""", "feedback"))
def _accuracy(spark, sf):
    out = metrics.accuracy_summary(fx.feedback(spark, sf)).drop("message")
    return out.select("total_feedback_entries", *[rounded(c).alias(c) for c in out.columns[1:]])


@query("error_histogram", oracle("""
select le, count(*) filter (abs(predicted_rul - actual_rul) <= le) as n
from feedback cross join (select unnest([1.0, 2.5, 5.0, 10.0, 25.0, 50.0, 100.0]::double[]) as le) b group by 1""", "feedback"))
def _histogram(spark, sf):
    return metrics.error_histogram(fx.feedback(spark, sf), absolute_error("actual_rul", "predicted_rul"),
                                   (1.0, 2.5, 5.0, 10.0, 25.0, 50.0, 100.0))


@query("pair_actual_predicted", oracle("""
select coalesce(p.prediction_id, a.prediction_id) as prediction_id, predicted_rul, actual_rul,
       p.prediction_id is not null and a.prediction_id is not null as paired
from (select prediction_id, predicted_rul from feedback where engine_id % 10 <> 3) p
full join (select prediction_id, actual_rul from feedback where engine_id % 10 <> 7) a
  on p.prediction_id = a.prediction_id""", "feedback"))
def _pair(spark, sf):
    fb = fx.feedback(spark, sf)
    return metrics.pair_actual_predicted(
        fb.filter(F.col("engine_id") % 10 != 3).select("prediction_id", "predicted_rul"),
        fb.filter(F.col("engine_id") % 10 != 7).select("prediction_id", "actual_rul"))
