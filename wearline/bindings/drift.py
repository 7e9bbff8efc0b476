"""Queries over drift statistics and the drift check."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearline.bindings import fixtures as fx
from wearline.bindings.features import FEATURED_CTES
from wearline.bindings.ready import derived_tables
from wearline.bindings.registry import oracle, query
from wearline.functions import rounded
from wearline.operators import drift, features
from wearline.plans.drift_check import Baseline, drift_check, kept_baseline, recent_feedback
from wearline.session import fresh_path, stored

PHYSICAL = [n for names in features.PHYSICAL_NAMES.values() for n in names]
ALL_FEATURES = features.feature_names()


def long_ctes(columns: list[str], source: str) -> tuple[str, ...]:
    """`cells` (feature, value, side 0/1) from `source`, which has the columns and `side`."""
    cols = ", ".join(columns)
    return (f"cells as (select side, feature, value from (unpivot (select side, {cols} from {source}) on {cols} "
            "into name feature value value) u where value is not null and not isnan(value))",)


# Interpolated quantiles with the same additions and multiplications as the operator.
EDGE_CTES = ("""
ordered as (select feature, list(value order by value) as l, count(*) as n from cells where side = 0 group by 1)""", """
ranked as (select feature, n, l, i, (n - 1) * (cast(i as double) / 10.0::double) as h
           from ordered cross join (select unnest(range(0, 11)) as i) r)""", """
ends as (select feature, i, h - floor(h) as t, l[cast(floor(h) as bigint) + 1] as a,
                l[least(cast(floor(h) as bigint) + 1, n - 1) + 1] as b from ranked)""", """
quantiles as (select feature, list(case when t >= 0.5 then b - (b - a) * (1.0::double - t) else a + (b - a) * t end
                order by i) as q from ends group by 1)""", """
edges as (select feature, case when len(list_distinct(q)) = 11 then q else
            list_transform(range(0, 11), lambda i: case when i = 10 then q[11] else q[1] + i * ((q[11] - q[1]) / 10.0::double) end)
            end as e from quantiles)""")

PSI_CTES = (*EDGE_CTES, """
bins as (select feature, len(list_filter(e[1:10], lambda x: x <= value)) - 1 as bin,
                count(*) filter (side = 0) as b, count(*) filter (side = 1) as c
         from cells join edges using (feature) where value >= e[1] and value <= e[11] group by 1, 2)""", """
shares as (select feature, bin, b / cast(sum(b) over f as double) as pb,
                  coalesce(c / nullif(cast(sum(c) over f as double), 0), 0) as pc
           from bins window f as (partition by feature))""", """
psi as (select feature, sum((pb - pc) * ln((pb + 1e-6) / (pc + 1e-6))) as psi from shares group by 1)""")

KS_CTES = ("""
steps as (select feature, value, count(*) filter (side = 0) as b, count(*) filter (side = 1) as c
          from cells group by 1, 2)""", """
gaps as (select feature, abs(sum(b) over upto / cast(sum(b) over f as double) - sum(c) over upto / cast(sum(c) over f as double)) as gap
         from steps window f as (partition by feature), upto as (partition by feature order by value rows unbounded preceding))""", """
ks as (select feature, max(gap) as ks from gaps group by 1)""")

# The ready training table as the baseline, all test rows as the current sample.
LABELLED = """
labelled as (select *, unit_number + 1000 * subset as unit,
               max(time_cycles) over (partition by split, subset, unit_number) - time_cycles as rul from featured)"""
BAND = "((subset in (1, 3) and rul between 6 and 145) or (subset in (2, 4) and rul between 6 and 194))"


def both_sides(columns):
    return (*FEATURED_CTES, LABELLED, f"""
sided as (select case when split = 'train' then 0 else 1 end as side, * from labelled where split = 'test' or {BAND})""",
            *long_ctes(columns, "sided"))


PLAIN = both_sides(ALL_FEATURES)
SCORES = (*PLAIN, *PSI_CTES, *KS_CTES, "scores as (select feature, psi, ks from psi join ks using (feature))")
ONE = ["s_7"]


def sides(spark, sf, columns=ALL_FEATURES):
    """Baseline and current sample of the ready tables."""
    t = derived_tables(spark, sf)
    return t.train(columns).select(*columns), t.test(columns).select(*columns)


@query("quantile_bins", oracle("select feature, i - 1 as bin, round(e[i], 6) as edge from edges cross join (select unnest(range(1, 12)) as i) r",
                               "telemetry", ctes=(*PLAIN, *EDGE_CTES)))
def _quantile_bins(spark, sf):
    base, _ = sides(spark, sf)
    out = drift.quantile_bins(base, ALL_FEATURES).select("feature", F.posexplode("edges").alias("bin", "edge"))
    return out.select("feature", F.col("bin").cast("bigint").alias("bin"), rounded("edge").alias("edge"))


@query("psi", oracle("select feature, round(psi, 6) as psi from psi", "telemetry", ctes=(*both_sides(ONE), *PSI_CTES)))
def _psi(spark, sf):
    base, cur = sides(spark, sf, ONE)
    return drift.psi_per_feature(base, cur, ONE).withColumn("psi", rounded("psi"))


@query("ks", oracle("select feature, round(ks, 6) as ks from ks", "telemetry", ctes=(*both_sides(ONE), *KS_CTES)))
def _ks(spark, sf):
    base, cur = sides(spark, sf, ONE)
    return drift.ks_per_feature(base, cur, ONE).withColumn("ks", rounded("ks"))


@query("psi_per_feature", oracle("select feature, round(psi, 6) as psi from psi", "telemetry", ctes=(*PLAIN, *PSI_CTES)))
def _psi_per_feature(spark, sf):
    base, cur = sides(spark, sf)
    return drift.psi_per_feature(base, cur, ALL_FEATURES).withColumn("psi", rounded("psi"))


@query("ks_per_feature", oracle("select feature, round(ks, 6) as ks from ks", "telemetry", ctes=(*PLAIN, *KS_CTES)))
def _ks_per_feature(spark, sf):
    base, cur = sides(spark, sf)
    return drift.ks_per_feature(base, cur, ALL_FEATURES).withColumn("ks", rounded("ks"))


# Levels that the test data actually crosses.
TIGHT = drift.DriftThresholds(psi_warn=0.0005, psi_alert=0.001, ks_warn=0.006, ks_alert=0.01)


@query("drift_feature_levels", oracle("""
select feature, case when psi >= 0.001 then 'alert' when psi >= 0.0005 then 'warn' else 'ok' end as psi_level,
       case when ks >= 0.01 then 'alert' when ks >= 0.006 then 'warn' else 'ok' end as ks_level from scores""",
                                      "telemetry", ctes=SCORES))
def _levels(spark, sf):
    base, cur = sides(spark, sf)
    return drift.feature_levels(drift.drift_scores(base, cur, ALL_FEATURES), TIGHT).drop("psi", "ks")


_STATS = """count(psi) as n_features, round(avg(psi), 6) as avg_psi, round(max(psi), 6) as max_psi,
       round(avg(ks), 6) as avg_ks, round(max(ks), 6) as max_ks,
       round(count(*) filter (psi >= 0.001) / cast(count(psi) as double), 6) as psi_alert_ratio,
       round(count(*) filter (ks >= 0.01) / cast(count(psi) as double), 6) as ks_alert_ratio"""


@query("drift_summary_stats", oracle(f"select {_STATS} from scores", "telemetry", ctes=SCORES))
def _stats(spark, sf):
    base, cur = sides(spark, sf)
    out = drift.drift_summary_stats(drift.drift_scores(base, cur, ALL_FEATURES), TIGHT)
    return out.select("n_features", *[rounded(c).alias(c) for c in out.columns[1:]])


VERSION_RMSE = """
errors as (select model_version, sqrt(avg((actual_rul - predicted_rul) * (actual_rul - predicted_rul))) as current_rmse,
                  cast(15 as double) as baseline_rmse from feedback group by 1)"""


def version_errors(spark, sf):
    from wearline.operators.metrics import rmse_by
    return rmse_by(fx.feedback(spark, sf), "actual_rul", "predicted_rul", ["model_version"]).withColumnRenamed(
        "rmse", "current_rmse").withColumn("baseline_rmse", F.lit(15.0))


@query("evaluate_drift", oracle("""
select model_version, round(current_rmse, 6) as current_rmse, round(avg(psi), 6) as avg_psi, round(avg(ks), 6) as avg_ks,
       current_rmse > 15 * 1.1::double as rmse_warn, current_rmse > 15 * 1.3::double as rmse_alert,
       avg(psi) >= 0.0005 or avg(ks) >= 0.1 or current_rmse > 15 * 1.1::double as should_retrain,
       count(*) filter (psi >= 0.001) as n_psi_alert, count(*) filter (psi >= 0.0005 and psi < 0.001) as n_psi_warn
from scores cross join errors group by model_version, current_rmse""", "telemetry", "feedback", ctes=(*SCORES, VERSION_RMSE)))
def _evaluate(spark, sf):
    base, cur = sides(spark, sf)
    t = drift.DriftThresholds(psi_warn=0.0005, psi_alert=0.001)
    out = drift.evaluate_drift(drift.drift_scores(base, cur, ALL_FEATURES), version_errors(spark, sf), t)
    return out.select("model_version", *[rounded(c).alias(c) for c in ("current_rmse", "avg_psi", "avg_ks")],
                      "rmse_warn", "rmse_alert", "should_retrain",
                      F.size("psi_alert_features").cast("bigint").alias("n_psi_alert"),
                      F.size("psi_warn_features").cast("bigint").alias("n_psi_warn"))


@query("drift_gauges", oracle("""
select model_version, round(15 * 1.1::double, 6) as rmse_warn_threshold, round(15 * 1.3::double, 6) as rmse_alert_threshold,
       case when current_rmse > 15 * 1.1::double then 1.0 else 0.0 end::double as rmse_flag,
       case when avg(psi) > 0.0005 then 1.0 else 0.0 end::double as psi_flag,
       case when avg(ks) > 0.1 then 1.0 else 0.0 end::double as ks_flag
from scores cross join errors group by model_version, current_rmse""", "telemetry", "feedback", ctes=(*SCORES, VERSION_RMSE)))
def _gauges(spark, sf):
    base, cur = sides(spark, sf)
    t = drift.DriftThresholds(psi_warn=0.0005, psi_alert=0.001)
    out = drift.drift_gauges(drift.evaluate_drift(drift.drift_scores(base, cur, ALL_FEATURES), version_errors(spark, sf), t), t)
    return out.select("model_version", rounded("rmse_warn_threshold").alias("rmse_warn_threshold"),
                      rounded("rmse_alert_threshold").alias("rmse_alert_threshold"), "rmse_flag", "psi_flag", "ks_flag")


@query("drift_score_maps", oracle("select feature, round(psi, 6) as psi, round(ks, 6) as ks from scores", "telemetry", ctes=SCORES))
def _score_maps(spark, sf):
    """The maps of the report, one row per entry."""
    base, cur = sides(spark, sf)
    errors = spark.createDataFrame([(0.0, 0.0)], "current_rmse double, baseline_rmse double")
    report = drift.evaluate_drift(stored(drift.drift_scores(base, cur, ALL_FEATURES), "scores"), errors)
    rows = report.select("ks_scores", F.explode("psi_scores").alias("feature", "psi"))
    return rows.select("feature", rounded("psi").alias("psi"), rounded(F.element_at("ks_scores", F.col("feature"))).alias("ks"))


# -- the check ----------------------------------------------------------------------------------

NOW, BACK, FRACTION, BASE_RMSE = "2024-01-30 00:00:00", 86_400, 0.5, 15.0


def check_ctes(since: str) -> tuple[str, ...]:
    return (*FEATURED_CTES, LABELLED, f"recent as (select * from feedback where feedback_timestamp >= {since})", f"""
banded as (select *, row_number() over (order by subset, unit_number, time_cycles) as rn, count(*) over () as n
           from labelled where split = 'train' and {BAND})""", f"""
both_sides as (select 0 as side, * exclude (rn, n) from banded where rn <= floor(n * cast({FRACTION} as double))
          union all
          select 1 as side, * from labelled where split = 'test' and rul = 0 and unit in (select engine_id from recent))""",
            *long_ctes(ALL_FEATURES, "both_sides"), *PSI_CTES, *KS_CTES,
            "scores as (select feature, psi, ks from psi join ks using (feature))", f"""
checked as (
  select (select count(*) from recent) as n_feedback,
         (select sqrt(avg((actual_rul - predicted_rul) * (actual_rul - predicted_rul))) from recent) as current_rmse,
         count(*) as n_features, avg(psi) as avg_psi, max(psi) as max_psi, avg(ks) as avg_ks, max(ks) as max_ks,
         count(*) filter (psi >= 0.25) / cast(count(*) as double) as psi_alert_ratio,
         count(*) filter (ks >= 0.2) / cast(count(*) as double) as ks_alert_ratio,
         (select count(*) filter (unit <= (select max(engine_id) from recent)) / cast(count(*) as double)
          from (select distinct unit from banded) u) as fraction
  from scores)""", f"""
decided as (select *, avg_psi >= 0.1 or avg_ks >= 0.1 or current_rmse > {BASE_RMSE} * 1.1::double as should_retrain from checked)""")


_stores: dict[tuple[str, str], str] = {}


def check_baseline(spark, sf) -> Baseline:
    """Half of the ready training table, with a folder for its statistics that lasts for the session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stores:
        _stores[key] = fresh_path(spark, "baselines")
    tables = derived_tables(spark, sf)
    return Baseline(tables.train(ALL_FEATURES), FRACTION, BASE_RMSE, version="1.0", store=_stores[key], source=tables)


def check_now(spark, sf):
    """The drift check on the ready tables, as of a fixed instant."""
    recent = recent_feedback(fx.feedback(spark, sf), F.lit(NOW).cast("timestamp"), BACK)
    return drift_check(recent, check_baseline(spark, sf), derived_tables(spark, sf).test_last_rows, ALL_FEATURES)


CHECKED = ("current_rmse", "avg_psi", "max_psi", "avg_ks", "max_ks", "psi_alert_ratio", "ks_alert_ratio")
CHECKED_SQL = ", ".join(f"round({c}, 6) as {c}" for c in CHECKED) + """,
       should_retrain, round(case when should_retrain then fraction end, 6) as retrain_on"""


@query("drift_check", oracle(f"select n_feedback, n_features, {CHECKED_SQL} from decided", "telemetry", "feedback",
                             ctes=check_ctes("timestamp '2024-01-29 00:00:00'")))
def _drift_check(spark, sf):
    out = check_now(spark, sf)
    return out.select("n_feedback", "n_features", "should_retrain", *[rounded(c).alias(c) for c in (*CHECKED, "retrain_on")])


@query("drift_baseline", oracle("""
select feature, i - 1 as bin, count(*) filter (side = 0 and value >= e[1] and value <= e[11]
         and len(list_filter(e[1:10], lambda x: x <= value)) = i) as n, round(any_value(e[i]), 6) as edge
from cells join edges using (feature) cross join (select unnest(range(1, 11)) as i) r group by 1, 2""", "telemetry", "feedback",
                                ctes=check_ctes("timestamp '2024-01-29 00:00:00'")))
def _drift_baseline(spark, sf):
    """Edges and counts per bin that are kept for the trained part, from which every check of it starts."""
    kept, _ = kept_baseline(check_baseline(spark, sf), ALL_FEATURES)
    edges = spark.read.parquet(f"{kept.path}/edges").select("fid", F.posexplode("edges").alias("bin", "edge")).filter("bin < 10")
    names = F.lit(ALL_FEATURES).cast("array<string>")
    out = edges.join(spark.read.parquet(f"{kept.path}/bins"), ["fid", "bin"], "left")
    return out.select(F.get(names, F.col("fid")).alias("feature"), F.col("bin").cast("bigint").alias("bin"),
                      F.coalesce("b", F.lit(0).cast("long")).alias("n"), rounded("edge").alias("edge"))
