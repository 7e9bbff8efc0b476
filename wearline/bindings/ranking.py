"""Queries over rankings, folds, scaling, versions and column statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearline.bindings import fixtures as fx
from wearline.bindings.drift import PHYSICAL
from wearline.bindings.features import FEATURED_CTES, with_rul
from wearline.bindings.ready import derived_tables
from wearline.bindings.registry import oracle, query
from wearline.functions import rounded
from wearline.operators import features, folds, metrics, ranking, select, sequences
from wearline.sources.models import next_model_version, promotion_gate
from wearline.spec import SPEC

# Blocks that are ranked against the target one after the other.
BLOCKS = {
    "rolling": [f"{c}_roll_{w}" for w in (3, 5, 10, 20) for c in SPEC.sensors + SPEC.settings],
    "delta": [f"{c}_delta" for c in SPEC.base],
    "setting_pairs": features.block_names("setting_pairs"),
    "setting_sensor": features.block_names("setting_sensor"),
    "physical": PHYSICAL,
}
SETTING_ROLLING = [c for c in BLOCKS["rolling"] if c.startswith("setting")]


def _spearman_sql(columns: list[str], sign: str) -> str:
    cols = ", ".join(columns)
    return f"""
select feature, round({sign}(corr(rx, ry)), 6) as rho from (
  select feature, rank() over f_x + (count(*) over (partition by feature, value) - 1) / 2.0::double as rx,
         rank() over f_y + (count(*) over (partition by feature, rul) - 1) / 2.0::double as ry
  from (select rul, feature, value from (unpivot (select rul, {cols} from ranked_rows) on {cols} into name feature value value) u) c
  window f_x as (partition by feature order by value), f_y as (partition by feature order by rul)) r
group by 1"""


RANKED_ROWS = (*FEATURED_CTES, """
ranked_rows as (select * from (
  select *, max(time_cycles) over (partition by split, subset, unit_number) - time_cycles as rul from featured) t
  where split = 'train' and ((subset in (1, 3) and rul between 6 and 145) or (subset in (2, 4) and rul between 6 and 194)))""")


def _rank(name: str, columns: list[str], signed: bool) -> None:
    # A constant column has no rank correlation: NULL here, NaN from corr().
    body = _spearman_sql(columns, "" if signed else "abs")
    body = f"select feature, case when isnan(rho) then null else rho end as rho from ({body}) t"

    @query(name, oracle(body, "telemetry", ctes=RANKED_ROWS))
    def _run(spark, sf):
        train = derived_tables(spark, sf).train(columns)
        return ranking.rank_features_spearman(train, columns, "RUL", signed=signed).withColumn("rho", rounded("rho"))


for _block, _columns in BLOCKS.items():
    _rank(f"rank_features_spearman_{_block}", _columns, signed=False)
_rank("rank_setting_rolling_signed", SETTING_ROLLING, signed=True)

@query("group_kfold", oracle("""
select subset, unit_number, n_rows, cast(case when turn % 2 = 0 then place else 4 - place end as int) as fold
from (select subset, unit_number, n_rows, (rn - 1) // 5 as turn, (rn - 1) % 5 as place
      from (select subset, unit_number, count(*) as n_rows, row_number() over (order by count(*) desc, subset, unit_number) as rn
            from train_rul group by 1, 2) a) b""", "prepared"))
def _kfold(spark, sf):
    return folds.group_kfold(fx.split_of(spark, sf, "train"))


@query("group_holdout", oracle("""
select subset, unit_number, n_rows, case when rn <= ceil(n * cast(0.1 as double)) then 'valid' else 'train' end as side
from (select subset, unit_number, count(*) as n_rows, count(*) over () as n,
             row_number() over (order by md5(concat_ws(':', '45', subset, unit_number)), subset, unit_number) as rn
      from train_rul group by 1, 2) a""", "prepared"))
def _holdout(spark, sf):
    train, valid = folds.group_holdout(fx.split_of(spark, sf, "train"))
    sides = (d.groupBy(*SPEC.keys).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("side", F.lit(s))
             for d, s in ((train, "train"), (valid, "valid")))
    return select.union_subsets(*sides)


_SCALED = SPEC.base


@query("minmax_scale", oracle(
    "select subset, unit_number, time_cycles, " + ", ".join(
        f"({c} - lo_{c}) / case when hi_{c} = lo_{c} then 1 else hi_{c} - lo_{c} end as {c}" for c in _SCALED) +
    " from telemetry cross join (select " + ", ".join(f"min({c}) as lo_{c}, max({c}) as hi_{c}" for c in _SCALED) +
    " from telemetry where split = 'train') r where split = 'test'", "telemetry"))
def _minmax(spark, sf):
    cols = [*SPEC.keys, "time_cycles", *_SCALED]
    return folds.minmax_scale(fx.split_of(spark, sf, "train"), fx.split_of(spark, sf, "test").select(*cols), _SCALED)


@query("next_model_version", oracle("""
select request_id, case when request_id % 7 < 4 then '1.0'
       else concat(cast(split_part(model_version, '.', 1) as bigint) + 1, '.0') end as next_version from requests""", "requests"))
def _next_version(spark, sf):
    k = F.col("request_id") % 7
    version = F.when(k == 0, None).when(k == 1, "x").when(k == 2, "1.2.3").when(k == 3, "4.y").otherwise(F.col("model_version"))
    return next_model_version(fx.requests(spark, sf).withColumn("version", version)).select("request_id", "next_version")


@query("backtest_summary", oracle("""
select round(min(rmse), 6) as min_rmse, round(max(rmse), 6) as max_rmse, round(arg_max(rmse, ratio), 6) as final_rmse,
       count(*) as n_points
from (select cast(split_part(model_version, '.', 1) as double) as ratio,
             sqrt(avg((actual_rul - predicted_rul) * (actual_rul - predicted_rul))) as rmse from feedback group by 1) p""", "feedback"))
def _backtest_summary(spark, sf):
    points = metrics.rmse_by(fx.feedback(spark, sf), "actual_rul", "predicted_rul", ["model_version"]).select(
        F.split("model_version", r"\.")[0].cast("double").alias("ratio"), "rmse")
    out = metrics.backtest_summary(points)
    return out.select(*[rounded(c).alias(c) for c in ("min_rmse", "max_rmse", "final_rmse")], "n_points")


# -- column statistics ------------------------------------------------------------------------

def _per_column(columns, exprs: str) -> str:
    return " union all ".join(exprs.format(c=c) for c in columns)


@query("profile_columns", oracle(
    "select column_name as \"column\", n_rows, n_nulls, mean, std, \"min\", \"max\", is_constant from (" + _per_column(
        SPEC.base, "select '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_nulls, "
        "round(avg({c}), 3) as mean, round(stddev_samp({c}), 3) as std, min({c}) as \"min\", max({c}) as \"max\", "
        "min({c}) = max({c}) as is_constant from telemetry") + ") t", "telemetry"))
def _profile(spark, sf):
    return ranking.profile_columns(fx.telemetry(spark, sf), SPEC.base).withColumns(
        {"mean": rounded("mean", 3), "std": rounded("std", 3)})


@query("baseline_stats", oracle(_per_column(
    SPEC.base, "select '{c}' as feature, round(avg({c}), 3) as mean, round(stddev_samp({c}), 3) as std, "
    "round(quantile_cont({c}, 0.25), 6) as p25, round(quantile_cont({c}, 0.5), 6) as p50, round(quantile_cont({c}, 0.75), 6) as p75 "
    "from telemetry where split = 'train'"), "telemetry"))
def _baseline_stats(spark, sf):
    stats = ranking.baseline_stats(fx.split_of(spark, sf, "train"), SPEC.base)
    return stats.select("feature", rounded("mean", 3).alias("mean"), rounded("std", 3).alias("std"),
                        *[F.round(F.get("percentiles", F.lit(i)), 6).alias(p) for i, p in enumerate(("p25", "p50", "p75"))])


@query("variance_threshold", oracle("select feature, variance from (" + _per_column(
    SPEC.base, "select '{c}' as feature, round(var_pop({c}), 3) as variance, var_pop({c}) as v from telemetry") +
    ") t where v > 0.01", "telemetry"))
def _variance(spark, sf):
    return ranking.variance_threshold(fx.telemetry(spark, sf), SPEC.base).withColumn("variance", rounded("variance", 3))


@query("mutual_information", oracle(f"""
select feature, round(sum(n / nt * ln(n * nt / (nx * ny))), 6) as mutual_information from (
  select feature, x, y, cast(count(*) as double) as n, cast(sum(count(*)) over (partition by feature) as double) as nt,
         cast(sum(count(*)) over (partition by feature, x) as double) as nx,
         cast(sum(count(*)) over (partition by feature, y) as double) as ny
  from (select feature, least(cast(floor(coalesce((value - lo) / nullif(hi - lo, 0), 0) * 16) as bigint), 15) as x,
               least(cast(floor((rul - rlo) / cast(rhi - rlo as double) * 16) as bigint), 15) as y
        from (select feature, value, rul, min(value) over (partition by feature) as lo, max(value) over (partition by feature) as hi,
                     min(rul) over () as rlo, max(rul) over () as rhi
              from (unpivot (select cast("RUL" as double) as rul, {", ".join(SPEC.base)} from train_rul)
                    on {", ".join(SPEC.base)} into name feature value value) u) b) c
  group by 1, 2, 3) j group by 1""", "prepared"))
def _mutual_information(spark, sf):
    return ranking.mutual_information(with_rul(spark, sf, "train"), SPEC.base, "RUL").withColumn(
        "mutual_information", rounded("mutual_information"))


@query("promotion_gate", oracle("select model_version, test_rmse from registry where test_rmse <= 50.0::double * 1.1::double", "registry"))
def _promotion(spark, sf):
    return promotion_gate(fx.registry(spark, sf), 50.0).select("model_version", "test_rmse")


# Every cell of a window counts in `digest`, with a weight for its step and its column.
@query("sequence_windows", oracle(f"""
select subset, unit_number, time_cycles, 50::bigint as n_steps, {len(SPEC.base)}::bigint as n_columns,
       case when time_cycles < 50 then 0 else l[1].first end as oldest, l[-1].last as newest,
       cast(list_sum(list_transform(l, lambda x, i: (i + 50 - len(l)) * x.cells)) as bigint) as digest
from (select subset, unit_number, time_cycles, list({{'first': {SPEC.base[0]}, 'last': {SPEC.base[-1]}, 'cells':
             {" + ".join(f"{i} * cast(floor({c} * 1024) as bigint)" for i, c in enumerate(SPEC.base, 1))}}})
             over (partition by subset, unit_number order by time_cycles rows 49 preceding) as l
      from telemetry where split = 'test') t""", "telemetry"))
def _sequences(spark, sf):
    df = fx.split_of(spark, sf, "test")
    out = sequences.sequence_windows(df, SPEC.base, layout=fx.layout_of(df))
    # One row a step, whose cells are added up by compiled code; the sums of a window's steps meet where they were made.
    steps = out.select(*SPEC.keys, "time_cycles", F.posexplode("sequence").alias("i", "step"))
    cells = sum((j * F.floor(F.get("step", F.lit(j - 1)) * 1024) for j in range(2, len(SPEC.base) + 1)),
                F.floor(F.get("step", F.lit(0)) * 1024))
    return steps.groupBy(*SPEC.keys, "time_cycles").agg(
        F.count(F.lit(1)).alias("n_steps"), F.max(F.size("step")).cast("bigint").alias("n_columns"),
        F.max(F.when(F.col("i") == 0, F.get("step", F.lit(0)))).alias("oldest"),
        F.max(F.when(F.col("i") == 49, F.get("step", F.lit(len(SPEC.base) - 1)))).alias("newest"),
        F.sum((F.col("i") + 1) * cells).alias("digest"))


@query("weighted_blend", oracle("""
select weight, round(sqrt(avg(pow(actual_rul - (weight * predicted_rul + (1 - weight) * (actual_rul + engine_id % 7 - 3)), 2))), 6) as rmse
from feedback cross join (select unnest(range(0, 11)) / 10.0::double as weight) w group by 1""", "feedback"))
def _blend(spark, sf):
    second = F.col("actual_rul") + F.col("engine_id") % 7 - 3
    return sequences.weighted_blend(fx.feedback(spark, sf).withColumn("second", second), "predicted_rul", "second",
                                    "actual_rul", 10).withColumn("rmse", rounded("rmse"))
