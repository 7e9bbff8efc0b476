"""Queries over labels, windows, features and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.bindings import fixtures as fx
from wearline.bindings.registry import oracle, query
from wearline.operators import features, labels
from wearline.spec import SPEC

ROLL_COLS = SPEC.sensors + SPEC.settings
WINDOWS = (3, 5, 10, 20)
KEYS = ("split", *SPEC.keys)
OVER = "over (partition by split, subset, unit_number order by time_cycles)"


def with_rul(spark: SparkSession, sf: str, split: str) -> DataFrame:
    df = fx.split_of(spark, sf, split)
    if split == "train":
        return labels.label_rul_train(df, layout=fx.layout_of(df))
    return labels.label_rul_test(df, fx.rul_labels(spark, sf), layout=fx.layout_of(df))


def featured(spark: SparkSession, sf: str, split: str) -> DataFrame:
    """The prepared split with all features, as the ready tables hold it."""
    df = fx.split_of(spark, sf, split)
    layout = fx.layout_of(df)
    named = (labels.label_rul_train(df, layout=layout) if split == "train"
             else labels.label_rul_test(df, fx.rul_labels(spark, sf), layout=layout))
    return features.create_features(named, layout=layout)


# -- labels ---------------------------------------------------------------------------------

@query("label_rul_train", oracle("select subset, unit_number, time_cycles, \"RUL\" from train_rul", "prepared"))
def _label_rul_train(spark, sf):
    return with_rul(spark, sf, "train").select(*SPEC.keys, "time_cycles", "RUL")


@query("label_rul_test", oracle("select subset, unit_number, time_cycles, \"RUL\" from test_rul", "prepared"))
def _label_rul_test(spark, sf):
    return with_rul(spark, sf, "test").select(*SPEC.keys, "time_cycles", "RUL")


@query("rekey_units", oracle("""
select subset, unit_number + stride * subset as unit_number, split, time_cycles
from telemetry cross join (select greatest(1000, cast(power(10, length(cast(max(unit_number) as varchar))) as bigint)) as stride from telemetry) s""",
                              "telemetry"))
def _rekey_units(spark, sf):
    return labels.rekey_units(fx.telemetry(spark, sf)).select("subset", "unit_number", "split", "time_cycles")


@query("rul_band_filter", oracle("""
select subset, unit_number, time_cycles, "RUL" from train_rul
where (subset in (1, 3) and "RUL" between 6 and 145) or (subset in (2, 4) and "RUL" between 6 and 194)""", "prepared"))
def _rul_band_filter(spark, sf):
    return labels.rul_band_filter(with_rul(spark, sf, "train")).select(*SPEC.keys, "time_cycles", "RUL")


@query("max_cycle_per_unit", oracle("""
select subset, unit_number, max(time_cycles) as max_cycle from telemetry where split = 'train' group by 1, 2""",
                                    "telemetry"))
def _max_cycle(spark, sf):
    return labels.max_cycle_per_unit(fx.split_of(spark, sf, "train"))


@query("last_row_per_unit", oracle("""
select * from test_rul qualify row_number() over (partition by subset, unit_number order by time_cycles desc) = 1""",
                                   "prepared"))
def _last_row(spark, sf):
    return labels.last_row_per_unit(with_rul(spark, sf, "test"))


@query("check_terminal_row", oracle("""
select subset, unit_number, count(*) filter (c_hit) as n_max_cycle, count(*) filter (r_hit) as n_min_rul,
       count(*) filter (c_hit and r_hit) as n_both
from (select subset, unit_number, time_cycles = max(time_cycles) over u as c_hit, "RUL" = min("RUL") over u as r_hit
      from (select subset, unit_number, time_cycles, "RUL" // 3 as "RUL" from test_rul)
      window u as (partition by subset, unit_number)) t
group by 1, 2
having n_max_cycle <> 1 or n_min_rul <> 1 or n_both <> 1""", "prepared"))
def _check_terminal(spark, sf):
    # Dividing the label makes ties, so that the check has something to report.
    return labels.check_terminal_row(with_rul(spark, sf, "test").withColumn("RUL", F.floor(F.col("RUL") / 3)))


@query("check_label_count", oracle("""
select subset, n_units, n_labels, n_units = n_labels as matches
from (select subset, count(distinct unit_number) as n_units from telemetry where split = 'train' group by 1) a
join (select subset, count(*) as n_labels from rul_labels group by 1) b using (subset)""", "labels"))
def _check_label_count(spark, sf):
    return labels.check_label_count(fx.split_of(spark, sf, "train"), fx.rul_labels(spark, sf))


# -- windows and products ---------------------------------------------------------------------

def rolling_sql(cols, windows) -> tuple[str, ...]:
    """Trailing means as explicit sums of lagged values, oldest first: the same additions in the same order."""
    need = max(windows)
    lags = ", ".join(f"coalesce(lag({c}, {k}) over w, 0) as {c}__{k}" for c in cols for k in range(1, need))
    means = ", ".join(
        "(" + " + ".join([f"{c}__{k}" for k in range(n - 1, 0, -1)] + [c]) + f") / least(time_cycles, {n}) as {c}_roll_{n}"
        for n in windows for c in cols)
    return (f"lagged as (select *, {lags} from telemetry window w as (partition by split, subset, unit_number order by time_cycles))",
            f"rolled as (select split, subset, unit_number, time_cycles, {means} from lagged)")


def delta_sql(cols) -> str:
    exprs = ", ".join(f"coalesce({c} - lag({c}) {OVER}, 0) as {c}_delta" for c in cols)
    return f"deltas as (select split, subset, unit_number, time_cycles, {exprs} from telemetry)"


@query("rolling_mean", oracle("select * from rolled", "telemetry", ctes=rolling_sql(ROLL_COLS, WINDOWS)))
def _rolling(spark, sf):
    df = fx.telemetry(spark, sf)
    keyed = fx.plan_series(df, KEYS, "time_cycles", dense=True)
    out = features.rolling_mean(df, WINDOWS, layout=keyed)
    return out.select(*KEYS, "time_cycles", *[f"{c}_roll_{n}" for n in WINDOWS for c in ROLL_COLS])


@query("delta", oracle("select * from deltas", "telemetry", ctes=(delta_sql(SPEC.base),)))
def _delta(spark, sf):
    df = fx.telemetry(spark, sf)
    keyed = fx.plan_series(df, KEYS, "time_cycles", dense=True)
    return features.delta(df, layout=keyed).select(*KEYS, "time_cycles", *[f"{c}_delta" for c in SPEC.base])


PRODUCT_SQL = {
    "setting_pairs": "setting_1 * setting_2 as setting_1_x_setting_2, setting_1 * setting_3 as setting_1_x_setting_3, "
                     "setting_2 * setting_3 as setting_2_x_setting_3",
    "setting_sensor": ", ".join(f"{a} * {b} as {a}_x_{b}" for a in SPEC.settings for b in SPEC.sensors),
    "temperature": "s_1 * s_2 as temp_fan_to_lpc, s_3 / s_2 as temp_compression_ratio, "
                   "s_4 / s_3 as temp_expansion_ratio, s_3 - s_1 as temp_overall_rise",
    "pressure": "s_7 / (s_5 + 1e-6) as pressure_ratio_fan, s_6 / (s_7 + 1e-6) as pressure_bypass_vs_core, "
                "s_7 - s_11 as pressure_drop_turbine",
    "speed": "s_8 / (s_9 + 1e-6) as speed_fan_core_ratio, s_13 / (s_14 + 1e-6) as speed_corrected_ratio, "
             "s_8 / (s_18 + 1e-6) as speed_efficiency",
    "fuel_air": "s_12 * s_16 as fuel_air_efficiency, s_20 + s_21 as cooling_air_total, "
                "s_12 / (s_20 + s_21 + 1e-6) as fuel_to_cooling",
    "cross_system": "s_3 * s_7 as thermal_pressure_stress, s_10 * s_15 as engine_load_indicator",
}
_BLOCKS = {
    "setting_pair_products": ("setting_pairs", features.setting_pair_products),
    "setting_sensor_products": ("setting_sensor", features.setting_sensor_products),
    "temperature_features": ("temperature", features.temperature_features),
    "pressure_features": ("pressure", features.pressure_features),
    "speed_features": ("speed", features.speed_features),
    "fuel_air_features": ("fuel_air", features.fuel_air_features),
    "cross_system_features": ("cross_system", features.cross_system_features),
}
for _name, (_block, _op) in _BLOCKS.items():
    query(_name, oracle(f"select split, subset, unit_number, time_cycles, {PRODUCT_SQL[_block]} from telemetry",
                        "telemetry"))(
        lambda spark, sf, op=_op, block=_block: op(fx.telemetry(spark, sf)).select(
            *KEYS, "time_cycles", *features.block_names(block)))

# Every derived column of the train split, joined from the parts above.
FEATURED_CTES = (
    *rolling_sql(ROLL_COLS, WINDOWS), delta_sql(SPEC.base),
    "featured as (select t.*, r.* exclude (split, subset, unit_number, time_cycles), "
    "d.* exclude (split, subset, unit_number, time_cycles), "
    + ", ".join(PRODUCT_SQL.values()) +
    " from telemetry t join rolled r using (split, subset, unit_number, time_cycles)"
    " join deltas d using (split, subset, unit_number, time_cycles))")


@query("create_features", oracle(
    "select * exclude (split) replace (unit_number + 1000 * subset as unit_number) from featured where split = 'test'",
    "telemetry", ctes=FEATURED_CTES))
def _create_features(spark, sf):
    df = fx.split_of(spark, sf, "test")
    return features.create_features(df, layout=fx.layout_of(df))


@query("ieee_div", """
select event_id, case when event_id % 5 = 0 then null else value / (event_id % 5) end as divided
from events""")
def _ieee_div(spark, sf):
    from wearline.functions import ieee_div
    den = (F.col("event_id") % 5).cast("double")
    return fx.table(spark, sf, "events").select("event_id", ieee_div(F.col("value"), den, zero_as_null=True).alias("divided"))


@query("order_telemetry", oracle("select split, subset, unit_number, time_cycles, s_2 from telemetry order by all", "telemetry"))
def _order(spark, sf):
    from wearline.operators.select import order_telemetry
    return order_telemetry(fx.telemetry(spark, sf)).select(*KEYS, "time_cycles", "s_2")
