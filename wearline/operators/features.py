"""Derived features: trailing means, differences, products and ratios."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.functions import ieee_div
from wearline.functions.columns import EPSILON
from wearline.operators.labels import rekey_units, unit_stride
from wearline.operators.series import SeriesLayout, add_windows, plan_series
from wearline.spec import SPEC, FeatureSwitches, TelemetrySpec


def rolling_mean(df: DataFrame, windows: tuple[int, ...], columns: tuple[str, ...] | None = None,
                 spec: TelemetrySpec = SPEC, layout: SeriesLayout | None = None) -> DataFrame:
    """Mean of the last w rows of the series; early rows average what exists, missing values are skipped."""
    columns = columns or spec.sensors + spec.settings
    layout = layout or plan_series(df, spec.keys, spec.order)
    return add_windows(df, layout, max(windows) - 1, _trailing(tuple(windows), tuple(columns), ()))


def delta(df: DataFrame, columns: tuple[str, ...] | None = None, spec: TelemetrySpec = SPEC,
          layout: SeriesLayout | None = None) -> DataFrame:
    """Change since the previous row; 0 on the first row and wherever either value is missing."""
    columns = columns or spec.base
    layout = layout or plan_series(df, spec.keys, spec.order)
    return add_windows(df, layout, 1, _trailing((), (), tuple(columns)))


def setting_pair_products(df: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    return df.select("*", *_setting_pairs(spec))


def setting_sensor_products(df: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    return df.select("*", *_setting_sensor(spec))


def temperature_features(df: DataFrame) -> DataFrame:
    return df.select("*", *_temperature())


def pressure_features(df: DataFrame) -> DataFrame:
    return df.select("*", *_pressure())


def speed_features(df: DataFrame) -> DataFrame:
    return df.select("*", *_speed())


def fuel_air_features(df: DataFrame) -> DataFrame:
    return df.select("*", *_fuel_air())


def cross_system_features(df: DataFrame) -> DataFrame:
    return df.select("*", *_cross_system())


def create_features(df: DataFrame, switches: FeatureSwitches = FeatureSwitches(), spec: TelemetrySpec = SPEC,
                    layout: SeriesLayout | None = None, rekey: bool = True, stride: int | None = None) -> DataFrame:
    """All feature blocks as one lazy plan: one window operator, then one projection.

    `layout`, if given, must describe `df` before re-keying, which moves whole series only. Tables that are to
    share ids need one `stride`; without it the table's own is looked up.
    """
    stride = unit_stride(df, spec=spec) if rekey and stride is None else stride
    windows = switches.rolling_windows or ()
    layout = layout or plan_series(df, spec.keys, spec.order)

    if windows or switches.delta:
        df = add_windows(df, layout, max((*windows, 2)) - 1,
                         _trailing(tuple(windows), spec.sensors + spec.settings, spec.base if switches.delta else ()))
    blocks = [
        (switches.setting_pairs, _setting_pairs(spec)),
        (switches.setting_sensor, _setting_sensor(spec)),
        (switches.temperature, _temperature()),
        (switches.pressure, _pressure()),
        (switches.speed, _speed()),
        (switches.fuel_air, _fuel_air()),
        (switches.cross_system, _cross_system()),
    ]
    out = df.select("*", *[e for on, exprs in blocks if on for e in exprs])
    return rekey_units(out, spec, stride) if rekey else out


def feature_names(switches: FeatureSwitches = FeatureSwitches(), spec: TelemetrySpec = SPEC) -> list[str]:
    """Model feature order: base, trailing means by window, differences, then the interaction blocks."""
    names = list(spec.base)
    for w in switches.rolling_windows or ():
        names += [f"{c}_roll_{w}" for c in spec.sensors + spec.settings]
    if switches.delta:
        names += [f"{c}_delta" for c in spec.base]
    for on, block in ((switches.setting_pairs, "setting_pairs"), (switches.setting_sensor, "setting_sensor"),
                      (switches.temperature, "temperature"), (switches.pressure, "pressure"),
                      (switches.speed, "speed"), (switches.fuel_air, "fuel_air"),
                      (switches.cross_system, "cross_system")):
        if on:
            names += block_names(block, spec)
    return names


def block_names(block: str, spec: TelemetrySpec = SPEC) -> list[str]:
    """Column names of one interaction block."""
    if block == "setting_pairs":
        return [f"{a}_x_{b}" for a, b in combinations(spec.settings, 2)]
    if block == "setting_sensor":
        return [f"{s}_x_{v}" for s in spec.settings for v in spec.sensors]
    return list(PHYSICAL_NAMES[block])


# Names of the physically grouped features.
PHYSICAL_NAMES = {
    "temperature": ("temp_fan_to_lpc", "temp_compression_ratio", "temp_expansion_ratio", "temp_overall_rise"),
    "pressure": ("pressure_ratio_fan", "pressure_bypass_vs_core", "pressure_drop_turbine"),
    "speed": ("speed_fan_core_ratio", "speed_corrected_ratio", "speed_efficiency"),
    "fuel_air": ("fuel_air_efficiency", "cooling_air_total", "fuel_to_cooling"),
    "cross_system": ("thermal_pressure_stress", "engine_load_indicator"),
}


def switches_for(names: Sequence[str], switches: FeatureSwitches = FeatureSwitches(),
                 spec: TelemetrySpec = SPEC) -> FeatureSwitches:
    """The blocks of `switches` that the named features lie in, and no others."""
    wanted = set(names)

    def lies(block: Sequence[str]) -> bool:
        return not wanted.isdisjoint(block)

    columns = spec.sensors + spec.settings
    windows = tuple(w for w in switches.rolling_windows or () if lies([f"{c}_roll_{w}" for c in columns]))
    blocks = {b: getattr(switches, b) and lies(block_names(b, spec))
              for b in ("setting_pairs", "setting_sensor", *PHYSICAL_NAMES)}
    return FeatureSwitches(windows or None, switches.delta and lies([f"{c}_delta" for c in spec.base]), **blocks)


_POSITION = "_position"


def _trailing(windows: tuple[int, ...], rolled: tuple[str, ...],
              differing: tuple[str, ...]) -> Callable[[DataFrame, WindowSpec], DataFrame]:
    """Trailing means of `rolled` and differences of `differing`, as a build step of `add_windows`.

    Spark deals and sorts the series and numbers their rows; the means are then added up batch by batch, for all
    series of a batch at once. The additions are those of a window function, oldest row first, so the digits are too,
    but a row costs a few vector additions instead of a replay of its frames.
    """
    back = max((*windows, 2)) - 1
    columns = list(dict.fromkeys((*rolled, *differing)))

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        added = [f"{c}_roll_{n}" for n in windows for c in rolled] + [f"{c}_delta" for c in differing]
        schema = T.StructType(rows.schema.fields + [T.StructField(a, T.DoubleType()) for a in added])
        kept = rows.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            earlier = {c: np.zeros(back) for c in columns}
            for batch in batches:
                at = batch.column(_POSITION).to_numpy()
                means: dict[tuple[int, str], pa.Array] = {}
                steps: dict[str, pa.Array] = {}
                for c in columns:
                    own = batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False)
                    values = np.concatenate([earlier[c], own])
                    earlier[c] = values[len(values) - back:]
                    if c in rolled:
                        means.update({(n, c): m for n, m in zip(windows, _means(values, at, windows, back))})
                    if c in differing:
                        steps[c] = _step(values, at, back)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k) for k in kept), *(means[n, c] for n in windows for c in rolled),
                     *(steps[c] for c in differing)], names=[*kept, *added])

        return rows.withColumn(_POSITION, F.row_number().over(w)).mapInArrow(run, schema)

    return build


def _means(values: np.ndarray, at: np.ndarray, windows: tuple[int, ...], back: int) -> Iterator[pa.Array]:
    """Mean of the last n present values up to each row, for each n; `values` has `back` rows from before the batch.

    `at` is a row's place in its series, from 1. Whole frames are added without a look at places; the first rows of a
    series, whose frames would reach into the series before, are added again.
    """
    n_rows = len(at)
    present = ~np.isnan(values)
    full = bool(present.all())
    filled = values if full else np.where(present, values, 0.0)
    with np.errstate(invalid="ignore", over="ignore"):
        for n in windows:
            total = np.zeros(n_rows)
            count = np.full(n_rows, n) if full else np.zeros(n_rows, dtype=np.int64)
            for k in reversed(range(n)):
                total += filled[back - k:back - k + n_rows]
                if not full:
                    count += present[back - k:back - k + n_rows]
            early = np.flatnonzero(at < n)
            total[early], count[early] = 0.0, 0
            for k in reversed(range(n - 1)):
                inside = early[at[early] > k]
                total[inside] += filled[back + inside - k]
                count[inside] += present[back + inside - k]
            yield pa.array(total / np.maximum(count, 1), mask=count == 0)


def _step(values: np.ndarray, at: np.ndarray, back: int) -> pa.Array:
    """Value less the value before in the series, 0 where one of them is missing."""
    own, before = values[back:], values[back - 1:len(values) - 1]
    known = (at > 1) & ~np.isnan(own) & ~np.isnan(before)
    with np.errstate(invalid="ignore"):
        return pa.array(np.where(known, own - before, 0.0))


def _setting_pairs(spec: TelemetrySpec) -> list[Column]:
    return [(F.col(a) * F.col(b)).alias(f"{a}_x_{b}") for a, b in combinations(spec.settings, 2)]


def _setting_sensor(spec: TelemetrySpec) -> list[Column]:
    return [(F.col(s) * F.col(v)).alias(f"{s}_x_{v}") for s in spec.settings for v in spec.sensors]


def _s(i: int) -> Column:
    return F.col(f"s_{i}")


def _temperature() -> list[Column]:
    return _named(PHYSICAL_NAMES["temperature"], _s(1) * _s(2), ieee_div(_s(3), _s(2)), ieee_div(_s(4), _s(3)),
                  _s(3) - _s(1))


def _pressure() -> list[Column]:
    return _named(PHYSICAL_NAMES["pressure"], ieee_div(_s(7), _s(5) + EPSILON),
                  ieee_div(_s(6), _s(7) + EPSILON), _s(7) - _s(11))


def _speed() -> list[Column]:
    return _named(PHYSICAL_NAMES["speed"], ieee_div(_s(8), _s(9) + EPSILON),
                  ieee_div(_s(13), _s(14) + EPSILON), ieee_div(_s(8), _s(18) + EPSILON))


def _fuel_air() -> list[Column]:
    cooling = _s(20) + _s(21)
    return _named(PHYSICAL_NAMES["fuel_air"], _s(12) * _s(16), cooling, ieee_div(_s(12), cooling + EPSILON))


def _cross_system() -> list[Column]:
    return _named(PHYSICAL_NAMES["cross_system"], _s(3) * _s(7), _s(10) * _s(15))


def _named(names: tuple[str, ...] | list[str], *exprs: Column) -> list[Column]:
    return [e.alias(n) for n, e in zip(names, exprs, strict=True)]
