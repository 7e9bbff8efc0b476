"""Remaining-useful-life labels, re-keying, bands and terminal-row checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.operators.series import SeriesLayout, add_position, add_series_max, plan_series
from wearline.spec import RUL_BANDS, SPEC, UNIT_STRIDE, TelemetrySpec


def unit_stride(*frames: DataFrame, spec: TelemetrySpec = SPEC, groups: tuple[int, ...] = tuple(RUL_BANDS)) -> int:
    """The usual stride, or the least power of ten above every id of a listed group: one narrow aggregate a table.

    Tables that are to share ids must share the stride.
    """
    stride = UNIT_STRIDE
    for df in frames:
        top = df.filter(F.col(spec.group).isin(*groups)).agg(F.max(spec.entity)).first()[0]
        while top is not None and top >= stride:
            stride *= 10
    return stride


def rekey_units(df: DataFrame, spec: TelemetrySpec = SPEC, stride: int | None = None,
                groups: tuple[int, ...] = tuple(RUL_BANDS)) -> DataFrame:
    """Make entity ids unique across groups; groups not listed keep their ids.

    Without a stride the table's own `unit_stride` is taken, so a fleet of any size fits. An id outside
    0 .. stride - 1 in a listed group would run into another group's ids: it stops the job. Operators on entities
    need no such ids, as they go by (group, entity).
    """
    stride = unit_stride(df, spec=spec, groups=groups) if stride is None else stride
    g, u = F.col(spec.group), F.col(spec.entity)
    message = F.format_string(f"{spec.entity} %s of {spec.group} %s does not fit the stride {stride}", u, g)
    moved = F.when((u < 0) | (u >= stride), F.raise_error(message)).otherwise(u + g * F.lit(stride))
    return df.withColumn(spec.entity, F.when(g.isin(*groups), moved).otherwise(u).cast("bigint"))


def label_rul_train(df: DataFrame, spec: TelemetrySpec = SPEC, layout: SeriesLayout | None = None) -> DataFrame:
    """Series that ran to failure: remaining life is the last cycle minus this one."""
    layout = layout or plan_series(df, spec.keys, spec.order)
    out = add_series_max(df, layout, spec.order, "_last")
    return out.withColumn(spec.target, F.col("_last") - F.col(spec.order)).drop("_last")


def label_rul_test(df: DataFrame, labels: DataFrame, spec: TelemetrySpec = SPEC,
                   layout: SeriesLayout | None = None) -> DataFrame:
    """Truncated series: label line n belongs to the n-th smallest entity of its group.

    An entity without a label line keeps its rows, with a NULL target; `check_label_count` finds the groups
    where that happens, and `prepare_ready` refuses them.
    `labels` has (group, line_no, rul). The entity table is distinct ids, ranked per group; its
    size is the number of entities, so the join strategy is left to the optimizer.
    """
    layout = layout or plan_series(df, spec.keys, spec.order)
    per_entity = entity_ranks(df, spec).join(
        labels.select(spec.group, F.col("line_no").alias("_rank"), F.col("rul").alias("_ref")),
        [spec.group, "_rank"]).drop("_rank")
    out = add_series_max(df, layout, spec.order, "_last").join(per_entity, list(spec.keys), "left")
    return out.withColumn(spec.target, F.col("_ref") + F.col("_last") - F.col(spec.order)).drop("_last", "_ref")


def entity_ranks(df: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    """Distinct entities with their 1-based rank by id within the group; a large group is numbered in blocks."""
    units = df.select(*spec.keys).distinct()
    return add_position(units, plan_series(units, (spec.group,), spec.entity), [spec.entity], "_rank")


def check_label_count(df: DataFrame, labels: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    """Entities against label lines per group."""
    entities = df.groupBy(spec.group).agg(F.count_distinct(spec.entity).alias("n_units"))
    lines = labels.groupBy(spec.group).agg(F.count(F.lit(1)).alias("n_labels"))
    zero = F.lit(0).cast("bigint")
    return (entities.join(lines, spec.group, "full")
            .select(spec.group, F.coalesce("n_units", zero).alias("n_units"),
                    F.coalesce("n_labels", zero).alias("n_labels"))
            .withColumn("matches", F.col("n_units") == F.col("n_labels")))


def rul_band_filter(df: DataFrame, spec: TelemetrySpec = SPEC,
                    bands: dict[int, tuple[int, int]] = RUL_BANDS) -> DataFrame:
    """Keep rows inside their group's inclusive band; rows of groups without a band go.

    A literal predicate, so that it prunes group partitions and reaches the Parquet reader.
    """
    g, y = F.col(spec.group), F.col(spec.target)
    keep = [(g == k) & y.between(lo, hi) for k, (lo, hi) in bands.items()]
    return df.filter(reduce(lambda a, b: a | b, keep))


def last_row_per_unit(df: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    """The row with the largest cycle of each series.

    A grouped maximum over whole rows: combined before the shuffle, so that a long series sends
    one row per task and never gathers in one place.
    """
    rest = [c for c in df.columns if c not in spec.keys]
    best = df.groupBy(*spec.keys).agg(F.max_by(F.struct(*rest), F.col(spec.order)).alias("_row"))
    return best.select(*[F.col(c) if c in spec.keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def max_cycle_per_unit(df: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    return df.groupBy(*spec.keys).agg(F.max(spec.order).alias("max_cycle"))


def check_terminal_row(df: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    """Series whose last cycle and least remaining life are not one and the same single row.

    Two grouped aggregates, both combined before the shuffle: the extremes, then the rows at them.
    """
    keys = list(spec.keys)
    ends = df.groupBy(*keys).agg(F.max(spec.order).alias("_c"), F.min(spec.target).alias("_r"))
    at_c, at_r = F.col(spec.order) == F.col("_c"), F.col(spec.target) == F.col("_r")
    marked = df.select(*keys, spec.order, spec.target).join(ends, keys).filter(at_c | at_r)
    counted = marked.groupBy(*keys).agg(
        F.count_if(at_c).alias("n_max_cycle"), F.count_if(at_r).alias("n_min_rul"),
        F.count_if(at_c & at_r).alias("n_both"))
    return counted.filter((F.col("n_max_cycle") != 1) | (F.col("n_min_rul") != 1) | (F.col("n_both") != 1))
