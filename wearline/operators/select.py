"""Ordering, prefixes, entity sets, samples and column selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.operators.series import SeriesLayout, add_position, add_running_total, number_rows, plan_series
from wearline.spec import SPEC, TelemetrySpec

#: Hexadecimal digits by which a sample is counted before its edge is ordered.
PREFIX = 4


def order_telemetry(df: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    """Total order by group, entity and cycle (a range-partitioned sort)."""
    return df.orderBy(*spec.keys, spec.order)


def union_subsets(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def split_by_subset(df: DataFrame, groups: Sequence[int], spec: TelemetrySpec = SPEC) -> dict[int, DataFrame]:
    """One lazy frame per group; each is a predicate that prunes group partitions."""
    return {g: df.filter(F.col(spec.group) == g) for g in groups}


def entity_key(*frames: DataFrame, spec: TelemetrySpec = SPEC) -> list[str]:
    """What identifies an entity: (group, entity), or the entity alone where a table has no group."""
    return [k for k in spec.keys if k == spec.entity or all(k in f.columns for f in frames)]


def distinct_units(df: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    key = entity_key(df, spec=spec)
    return df.select(*key).distinct().orderBy(*key)


def common_units(left: DataFrame, right: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    key = entity_key(left, right, spec=spec)
    return left.select(*key).intersect(right.select(*key))


def semi_join_entities(df: DataFrame, entities: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    """Rows whose entity is listed. The list is made distinct and left to the optimizer, which
    broadcasts it only under its size threshold and splits skewed keys otherwise."""
    key = entity_key(df, entities, spec=spec)
    return df.join(entities.select(*key).distinct(), key, "left_semi")


def feedback_entities(feedback: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    """The entities that feedback names: its group, where it has one, and its engine."""
    return feedback.select(*[c for c in (spec.group,) if c in feedback.columns], F.col("engine_id").alias(spec.entity))


def recent_entities(df: DataFrame, feedback: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    """Rows of entities that appear in the given feedback. Feedback without a group column names entities of `df`
    by ids that are unique across groups."""
    return semi_join_entities(df, feedback_entities(feedback, spec), spec)


def _upto(bound: tuple[int, int] | int, spec: TelemetrySpec) -> Column:
    if not isinstance(bound, tuple):
        return F.col(spec.entity) <= bound
    group, entity = bound
    return (F.col(spec.group) < group) | ((F.col(spec.group) == group) & (F.col(spec.entity) <= entity))


def units_upto(df: DataFrame, bound: tuple[int, int] | int, spec: TelemetrySpec = SPEC) -> DataFrame:
    """Rows of the entities up to (group, entity) in their order, or up to an entity id."""
    return df.filter(_upto(bound, spec))


def slice_baseline_current(df: DataFrame, trained: DataFrame, new: DataFrame, features: Sequence[str],
                           spec: TelemetrySpec = SPEC) -> tuple[DataFrame, DataFrame]:
    """Feature rows of the trained and of the new entities."""
    return tuple(semi_join_entities(df, ids, spec).select(*features) for ids in (trained, new))


def input_example(df: DataFrame, features: Sequence[str], spec: TelemetrySpec = SPEC) -> DataFrame:
    """The first feature row (a top-1, not a full sort)."""
    return df.orderBy(*spec.keys, spec.order).limit(1).select(*features)


def select_model_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Exactly the model's columns in the model's order; other columns are dropped."""
    missing = sorted(set(features) - set(df.columns))
    if missing:
        raise ValueError(f"missing required features: {missing}")
    return df.select(*features)


def row_prefix_fraction(df: DataFrame, fraction: float, spec: TelemetrySpec = SPEC,
                        layout: SeriesLayout | None = None) -> DataFrame:
    """The first floor(n * fraction) rows in (group, entity, cycle) order.

    No global sort: entities that lie wholly before or after the cut are decided from the
    entity counts, and only the entity on the cut has its rows numbered.
    """
    counts = df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("_n"))
    # Rows before each entity: totals per group first, then entities within their group, so that
    # no window covers the whole entity table.
    groups = counts.groupBy(spec.group).agg(F.sum("_n").alias("_gn"))
    earlier = Window.orderBy(spec.group).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(spec.group).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    groups = groups.select(spec.group, F.coalesce(F.sum("_gn").over(earlier), F.lit(0)).alias("_gbefore"),
                           F.floor(F.sum("_gn").over(everything) * F.lit(float(fraction))).alias("_quota"))
    placed = add_running_total(counts, plan_series(counts, (spec.group,), spec.entity), "_n", "_before")
    quota = (placed.join(groups, spec.group)
             .select(*spec.keys, F.least("_n", F.col("_quota") - F.col("_gbefore") - F.col("_before")).alias("_take"),
                     "_n").filter(F.col("_take") > 0))
    whole = df.join(quota.filter(F.col("_take") == F.col("_n")).select(*spec.keys), list(spec.keys), "left_semi")
    cut = df.join(quota.filter(F.col("_take") < F.col("_n")).select(*spec.keys, "_take"), list(spec.keys))
    numbered = add_position(cut, layout or plan_series(cut, spec.keys, spec.order), [spec.order], "_rn")
    return whole.unionByName(numbered.filter(F.col("_rn") <= F.col("_take")).drop("_rn", "_take"))


def entity_prefix(df: DataFrame, fraction: float, spec: TelemetrySpec = SPEC) -> DataFrame:
    """The first max(1, int(n * fraction)) entities by group and id. The product is a truncated double on purpose."""
    key = entity_key(df, spec=spec)
    units = df.select(*key).distinct()
    n = units.agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) * F.lit(float(fraction)))).alias("_k"))
    return number_rows(units, key, "_rn").join(F.broadcast(n), F.col("_rn") <= F.col("_k")).select(*key)


def entity_prefix_fraction(train: DataFrame, test: DataFrame, fraction: float,
                           spec: TelemetrySpec = SPEC) -> tuple[DataFrame, DataFrame]:
    """Both splits cut to the first entities of the training split."""
    first = entity_prefix(train, fraction, spec)
    return semi_join_entities(train, first, spec), semi_join_entities(test, first, spec)


def retrain_fraction(train: DataFrame, feedback: DataFrame, spec: TelemetrySpec = SPEC) -> DataFrame:
    """Share of training entities up to the last one, by group and id, in the feedback; 1.0 without entities."""
    named = feedback_entities(feedback, spec)
    key = entity_key(train, named, spec=spec)
    top = named.agg(F.max(F.struct(*key)).alias("_top"))
    units = train.select(*key).distinct().crossJoin(F.broadcast(top))  # one row
    return units.agg(F.coalesce(F.try_divide(F.count_if(F.struct(*key) <= F.col("_top")), F.count(F.lit(1))),
                                F.lit(1.0)).alias("fraction"))


def seeded_hash(key: Sequence[str], seed: int) -> Column:
    """MD5 of `seed:key:...`, in hexadecimal; a NULL part of the key is empty."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))


def smallest(df: DataFrame, order_by: Sequence[str], count: Column) -> DataFrame:
    """Exactly `count` (an aggregate over `df`) rows, the first by `order_by`, whose first column is a hexadecimal hash.

    Rows are counted by the hash's first digits (at most 16 ** PREFIX counts). Rows below the digits on which the
    count runs out are taken as they are; only the rows on those digits, about one in 16 ** PREFIX, are ordered.
    """
    digits = F.substring(order_by[0], 1, PREFIX)
    rows = df.withColumn("_digits", digits)
    counts = rows.groupBy("_digits").agg(F.count(F.lit(1)).alias("_n"))
    wanted = df.agg(count.cast("bigint").alias("_k"))
    upto = F.sum("_n").over(Window.orderBy("_digits"))  # at most 16 ** PREFIX rows
    edge = counts.withColumn("_upto", upto).crossJoin(F.broadcast(wanted)).withColumn("_left", F.col("_k") - F.col("_upto") + F.col("_n"))
    marked = rows.join(F.broadcast(edge.filter("_left > 0").select("_digits", "_n", "_left")), "_digits")
    whole = marked.filter("_left >= _n")
    cut = number_rows(marked.filter("_left < _n"), list(order_by), "_rn").filter("_rn <= _left").drop("_rn")
    return whole.unionByName(cut).select(*df.columns)


def sample_fraction(df: DataFrame, fraction: float, seed: int, key: Sequence[str]) -> DataFrame:
    """Repeatable sample of n * fraction rows, rounded half to even: the least by a seeded hash of `key`, whatever the partitioning.

    `key` should tell rows apart: of rows with the same key on the edge of the sample any may be taken.
    """
    rows = df.withColumn("_hash", seeded_hash(key, seed))
    return smallest(rows, ["_hash", *key], F.bround(F.count(F.lit(1)) * F.lit(float(fraction)))).drop("_hash")
