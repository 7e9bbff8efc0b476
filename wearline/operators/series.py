"""Windows over long series without putting one series into one task.

A window partitioned by entity reads each entity in a single task. That is fine until one
entity holds a large share of all rows. `plan_series` looks for such entities with one narrow
aggregate. If there are none, windows run over the plain keys: one shuffle, nothing added.
Otherwise the rows of the long entities are cut along the order column into blocks, and the
few rows a trailing frame needs from before a block are copied into it and dropped after the
window. The result is the same row for row.

How blocks are found: each long entity's order values are cut at approximate quantiles, so a burst
or a value far off does not fill one slice; row counts of the slices come from a map-side aggregate,
and neighbouring slices are packed into blocks. All tables involved are bounded: at most MAX_BLOCKS
entities can be long, and an entity has at most SLICES slices per block.

`number_rows` numbers a whole table in one order, without a sort in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wearline.session import stored

ROWS_PER_BLOCK = 2_000_000
MAX_BLOCKS = 4096
SLICES = 4

_SLICE, _BLOCK, _HALO, _START, _CUTS = "_slice", "_block", "_halo", "_block_start", "_cuts"


@dataclass(frozen=True)
class SeriesLayout:
    """How the rows of a table are cut for windows: `long_series` is None when nothing is cut."""

    keys: tuple[str, ...]
    order: str
    block_rows: int
    long_series: DataFrame | None = None
    slices: DataFrame | None = None

    @property
    def is_cut(self) -> bool:
        return self.long_series is not None


def plan_series(df: DataFrame, keys: tuple[str, ...], order: str, *,
                rows_per_block: int = ROWS_PER_BLOCK, dense: bool = False) -> SeriesLayout:
    """Find entities that need cutting. `dense` states that order runs 1, 2, ... n per entity.

    `order` must be numeric or a timestamp and NOT NULL. Equal order values stay in one block.
    """
    where = _number(df, order)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, longest = sizes.agg(F.sum("_n"), F.max("_n")).first()
    if longest is None or longest <= rows_per_block:
        return SeriesLayout(keys, order, rows_per_block)

    block_rows = max(rows_per_block, math.ceil(total / MAX_BLOCKS))
    # At most MAX_BLOCKS entities can exceed block_rows, so this table is small by construction.
    long_rows = sizes.filter(F.col("_n") > block_rows).collect()
    if not long_rows:
        return SeriesLayout(keys, order, block_rows)
    n = SLICES * math.ceil(longest / block_rows)
    points = np.arange(1, n) / n
    named = {k: f"_key_{i}" for i, k in enumerate(keys)}
    long_keys = df.sparkSession.createDataFrame(long_rows, sizes.schema).withColumnsRenamed(named)
    if dense:
        cuts = F.transform(F.lit(points), lambda p: F.ceil(p * F.col("_n")) + F.lit(1.0))
        found = long_keys.select(*named.values(), cuts.alias(_CUTS))
    else:
        same = [F.col(k).eqNullSafe(F.col(c)) for k, c in named.items()]
        own = df.select(*keys, where.alias("_where")).join(F.broadcast(long_keys), same)
        found = own.groupBy(*named.values()).agg(F.percentile_approx("_where", F.lit(points), 4 * n).alias(_CUTS))
    # Several passes read the cuts, and every one of them must see the same.
    long_series = stored(found.withColumnsRenamed({c: k for k, c in named.items()}), "cuts")

    counts = (_with_slice(df, keys, order, long_series, "inner")
              .groupBy(*keys, _SLICE).agg(F.count(F.lit(1)).alias("_n")))
    along = Window.partitionBy(*keys).orderBy(_SLICE)
    before = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1))
    slices = (counts.withColumn("_from", F.coalesce(before, F.lit(0)))
              .withColumn(_BLOCK, F.floor(F.col("_from") / block_rows))
              .withColumn(_START, F.min("_from").over(Window.partitionBy(*keys, _BLOCK))))
    return SeriesLayout(keys, order, block_rows, long_series, slices)


def add_windows(df: DataFrame, layout: SeriesLayout, halo: int,
                build: Callable[[DataFrame, WindowSpec], DataFrame]) -> DataFrame:
    """Run `build(rows, window)`; its frames may look back at most `halo` rows."""
    if not layout.is_cut:
        return build(df, Window.partitionBy(*layout.keys).orderBy(layout.order))

    # A slice also goes to each later block that starts less than `halo` rows after it ends.
    # Slices are never empty, so those blocks begin within the next `halo` slices.
    along = Window.partitionBy(*layout.keys).orderBy(_SLICE)
    ahead = F.collect_list(F.struct(F.col(_BLOCK), F.col(_START))).over(along.rowsBetween(1, max(halo, 1)))
    end = F.col("_from") + F.col("_n")
    later = F.transform(
        F.filter(ahead, lambda b: (b[_BLOCK] > F.col(_BLOCK)) & (b[_START] - end < halo)),
        lambda b: b[_BLOCK])
    sent_to = layout.slices.select(
        *layout.keys, _SLICE, F.col(_BLOCK).alias("_own"),
        F.array_union(F.array(_BLOCK), later).alias("_blocks"))

    rows = (_with_slice(df, layout.keys, layout.order, layout.long_series, "left")
            .join(F.broadcast(sent_to), [*layout.keys, _SLICE], "left")
            .withColumn(_BLOCK, F.explode(F.coalesce("_blocks", F.array(F.lit(0).cast("bigint")))))
            .withColumn(_HALO, F.coalesce(F.col(_BLOCK) != F.col("_own"), F.lit(False)))
            .drop(_SLICE, "_blocks", "_own"))
    out = build(rows, Window.partitionBy(*layout.keys, _BLOCK).orderBy(layout.order))
    return out.filter(~F.col(_HALO)).drop(_HALO, _BLOCK)


def add_position(df: DataFrame, layout: SeriesLayout, order_by: list[str], name: str) -> DataFrame:
    """Number the rows of each entity 1, 2, ... by `order_by`, whose first column is the layout's order."""
    if not layout.is_cut:
        w = Window.partitionBy(*layout.keys).orderBy(*order_by)
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    rows = (_with_slice(df, layout.keys, layout.order, layout.long_series, "left")
            .join(F.broadcast(layout.slices.select(*layout.keys, _SLICE, _BLOCK, _START)),
                  [*layout.keys, _SLICE], "left"))
    w = Window.partitionBy(*layout.keys, _BLOCK).orderBy(*order_by)
    position = F.row_number().over(w) + F.coalesce(_START, F.lit(0))
    return rows.withColumn(name, position.cast("bigint")).drop(_SLICE, _BLOCK, _START)


def add_running_total(df: DataFrame, layout: SeriesLayout, amount: str, name: str) -> DataFrame:
    """Sum of `amount` over the earlier rows of the series (0 on the first); order values must be distinct."""
    def earlier(w: WindowSpec) -> Column:
        total = F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(total, F.lit(0))

    keys = list(layout.keys)
    if not layout.is_cut:
        return df.withColumn(name, earlier(Window.partitionBy(*keys).orderBy(layout.order)))
    rows = (_with_slice(df, layout.keys, layout.order, layout.long_series, "left")
            .join(F.broadcast(layout.slices.select(*keys, _SLICE, _BLOCK)), [*keys, _SLICE], "left"))
    totals = rows.filter(F.col(_BLOCK).isNotNull()).groupBy(*keys, _BLOCK).agg(F.sum(amount).alias(amount))
    offsets = totals.select(*keys, _BLOCK, earlier(Window.partitionBy(*keys).orderBy(_BLOCK)).alias("_offset"))
    inside = earlier(Window.partitionBy(*keys, _BLOCK).orderBy(layout.order))
    return (rows.withColumn(name, inside).join(F.broadcast(offsets), [*keys, _BLOCK], "left")  # one row per block
            .withColumn(name, F.col(name) + F.coalesce("_offset", F.lit(0))).drop(_SLICE, _BLOCK, "_offset"))


def add_series_max(df: DataFrame, layout: SeriesLayout, column: str, name: str) -> DataFrame:
    """Attach the largest value of `column` in the row's series.

    Uncut: a window, which shares its shuffle with other windows on the keys. Cut: a grouped
    maximum (combined before the shuffle) joined back; adaptive execution splits the long keys.
    """
    if not layout.is_cut:
        return df.withColumn(name, F.max(column).over(Window.partitionBy(*layout.keys)))
    named = {k: f"_key_{i}" for i, k in enumerate(layout.keys)}
    top = df.groupBy(*[F.col(k).alias(n) for k, n in named.items()]).agg(F.max(column).alias(name))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in named.items()]  # NULL keys are one series, as in a window
    return df.join(top, same, "left").drop(*named.values())


def _number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def _with_slice(df: DataFrame, keys: tuple[str, ...], order: str, long_series: DataFrame, how: str) -> DataFrame:
    """Slice of each row of a long entity, the number of cuts at or below its order value; NULL for the others."""
    where = _number(df, order)
    levels = (SLICES * MAX_BLOCKS * 2).bit_length()

    def halved(at: Column, step: Column) -> Column:
        passed = (at + step <= F.size(_CUTS)) & (F.get(F.col(_CUTS), at + step - 1) <= where)
        return F.when(passed, at + step).otherwise(at)

    steps = F.array(*[F.lit(2 ** k) for k in reversed(range(levels))])
    number = F.aggregate(steps, F.lit(0), halved)
    return (df.join(F.broadcast(long_series), list(keys), how)
            .withColumn(_SLICE, F.when(F.col(_CUTS).isNotNull(), number).cast("bigint"))
            .drop(_CUTS))


def number_rows(df: DataFrame, order_by: list[str], name: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Number all rows 1, 2, ... by `order_by`, whose columns must tell rows apart where the number matters.

    A table of more than `rows_per_block` rows is dealt into ranges at sampled quantiles of all of `order_by`, so
    ties of the first column are cut too; rows are numbered within their range and moved up by the rows before it.
    The ranges are written to the shared folder first: what is numbered later is what was counted.
    """
    blocks = -(-df.count() // rows_per_block)
    if blocks <= 1:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order_by)).cast("bigint"))
    ranged = stored(df.repartitionByRange(blocks, *order_by).withColumn(_BLOCK, F.spark_partition_id()), "ranges")
    counts = ranged.groupBy(_BLOCK).agg(F.count(F.lit(1)).alias("_n"))  # one row a range
    before = F.sum("_n").over(Window.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(_BLOCK, F.coalesce(before, F.lit(0)).alias(_START))
    inside = F.row_number().over(Window.partitionBy(_BLOCK).orderBy(*order_by))
    return (ranged.withColumn(name, inside).join(F.broadcast(offsets), _BLOCK)
            .withColumn(name, (F.col(name) + F.col(_START)).cast("bigint")).drop(_BLOCK, _START))
