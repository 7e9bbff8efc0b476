"""Exact ranks and order statistics of many columns at once, without gathering a column anywhere.

A table with k value columns becomes rows (feature id, value). Each feature gets a ladder:
approximate quantiles, from mergeable sketches of the wide rows, that cut its values into buckets
of similar size. The ladder is only a way of cutting: whatever the approximation, a value's
bucket number never falls as the value grows, so ranks computed as "rows in earlier buckets plus
rank within the bucket" are exact. Bucket totals are combined before the shuffle and number at
most features * buckets rows; only distinct values of the buckets that matter are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A ladder has 2 ** LEVELS buckets.
LEVELS = 8
# Buckets whose counts travel as one array.
CHUNK = 512
# Items a sketch keeps on its top level, for a rank error of about 0.4%, and sketches of a feature merged at a time.
SKETCH_ITEMS, SLOTS = 800, 64


def sketches(df: DataFrame, features: Sequence[str], k: int = SKETCH_ITEMS) -> DataFrame:
    """(fid, sketch): one mergeable quantile sketch per feature that has values.

    Every task of the scan makes one sketch per feature. These are merged per (feature, slot) and then per feature,
    so no task merges more than a slot's share of one feature's sketches, or SLOTS of them.
    """
    # One text for all columns: hundreds of column objects take longer to build than to run.
    clean = ["spark_partition_id() as _task"] + [f"nanvl(cast(`{c}` as double), null) as _{i}" for i, c in enumerate(features)]
    every = ", ".join(f"kll_sketch_agg_double(_{i}, {k})" for i in range(len(features)))
    per_task = df.selectExpr(*clean).groupBy("_task").agg(F.expr(f"array({every})").alias("_all"))
    rows = per_task.select((F.col("_task") % SLOTS).alias("_slot"), F.posexplode("_all").alias("fid", "sketch"))
    for by in (("fid", "_slot"), ("fid",)):
        rows = rows.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return rows.filter(F.kll_sketch_get_n_double("sketch") > 0)


def ladders(df: DataFrame, features: Sequence[str], levels: int = LEVELS) -> DataFrame:
    """One row per feature that has values: `fid`, `rungs`, the ascending bucket bounds, and `ends`, the least and largest value."""
    n = 2 ** levels
    points = F.lit(np.arange(1, n) / n)  # one array literal rather than an expression per point
    return sketches(df, features).select("fid", F.kll_sketch_get_quantile_double("sketch", points).alias("rungs"),
                                         F.kll_sketch_get_quantile_double("sketch", F.lit(np.array([0.0, 1.0]))).alias("ends"))


def usable(name: str) -> Column:
    """The value as a double, with NaN read as missing."""
    c = F.col(name).cast("double")
    return F.when(~F.isnan(c), c)


def to_long(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows (keep..., fid, value), one per non-missing cell; `fid` is the position in `features`."""
    # Missing cells are tested after the explode: one test in the loop instead of one per column.
    cells = F.posexplode(F.array(*[F.col(c).cast("double") for c in features])).alias("fid", "value")
    return df.select(*keep, cells).filter(F.col("value").isNotNull() & ~F.isnan("value"))


def with_buckets(long: DataFrame, rungs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Attach `bucket`, the number of rungs at or below the value, by halving: `levels` comparisons.

    One column a level: each is compiled, and few comparisons keep the generated method small enough for it.
    The ladder table has one row per column of the schema, so it is broadcast.
    """
    out = long.join(F.broadcast(rungs), "fid").withColumn("bucket", F.lit(0))
    for level in reversed(range(levels)):
        step = 2 ** level
        passed = F.col("value") >= F.get("rungs", F.col("bucket") + (step - 1))
        out = out.withColumn("bucket", F.col("bucket") + F.when(passed, step).otherwise(0))
    return out.select(*long.columns, "bucket")


def bucket_totals(bucketed: DataFrame, *sums: str) -> DataFrame:
    """Per (fid, bucket): each named count, the count in earlier buckets and in the whole feature."""
    totals = bucketed.groupBy("fid", "bucket").agg(*[F.sum(s).alias(s) for s in sums])
    by_feature = Window.partitionBy("fid")  # at most 2 ** LEVELS rows per feature
    earlier = by_feature.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "fid", "bucket", *sums,
        *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_before") for s in sums],
        *[F.sum(s).over(by_feature).alias(f"{s}_all") for s in sums])


def value_ranks(counted: DataFrame, offsets: DataFrame, *sums: str) -> DataFrame:
    """Running counts over distinct values.

    `counted` has one row per (fid, bucket, value); `offsets` comes from `bucket_totals` and is
    bounded by features * buckets. Adds `<s>_upto`, the count at or below the value.
    """
    return running_counts(counted.join(F.broadcast(offsets.drop(*sums)), ["fid", "bucket"]), *sums)


def running_counts(counted: DataFrame, *sums: str) -> DataFrame:
    """`<s>_upto` of rows (fid, bucket, value, each count, and `<s>_before`, the count in earlier buckets)."""
    w = Window.partitionBy("fid", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.withColumns({f"{s}_upto": F.col(f"{s}_before") + F.sum(s).over(w) for s in sums})


# -- passes over wide rows ----------------------------------------------------------------------
#
# Two samples lie in one table of wide rows with `side` 0 or 1. A pass reads Arrow batches column by column and
# keeps small arrays of counts, so cells are never made into rows: only totals, and values of wanted buckets, leave.

Batches = Iterator[pa.RecordBatch]


def sided(first: DataFrame, second: DataFrame, features: Sequence[str]) -> DataFrame:
    def part(df: DataFrame, side: int) -> DataFrame:
        return df.selectExpr(f"{side} as side", *[f"cast(`{c}` as double) as `{c}`" for c in features])
    return part(first, 0).unionByName(part(second, 1))


def cuts_of(rungs: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """The ladders as arrays, by fid: bounded by 2 * features * 2 ** LEVELS numbers.

    A rung that comes up several times is a value with much of the rows: it gets a bucket of its own. So do the least
    and the largest value, where the ladder tells them: no bucket with rows is then open to infinity.
    """
    found: dict[int, np.ndarray] = {}
    for r in rungs.collect():
        rung, times = np.unique(np.array(r["rungs"], dtype=np.float64) + 0.0, return_counts=True)
        ends = np.array(r["ends"] if "ends" in rungs.columns else [], dtype=np.float64) + 0.0
        cuts = np.unique(np.r_[rung, np.nextafter(rung[times > 1], np.inf), ends, np.nextafter(ends, np.inf)])
        found[r["fid"]] = cuts[np.isfinite(cuts)]
    return [found.get(i, np.empty(0)) for i in range(len(features))]


def single_valued(cuts: np.ndarray) -> np.ndarray:
    """Per bucket, whether only one value fits between its two cuts."""
    return np.r_[False, np.nextafter(cuts[:-1], np.inf) == cuts[1:], False] if len(cuts) else np.zeros(1, dtype=bool)


def _cells(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(fid, values, sides) of the cells that are neither NULL nor NaN."""
    side = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    for fid in range(batch.num_columns - 1):
        value = batch.column(fid + 1).to_numpy(zero_copy_only=False)
        here = ~np.isnan(value)
        yield fid, value[here] + 0.0, side[here]  # one zero


def _batch(names: Sequence[str], kinds: Sequence[type], parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    columns = zip(*parts) if parts else [()] * len(names)
    return pa.RecordBatch.from_pydict({
        n: np.concatenate(c).astype(k) if len(c) else np.empty(0, dtype=k) for n, k, c in zip(names, kinds, columns)})


def _counted(place: Callable[[int, np.ndarray], np.ndarray], sizes: list[int], name: str) -> Callable[[Batches], Batches]:
    """Counts of both sides by place, one array per feature and task; negative places are left out."""
    def run(batches: Batches) -> Batches:
        counts = [np.zeros(2 * n, dtype=np.int64) for n in sizes]
        for batch in batches:
            for fid, value, side in _cells(batch):
                at = place(fid, value)
                if len(at):
                    kept = at >= 0
                    counts[fid] += np.bincount(2 * at[kept] + side[kept], minlength=len(counts[fid]))
        parts = [(np.full(len(used := np.flatnonzero(both[0::2] + both[1::2])), fid), used, both[0::2][used], both[1::2][used])
                 for fid, both in enumerate(counts)]
        yield _batch(("fid", name, "b", "c"), (np.int32, np.int32, np.int64, np.int64), parts)
    return run


def count_buckets(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """(fid, bucket, b, c): rows of each side per bucket, the number of cuts at or below the value."""
    run = _counted(lambda fid, v: np.searchsorted(cuts[fid], v, side="right"), [len(c) + 1 for c in cuts], "bucket")
    return (rows.mapInArrow(run, "fid int, bucket int, b long, c long")
            .groupBy("fid", "bucket").agg(F.sum("b").alias("b"), F.sum("c").alias("c")))


def bucket_counts(rows: DataFrame, cuts: list[np.ndarray]) -> list[np.ndarray]:
    """Rows per bucket and side, one array (bucket, side) per feature: bounded by the number of cuts.

    A task sends arrays of CHUNK buckets and no row per bucket; they are added up as arrays, by feature and chunk.
    """
    sizes = [len(c) + 1 for c in cuts]

    def run(batches: Batches) -> Batches:
        counts = [np.zeros(2 * CHUNK * -(-n // CHUNK), dtype=np.int64) for n in sizes]
        for batch in batches:
            for fid, value, side in _cells(batch):
                at = np.searchsorted(cuts[fid], value, side="right")
                counts[fid] += np.bincount(2 * at + side, minlength=len(counts[fid]))
        for fid, both in enumerate(counts):
            chunks = both.reshape(-1, 2 * CHUNK)
            yield _chunked([(fid, k, chunks[k]) for k in np.flatnonzero(chunks.any(axis=1))])

    def add(batches: Batches) -> Batches:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for fid, chunk, part in zip(*(column.to_pylist() for column in batch.columns)):
                counts = np.frombuffer(part, dtype=np.int64)
                total[fid, chunk] = total[fid, chunk] + counts if (fid, chunk) in total else counts
        yield _chunked([(*at, counts) for at, counts in total.items()])

    schema = "fid int, chunk int, counts binary"
    added = rows.mapInArrow(run, schema).repartition("fid", "chunk").mapInArrow(add, schema).toArrow()
    found = [np.zeros((CHUNK * -(-n // CHUNK), 2), dtype=np.int64) for n in sizes]
    for fid, chunk, part in zip(*(column.to_pylist() for column in added.columns)):
        found[fid][CHUNK * chunk:CHUNK * (chunk + 1)] = np.frombuffer(part, dtype=np.int64).reshape(-1, 2)
    return [counts[:n] for counts, n in zip(found, sizes)]


def _chunked(parts: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    fids, chunks, counts = zip(*parts) if parts else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(fids, pa.int32()), pa.array(chunks, pa.int32()),
                                       pa.array([c.tobytes() for c in counts], pa.binary())], names=["fid", "chunk", "counts"])


def count_bins(rows: DataFrame, edges: dict[int, list[float]]) -> DataFrame:
    """(fid, bin, b, c): bins are closed on the left, the last on both sides; values outside the edges are not counted."""
    bounds = {fid: np.array(e) for fid, e in edges.items()}

    def place(fid: int, value: np.ndarray) -> np.ndarray:
        if fid not in bounds:
            return np.empty(0, dtype=np.int64)
        e = bounds[fid]
        inside = (value >= e[0]) & (value <= e[-1])
        return np.where(inside, np.searchsorted(e[:-1], value, side="right") - 1, -1)

    sizes = [len(bounds[i]) - 1 if i in bounds else 0 for i in range(len(rows.columns) - 1)]
    return (rows.mapInArrow(_counted(place, sizes, "bin"), "fid int, bin int, b long, c long")
            .groupBy("fid", "bin").agg(F.sum("b").alias("b"), F.sum("c").alias("c")))


def count_values(rows: DataFrame, cuts: list[np.ndarray], wanted: dict[int, list[int]] | None = None) -> DataFrame:
    """(fid, bucket, value, b, c): distinct values with their counts, of all buckets or of the wanted ones."""
    masks = None
    if wanted is not None:
        masks = {fid: np.isin(np.arange(len(cuts[fid]) + 1), buckets) for fid, buckets in wanted.items()}

    def run(batches: Batches) -> Batches:
        for batch in batches:
            parts = []
            for fid, value, side in _cells(batch):
                if masks is not None and fid not in masks:
                    continue
                if masks is not None:
                    here = masks[fid][np.searchsorted(cuts[fid], value, side="right")]
                    value, side = value[here], side[here]
                distinct, index = np.unique(value, return_inverse=True)
                both = np.bincount(2 * index + side, minlength=2 * len(distinct))
                parts.append((np.full(len(distinct), fid), np.searchsorted(cuts[fid], distinct, side="right"), distinct,
                              both[0::2], both[1::2]))
            yield _batch(("fid", "bucket", "value", "b", "c"), (np.int32, np.int32, np.float64, np.int64, np.int64), parts)

    return (rows.mapInArrow(run, "fid int, bucket int, value double, b long, c long")
            .groupBy("fid", "bucket", "value").agg(F.sum("b").alias("b"), F.sum("c").alias("c")))
