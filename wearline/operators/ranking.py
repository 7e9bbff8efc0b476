"""Feature ranking: Spearman correlation with the target, and simple per-column statistics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.operators import ladder
from wearline.operators.drift import quantiles
from wearline.session import stored

#: Most distinct target values whose ranks are kept in every task, and rows that are packed together.
TARGET_VALUES, PACK_ROWS = 1024, 50_000


def spearman(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Signed rank correlation of each feature with the target, over rows where both are present.

    Ranks of ties are averaged. Ranks come from the ladders, so no feature is ever sorted in one
    place: values are ranked within their bucket. A target of few distinct values has its ranks in every
    task, and cells travel packed; otherwise the target's ranks are joined to the cells. A constant column gives NULL.
    """
    levels = df.select(ladder.usable(target).alias("_y")).filter("_y is not null").distinct().limit(TARGET_VALUES + 1)
    ys = np.unique(np.array([r["_y"] for r in levels.collect()], dtype=np.float64) + 0.0)
    sums = _packed_sums(df, features, target, ys) if len(ys) <= TARGET_VALUES else _joined_sums(df, features, target)
    names = F.lit(list(features)).cast(T.ArrayType(T.StringType()))
    return sums.select(F.get(names, F.col("fid")).alias("feature"),
                       F.try_divide(F.col("_xy"), F.sqrt(F.col("_xx") * F.col("_yy"))).alias("rho"))


def _packed_sums(df: DataFrame, features: Sequence[str], target: str, ys: np.ndarray) -> DataFrame:
    """(fid, _xy, _xx, _yy): sums over centred ranks, with cells sent as packed (value, target, count) by bucket.

    What the driver holds is bounded by features * (buckets + TARGET_VALUES).
    """
    spark, k = df.sparkSession, len(features)
    rows = df.select(ladder.usable(target).alias("_y"), *[F.col(c).cast("double").alias(c) for c in features]).filter("_y is not null")
    cuts = ladder.cuts_of(stored(ladder.ladders(rows, features), "ladder"), features)

    def cells(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        code = np.searchsorted(ys, table.column(0).to_numpy() + 0.0)
        for fid in range(k):
            value = table.column(fid + 1).to_numpy(**({} if isinstance(table, pa.Table) else {"zero_copy_only": False}))
            here = ~np.isnan(value)
            yield fid, value[here] + 0.0, code[here]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Buckets first, then target values.
        counts = [np.zeros(len(c) + 1 + len(ys), dtype=np.int64) for c in cuts]
        for batch in batches:
            for fid, value, code in cells(batch):
                own = len(cuts[fid]) + 1
                counts[fid][:own] += np.bincount(np.searchsorted(cuts[fid], value, side="right"), minlength=own)
                counts[fid][own:] += np.bincount(code, minlength=len(ys))
        for fid, n in enumerate(counts):
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"fid": np.full(len(at), fid, dtype=np.int32), "at": at.astype(np.int32), "n": n[at]})

    found = [np.zeros(len(c) + 1 + len(ys), dtype=np.int64) for c in cuts]
    for fid, at, n in rows.mapInArrow(count, "fid int, at int, n long").groupBy("fid", "at").agg(F.sum("n")).collect():
        found[fid][at] = n
    before, ranks, spread, sizes = [], [], [], []
    for fid, n in enumerate(found):
        of_bucket, of_y = n[:len(cuts[fid]) + 1], n[len(cuts[fid]) + 1:]
        sizes.append(int(of_bucket.sum()))
        before.append(np.cumsum(of_bucket) - of_bucket)
        ranks.append(np.cumsum(of_y) - (of_y - 1) / 2 - (sizes[fid] + 1) / 2)  # average rank of ties, from the middle rank
        spread.append((fid, float((of_y * ranks[fid] ** 2).sum())))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= PACK_ROWS:
                yield from packed(pa.Table.from_batches(held))
                held = []
        if held:
            yield from packed(pa.Table.from_batches(held))

    def packed(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for fid, value, code in cells(table):
            if not len(value):
                continue
            order = np.lexsort((code, value))
            value, code = value[order], code[order]
            first = np.flatnonzero(np.r_[True, (value[1:] != value[:-1]) | (code[1:] != code[:-1])])
            n = np.diff(np.r_[first, len(value)])
            value, code = value[first], code[first]
            ends = np.r_[0, np.searchsorted(value, cuts[fid], side="left"), len(value)]
            used = np.flatnonzero(np.diff(ends))
            yield pa.RecordBatch.from_pydict({
                "fid": np.full(len(used), fid, dtype=np.int32), "bucket": used.astype(np.int32),
                "cells": [_pack(value[ends[b]:ends[b + 1]], code[ends[b]:ends[b + 1]], n[ends[b]:ends[b + 1]]) for b in used]})

    def add(group: pa.Table) -> pa.Table:
        fid, bucket = group.column("fid")[0].as_py(), group.column("bucket")[0].as_py()
        parts = [_unpack(b) for b in group.column("cells").to_pylist()]
        value, code, n = (np.concatenate(p) for p in zip(*parts))
        distinct, at = np.unique(value, return_inverse=True)
        of_value = np.bincount(at, weights=n, minlength=len(distinct))
        ry = np.bincount(at, weights=n * ranks[fid][code], minlength=len(distinct))
        centred = before[fid][bucket] + np.cumsum(of_value) - (of_value - 1) / 2 - (sizes[fid] + 1) / 2
        return pa.table({"fid": pa.array([fid], pa.int32()), "_xy": [float((centred * ry).sum())],
                         "_xx": [float((of_value * centred ** 2).sum())]})

    sums = (rows.mapInArrow(pack, "fid int, bucket int, cells binary").groupBy("fid", "bucket")
            .applyInArrow(add, "fid int, _xy double, _xx double")
            .groupBy("fid").agg(F.sum("_xy").alias("_xy"), F.sum("_xx").alias("_xx")))
    return sums.join(F.broadcast(spark.createDataFrame(spread, "fid int, _yy double")), "fid")  # one row per feature


def _pack(value: np.ndarray, code: np.ndarray, n: np.ndarray) -> bytes:
    """The arrays byte plane by byte plane: of sorted values the high planes hardly change, and compress away."""
    arrays = (value.astype("<f8"), code.astype("<u2"), n.astype("<u4"))
    return b"".join(a.view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays)


def _unpack(cells: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(cells, dtype=np.uint8).reshape(14, -1)
    return tuple(np.ascontiguousarray(planes[a:b].T).view(kind).ravel()
                 for a, b, kind in ((0, 8, "<f8"), (8, 10, "<u2"), (10, 14, "<u4")))


def _joined_sums(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """The same sums with the target's ranks joined to the cells, which are summed per distinct value."""
    columns = [*features, target]
    rungs = stored(ladder.ladders(df, columns), "ladder")
    y_id = len(features)
    cells = ladder.to_long(df.withColumn("_y", ladder.usable(target)).filter(F.col("_y").isNotNull()), features, ("_y",))

    # Target side: every feature has its own ranks, since its missing cells drop out.
    y_rungs = rungs.filter(F.col("fid") == y_id).select("rungs").crossJoin(
        df.sparkSession.range(y_id).select(F.col("id").cast("int").alias("fid")))
    y_cells = cells.select("fid", F.col("_y").alias("value"), F.lit(1).alias("n"))
    y_counts = (y_cells.groupBy("fid", "value").agg(F.sum("n").alias("n")))
    y_bucketed = stored(ladder.with_buckets(y_counts, y_rungs), "target-counts")
    y_ranked = ladder.value_ranks(y_bucketed, ladder.bucket_totals(y_bucketed, "n"), "n")
    mid = (F.col("n_all") + 1) / 2
    # Average rank of ties, measured from the middle rank.
    centred = F.col("n_upto") - (F.col("n") - 1) / 2 - mid
    ry = y_ranked.select("fid", F.col("value").alias("_y"), centred.alias("_ry"))
    y_spread = y_ranked.groupBy("fid").agg(F.sum(F.col("n") * centred * centred).alias("_yy"))

    x_cells = ladder.with_buckets(cells, rungs.filter(F.col("fid") < y_id))
    totals = ladder.bucket_totals(x_cells.withColumn("n", F.lit(1)), "n")
    by_value = (x_cells.join(ry, ["fid", "_y"]).groupBy("fid", "bucket", "value")
                .agg(F.count(F.lit(1)).alias("n"), F.sum("_ry").alias("_sy")))
    x_ranked = ladder.value_ranks(by_value, totals, "n")
    sums = x_ranked.groupBy("fid").agg(F.sum(centred * F.col("_sy")).alias("_xy"),
                                       F.sum(F.col("n") * centred * centred).alias("_xx"))
    return sums.join(F.broadcast(y_spread), "fid")  # one row per feature


def rank_features_spearman(df: DataFrame, features: Sequence[str], target: str, k: int | None = None,
                           signed: bool = False) -> DataFrame:
    """Features by falling correlation with the target, absolute unless `signed`; constant columns last."""
    rho = spearman(df, features, target)
    out = rho if signed else rho.withColumn("rho", F.abs("rho"))
    out = out.orderBy(F.desc_nulls_last("rho"), "feature")
    return out.limit(k) if k else out


def profile_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, nulls, mean, deviation, range and a constant flag per column: one aggregate over wide rows."""
    stats = F.array(*[F.struct(
        F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_rows"),
        F.count_if(ladder.usable(c).isNull()).alias("n_nulls"), F.avg(ladder.usable(c)).alias("mean"),
        F.stddev_samp(ladder.usable(c)).alias("std"), F.min(ladder.usable(c)).alias("min"),
        F.max(ladder.usable(c)).alias("max")) for c in columns])
    return (df.agg(stats.alias("_s")).select(F.explode("_s").alias("_r")).select("_r.*")
            .withColumn("is_constant", F.coalesce(F.col("min") == F.col("max"), F.lit(False))))


def baseline_stats(df: DataFrame, columns: Sequence[str], parts: int = 4) -> DataFrame:
    """Mean, deviation and `percentiles` per feature: the exact, interpolated quantiles 1 / parts, 2 / parts, ...

    Missing cells are left out; a column without values has NULL statistics.
    """
    stats = F.array(*[F.struct(
        F.lit(c).alias("feature"), F.avg(ladder.usable(c)).alias("mean"), F.stddev_samp(ladder.usable(c)).alias("std"))
        for c in columns])
    moments = df.agg(stats.alias("_s")).select(F.explode("_s").alias("_r")).select("_r.*")
    inner = quantiles(df, columns, parts).select("feature", F.slice("quantiles", 2, parts - 1).alias("percentiles"))
    return moments.join(F.broadcast(inner), "feature", "left")  # one row per feature


def variance_threshold(df: DataFrame, columns: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """Columns whose population variance exceeds the threshold."""
    var = F.array(*[F.struct(F.lit(c).alias("feature"), F.var_pop(ladder.usable(c)).alias("variance")) for c in columns])
    return (df.agg(var.alias("_s")).select(F.explode("_s").alias("_r")).select("_r.*")
            .filter(F.col("variance") > threshold))


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 16) -> DataFrame:
    """Mutual information, in nats, of each feature with the target, both cut into equal-width bins.

    Joint counts are combined before the shuffle and number at most features * bins * bins.
    """
    columns = [*features, target]
    spans = df.agg(*[F.min(ladder.usable(c)).alias(f"{c}__lo") for c in columns],
                   *[F.max(ladder.usable(c)).alias(f"{c}__hi") for c in columns])

    def bin_of(c: str):
        width = F.col(f"{c}__hi") - F.col(f"{c}__lo")
        place = F.floor(F.coalesce(F.try_divide(ladder.usable(c) - F.col(f"{c}__lo"), width), F.lit(0.0)) * bins)
        return F.when(ladder.usable(c).isNotNull(), F.least(place, F.lit(bins - 1)))

    binned = df.crossJoin(F.broadcast(spans)).select(  # one row of ranges
        bin_of(target).alias("_t"), F.posexplode(F.array(*[bin_of(c) for c in features])).alias("fid", "_x"))
    joint = binned.filter(F.col("_x").isNotNull() & F.col("_t").isNotNull()).groupBy("fid", "_x", "_t").agg(
        F.count(F.lit(1)).alias("_n"))

    total = F.sum("_n").over(Window.partitionBy("fid"))
    px, pt = F.sum("_n").over(Window.partitionBy("fid", "_x")), F.sum("_n").over(Window.partitionBy("fid", "_t"))
    term = F.col("_n") / total * F.ln(F.col("_n").cast("double") * total / (px.cast("double") * pt))
    names = F.lit(list(features)).cast(T.ArrayType(T.StringType()))
    return (joint.select("fid", term.alias("_mi")).groupBy("fid").agg(F.sum("_mi").alias("mutual_information"))
            .select(F.get(names, F.col("fid")).alias("feature"), "mutual_information"))
