"""Distribution drift (PSI, KS) of many features at once, drift levels and the retrain decision.

Exact results come from the ladder of `ladder.py`: counts per bucket say which buckets can hold a wanted
quantile or the largest distribution distance. These are cut further and counted again, together for all
statistics that are asked for and with the others laid together, until few rows are left in them; only the distinct
values of those are shuffled and ordered, once. Counts per bucket are arrays, bounded by the number of cuts. A baseline
that is checked again and again keeps its statistics (`keep_statistics`): ladder,
totals, edges, bin counts, and its rows as narrow as they can be derived from again. A check then reads the current
sample, the small tables and, for the features with buckets that matter, the kept rows, and the training table not
at all. Distinct values by bucket are not kept: they are nearly as many as the cells, and each was shuffled for it.

NULL and NaN cells are left out on both sides; `dropped_cells` reports how many.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.operators import ladder
from wearline.session import stored
from wearline.spec import DriftThresholds

N_BINS = 10
EPSILON = 1e-6
#: Rows in open buckets that KS and quantiles order at most, while cutting the buckets further still helps.
KS_ROWS = 1_000_000
#: Parts an open bucket is cut into, and rounds.
KS_PARTS, KS_ROUNDS = 256, 8
#: So many parts that leave a feature nine tenths of its rows will leave them the next time too.
STUCK_PARTS = 8
#: Cuts of all features together: one for each CELLS_PER_CUT cells, but so many at least and at most.
CELLS_PER_CUT, KS_CUTS, MOST_CUTS = 256, 400_000, 2_000_000
#: Rows a join may broadcast; beyond, which only like samples reach, the optimizer decides.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Samples:
    """Baseline (b) and current sample (c): wide rows with `side`, cuts per feature, and rows per (bucket, side)."""

    features: tuple[str, ...]
    rows: DataFrame
    cuts: list[np.ndarray]
    counts: list[np.ndarray]

    def values(self, wanted: dict[int, list[int]]) -> DataFrame:
        return ladder.count_values(self.rows, self.cuts, wanted)

    def binned(self, edges: dict[int, list[float]]) -> DataFrame:
        return ladder.count_bins(self.rows, edges)

    def recut(self, cuts: list[np.ndarray]) -> Samples:
        return Samples(self.features, self.rows, cuts, ladder.bucket_counts(self.rows, cuts))


def pair_samples(baseline: DataFrame, current: DataFrame, features: Sequence[str],
                 levels: int = ladder.LEVELS) -> Samples:
    """Lay both samples side by side. Pass stored tables: the rows are read once per pass.

    The ladder is cut from both samples together. Its buckets are cut into equal parts before they are counted first:
    like samples leave most of them open.
    """
    rows = ladder.sided(baseline, current, features)
    cuts = ladder.cuts_of(ladder.ladders(rows, features, levels), features)
    whole = {fid: np.arange(1, len(c)) for fid, c in enumerate(cuts) if len(c) > 1}
    whole = {fid: at[~ladder.single_valued(cuts[fid])[at]] for fid, at in whole.items()}
    cuts = _finer(cuts, whole, min(KS_PARTS, KS_CUTS // max(1, sum(map(len, whole.values())))))
    return Samples(tuple(features), rows, cuts, ladder.bucket_counts(rows, cuts))


def _table(spark: SparkSession, schema: str, *columns: Sequence) -> DataFrame:
    """A table of bounded size from the driver's arrays."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=[n for n, _ in fields]), schema)


# -- statistics kept for a baseline ---------------------------------------------------------------

#: Named features of the baseline's rows, from the narrow rows that were kept.
Derive = Callable[[DataFrame, Sequence[str]], DataFrame]


def _as_kept(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    return rows.select(*names)


@dataclass(frozen=True)
class BaselineStatistics:
    """Statistics of a baseline below `path`, as `keep_statistics` wrote them."""

    path: str
    features: tuple[str, ...]
    cuts: list[np.ndarray]
    edges: dict[int, list[float]]
    derive: Derive = _as_kept

    def against(self, current: DataFrame) -> KeptSamples:
        rows = ladder.sided(current.limit(0), current, self.features)
        counts = ladder.bucket_counts(rows, self.cuts)
        kept = current.sparkSession.read.parquet(f"{self.path}/totals").select("fid", "bucket", "b").toArrow()
        fids, buckets, n = (c.to_numpy() for c in kept.columns)
        for fid, own in enumerate(counts):
            own[buckets[fids == fid], 0] += n[fids == fid]
        return KeptSamples(self.features, rows, self.cuts, counts, self)


@dataclass(frozen=True)
class KeptSamples(Samples):
    """`rows` holds the current sample only; the baseline's share comes from its kept tables."""

    baseline: BaselineStatistics

    def _kept(self, names: Sequence[str]) -> DataFrame:
        rows = self.rows.sparkSession.read.parquet(f"{self.baseline.path}/rows")
        rows = self.baseline.derive(rows, names)
        return ladder.sided(rows, rows.limit(0), names)

    def values(self, wanted: dict[int, list[int]]) -> DataFrame:
        current = ladder.count_values(self.rows, self.cuts, wanted)
        fids = sorted(fid for fid, buckets in wanted.items() if buckets)
        if not fids:
            return current
        # Only the features with wanted buckets are derived, so their numbers are places in `fids`.
        kept = ladder.count_values(self._kept([self.features[fid] for fid in fids]), [self.cuts[fid] for fid in fids],
                                   {i: wanted[fid] for i, fid in enumerate(fids)})
        kept = kept.withColumn("fid", F.get(F.lit(fids).cast("array<int>"), F.col("fid")))
        both = kept.unionByName(current)
        return both.groupBy("fid", "bucket", "value").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))

    def binned(self, edges: dict[int, list[float]]) -> DataFrame:
        kept = self.rows.sparkSession.read.parquet(f"{self.baseline.path}/bins").withColumn("c", F.lit(0).cast("long"))
        both = kept.unionByName(ladder.count_bins(self.rows, edges))
        return both.groupBy("fid", "bin").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))

    def recut(self, cuts: list[np.ndarray]) -> Samples:
        both = self._kept(self.features).unionByName(self.rows)
        return Samples(self.features, both, cuts, ladder.bucket_counts(both, cuts))


def keep_statistics(baseline: DataFrame, features: Sequence[str], path: str, n_bins: int = N_BINS,
                    levels: int = ladder.LEVELS, derive: Derive | None = None) -> BaselineStatistics:
    """Write the statistics of a baseline below `path`; the table of edges comes last and says that all is there.

    With `derive` the baseline is given by narrow rows, which are kept as they are, and its features are those that
    `derive` makes of them. Otherwise it has the features, and they are kept. Cells are only counted, never shuffled.
    """
    spark = baseline.sparkSession
    narrow = baseline.select(*features) if derive is None else baseline
    narrow.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/rows")
    # Derived from the given rows, which may lie in buckets by series; features alone are read back.
    base = spark.read.parquet(f"{path}/rows") if derive is None else derive(baseline, features)
    rows = ladder.sided(base, base.limit(0), features)
    rungs = ladder.ladders(rows, features, levels)
    rungs.write.mode("overwrite").parquet(f"{path}/ladder")
    cuts = ladder.cuts_of(spark.read.parquet(f"{path}/ladder"), features)
    s = Samples(tuple(features), rows, cuts, ladder.bucket_counts(rows, cuts))
    used = [np.flatnonzero(n[:, 0]) for n in s.counts]
    _table(spark, "fid int, bucket int, b long", np.repeat(np.arange(len(used)), [len(u) for u in used]), np.concatenate(used),
           np.concatenate([n[u, 0] for n, u in zip(s.counts, used)])).coalesce(1).write.mode("overwrite").parquet(f"{path}/totals")
    settled = _settled(s, n_bins)
    bounds = settled.edges()
    bins = [(fid, i, int(n[0])) for fid, found in settled.bins(bounds).items() for i, n in enumerate(found) if n[0]]
    spark.createDataFrame(bins, "fid int, bin int, b long").coalesce(1).write.mode("overwrite").parquet(f"{path}/bins")
    edges = spark.createDataFrame(list(bounds.items()), "fid int, edges array<double>")
    edges.coalesce(1).write.mode("overwrite").parquet(f"{path}/edges")
    return load_statistics(spark, path, features, derive)


def load_statistics(spark: SparkSession, path: str, features: Sequence[str],
                    derive: Derive | None = None) -> BaselineStatistics | None:
    """The kept statistics, or None before they are written. The features and `derive` must be those they were written for."""
    try:
        edges = {r["fid"]: list(r["edges"]) for r in spark.read.parquet(f"{path}/edges").collect()}  # one row a feature
    except AnalysisException:
        return None
    return BaselineStatistics(path, tuple(features), ladder.cuts_of(spark.read.parquet(f"{path}/ladder"), features), edges,
                              derive or _as_kept)


def dropped_cells(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Missing cells per feature, which the drift statistics leave out."""
    counts = F.array(*[F.count_if(ladder.usable(c).isNull()) for c in features])
    return _named(df.agg(counts.alias("_n")).select(F.posexplode("_n").alias("fid", "dropped")), features)


# -- buckets that matter ------------------------------------------------------------------------

@dataclass(frozen=True)
class Settled:
    """Samples cut so far that few rows are left in the buckets that matter (`wanted`), and the running counts of their values.

    `known` is the largest gap seen at any bucket end, by feature. `ranked` is stored: (fid, bucket, value, b, c, b_upto,
    c_upto), or None where no bucket matters.
    """

    samples: Samples
    n_bins: int | None
    wanted: list[np.ndarray]
    known: np.ndarray
    ranked: DataFrame | None

    def quantiles(self) -> dict[int, list[float]]:
        """Quantiles per fid. Each quantile i lies between the order statistics at ranks floor(h) and floor(h)+1
        with h = (n-1) * i / n_bins."""
        at: dict[int, dict[int, float]] = {}
        asked: list[tuple[int, int, int]] = []
        for fid, counts in enumerate(self.samples.counts):
            ranks, buckets = _ranks(counts[:, 0], self.n_bins)
            open_ = np.isin(buckets, self.wanted[fid])
            # What is not open holds one value, its lower end.
            at[fid] = {int(r): float(self.samples.cuts[fid][b - 1]) for r, b in zip(ranks[~open_], buckets[~open_])}
            asked += [(fid, int(b), int(r)) for r, b in zip(ranks[open_], buckets[open_])]
        if asked:
            points = _table(self.ranked.sparkSession, "fid int, bucket int, rank long", *zip(*asked))  # 2 * (n_bins + 1) a feature
            hits = self.ranked.join(F.broadcast(points), ["fid", "bucket"]).filter("rank >= b_upto - b and rank < b_upto")
            for r in hits.select("fid", "rank", "value").collect():
                at[r["fid"]][r["rank"]] = r["value"]
        found = {}
        for fid, counts in enumerate(self.samples.counts):
            n = int(counts[:, 0].sum())
            if n:
                hs = [_rank_of(i, n, self.n_bins) for i in range(self.n_bins + 1)]
                found[fid] = [_between(at[fid][math.floor(h)], at[fid][min(math.floor(h) + 1, n - 1)], h - math.floor(h)) for h in hs]
        return found

    def edges(self) -> dict[int, list[float]]:
        """Edges per fid: the quantiles, or equal steps between the least and the largest value where quantiles repeat."""
        found = self.quantiles()
        for fid, q in found.items():
            if len(np.unique(q)) < self.n_bins + 1:
                step = (q[-1] - q[0]) / float(self.n_bins)
                found[fid] = [q[0] + i * step for i in range(self.n_bins)] + [q[-1]]
        return found

    def bins(self, edges: dict[int, list[float]]) -> dict[int, np.ndarray]:
        """Rows per (bin, side) of each fid: bins are closed on the left, the last on both sides.

        They come from the counts of whole buckets and the values of the wanted ones; only features with an edge inside
        another bucket are counted over the rows again.
        """
        s = self.samples
        found: dict[int, np.ndarray] = {}
        asked: list[tuple[int, int, int, float]] = []
        again: list[int] = []
        for fid, e in edges.items():
            points = np.r_[e[:-1], np.nextafter(e[-1], np.inf)]
            if not np.isfinite(points).all():
                again.append(fid)
                continue
            cuts, counts = s.cuts[fid], s.counts[fid]
            bucket = np.searchsorted(cuts, points, side="right")
            inside = (bucket > 0) & (points != cuts[np.maximum(bucket, 1) - 1]) & (counts[bucket].sum(axis=1) > 0)
            single = ladder.single_valued(cuts)[bucket]
            asks = inside & ~single
            if not np.isin(bucket[asks], self.wanted[fid]).all():
                again.append(fid)
                continue
            found[fid] = (np.cumsum(counts, axis=0) - counts)[bucket] + np.where((inside & single)[:, None], counts[bucket], 0)
            asked += [(fid, int(bucket[i]), int(i), float(points[i])) for i in np.flatnonzero(asks)]
        if asked:
            points = _table(self.ranked.sparkSession, "fid int, bucket int, i int, point double", *zip(*asked))
            below = (self.ranked.join(F.broadcast(points), ["fid", "bucket"]).filter("value < point")  # n_bins + 1 rows a feature
                     .groupBy("fid", "i").agg(F.sum("b").alias("b"), F.sum("c").alias("c")))
            for r in below.collect():
                found[r["fid"]][r["i"]] += (r["b"], r["c"])
        found = {fid: np.diff(below, axis=0) for fid, below in found.items()}
        if again:
            names = [s.features[fid] for fid in again]
            counted = ladder.count_bins(s.rows.select("side", *names), {i: edges[fid] for i, fid in enumerate(again)})
            found |= _binned(counted, {i: edges[fid] for i, fid in enumerate(again)}, again)
        return found

    def distances(self) -> dict[int, float]:
        """The largest gap between the two distribution functions, of features where both samples have values."""
        sizes = [n.sum(axis=0) for n in self.samples.counts]
        found = {fid: float(self.known[fid]) for fid, n in enumerate(sizes) if n.all()}
        if self.ranked is not None:
            both = sorted(found)
            all_of = _table(self.ranked.sparkSession, "fid int, b_all long, c_all long", both,
                            *([int(sizes[fid][side]) for fid in both] for side in (0, 1)))  # one row per feature
            gap = F.abs(F.col("b_upto") / F.col("b_all") - F.col("c_upto") / F.col("c_all"))
            for r in self.ranked.join(F.broadcast(all_of), "fid").groupBy("fid").agg(F.max(gap).alias("gap")).collect():
                found[r["fid"]] = max(found[r["fid"]], r["gap"])
        return found


def _settled(s: Samples, n_bins: int | None = None, ks: bool = False) -> Settled:
    """Cut the buckets that matter further, until at most KS_ROWS rows are left in them.

    What matters are the buckets that hold a rank of the n_bins quantiles, and those inside which the counts at their
    ends allow a larger gap than the largest seen at any end. Two large samples that are alike leave many of the latter:
    finer cuts find larger gaps at more ends and beat the reach of smaller buckets. Two equal samples end with all
    their distinct values. A bucket with room for one value has no inside.
    """
    known = np.zeros(len(s.cuts))
    live = [np.ones(len(counts), dtype=bool) for counts in s.counts]  # buckets that were laid together stay closed
    stuck, parts, rows = np.zeros(len(s.cuts), dtype=bool), 0, np.zeros(len(s.cuts), dtype=np.int64)
    for turn in range(KS_ROUNDS + 1):
        wanted, earlier, rows = [], rows, np.zeros(len(s.cuts), dtype=np.int64)
        for fid, counts in enumerate(s.counts):
            mask = np.zeros(len(counts), dtype=bool)
            if ks:
                known[fid], mask = _reaching(counts, known[fid])
            if n_bins:
                mask[_ranks(counts[:, 0], n_bins)[1]] = True
            mask &= live[fid] & ~ladder.single_valued(s.cuts[fid])
            wanted.append(np.flatnonzero(mask))
            rows[fid] = counts[mask].sum()
        # Few values with many rows each: no cut parts them, and a task sends each of them once a batch.
        stuck |= (parts >= STUCK_PARTS) & (10 * rows > 9 * earlier)
        buckets = sum(map(len, wanted))
        cells = sum(int(counts.sum()) for counts in s.counts)
        going = sum(len(at) for at, still in zip(wanted, stuck) if not still)
        parts = min(KS_PARTS, min(max(KS_CUTS, cells // CELLS_PER_CUT), MOST_CUTS) // max(1, going))
        if rows[~stuck].sum() <= KS_ROWS or turn == KS_ROUNDS or parts < 2:
            break
        finer = _finer(s.cuts, {fid: at for fid, at in enumerate(wanted) if not stuck[fid]}, parts)
        finer = _finer(finer, {fid: at for fid, at in enumerate(wanted) if stuck[fid]}, 1)
        live = [_inside(new, old, at) for new, old, at in zip(finer, s.cuts, wanted)]
        s = s.recut(finer)
    if not buckets:
        return Settled(s, n_bins, wanted, known, None)
    before = [(np.cumsum(counts, axis=0) - counts)[at] for counts, at in zip(s.counts, wanted)]
    offsets = _table(s.rows.sparkSession, "fid int, bucket int, b_before long, c_before long",
                     np.repeat(np.arange(len(wanted)), [len(w) for w in wanted]), np.concatenate(wanted),
                     *(np.concatenate([n[:, side] for n in before]) for side in (0, 1)))
    offsets = F.broadcast(offsets) if buckets <= BROADCAST_ROWS else offsets
    values = s.values({fid: at.tolist() for fid, at in enumerate(wanted) if len(at)})
    ranked = ladder.running_counts(values.join(offsets, ["fid", "bucket"]), "b", "c").drop("b_before", "c_before")
    return Settled(s, n_bins, wanted, known, stored(ranked, "ranked"))


def _ranks(counts: np.ndarray, n_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """The wanted ranks of a sample, at most 2 * (n_bins + 1), and the buckets that hold them."""
    n = int(counts.sum())
    if not n:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    low = [math.floor(_rank_of(i, n, n_bins)) for i in range(n_bins + 1)]
    ranks = np.unique([*low, *(min(r + 1, n - 1) for r in low)])
    return ranks, np.searchsorted(np.cumsum(counts), ranks, side="right")


def _reaching(counts: np.ndarray, known: float) -> tuple[float, np.ndarray]:
    """The largest gap at any bucket end, or the one known before; and the buckets inside which a larger one is possible."""
    nb, nc = (int(n) for n in counts.sum(axis=0))
    if not nb or not nc:
        return known, np.zeros(len(counts), dtype=bool)
    upto = np.cumsum(counts, axis=0)
    before = upto - counts
    known = max(known, float(np.abs(upto[:, 0] / nb - upto[:, 1] / nc).max()))
    return known, np.maximum(upto[:, 0] / nb - before[:, 1] / nc, upto[:, 1] / nc - before[:, 0] / nb) > known


def _finer(cuts: list[np.ndarray], wanted: dict[int, np.ndarray], parts: int) -> list[np.ndarray]:
    """Cuts with each wanted bucket cut into equal parts of the range that its two cuts leave, and the others laid together.

    Parts are equal in the order of the bits of a double, which is the order of the values: after at most eight
    rounds of 256 parts a part holds one value, whatever the distribution.
    """
    finer = list(cuts)
    for fid, buckets in wanted.items():
        bounds = np.r_[-np.inf, cuts[fid], np.inf]
        low, high = (_ordered(bounds[buckets + i]) for i in (0, 1))
        share = (high - low).astype(np.uint64) // np.uint64(max(1, parts))
        inner = low[:, None].astype(np.uint64) + share[:, None] * np.arange(1, parts, dtype=np.uint64)
        kept = np.unique(np.r_[bounds[buckets], bounds[buckets + 1], _valued(inner.ravel())])
        # One-valued buckets keep their cuts: what they hold is known without a look at their rows.
        single = np.flatnonzero(ladder.single_valued(cuts[fid]))
        finer[fid] = np.unique(np.r_[kept[np.isfinite(kept)], bounds[single], bounds[single + 1]])
    return finer


def _inside(cuts: np.ndarray, earlier: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Per bucket of `cuts`, whether it lies in a wanted one of `earlier`."""
    inside = np.zeros(len(earlier) + 1, dtype=bool)
    inside[wanted] = True
    return inside[np.searchsorted(earlier, np.r_[-np.inf, cuts], side="right")]


_SIGN = np.uint64(1 << 63)


def _ordered(values: np.ndarray) -> np.ndarray:
    """Doubles as whole numbers in the same order."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def _valued(numbers: np.ndarray) -> np.ndarray:
    return np.where(numbers & _SIGN, numbers ^ _SIGN, ~numbers).view(np.float64)


def _rank_of(i: int, n: int, n_bins: int) -> float:
    """Zero-based fractional rank of quantile i / n_bins."""
    return float(n - 1) * (float(i) / float(n_bins))


def _between(low: float, high: float, t: float) -> float:
    """Linear interpolation that is exact at both ends and for equal ends."""
    return high - (high - low) * (1.0 - t) if t >= 0.5 else low + (high - low) * t


# -- quantile edges ---------------------------------------------------------------------------

def quantile_bins(baseline: DataFrame, features: Sequence[str], n_bins: int = N_BINS) -> DataFrame:
    """`edges` per feature: n_bins + 1 interpolated quantiles, or equal steps where quantiles repeat."""
    found = _settled(pair_samples(baseline, baseline.limit(0), features), n_bins).edges()
    return _by_name(baseline.sparkSession, features, "edges array<double>", found)


def quantiles(df: DataFrame, features: Sequence[str], n: int) -> DataFrame:
    """`quantiles` per feature: the exact, interpolated quantiles 0 / n, 1 / n, ... n / n."""
    found = _settled(pair_samples(df, df.limit(0), features), n).quantiles()
    return _by_name(df.sparkSession, features, "quantiles array<double>", found)


# -- PSI ----------------------------------------------------------------------------------------

def psi_per_feature(baseline: DataFrame, current: DataFrame, features: Sequence[str],
                    n_bins: int = N_BINS, epsilon: float = EPSILON) -> DataFrame:
    """Population stability index per feature; features with an empty baseline give no row."""
    settled = _settled(pair_samples(baseline, current, features), n_bins)
    return _by_name(baseline.sparkSession, features, "psi double", _psi(settled.bins(settled.edges()), epsilon))


def _binned(counted: DataFrame, edges: dict[int, list[float]], fids: Sequence[int] | None = None) -> dict[int, np.ndarray]:
    """Counted bins as arrays (bin, side), by fid or by what `fids` says: n_bins rows a feature."""
    named = dict(enumerate(fids)) if fids is not None else {fid: fid for fid in edges}
    found = {named[fid]: np.zeros((len(e) - 1, 2), dtype=np.int64) for fid, e in edges.items()}
    for r in counted.collect():
        found[named[r["fid"]]][r["bin"]] = r["b"], r["c"]
    return found


def _psi(bins: dict[int, np.ndarray], epsilon: float) -> dict[int, float]:
    found = {}
    for fid, counts in bins.items():
        if counts.any():
            shares = [[n / max(float(counts[:, side].sum()), epsilon) for n in counts[:, side].tolist()] for side in (0, 1)]
            found[fid] = sum((pb - pc) * math.log((pb + epsilon) / (pc + epsilon)) for pb, pc in zip(*shares))
    return found


# -- KS -----------------------------------------------------------------------------------------

def ks_per_feature(baseline: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per feature, where both samples have values."""
    settled = _settled(pair_samples(baseline, current, features), ks=True)
    return _by_name(baseline.sparkSession, features, "ks double", settled.distances())


# -- levels and decision ------------------------------------------------------------------------

def drift_scores(baseline: DataFrame, current: DataFrame, features: Sequence[str],
                 n_bins: int = N_BINS, epsilon: float = EPSILON) -> DataFrame:
    """`psi` and `ks` per feature from one pair of samples."""
    settled = _settled(pair_samples(baseline, current, features), n_bins, ks=True)
    return _by_name(baseline.sparkSession, features, "psi double, ks double",
                    _psi(settled.bins(settled.edges()), epsilon), settled.distances())


def scores_against(kept: BaselineStatistics, current: DataFrame, epsilon: float = EPSILON) -> DataFrame:
    """`psi` and `ks` per feature of a sample against a baseline's kept statistics."""
    s = kept.against(current)
    psi = _psi(_binned(s.binned(kept.edges), kept.edges), epsilon)
    return _by_name(current.sparkSession, kept.features, "psi double, ks double", psi, _settled(s, ks=True).distances())


def feature_levels(scores: DataFrame, t: DriftThresholds = DriftThresholds()) -> DataFrame:
    """'alert' from the alert threshold on, 'warn' from the warning threshold on, else 'ok'."""
    def level(name: str, warn: float, alert: float) -> Column:
        v = F.col(name)
        return F.when(v >= alert, "alert").when(v >= warn, "warn").otherwise("ok")
    return scores.withColumns({"psi_level": level("psi", t.psi_warn, t.psi_alert),
                               "ks_level": level("ks", t.ks_warn, t.ks_alert)})


def drift_summary_stats(scores: DataFrame, t: DriftThresholds = DriftThresholds()) -> DataFrame:
    """Mean, maximum and alert ratio of both statistics; the ratio of both is over the PSI count."""
    n = F.count("psi")
    zero = F.lit(0.0)
    return scores.agg(
        n.alias("n_features"),
        F.coalesce(F.avg("psi"), zero).alias("avg_psi"), F.coalesce(F.max("psi"), zero).alias("max_psi"),
        F.coalesce(F.avg("ks"), zero).alias("avg_ks"), F.coalesce(F.max("ks"), zero).alias("max_ks"),
        F.coalesce(F.try_divide(F.count_if(F.col("psi") >= t.psi_alert), n), zero).alias("psi_alert_ratio"),
        F.coalesce(F.try_divide(F.count_if(F.col("ks") >= t.ks_alert), n), zero).alias("ks_alert_ratio"))


def evaluate_drift(scores: DataFrame, rmse: DataFrame, t: DriftThresholds = DriftThresholds()) -> DataFrame:
    """One row per row of `rmse` (current_rmse, baseline_rmse, ...): statistics, feature lists, score maps, decision.

    Retraining is due when the mean PSI or KS reaches its warning level or the RMSE passes its
    warning factor; alert levels are reported and never decide. A baseline RMSE of zero means
    that no model was trained yet, and is not compared.

    The scores are stored, one row per feature, as three aggregates read them.
    """
    scores = stored(scores, "scores")

    def names(score: str, level: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col(f"{score}_level") == level, F.col("feature"))))

    # One name per feature: bounded by the number of columns.
    lists = feature_levels(scores, t).agg(*[names(s, lv).alias(f"{s}_{lv}_features")
                                           for s in ("psi", "ks") for lv in ("warn", "alert")])
    # The same bound for the score of every feature by its name.
    maps = scores.agg(*[F.map_from_entries(F.array_sort(F.collect_list(
        F.when(F.col(s).isNotNull(), F.struct("feature", s))))).alias(f"{s}_scores") for s in ("psi", "ks")])
    base = F.when(F.col("baseline_rmse") > 0, F.col("baseline_rmse"))

    def worse(factor: float) -> Column:
        return F.coalesce(F.col("current_rmse") > base * factor, F.lit(False))

    report = rmse.crossJoin(F.broadcast(drift_summary_stats(scores, t))).crossJoin(F.broadcast(lists)).crossJoin(F.broadcast(maps))
    return report.withColumns({"rmse_warn": worse(t.rmse_warn_factor), "rmse_alert": worse(t.rmse_alert_factor)}) \
        .withColumn("should_retrain", (F.col("avg_psi") >= t.psi_warn) | (F.col("avg_ks") >= t.ks_warn)
                    | F.col("rmse_warn"))


def drift_gauges(report: DataFrame, t: DriftThresholds = DriftThresholds()) -> DataFrame:
    """Gauge values of a check. Flags use a strict comparison with the warning levels."""
    base = F.col("baseline_rmse")

    def flag(c: Column) -> Column:
        return F.when(c, 1.0).otherwise(0.0)

    return report.withColumns({
        "rmse_warn_threshold": base * t.rmse_warn_factor, "rmse_alert_threshold": base * t.rmse_alert_factor,
        "psi_warn_threshold": F.lit(t.psi_warn), "psi_alert_threshold": F.lit(t.psi_alert),
        "ks_warn_threshold": F.lit(t.ks_warn), "ks_alert_threshold": F.lit(t.ks_alert),
        "rmse_flag": flag(F.col("rmse_warn")), "psi_flag": flag(F.col("avg_psi") > t.psi_warn),
        "ks_flag": flag(F.col("avg_ks") > t.ks_warn)})


def _by_name(spark: SparkSession, features: Sequence[str], schema: str, *found: dict[int, object]) -> DataFrame:
    """One row per feature that has a result, by name."""
    fids = sorted(set().union(*found))
    kind = pa.list_(pa.float64()) if "array" in schema else pa.float64()
    columns = [pa.array([features[fid] for fid in fids], pa.string()), *(pa.array([f.get(fid) for fid in fids], kind) for f in found)]
    names = ["feature", *(field.split()[0] for field in schema.split(","))]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=names), f"feature string, {schema}")


def _named(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature id to feature name."""
    names = F.lit(list(features)).cast(T.ArrayType(T.StringType()))
    return df.withColumn("feature", F.get(names, F.col("fid")))
