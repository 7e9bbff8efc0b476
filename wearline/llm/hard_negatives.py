"""Hard negatives by exact integer scores from a residue number system.

Vectors become whole numbers. A tile of anchors and a tile of candidates are multiplied once per prime: both
are reduced to centred residues, and a float32 matrix product of residues is exact while every partial sum stays
below 2 ** 24, which bounds the primes and the number of dimensions multiplied at a time. As many primes are used
as the largest possible score of the tile asks for (Cauchy and Schwarz over the longest vectors), and the signed
scores come back from their residues by Chinese remaindering in mixed radix.

Two passes over the tiles: the first finds the positives of each anchor, the second takes, in the window that each
positive's score opens, the best rows of other labels. Tiles are groups of bounded size; each is one task, and only
the few best rows of a tile leave it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearline.llm import common
from wearline.session import stored

ANCHOR_STEP = 100
#: Rows of an anchor tile and of a candidate tile, on average; anchors multiplied at a time inside a tile.
ANCHOR_ROWS, CANDIDATE_ROWS, STEP = 4096, 8192, 256
#: Dimensions multiplied at a time: 64 products of centred residues of primes below 1024 stay under 2 ** 24.
DEPTH, PRIME_LIMIT = 64, 1024
#: Squared length from which a score might not fit a long.
LONGEST = float(2 ** 60)


@dataclass(frozen=True)
class Mining:
    """How many positives and negatives, and the window of negatives in hundredths of the positive's score."""

    scale: int = 256
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90


def _primes_below(limit: int) -> list[int]:
    """Odd primes, largest first."""
    sieve = np.ones(limit, dtype=bool)
    sieve[:2] = False
    for p in range(2, int(limit ** 0.5) + 1):
        if sieve[p]:
            sieve[p * p::p] = False
    return np.flatnonzero(sieve)[:0:-1].tolist()


PRIMES = _primes_below(PRIME_LIMIT)


def primes_for(bound: int) -> list[int]:
    """Enough primes that every whole number from -bound to bound has residues of its own."""
    chosen, product = [], 1
    for p in PRIMES:
        if product > 2 * bound + 1:
            return chosen
        chosen.append(p)
        product *= p
    raise ValueError(f"scores up to {bound} need more primes than there are below {PRIME_LIMIT}")


def residues(rows: np.ndarray, prime: int) -> np.ndarray:
    """Centred residues, from -(prime - 1) / 2 to (prime - 1) / 2, as float32."""
    half = prime // 2
    return ((rows + half) % prime - half).astype(np.float32)


def product_modulo(a: list[np.ndarray], b: list[np.ndarray], prime: int) -> np.ndarray:
    """Centred residues of a @ b.T from slices of `DEPTH` dimensions, each an exact float32 product."""
    half = prime // 2
    total = np.zeros((len(a[0]), len(b[0])), dtype=np.int32)
    for x, y in zip(a, b):
        part = (x @ y.T).astype(np.int32)
        total = (total + part + half) % prime - half
    return total


def scores(residues_a: dict, residues_b: dict, primes: Sequence[int]) -> np.ndarray:
    """Signed scores from their residues: mixed-radix digits, each centred, summed up in 64 bits.

    The sum is below 2 ** 63 by the choice of primes' bound, so wrapping inside it cannot show.
    """
    digits: list[np.ndarray] = []
    value, weight = None, 1
    for k, p in enumerate(primes):
        half = p // 2
        rest = product_modulo(residues_a[p], residues_b[p], p).astype(np.int64)
        for q, d in zip(primes[:k], digits):
            rest = (rest - d) * pow(q, -1, p) % p
        digit = (rest + half) % p - half
        digits.append(digit)
        step = digit * np.int64((weight + 2 ** 63) % 2 ** 64 - 2 ** 63)
        value = step if value is None else value + step
        weight *= p
    return value


def _lists(table: pa.Table) -> pa.ListArray:
    return pa.concat_arrays(table["v"].chunks)  # a group may come in several batches


class Tile:
    """Ids, labels and whole-number vectors of a tile, sorted by id; residues are made once per prime."""

    def __init__(self, table: pa.Table, width: int):
        ids = table["id"].to_numpy()
        order = np.lexsort((table["label"].to_numpy(), ids))
        self.id, self.label = ids[order], table["label"].to_numpy()[order]
        lists = _lists(table)
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.v = np.zeros((len(ids), width), dtype=np.int64)
        # Missing components of shorter vectors count as zero.
        self.v[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        self.v = self.v[order]

    def longest(self) -> int:
        """Largest squared length; below 2 ** 61 each, as `whole_vectors` sees to it."""
        return int((self.v * self.v).sum(axis=1).max(initial=0))

    def reduced(self, primes: Sequence[int], rows: slice = slice(None)) -> dict[int, list[np.ndarray]]:
        width = max(1, self.v.shape[1])
        return {p: [residues(self.v[rows, d:d + DEPTH], p) for d in range(0, width, DEPTH)] for p in primes}


def tiles(left: pa.Table, right: pa.Table) -> tuple[Tile, Tile]:
    width = max(int(_lists(t).value_lengths().to_numpy(zero_copy_only=False).max(initial=0)) for t in (left, right))
    return Tile(left, width), Tile(right, width)


def scored(a: Tile, c: Tile) -> Iterator[tuple[int, np.ndarray]]:
    """(first anchor row, scores of the next `STEP` anchors against all candidates of the tile)."""
    # |a . c| <= sqrt(|a|^2 * |c|^2); one more for the rounding of the root.
    primes = primes_for(int(np.ceil(np.sqrt(float(a.longest()) * float(c.longest())) * (1 + 1e-9))) + 1)
    right = c.reduced(primes)
    for start in range(0, len(a.id), STEP):
        yield start, scores(a.reduced(primes, slice(start, start + STEP)), right, primes)


def best(score: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """The k of `rows` (ascending, so ties go to the smaller id) with the highest scores."""
    mine = score[rows]
    if len(rows) <= k:
        return rows
    least = np.partition(mine, len(mine) - k)[len(mine) - k]
    above = np.flatnonzero(mine > least)
    return rows[np.sort(np.r_[above, np.flatnonzero(mine == least)[:k - len(above)]])]


FOUND = "anchor_id long, slot int, positive_id long, positive_score long, vec_id long, score long"


def _table(parts: list[tuple]) -> pa.Table:
    names = ("anchor_id", "slot", "positive_id", "positive_score", "vec_id", "score")
    kinds = (np.int64, np.int32, np.int64, np.int64, np.int64, np.int64)
    columns = list(zip(*parts)) if parts else [()] * len(names)
    return pa.table({n: np.concatenate(c).astype(k) if len(c) else np.empty(0, dtype=k)
                     for n, k, c in zip(names, kinds, columns)})


def tile_positives(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The k best rows of the anchor's label in this tile, never a row with the anchor's id."""
    parts = []
    if left.num_rows and right.num_rows:
        a, c = tiles(left, right)
        for start, score in scored(a, c):
            for i, s in enumerate(score):
                anchor = a.id[start + i]
                rows = best(s, np.flatnonzero((c.label == a.label[start + i]) & (c.id != anchor)), k)
                fill = np.zeros(len(rows), dtype=np.int64)
                parts.append((fill + anchor, fill, fill, fill, c.id[rows], s[rows]))
    return _table(parts)


def tile_negatives(left: pa.Table, right: pa.Table, m: Mining) -> pa.Table:
    """For each positive of an anchor, the best rows of other labels inside the positive's window."""
    parts = []
    if left.num_rows and right.num_rows:
        a, c = tiles(left, right)
        wanted = left.select(["id", "positives"]).to_pylist()
        positives = {r["id"]: r["positives"] for r in wanted}
        for start, score in scored(a, c):
            for i, s in enumerate(score):
                anchor = int(a.id[start + i])
                other = c.label != a.label[start + i]
                for p in positives[anchor]:
                    at = p["score"]  # bounds in Python numbers, which do not overflow
                    low, high = -(-m.low * at // 100), m.high * at // 100
                    rows = best(s, np.flatnonzero(other & (s >= low) & (s <= high)), m.negatives)
                    fill = np.zeros(len(rows), dtype=np.int64)
                    parts.append((fill + anchor, fill + p["slot"], fill + p["vec_id"], fill + at, c.id[rows], s[rows]))
    return _table(parts)


def whole_vectors(vectors: DataFrame, key: str = "vec_id", value: str = "embedding", label: str = "label",
                  scale: int = Mining.scale) -> DataFrame:
    """(id, label, v) with v = floor(scale * x) of each component.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. A vector so long
    that a score might not fit 64 bits (squared length from 2 ** 60 on) stops the job with its id named.
    """
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = (vectors.select(vectors[key].cast("long").alias("id"), vectors[label].cast("long").alias("label"),
                           vectors[value].cast("array<double>").alias("x"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite))
    squared = F.aggregate("x", F.lit(0.0), lambda s, c: s + (c * scale) * (c * scale))
    message = F.format_string("vector %s is too long for exact 64-bit scores", "id")
    v = F.transform("x", lambda c: F.floor(c * scale))
    return rows.select("id", "label", F.when(squared >= LONGEST, F.raise_error(message)).otherwise(v).alias("v"))


def _paired(anchors: DataFrame, rows: DataFrame, n_a: int, n_c: int):
    """Each anchor tile beside each candidate tile: a stated query set against all rows, in blocks."""
    left = (anchors.withColumn("a", F.pmod(F.xxhash64("id"), F.lit(n_a)).cast("int"))
            .withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1)))))
    # New columns under the old names: a cogroup of two tables made from one loses columns they share.
    right = (rows.select(*[F.col(c).alias(c) for c in rows.columns]).withColumn("c", F.pmod(F.xxhash64("id", "label", "v"), F.lit(n_c)).cast("int"))
             .withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(n_a - 1)))))
    return left.groupBy("a", "c").cogroup(right.groupBy("a", "c"))


def mine(anchors: DataFrame, rows: DataFrame, m: Mining = Mining()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for (id, label, v) tables.

    Positives of an anchor are its best rows of the same label and another id; the negatives of a positive are
    the best rows of other labels with low * positive <= 100 * score <= high * positive, so a negative positive
    score opens no window. Ties go to the smaller id. Anchors that repeat an id are asked once, with the least
    (label, vector); rows that repeat an id are searched and listed as often as they occur. An anchor without
    positives, or a positive without negatives, gives no row; empty tables give no rows.
    """
    asked = anchors.groupBy("id").agg(F.min(F.struct("label", "v")).alias("_least")).select("id", "_least.label", "_least.v")
    n_a, n_c = common.blocks_for(asked.count(), ANCHOR_ROWS), common.blocks_for(rows.count(), CANDIDATE_ROWS)

    near = _paired(asked, rows, n_a, n_c).applyInArrow(lambda x, y: tile_positives(x, y, m.positives), FOUND)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")  # `positives` rows a tile at most
    near = near.withColumn("slot", F.row_number().over(order)).where(F.col("slot") <= m.positives)
    chosen = near.groupBy(F.col("anchor_id").alias("id")).agg(  # at most `positives` entries
        F.collect_list(F.struct("slot", "vec_id", "score")).alias("positives"))
    opened = stored(asked.join(chosen, "id"), "positives")

    far = _paired(opened, rows, n_a, n_c).applyInArrow(lambda x, y: tile_negatives(x, y, m), FOUND)
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")  # `negatives` rows a tile
    return (far.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= m.negatives)
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def digest(vectors: DataFrame, m: Mining = Mining()) -> DataFrame:
    """Every hundredth id mines among all rows; where the id is divisible by 7 the label first becomes (label + 1) % 10.

    Nulls, odd vectors, ties and repeated rows: see `whole_vectors` and `mine`. Other columns are not read.
    """
    rows = whole_vectors(vectors, scale=m.scale)
    rows = rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(rows.where(F.col("id") % ANCHOR_STEP == 0), rows, m)


DIGEST_SQL = """
with v as (
  select vec_id::bigint as id,
         case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.id as anchor_id, c.id, a.label = c.label as alike,
         list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from v a join v c on a.id % 100 = 0 and (a.id <> c.id or a.label <> c.label)),
positive as (
  select anchor_id, id as positive_id, score as positive_score,
         row_number() over (partition by anchor_id order by score desc, id) as slot
  from s where alike qualify slot <= 5),
ranked as (
  select p.*, n.id as negative_id, n.score as negative_score,
         row_number() over (partition by p.anchor_id, p.slot order by n.score desc, n.id) as rank
  from positive p join s n on n.anchor_id = p.anchor_id and not n.alike
    and 30 * p.positive_score <= 100 * n.score and 100 * n.score <= 90 * p.positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
from ranked where rank <= 10
"""
