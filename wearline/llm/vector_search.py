"""Exact top-k search by inner product, term at a time.

Every dimension is a term. A block of candidate vectors is turned into postings: for each dimension the rows
that are not zero there, with their weights. For a block of queries a dense array of scores is kept; each term
of the queries scatters its weighted postings into it, and after the last term a partition selection takes the
best rows of the block. The best of all blocks are merged by query.

Candidates and queries are dealt into blocks of bounded size; a task sees one block of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearline.llm import common

SCALE = 1024
QUERY_STEP = 100
TOP = 10
#: Rows of a candidate block and of a query block, on average.
CANDIDATE_ROWS, QUERY_ROWS = 4096, 1024


def quantized(vectors: DataFrame, key: str = "vec_id", value: str = "embedding") -> DataFrame:
    """(id, v): floor(1024 * x) of each component, without vectors that are null or hold null or non-finite x.

    Rows with a null id take no part either, as they can neither ask nor be named.
    """
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (vectors.select(vectors[key].cast("long").alias("id"), vectors[value].cast("array<double>").alias("x"))
            .where(F.col("id").isNotNull() & F.col("x").isNotNull() & finite)
            .select("id", F.transform("x", lambda c: F.floor(c * SCALE)).alias("v")))


def postings(rows: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Dimension -> (rows, weights) without zeros; vectors may differ in length."""
    if not rows:
        return {}
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    term = np.concatenate([np.arange(len(r)) for r in rows])
    weight = np.concatenate(rows).astype(np.int64)
    use = weight != 0
    row, term, weight = row[use], term[use], weight[use]
    order = np.argsort(term, kind="stable")
    row, term, weight = row[order], term[order], weight[order]
    cuts = np.flatnonzero(np.diff(term)) + 1
    return {int(t[0]): (r, w) for t, r, w in zip(np.split(term, cuts), np.split(row, cuts), np.split(weight, cuts))
            if len(t)}


def best_of_block(query_ids: np.ndarray, queries: list[np.ndarray], ids: np.ndarray, rows: list[np.ndarray],
                  k: int, step: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, row ids, scores) of each query's k best rows of the block; ties go to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], [rows[i] for i in order]
    lists = postings(rows)
    for a in range(0, len(queries), step):
        part, own = queries[a:a + step], query_ids[a:a + step]
        score = np.zeros((len(part), len(ids)), dtype=np.int64)
        for term, (at, weight) in postings(part).items():
            if term in lists:
                hit, values = lists[term]
                for q, w in zip(at.tolist(), weight.tolist()):
                    if len(hit) == len(ids):
                        score[q] += w * values
                    else:
                        score[q, hit] += w * values
        for q, s in zip(own, score):
            other = np.flatnonzero(ids != q)
            mine = s[other]
            if len(other) > k:
                least = np.partition(mine, len(mine) - k)[len(mine) - k]
                above = np.flatnonzero(mine > least)
                other = other[np.sort(np.r_[above, np.flatnonzero(mine == least)[:k - len(above)]])]
            yield np.full(len(other), q), ids[other], s[other]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each query, never the query's own id.

    Both take (id, v) rows with whole numbers. Ranks follow the score, then the smaller vec_id. Of vectors
    with different lengths the missing components count as zero. Rows that repeat an id are searched and
    listed as often as they occur; repeated queries of one id are asked once.
    """
    asked = queries.dropDuplicates(["id"])
    n_q, n_c = common.blocks_for(asked.count(), QUERY_ROWS), common.blocks_for(candidates.count(), CANDIDATE_ROWS)
    # Each block of queries meets each block of candidates: the whole work, dealt evenly.
    q = (asked.withColumn("q", F.pmod(F.xxhash64("id"), F.lit(n_q)).cast("int"))
         .withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1)))).select("q", "c", "id", "v"))
    c = (candidates.withColumn("c", F.pmod(F.xxhash64("id", "v"), F.lit(n_c)).cast("int"))
         .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)))).select("q", "c", "id", "v"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = list(best_of_block(left["id"].to_numpy(), list(left["v"]), right["id"].to_numpy(),
                                   list(right["v"]), k)) if len(left) and len(right) else []
        parts = [np.concatenate(x) if found else np.empty(0, dtype=np.int64) for x in (zip(*found) if found else [()] * 3)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), parts)), dtype=np.int64)

    best = q.groupBy("q", "c").cogroup(c.groupBy("q", "c")).applyInPandas(
        run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def search(vectors: DataFrame) -> DataFrame:
    """Every hundredth id asks all other rows. Nulls and odd vectors: see `quantized`; no rows give no rows."""
    rows = quantized(vectors)
    return top_k(rows.where(F.col("id") % QUERY_STEP == 0), rows)


SEARCH_SQL = f"""
with v as (
  select vec_id::bigint as id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.id as query_id, c.id as vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.id % {QUERY_STEP} = 0 and q.id <> c.id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= {TOP}
"""
