from __future__ import annotations

import random

import brute
import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from wearline.llm import quality_mil, queries, vector_search
from wearline.session import stored


def vectors(n=450):
    rng = random.Random(7)
    rows = [(i, [rng.choice([0.0, rng.uniform(-1, 1)]) for _ in range(8)]) for i in range(n)]
    same = [0.25] * 8
    rows += [(1000 + i, same) for i in range(30)]  # ties
    return rows + [(2000, None), (2100, [0.1, None] + [0.0] * 6), (2200, [float("nan")] + [0.0] * 7),
                   (2300, [float("inf")] * 8), (None, same), (2400, []), (2500, [0.5, -0.5])]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, id int, v string")


def as_float(rows):
    import numpy as np
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


@pytest.mark.parametrize("block", [4096, 16])
def test_search_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(vector_search, "CANDIDATE_ROWS", block)
    monkeypatch.setattr(vector_search, "QUERY_ROWS", max(2, block // 8))
    got = sorted(tuple(r) for r in vector_search.search(frame(spark, vectors())).collect())
    assert got == brute.top(as_float(vectors()))


def test_search_few_and_no_rows(spark):
    few = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (7, [0.5, 0.5])]
    assert sorted(tuple(r) for r in vector_search.search(frame(spark, few)).collect()) == brute.top(few)
    assert vector_search.search(frame(spark, few).limit(0)).collect() == []


def test_search_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{sf['0.001']}/embeddings.parquet')")
    got = vector_search.search(spark.read.parquet(f"{sf['0.001']}/embeddings.parquet"))
    want = con.execute(queries.ORACLES["op9_exact_top_k"]).fetchall()
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == sorted(want)


def test_every_operator_is_registered_once():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run


def test_pipeline_stages_against_plain_versions(spark, sf):
    """Each stage on what its predecessor really kept, against the plain version of its operator."""
    sf_dir = sf["0.001"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 8000")
    columns = docs.columns
    scores = {r.doc_id: r.predicted for r in quality_mil.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stored(stage(spark, docs, sf_dir), "stage")
        assert docs.columns == columns
        rows = docs.collect()
        after = {r.doc_id: r.text for r in rows}
        assert len(after) == len(rows) and all(r.n_chars == len(r.text) for r in rows)
        if k == 0:
            assert after == {d: t for d, t in before.items() if scores[d]}
        elif k == 1:
            gone = brute.gone_lines(before.items())
            assert after == {d: brute.without(t, {p for i, p in gone if i == d}) for d, t in before.items()}
        elif k == 2:
            assert set(after) == {d for d, _, c in brute.components(list(before.items())) if d == c}
        else:
            want = brute.repeated(before.items())
            assert after == {d: x[4].decode("utf-8", "ignore") for d, x in want.items()}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in last} == set(after)


def test_pipeline_stages_take_odd_rows(spark, documents, odd_rows, sf):
    docs = documents([(d, t) for d, t in odd_rows if t is None or len(t) < 20_000])
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[1:]:
            rows = stored(stage(spark, rows, sf["0.001"]), "stage")
    assert rows.count() == 0
