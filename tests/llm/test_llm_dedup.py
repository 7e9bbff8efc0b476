from __future__ import annotations

import random

import brute
import pytest

from wearline.llm import line_dedup, simhash, suffix_dedup
from wearline.llm.components import connected_components


def key(rows):
    return sorted(rows, key=repr)


def test_components_of_chains_stars_and_random_links(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)]
    links += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    sets = brute.Sets()
    for a, b in links:
        sets.join(a, b)
    want = {(x, sets.find(x)) for a, b in links if a != b for x in (a, b)}
    rows = links + [(5, 5), (None, 3), (7, None), (0, 1)]
    got = connected_components(spark.createDataFrame(rows, "a long, b long"), "a", "b").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_components_without_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_simhash_odd_rows(documents, odd_rows, small_batches):
    got = [tuple(r) for r in simhash.digest(documents(odd_rows)).collect()]
    assert key(got) == key(brute.components(odd_rows))


def test_simhash_empty_table(documents):
    assert simhash.digest(documents([])).collect() == []


def test_simhash_table(spark, sf):
    docs = spark.read.parquet(f"{sf['0.001']}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert key(tuple(r) for r in simhash.digest(docs).collect()) == key(brute.components(rows))


def test_simhash_crowded_keys_are_split(spark, monkeypatch):
    """Hundreds of fingerprints that share keys, in blocks of five: the same components as all pairs give."""
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 5)
    rng = random.Random(1)
    fps = {0}
    for centre in (0, 0xFFFF0000FFFF0000, rng.getrandbits(64)):
        for _ in range(80):
            x = centre
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                x ^= 1 << b
            fps.add(x)
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    sets = brute.Sets()
    for i, a in enumerate(signed):
        sets.find(i)
        for j in range(i):
            if ((a ^ signed[j]) & (1 << 64) - 1).bit_count() <= 3:
                sets.join(i, j)
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    assert len(links) < 20 * len(signed)
    found = brute.Sets()
    place = {x: i for i, x in enumerate(signed)}
    for r in links:
        assert ((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 3
        found.join(place[r.a], place[r.b])
    assert [found.find(i) for i in range(len(signed))] == [sets.find(i) for i in range(len(signed))]


def test_one_of_each(documents, odd_rows):
    got = simhash.one_of_each(documents(odd_rows))
    want = {d for d, _, c in brute.components(odd_rows) if d == c and d is not None}
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == sorted(want)
    assert got.columns == documents([]).columns


def check_suffix(docs, rows):
    want = brute.repeated({d: t for d, t in rows}.items())
    got = suffix_dedup.digest(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id][:4], r.doc_id


@pytest.mark.parametrize("hot", [20_000, 0])
def test_suffix_odd_rows(documents, odd_rows, small_batches, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = [r for r in odd_rows if r[0] is not None]
    check_suffix(documents(rows), rows)


def test_suffix_joins_without_broadcast(documents, odd_rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", -1)
    rows = [r for r in odd_rows if r[0] is not None]
    check_suffix(documents(rows), rows)


def test_suffix_null_ids_come_last_and_one_id_may_have_two_texts(documents):
    text = "0123456789" * 9 + "abcdefghijklmnopqrst"
    got = suffix_dedup.digest(documents([(None, text), (1, text), (2, "other"), (2, text + "x")])).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in got) == [
        (0, 110, 110), (1, 110, 0), (2, 5, 0), (2, 111, 110)]


def test_suffix_table(spark, sf):
    docs = spark.read.parquet(f"{sf['0.001']}/documents.parquet")
    check_suffix(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_suffix_shared_passages_between_different_surroundings(documents):
    rng = random.Random(3)
    rare = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passages = [rare(n) for n in (99, 100, 101, 150, 400)]
    rows = [(i, rare(rng.randrange(80)) + rng.choice(passages) + rare(rng.randrange(80)) + rng.choice(passages))
            for i in range(120)]
    check_suffix(documents(rows), rows)


def test_suffix_empty_table_and_text(documents):
    assert suffix_dedup.digest(documents([])).collect() == []
    out = suffix_dedup.shortened(documents([(1, "é" * 60), (2, "é" * 60), (3, None)]))
    assert out.columns == documents([]).columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "é", 2: "", 3: ""}  # it repeats itself


def check_lines(docs, rows):
    gone = brute.gone_lines(rows)
    got = line_dedup.deduplicated(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_removed_lines"]
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r.text)
    for d, t in rows:
        want = t if t is None else brute.without(t, {p for i, p in gone if i == d})
        assert want in by[d], d
    assert sum(map(len, by.values())) == len(rows)


def test_lines_odd_rows(documents, odd_rows):
    short = [(d, t) for d, t in odd_rows if t is None or len(t) < 20_000]
    check_lines(documents(short), short)


def test_lines_crowded_key(documents):
    """Many variants of one line: each differs in one place from the first, some from each other only."""
    words = [f"token{i}" for i in range(120)]
    rows = [(0, " ".join(words))]
    for i in range(1, 60):
        w = list(words)
        w[i % 7] = f"x{i}"
        w[60 + i % 11] = f"y{i}"
        rows.append((i, "first line\n" + " ".join(w) + "\nlast line " + str(i)))
    check_lines(documents(rows), rows)


def test_lines_table(spark, sf):
    docs = spark.read.parquet(f"{sf['0.001']}/documents.parquet").where("length(text) < 6000")
    check_lines(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_lines_long_lines_count_every_word(spark, documents):
    text = " ".join(f"w{i % 301}" for i in range(1000))
    got = line_dedup.fingerprints(documents([(1, text)])).first()
    import xxhash
    want = brute.bits([xxhash.xxh64_intdigest(w.encode(), seed=42) for w in set(text.split())])
    assert got.fp & (1 << 64) - 1 == want


def test_lines_empty_table(documents):
    assert line_dedup.digest(documents([])).collect() == []


def test_lines_run_no_python(spark, sf):
    docs = spark.read.parquet(f"{sf['0.001']}/documents.parquet")
    plan = line_dedup.fingerprints(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_lines_unlike_fingerprints_share_few_keys(spark, monkeypatch):
    """Chance keys grow with the square of the lines: 100,000 unlike lines must bring less than a row in a thousand."""
    class Counted(Exception):
        pass

    def stop_at_keys(df, label, stored=line_dedup.stored):
        if label == "keyed":
            raise Counted(df.count())
        return stored(df, label)

    monkeypatch.setattr(line_dedup, "stored", stop_at_keys)
    lines = spark.range(100_000).selectExpr("struct(id as a, id as b) as line", "xxhash64(id) as fp",
                                            "struct(false as last, id as doc_id, 0 as pos) as first")
    with pytest.raises(Counted) as found:
        line_dedup.linked(None, lines)
    assert found.value.args[0] < 100


def test_lines_keys_are_dealt_once(spark, monkeypatch):
    """However many keys are shared, the rows of all keys are shuffled once, without their lines."""
    class Planned(Exception):
        pass

    def stop_at_keys(df, label, stored=line_dedup.stored):
        if label == "keyed":
            raise Planned(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(line_dedup, "stored", stop_at_keys)
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", -1)
    lines = spark.range(1000).selectExpr("struct(id as a, id as b) as line", "id div 2 as fp",
                                         "struct(false as last, id as doc_id, 0 as pos) as first")
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        with pytest.raises(Planned) as found:
            line_dedup.linked(None, lines)
    finally:
        spark.conf.set(name, old)
    plan = found.value.args[0]
    assert plan.count("hashpartitioning(key") == 1 and "SortMergeJoin [key" not in plan
