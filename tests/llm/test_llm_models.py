from __future__ import annotations

import brute
import numpy as np
import pytest

from wearline.llm import folds, quality_mil, quality_rules, toxicity


def crc_rest(i, parts):
    import zlib
    return zlib.crc32(str(i).encode()) % parts


def ranks_well(rows, label, least):
    pos = [r.score for r in rows if label[r.doc_id] == 1]
    neg = [r.score for r in rows if label[r.doc_id] == 0]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > least, auc


@pytest.mark.parametrize("module,label,parts,held,least", [
    (toxicity, "toxic", 4, 2, 0.9), (quality_mil, "quality", 5, 0, 0.98)])
def test_held_out_accuracy(spark, sf, module, label, parts, held, least):
    docs, labels = (spark.read.parquet(f"{sf['0.1']}/{t}.parquet") for t in ("documents", "labels"))
    rows = module.score(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (crc_rest(r.doc_id, parts) == held) for r in rows)
    assert all(r.predicted == int(r.score >= folds.CUT) for r in rows)
    known = {r.doc_id: r[label] for r in labels.collect()}
    own = [r for r in rows if r.held_out and r.doc_id in known]
    ranks_well(own, known, least)
    assert np.mean([r.predicted == known[r.doc_id] for r in own]) > 0.93


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality_mil, "quality")])
def test_scores_never_look_at_held_out_labels(spark, documents, module, label):
    rows = [(i, f"some words stupid{'' if i % 3 else ' idiot scum'} number {i} of many") for i in range(80)]
    labels = [(i, int(i % 3 == 0), int(i % 3 == 0)) for i in range(80)]
    parts, held = (4, 2) if module is toxicity else (5, 0)
    turned = [(i, 1 - q, 1 - t) if crc_rest(i, parts) == held else (i, q, t) for i, q, t in labels]
    out = [sorted((r.doc_id, r.score) for r in module.score(
        documents(rows), spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect())
        for x in (labels, turned)]
    assert out[0] == out[1]


@pytest.mark.parametrize("module", [toxicity, quality_mil])
def test_odd_rows_and_labels(spark, documents, odd_rows, small_batches, module):
    kinds = "doc_id long, quality int, toxic int, text string"
    labels = spark.createDataFrame([(5, 1, 0, "x"), (5, 0, 1, "x"), (3, None, None, "x"), (None, 1, 1, "x"),
                                    (9, 1, 0, "x"), (4, 1, 1, "x"), (12, 0, 0, "x"), (999, 1, 1, "x"), (15, 0, 0, "x")], kinds)
    for table in (labels, labels.limit(0)):
        got = module.score(documents(odd_rows), table).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, _ in odd_rows)
        assert all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id in (2, 4)}) == 1  # empty and null
    assert module.score(documents([]), labels).collect() == []


def test_kernel_tolerates_gaps_and_insertions():
    kernel = toxicity.Kernel(["idiot", "worthless"])
    value = kernel.with_landmarks(["idiot", "id*iot", "i-d-i-o-t", "idxiot", "worth.less", "table", "river", "w" * 5000])
    assert value[0, 0] >= 0.99  # repeated letters lift it above 1
    assert (value[1:4, 0] > 0.2).all() and value[4, 1] > 0.5
    assert (value[5:7] < 0.1).all() and np.isfinite(value).all()
    assert toxicity.words_of("an I d i o t here") == ["an", "idiot", "here"]


def test_kernel_matches_its_definition():
    from collections import Counter
    from itertools import combinations

    def grams(word):
        codes = toxicity._codes([word])[0]
        found = Counter()
        for at in combinations(range(len(codes)), toxicity.GRAM):
            if at[-1] - at[0] < toxicity.SPAN:
                found[tuple(codes[list(at)])] += toxicity.DECAY ** (at[-1] - at[0] + 1 - toxicity.GRAM)
        norm = sum(toxicity.DECAY ** (2 * (at[-1] - at[0] + 1 - toxicity.GRAM)) for at in combinations(range(len(codes)), toxicity.GRAM)
                   if at[-1] - at[0] < toxicity.SPAN)
        return found, norm ** 0.5 or 1.0

    words, marks = ["stupid", "stu_pid", "banana", "é"], ["stupid", "bananas"]
    got = toxicity.Kernel(marks).with_landmarks(words)
    for i, w in enumerate(words):
        for j, m in enumerate(marks):
            (a, x), (b, y) = grams(w), grams(m)
            want = sum(a[g] * b[g] for g in a) / (x * y) if a and b else 0.0
            assert got[i, j] == pytest.approx(want, abs=1e-4)


def test_rule_counts_odd_rows(spark, documents, odd_rows, small_batches):
    labels = spark.createDataFrame([(5, 1), (9, 1), (7, 1), (12, 1), (13, 0), (14, 0)], "doc_id long, quality int")
    for table in (labels, labels.limit(0)):
        got = quality_rules.judged(documents(odd_rows), table).collect()
        want = {d: brute.rule_counts(t) for d, t in odd_rows}
        assert len(got) == len(odd_rows)
        for r in got:
            counts = want[r.doc_id]
            assert tuple(r[c] for c in quality_rules.COUNTS) == counts, r.doc_id
            failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
            assert r.base_failed == failed and not (failed and r.kept)
    assert quality_rules.judged(documents([]), labels).collect() == []


def test_forest_keeps_keepers_and_finds_junk(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf['0.01']}/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality_rules.judged(docs, labels).collect() if r.doc_id in known and not r.base_failed]
    assert np.mean([r.kept for r in rows if known[r.doc_id] == 1]) > 0.98
    assert np.mean([not r.kept for r in rows if known[r.doc_id] == 0]) > 0.8


def test_short_paths_are_anomalous():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (500, 8))
    forest = quality_rules.grow(x, x.min(axis=0) - 10, x.max(axis=0) + 10, np.full(8, 1 / 8))
    far = quality_rules.anomaly(forest, np.full((5, 8), 9.0))
    assert far.min() > quality_rules.anomaly(forest, x).max()


def test_attention_weighs_the_passage_that_matters():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (200, 6, 4))
    y = (np.arange(200) % 2).astype(float)
    x[y == 1, 2, 0] += 6
    p = quality_mil.train(x, np.ones((200, 6), dtype=bool), y, np.ones(200))
    owner = np.repeat(np.arange(200), 6)
    assert (((quality_mil.evaluate(p, x.reshape(-1, 4), owner, 200) > 0.5) == y).mean()) > 0.95


def test_rules_are_fitted_on_every_labelled_row(spark, monkeypatch):
    """Ranges, draw shares and the threshold are those of all labelled rows, worked out plainly."""
    rng = np.random.default_rng(3)
    y = (rng.random(9000) < 0.6).astype(int)
    x = np.round(rng.normal(y[:, None] * np.arange(8) / 8, 1), 2)
    names = quality_rules.RATES
    table = spark.createDataFrame([(i, int(k), *map(float, v)) for i, (k, v) in enumerate(zip(y, x))],
                                  "doc_id long, label int, " + ", ".join(f"{n} double" for n in names))
    a, b = x[y == 1], x[y == 0]
    gain = np.array([abs(np.mean([(np.searchsorted(k, v, "left") + np.searchsorted(k, v, "right")) / len(k)
                                  for k in [np.sort(a[:, f])] for v in b[:, f]]) - 1) for f in range(8)]) ** 4 + 0.01
    assert np.allclose(quality_rules.told_apart(table, names), gain / gain.sum(), atol=1e-12)

    score = np.round(rng.normal(1 - y, 0.4), 3)
    scored = spark.createDataFrame([(int(k), float(v)) for k, v in zip(y, score)], "label int, anomaly double")
    keepers, rejects = np.sort(score[y == 1]), np.sort(score[y == 0])
    least = keepers[min(len(keepers) - 1, int(np.ceil((1 - quality_rules.KEEPER_LOSS) * len(keepers))))]
    options = np.unique(np.r_[score[score > least], np.nextafter(least, np.inf)])
    apart = (np.searchsorted(keepers, options) * len(rejects) - np.searchsorted(rejects, options) * len(keepers))
    best = options[np.argmax(apart)]
    assert quality_rules.calibrate(scored) == (best + score[score < best].max()) / 2

    own = quality_rules.drawn_rows(table.where("label = 1"), names, len(a))
    assert len(own) == quality_rules.TREES and all(v.shape == (quality_rules.SUBSAMPLE, 8) for v in own)
    places = {tuple(v): i for i, v in enumerate(a)}
    drawn = {places[tuple(v)] for tree in own for v in tree}
    assert len(drawn) > 0.99 * len(places)  # trees differ, and no keeper is left out beforehand
    few = quality_rules.drawn_rows(table.where("label = 1 and doc_id < 100"), names, int(y[:100].sum()))
    assert all(len(v) == y[:100].sum() for v in few)


def test_toxicity_is_learnt_alike_from_rows_in_any_order(spark):
    rows = [(i, int(i % 3 == 0), f"some words stupid{'' if i % 3 else ' idiot scum'} number {i} of {i * i} many {'more ' * (i % 7)}")
            for i in range(80)]
    found = [spark.createDataFrame(x, "doc_id long, label int, text string").coalesce(1) for x in (rows, rows[::-1], rows[40:] + rows[:40])]
    first, *others = [toxicity.fit(f, {0: 53, 1: 27}) for f in found]
    for other in others:
        assert list(first["beta"]) == list(other["beta"]) and first["base"] == other["base"]
