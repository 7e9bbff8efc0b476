"""Quality rules: rule statistics of each text and an isolation forest over them.

The base rules are two fixed limits. The forest judges what they pass: trees of random splits, each grown on
SUBSAMPLE rows of its own, drawn from all labelled rows that humans would keep, and a document whose path
through them is short is anomalous. How often a statistic is split on, the ranges that are cut and the anomaly
from which a document is rejected come from every labelled row of both classes that passes the base rules:
ranks and order statistics are counted by Spark, and what reaches the driver is as large as the forest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearline.llm import common, folds
from wearline.operators import ladder
from wearline.session import stored

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3
TREES, SUBSAMPLE, DEPTH, SEED = 200, 256, 10, 17
#: Keepers that draw for a place in a tree, as a multiple of SUBSAMPLE, when there are more: with fewer than
#: SUBSAMPLE of them (odds of about 1e-150) the tree would be grown on fewer rows.
DRAWN = 4
#: Largest share of labelled keepers that the threshold may reject.
KEEPER_LOSS = 0.002

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Further counts that the forest sees: lines with a word, capitals, '!' or '?', digits, words equal to the
#: word before, different words.
MORE = ("n_lines", "n_upper", "n_marks", "n_digits", "n_stutter", "n_distinct")
#: What the forest splits on, see `_rates`.
RATES = [f"x{i}" for i in range(8)]
_SYMBOLS = re.compile(r"[#*$%&|<>]")


def repeat_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    code = ids[:n].copy()
    for k in range(1, window):  # renumbered each time, so codes never overflow
        code = np.unique(code * (ids.max() + 1) + ids[k:n + k], return_inverse=True)[1].reshape(-1)
    repeated = np.bincount(code)[code] > 1
    cover = np.zeros(len(ids) + 1, dtype=np.int64)
    starts = np.flatnonzero(repeated)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def statistics(text: str) -> tuple[int, ...]:
    """COUNTS and MORE of one text."""
    raw = text.encode()
    words = raw.split()
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    bytes_ = np.frombuffer(raw, dtype=np.uint8)
    upper = int(((bytes_ >= 65) & (bytes_ <= 90)).sum())
    if len(text) != len(raw):
        upper += sum(c.isupper() for c in text if c > "\x7f")
    blanks = int(common.space_mask(bytes_).sum())
    return (len(words), len(text) - blanks, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)),
            repeat_words(ids), len(lines), upper, raw.count(b"!") + raw.count(b"?"),
            int(((bytes_ >= 48) & (bytes_ <= 57)).sum()), int((ids[1:] == ids[:-1]).sum()), len(number))


def rule_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """`keep` columns and COUNTS, MORE of each whole text; a null text has none of anything."""
    kinds = dict(docs.dtypes)
    names = [*COUNTS, *MORE]
    schema = ", ".join([f"{k} {kinds[k]}" for k in keep] + [f"{n} long" for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                rows = np.array([statistics(t or "") for t in part.column("text").to_pylist()], dtype=np.int64)
                yield pa.record_batch([*[part.column(k) for k in keep], *map(pa.array, rows.T.copy())],
                                      names=[*keep, *names])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def _base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _rates() -> list:
    """What the forest splits on: rates per word, character or line, so that length alone does not decide."""
    n, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return [F.col("word_chars") / n, F.col("n_symbols") / chars, F.col("n_dup_lines") / lines,
            F.col("n_repeat_words") / n, F.col("n_upper") / chars, F.col("n_marks") / n,
            F.col("n_digits") / chars, F.col("n_stutter") / n]


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    m = np.maximum(np.asarray(n, dtype=float), 2.0)
    return np.where(np.asarray(n) < 2, 0.0, 2 * (np.log(m - 1) + 0.5772156649) - 2 * (m - 1) / m)


def _ranked(rows: DataFrame, names: list[str]) -> DataFrame:
    """(fid, value, b, c, b_all, c_all, b_upto, c_upto): distinct values of `names` with the keepers (b) and rejects
    (c) that have them, that there are, and at or below them; a bucket of values is ordered at a time."""
    wide = ladder.sided(rows.where("label = 1"), rows.where("label = 0"), names)
    cuts = ladder.cuts_of(ladder.ladders(wide, names), names)
    totals = stored(ladder.bucket_totals(ladder.count_buckets(wide, cuts), "b", "c"), "totals")
    return ladder.value_ranks(ladder.count_values(wide, cuts), totals, "b", "c")


def told_apart(rows: DataFrame, names: list[str]) -> np.ndarray:
    """How often each statistic is drawn: by how well it alone orders the labelled rows, never nought."""
    # Twice the pairs of a reject and a keeper below it, ties counted half; one row a statistic.
    pairs = F.sum(F.col("c").cast("double") * (2 * F.col("b_upto") - F.col("b"))) / F.first("b_all") / F.first("c_all")
    found = _ranked(rows, names).where("c_all > 0 and b_all > 0").groupBy("fid").agg(pairs.alias("share")).collect()
    if not found:
        return np.full(len(names), 1 / len(names))
    gain = np.zeros(len(names))
    for r in found:
        gain[r["fid"]] = abs(r["share"] - 1)
    gain = gain ** 4 + 0.01
    return gain / gain.sum()


def drawn_rows(keepers: DataFrame, names: list[str], n: int) -> list[np.ndarray]:
    """SUBSAMPLE of all n keepers for each tree (all, if fewer): those of least hash of the tree and the row.

    Of many keepers only the DRAWN * SUBSAMPLE or so below a hash limit draw, so what is ordered and what reaches the
    driver (TREES * SUBSAMPLE rows) does not grow with the table.
    """
    row = F.xxhash64(F.col("doc_id"), *names)
    share = min(1.0, DRAWN * SUBSAMPLE / max(n, 1))
    place = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(
        t.alias("tree"), F.pmod(F.xxhash64(F.lit(SEED), t, row), F.lit(1 << 48)).alias("h")))
    asked = keepers.select("doc_id", *names, F.explode(F.filter(place, lambda p: p["h"] < int(share * (1 << 48)))).alias("p"))
    order = Window.partitionBy("p.tree").orderBy("p.h", "doc_id", *names)
    first = asked.withColumn("at", F.row_number().over(order)).where(F.col("at") <= SUBSAMPLE)
    got = first.select(F.col("p.tree").alias("tree"), "at", *names).toArrow().sort_by([("tree", "ascending"), ("at", "ascending")])
    x = np.column_stack([got.column(c).to_numpy() for c in names])
    return np.split(x, np.flatnonzero(np.diff(got.column("tree").to_numpy())) + 1)


def grow(x: np.ndarray | list[np.ndarray], low: np.ndarray, high: np.ndarray, drawn: np.ndarray,
         seed: int = SEED) -> dict[str, np.ndarray]:
    """The forest as arrays [tree, node]: children of node k are 2k + 1 and 2k + 2; feature -1 is a leaf.

    `x` holds each tree's rows, or rows of which every tree draws SUBSAMPLE. `low` and `high` bound what occurs in either class. Every other split is drawn over the whole cell of the
    node instead of the range of its rows, so places where no keeper lies are cut off near the root. `drawn`
    is the probability of each statistic.
    """
    rng = np.random.default_rng(seed)
    size = 2 ** (DEPTH + 1) - 1
    feature = np.full((TREES, size), -1, dtype=np.int16)
    cut, path = np.zeros((TREES, size)), np.zeros((TREES, size))
    for t in range(TREES):
        tree = x[t] if isinstance(x, list) else x[rng.choice(len(x), size=min(SUBSAMPLE, len(x)), replace=False)]
        stack = [(0, np.arange(len(tree)), 0, low, high)]
        while stack:
            k, own, depth, a, b = stack.pop()
            path[t, k] = depth + float(average_path(len(own)))
            if depth == DEPTH or len(own) < 2:
                continue
            f = int(rng.choice(tree.shape[1], p=drawn))
            v = tree[own, f]
            ends = (a[f], b[f]) if rng.random() < 0.5 else (v.min(), v.max())
            at = rng.uniform(*ends)
            feature[t, k], cut[t, k] = f, at
            left = v < at
            below, above = b.copy(), a.copy()
            below[f] = above[f] = at
            stack += [(2 * k + 1, own[left], depth + 1, a, below), (2 * k + 2, own[~left], depth + 1, above, b)]
    return {"feature": feature, "cut": cut, "path": path}


def anomaly(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """2 ** (-mean path / usual path): higher is more anomalous."""
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for feature, cut, path in zip(forest["feature"], forest["cut"], forest["path"]):
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(DEPTH):
            f = feature[node]
            node = np.where(f < 0, node, 2 * node + 1 + (x[rows, f] >= cut[node]))
        total += path[node]
    return 2.0 ** (-total / len(forest["feature"]) / float(average_path(SUBSAMPLE)))


def calibrate(scored: DataFrame) -> float:
    """The threshold that tells the classes of (label, anomaly) apart best without losing more than KEEPER_LOSS of the
    keepers. Every labelled row counts; ties go to the smaller threshold."""
    ranked = stored(_ranked(scored, ["anomaly"]).drop("fid"), "ranked")
    ends = ranked.agg(F.max("b_all"), F.max("c_all"), F.max(F.when(F.col("b") > 0, F.col("value")))).first()
    if not ends[0]:
        return float("inf")
    keepers, rejects, last = ends
    if not rejects:
        return float(np.nextafter(last, np.inf))
    at = min(keepers - 1, int(np.ceil((1 - KEEPER_LOSS) * keepers)))
    least = ranked.where((F.col("b_upto") - F.col("b") <= at) & (F.col("b_upto") > at) & (F.col("b") > 0)).first()

    def apart(b, c):
        """Share caught less share lost, times both totals, with b keepers and c rejects below the threshold."""
        return b.cast("decimal(19,0)") * F.lit(rejects) - c.cast("decimal(19,0)") * F.lit(keepers)

    options = (ranked.where(F.col("value") > least["value"])
               .select("value", apart(F.col("b_upto") - F.col("b"), F.col("c_upto") - F.col("c")).alias("apart"))
               .unionByName(ranked.where(F.col("value") == least["value"]).select(
                   F.lit(float(np.nextafter(least["value"], np.inf))).alias("value"),
                   apart(F.col("b_upto"), F.col("c_upto")).alias("apart"))))
    best = options.orderBy(F.desc("apart"), "value").limit(1).first()["value"]
    below = ranked.where(F.col("value") < best).agg(F.max("value")).first()[0]
    return float((best + below) / 2) if below is not None else float(best)


def _rated(counted: DataFrame) -> DataFrame:
    return counted.withColumns(dict(zip(RATES, _rates())))


def _scored(rows: DataFrame, forest: dict[str, np.ndarray], names: list[str]) -> DataFrame:
    """`names` of rows that have RATES, and their `anomaly`."""
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in RATES])
            a = anomaly(forest, x) if len(x) else np.zeros(0)
            yield pa.record_batch([*[batch.column(k) for k in names], pa.array(a)], names=[*names, "anomaly"])

    schema = ", ".join(f"{c} {kinds[c]}" for c in names) + ", anomaly double"
    return rows.select(*names, *RATES).mapInArrow(run, schema)


def fit(counted: DataFrame, labels: DataFrame) -> tuple[dict[str, np.ndarray], float] | None:
    """Forest and threshold from all labelled rows of `counted` that pass the base rules; None without keepers."""
    rows = folds.labelled(labels, "quality", None, 0).withColumnRenamed("doc_id", "labelled_id")
    passed = _rated(counted.where(~F.col("base_failed")))
    known = stored(passed.join(rows, F.col("doc_id") == F.col("labelled_id")).select("doc_id", "label", *RATES), "known")
    ends = known.agg(F.count_if(F.col("label") == 1), *[f(c) for f in (F.min, F.max) for c in RATES]).first()
    if not ends[0]:
        return None
    low, high = np.array(ends[1:], dtype=float).reshape(2, -1)
    own = drawn_rows(known.where("label = 1"), RATES, ends[0])
    forest = grow(own, low, high, told_apart(known, RATES))
    return forest, calibrate(_scored(known, forest, ["label"]))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, COUNTS, base_failed, kept, anomaly) of every document.

    Null and empty texts have zero counts and fail the base rules. Repeated rows come out as often as they
    occur. Without labelled keepers the base rules decide alone and anomaly is null. No documents give no rows.
    """
    ids = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    # Texts are read once: counts serve the fit and the verdict.
    counted = stored(rule_statistics(ids, "doc_id").withColumn("base_failed", _base_failed()), "counted")
    model = fit(counted, labels)
    names = ["doc_id", *COUNTS, "base_failed"]
    if model is None:
        return counted.select(*names, (~F.col("base_failed")).alias("kept"), F.lit(None).cast("double").alias("anomaly"))
    forest, threshold = model
    out = _scored(_rated(counted), forest, names)
    return out.select(*names, (~F.col("base_failed") & (F.col("anomaly") < F.lit(threshold))).alias("kept"), "anomaly")
