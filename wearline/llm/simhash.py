"""SimHash near-duplicates of documents: fingerprints, linking through pivot distance tables, components.

Pairs to look at come from pigeonhole keys: with six blocks, fingerprints that differ in at most three bits
agree in three blocks at least, so they share one of the twenty keys of three blocks. Inside a key, each
fingerprint has a table row of its Hamming distances to fixed reference fingerprints; by the triangle
inequality two fingerprints whose rows differ by more than the limit in any coordinate cannot be close, so
only the others are verified.

Copies share a fingerprint and are one node, however many there are. A key that many different fingerprints
share is cut into blocks, and block pairs are compared in separate tasks of bounded size. Each task returns
links that span what it joined, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearline.llm import common
from wearline.llm.components import connected_components
from wearline.session import stored

BITS = 64
WORDS_IN_SHINGLE = 3
#: Differing bits at which two fingerprints still link.
LIMIT = 3
#: (shift, width) of the six blocks.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
#: Reference fingerprints.
PIVOTS = 24
#: Different fingerprints of one key that a task compares at once; a task holds two such blocks.
BLOCK_ROWS = 2048
#: Ids that a join may broadcast; beyond, both sides are shuffled.
BROADCAST_ROWS = 1_500_000


def shingle_hashes(text: bytes, words: int = WORDS_IN_SHINGLE) -> np.ndarray:
    """Unsigned XXH64 (seed 42) of each shingle of a text whose A-Z are lower-cased."""
    w = text.lower().split()
    if not w:
        return np.empty(0, dtype=np.uint64)
    h = xxhash.xxh64_intdigest
    if len(w) <= words:
        return np.array([h(b" ".join(w), 42)], dtype=np.uint64)
    parts = [w[i:len(w) - words + 1 + i] for i in range(words)]
    return np.array([h(b" ".join(s), 42) for s in zip(*parts)], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set when more than half of the hashes have it."""
    if not len(hashes):
        return 0
    count = np.zeros(BITS, dtype=np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a:a + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text as a signed long; null and empty texts give 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                fps = [fingerprint(shingle_hashes(t)) for t in common.encoded(part.column(1))]
                yield pa.record_batch([part.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))],
                                      names=["doc_id", "fp"])

    source = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    return source.mapInArrow(run, "doc_id long, fp long")


def block_keys(column: str, blocks: tuple[tuple[int, int], ...] = BLOCKS, agree: int = 3) -> Column:
    """The keys of every `agree` blocks of a fingerprint; the lowest five bits number the choice of blocks."""
    fp = F.col(column)
    out = []
    for i, chosen in enumerate(combinations(blocks, agree)):
        key, at = F.lit(i).cast("long"), 5
        for shift, width in chosen:
            bits = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            key, at = key.bitwiseOR(F.shiftleft(bits, at)), at + width
        out.append(key)
    return F.array(*out)


def pivots() -> np.ndarray:
    """The reference fingerprints: fixed, spread over the space."""
    return np.array([xxhash.xxh64_intdigest(f"reference {i}", 42) for i in range(PIVOTS)], dtype=np.uint64)


def link_groups(group: np.ndarray, fp: np.ndarray, block: np.ndarray, refs: np.ndarray, limit: int = LIMIT
                ) -> list[tuple[int, int]]:
    """Links that span each group (rows of equal `group`, sorted): pairs within the limit join their trees.

    Rows of one group are compared at growing lags, all groups in one step. `block` tells the halves of a
    cell of two blocks apart: within such a cell only pairs of different blocks are compared, as each block
    also has a cell of its own (block < 0: compare all).
    """
    n = len(fp)
    table = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.int16)
    parent = np.arange(n)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return int(x)

    links = []
    left = np.arange(n)
    lag = 1
    while True:
        left = left[left + lag < n]
        left = left[group[left] == group[left + lag]]
        if not len(left):
            return links
        a, b = left, left + lag
        use = (block[a] < 0) | (block[a] != block[b])
        a, b = a[use], b[use]
        for c in range(0, table.shape[1], 4):
            near = (np.abs(table[a, c:c + 4] - table[b, c:c + 4]) <= limit).all(axis=1)
            a, b = a[near], b[near]
        close = np.bitwise_count(fp[a] ^ fp[b]) <= limit
        for x, y in zip(a[close].tolist(), b[close].tolist()):
            p, q = find(x), find(y)
            if p != q:
                parent[max(p, q)] = min(p, q)
                links.append((x, y))
        lag += 1


def _link_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the cells of a partition sorted by cell; an unfinished cell waits for the next batch."""
    refs, names = pivots(), ("key", "i", "j", "fp", "mine")
    held = {c: np.empty(0, dtype=np.int64) for c in names}

    def flush(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        new = np.zeros(len(rows["fp"]), dtype=bool)
        for c in ("key", "i", "j"):
            new[1:] |= np.diff(rows[c]) != 0
        block = np.where(rows["i"] == rows["j"], -1, rows["mine"])
        fp = rows["fp"].view(np.uint64)
        pairs = np.array(link_groups(np.cumsum(new), fp, block, refs), dtype=np.int64).reshape(-1, 2)
        return pa.record_batch([pa.array(rows["fp"][pairs[:, 0]]), pa.array(rows["fp"][pairs[:, 1]])],
                               names=["a", "b"])

    for batch in batches:
        rows = {c: np.concatenate([held[c], batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)])
                for c in names}
        last = (rows["key"] == rows["key"][-1:]) & (rows["i"] == rows["i"][-1:]) & (rows["j"] == rows["j"][-1:])
        cut = len(last) - int(last.sum())
        if cut:
            yield flush({c: v[:cut] for c, v in rows.items()})
        held = {c: v[cut:] for c, v in rows.items()}
    if len(held["fp"]):
        yield flush(held)


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """(a, b): links that span every component of the different fingerprints in `fps` (column fp)."""
    keyed = fps.select("fp").distinct().select("fp", F.explode(block_keys("fp")).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    cells = (keyed.join(shared, "key")
             .withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
             .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                     "fp", "mine"))
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (cells.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")
            .mapInArrow(_link_cells, "a long, b long"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every document; component_id is the least doc_id reachable over links.

    Null and empty texts have fingerprint 0 and link like any other. Repeated rows come out as often as they
    came in. Rows with a null doc_id take part in linking and never name a component unless nothing else is
    in it (then component_id is null). No rows give no rows.
    """
    fps = stored(with_fingerprint(docs), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "different")
    roots = connected_components(fingerprint_links(nodes), "a", "b")
    tied = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = tied.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps.join(tied.join(least, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    """`near_duplicates` with the fingerprint as 16 hexadecimal digits."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that stand for their component: those with its least doc_id.

    Of rows that repeat such an id one stays. A component whose ids are all null keeps one row.
    """
    found = stored(near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("kept_id")), "kept")
    ids = found.distinct()
    rows, different = found.count(), ids.count()
    if different <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    kept = docs.join(ids, docs["doc_id"].cast("long").eqNullSafe(F.col("kept_id")), "left_semi")
    return kept if rows == different else kept.dropDuplicates(["doc_id"])
