"""Removal of repeated byte strings by bucket-pointer refinement.

Every `LENGTH`-byte string of every text is a suffix cut at that length; a byte goes when it lies in a string
that also starts earlier. Equal strings are found by refining buckets of suffixes, as in a suffix array sort that
stops at depth LENGTH:

1. The initial bucket of a suffix is its q-gram (Q bytes). A name of the q-gram comes from names of half as
   many bytes, at the suffix and at a later offset, and so on down to single bytes.
2. Only some suffixes represent the others: of the q-grams inside a string, the one of least name, the last of
   equals, is its anchor. Equal strings have equal anchors at equal offsets, so nothing is lost. An anchor
   stands for the run of strings that chose it.
3. Buckets of anchors with one member are settled. The others are refined by the bucket identifiers of later
   offsets, which name the whole run: where an equal run starts earlier, the run goes.
4. What is left are runs that agree in part only, one of each kind. Their strings are refined one by one: sorted
   on (identifier, identifier Q later), then renumbered, and again with the new identifiers, until the depth is
   LENGTH; buckets that become single drop out on the way.

Steps 3 and 4 group by q-gram. In step 3 the rows of a q-gram stream through a sorted task that remembers one row.
In step 4 a q-gram with more than HOT kinds of runs is not given to a task: its strings go through a grouped
minimum and a join, which combine and split across tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.llm import common
from wearline.session import stored

LENGTH, Q = 100, 32
#: Kinds of runs of one q-gram that a task refines together.
HOT = 20_000
#: Rows that a join may broadcast (some tens of bytes each); beyond, both sides are shuffled.
BROADCAST_ROWS = 1_500_000

_U = np.uint64
_BYTE = np.random.default_rng(3).integers(1, 1 << 63, size=256, dtype=np.uint64)
_K1, _K2 = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of a bucket from the names at two offsets."""
    x = a * _K1
    x += b
    x ^= x >> _U(29)
    x *= _K2
    x ^= x >> _U(32)
    return x


def names(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the Q-byte and of the 2 Q-byte string at each place."""
    h, k = _BYTE[data], 1
    narrow = h
    while k < 2 * Q:
        n = max(len(h) - k, 0)
        narrow, h = h, _pair(h[:n], h[k:k + n])
        k *= 2
    return narrow, h


def _least(value: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of `width` values from each place on; the last of equals."""
    place = np.arange(len(value), dtype=np.int32)

    def wider(v: np.ndarray, i: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
        n = max(len(v) - d, 0)
        right = v[d:] <= v[:n]
        return np.where(right, v[d:], v[:n]), np.where(right, i[d:], i[:n])

    k = 1
    while 2 * k <= width:
        value, place = wider(value, place, k)
        k *= 2
    return wider(value, place, width - k)[1] if width > k else place


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(q-gram name, run name, first and last string of the run) of each anchor of texts joined in `data`."""
    gram, double = names(data)
    place = _least((gram >> _U(32)).astype(np.uint32), LENGTH - Q + 1)
    long_ = ends - starts >= LENGTH
    first, stop = starts[long_], ends[long_] - LENGTH + 1
    size = stop - first
    if not len(size):
        none = np.empty(0, dtype=np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    p = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    chosen = place[p]
    cut = np.r_[True, chosen[1:] != chosen[:-1]]
    cut[(np.cumsum(size) - size)] = True
    head = np.flatnonzero(cut)
    low, high = p[head], p[np.r_[head[1:] - 1, len(p) - 1]]
    at = chosen[head].astype(np.int64)
    n = high + LENGTH - low
    run = _pair(_pair(double[low], double[low + (n - 2 * Q) // 2]),
                _pair(double[high + LENGTH - 2 * Q], ((at - low) * 1000 + n).astype(np.uint64)))
    return gram[at], run, low, high


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """(gram, run, doc, at): at is 128 * first string + further strings of the run.

    Runs that start earlier within the same slice of texts are settled there: their at is -1 - at, and a name of
    their own stands for the gram, so copies don't meet in one task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                texts = common.encoded(part.column("text"))
                data, starts, ends = common.joined(texts, b"\x00")
                data = np.r_[data, np.zeros(2 * LENGTH, dtype=np.uint8)]
                gram, name, low, high = anchors(data, starts, ends)
                own = np.searchsorted(ends, low, side="right")
                doc = part.column("doc").to_numpy(zero_copy_only=False)[own]
                at = (low - starts[own]) * 128 + high - low
                order = np.lexsort((at, doc, name, gram))
                gram, name, doc, at = gram[order], name[order], doc[order], at[order]
                opens = np.r_[True, (gram[1:] != gram[:-1]) | (name[1:] != name[:-1])][:len(gram)]
                opener = np.maximum.accumulate(np.where(opens, np.arange(len(gram)), 0)) if len(gram) else order
                later = (doc != doc[opener]) | (at != at[opener])
                gram = np.where(later, _pair(gram, (doc * 1_000_003 + at).astype(np.uint64)), gram)
                yield pa.record_batch([pa.array(gram.view(np.int64)), pa.array(name.view(np.int64)), pa.array(doc),
                                       pa.array(np.where(later, -1 - at, at))], names=["gram", "run", "doc", "at"])

    return docs.select("doc", "text").mapInArrow(run, "gram long, run long, doc long, at long")


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (gram, run, doc, at): later runs of a kind (ask false), and the first run of each kind
    where the q-gram has several kinds (ask true). One row and two flags are carried from batch to batch."""
    first: np.ndarray | None = None  # (gram, run, doc, at) that opened the current kind
    several = False  # whether that kind has been asked for already
    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)])
        done = rows[3] < 0
        yield pa.record_batch([pa.array(np.zeros(int(done.sum()), dtype=bool)), pa.array(rows[0, done]),
                               pa.array(rows[2, done]), pa.array(-1 - rows[3, done])], names=["ask", "gram", "doc", "at"])
        rows = rows[:, ~done]
        if not rows.shape[1]:
            continue
        carried = first is not None
        if carried:
            rows = np.c_[first, rows]
        gram, run, doc, at = rows
        opens = np.r_[True, (gram[1:] != gram[:-1]) | (run[1:] != run[:-1])]
        opener = np.maximum.accumulate(np.where(opens, np.arange(len(gram)), 0))
        later = (doc != doc[opener]) | (at != at[opener])
        kinds = np.flatnonzero(opens)
        same = gram[kinds][1:] == gram[kinds][:-1]
        ask = np.r_[False, same] | np.r_[same, False]
        if carried and several:
            ask[0] = False  # asked for in an earlier batch
        last_asked = bool(ask[-1]) or (several and carried and len(kinds) == 1)
        asked = kinds[ask]
        take = np.r_[np.flatnonzero(later), asked]
        yield pa.record_batch([pa.array(np.r_[np.zeros(int(later.sum()), dtype=bool), np.ones(len(asked), dtype=bool)]),
                               pa.array(gram[take]), pa.array(doc[take]), pa.array(at[take])],
                              names=["ask", "gram", "doc", "at"])
        first, several = rows[:, kinds[-1]].copy(), last_asked


def _contexts(docs: DataFrame, asked: DataFrame, rows: int) -> DataFrame:
    """(gram, doc, low, bytes) of the runs asked for."""
    lists = asked.groupBy("doc").agg(F.collect_list(F.struct("gram", "at")).alias("runs"))
    if rows <= BROADCAST_ROWS:
        lists = F.broadcast(lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                grams, docs_, lows, parts = [], [], [], []
                for key, text, runs in zip(part.column(0).to_pylist(), common.encoded(part.column(1)),
                                           part.column(2).to_pylist()):
                    for r in runs:
                        low = r["at"] >> 7
                        grams.append(r["gram"])
                        docs_.append(key)
                        lows.append(low)
                        parts.append(text[low:low + (r["at"] & 127) + LENGTH])
                yield pa.record_batch([pa.array(grams, pa.int64()), pa.array(docs_, pa.int64()),
                                       pa.array(lows, pa.int64()), pa.array(parts, pa.binary())],
                                      names=["gram", "doc", "low", "bytes"])

    # Rows that repeat a document give the same runs again, which is harmless.
    return docs.join(lists, "doc").select("doc", "text", "runs").mapInArrow(
        run, "gram long, doc long, low long, bytes binary")


def strings(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each LENGTH-byte string in `parts`: its part, its place in it, and the names that tell it from others."""
    data, starts, ends = common.joined(parts, b"\x00")
    data = np.r_[data, np.zeros(2 * LENGTH, dtype=np.uint8)]
    _, double = names(data)
    size = ends - starts - LENGTH + 1
    own = np.repeat(np.arange(len(parts)), size)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    p = starts[own] + place
    return own, place, double[p], double[p + LENGTH - 2 * Q]


def refine(bucket: np.ndarray, parts: list[bytes], doc: np.ndarray, low: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """(doc, start) of every LENGTH-byte string that equals an earlier one of its bucket."""
    data, starts, ends = common.joined(parts, b"\x00")
    size = ends - starts - LENGTH + 1
    own = np.repeat(np.arange(len(parts)), size)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    at = starts[own] + place
    # Identifiers at depth Q for every place of every part, then pointer steps to depths 2 Q and LENGTH.
    data = np.r_[data, np.zeros(2 * LENGTH, dtype=np.uint8)]
    gram, _ = names(data)
    ids = np.unique(gram, return_inverse=True)[1].reshape(-1)
    live = np.arange(len(at))
    key = np.unique(bucket, return_inverse=True)[1].reshape(-1)[own]
    for step in (0, Q, 2 * Q, LENGTH - Q):
        code = key[live] * (ids.max() + 1) + ids[at[live] + step]
        new, count = np.unique(code, return_inverse=True, return_counts=True)[1:]
        key[live] = new.reshape(-1)
        live = live[count[new.reshape(-1)] > 1]
    order = live[np.lexsort((low[own[live]] + place[live], doc[own[live]], key[live]))]
    opens = np.r_[True, key[order][1:] != key[order][:-1]][:len(order)]
    opener = np.maximum.accumulate(np.where(opens, np.arange(len(order)), 0)) if len(order) else order
    d, s = doc[own[order]], low[own[order]] + place[order]
    later = (d != d[opener]) | (s != s[opener])
    return d[later], s[later]


def _runs(doc: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """(doc, start, stop) of byte ranges covered by strings at (doc, start)."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + LENGTH)][:len(doc)])
    last = np.r_[cut[1:] - 1, len(doc) - 1][:len(cut)]
    return pa.record_batch([pa.array(doc[cut]), pa.array(start[cut]), pa.array(start[last] + LENGTH)],
                           names=["doc", "start", "stop"])


def _refine_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of repeated strings over rows sorted by gram; a gram cut by the end of a batch waits for the next."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        if not rows.num_rows:
            continue
        gram = rows.column("gram").to_numpy()
        cut = int(np.searchsorted(gram, gram[-1], side="left"))
        held = rows.slice(cut)
        if cut:
            yield from _refined(rows.slice(0, cut))
    if held is not None and held.num_rows:
        yield from _refined(held)


def _refined(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    gram = rows.column("gram").to_numpy()
    a = 0
    while a < len(gram):  # whole grams, about so many runs at a time
        b = min(len(gram), a + 4000)
        b = int(np.searchsorted(gram, gram[b - 1], side="right"))
        part = rows.slice(a, b - a)
        d, s = refine(gram[a:b], part.column("bytes").to_pylist(), part.column("doc").to_numpy(),
                      part.column("low").to_numpy())
        if len(d):
            yield _runs(d, s)
        a = b


def _hot_ranges(contexts: DataFrame) -> DataFrame:
    """The same for q-grams with very many kinds of runs, by a grouped minimum over their strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4000):
                part = batch.slice(a, 4000)
                own, place, x, y = strings(part.column("bytes").to_pylist())
                doc = part.column("doc").to_numpy(zero_copy_only=False)[own]
                start = part.column("low").to_numpy(zero_copy_only=False)[own] + place
                yield pa.record_batch([pa.array(x.view(np.int64)), pa.array(y.view(np.int64)), pa.array(doc),
                                       pa.array(start)], names=["x", "y", "doc", "start"])

    found = contexts.mapInArrow(run, "x long, y long, doc long, start long")
    least = found.groupBy("x", "y").agg(F.min(F.struct("doc", "start")).alias("first"))
    return (found.join(least, ["x", "y"]).where(F.struct("doc", "start") > F.col("first"))
            .select("doc", "start", (F.col("start") + LENGTH).alias("stop")))


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc, start, stop): byte ranges that cover all repeated strings of `docs` (doc, text)."""
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    settled = stored(_anchor_rows(docs).repartition(parts, "gram")
                     .sortWithinPartitions("gram", "run", "doc", "at")
                     .mapInArrow(_settle, "ask boolean, gram long, doc long, at long"), "settled")
    whole = settled.where("not ask").select(
        "doc", F.shiftright("at", 7).alias("start"),
        (F.shiftright("at", 7) + F.col("at").bitwiseAND(F.lit(127)) + LENGTH).alias("stop"))
    asked = settled.where("ask")
    contexts = stored(_contexts(docs, asked, asked.count()), "runs")
    hot = asked.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("gram")
    partly = (contexts.join(hot, "gram", "left_anti").repartition(parts, "gram").sortWithinPartitions("gram")
              .mapInArrow(_refine_rows, "doc long, start long, stop long"))
    return whole.unionAll(partly).unionAll(_hot_ranges(contexts.join(hot, "gram", "left_semi")))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc, text, row) where doc orders documents as doc_id does and row holds the other columns of `docs`.

    doc is doc_id itself when no id is null or names different texts. Otherwise documents are numbered by
    (doc_id, hash of the text), null ids last, so each text has a key of its own.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row"), docs["doc_id"].cast("long").alias("doc"),
                       F.coalesce(docs["text"], F.lit("")).alias("text"))
    print_ = F.xxhash64("text")
    odd = (rows.groupBy("doc").agg(F.min(print_).alias("a"), F.max(print_).alias("b"))
           .where("doc is null or a <> b").limit(1).count())
    if not odd:
        return rows
    spark = docs.sparkSession
    order = rows.select("doc", print_.alias("p")).distinct().orderBy(F.col("doc").asc_nulls_last(), "p")
    numbered = stored(spark.createDataFrame(order.rdd.zipWithIndex().map(lambda r: (r[0][0], r[0][1], r[1])),
                                            "k long, p2 long, number long"), "numbered")
    return rows.withColumn("p", print_).join(
        numbered, F.col("doc").eqNullSafe(F.col("k")) & (F.col("p") == F.col("p2"))
    ).select("row", F.col("number").alias("doc"), "text")


def _with_ranges(docs: DataFrame) -> DataFrame:
    """(row, text, ranges): the removed byte ranges of each text, which may overlap."""
    keyed = _keyed(docs)
    lists = (repeated_ranges(keyed).groupBy("doc")
             .agg(F.collect_list(F.struct("start", "stop")).alias("ranges")))
    lists = stored(lists, "ranges")
    size = lists.agg(F.sum(F.size("ranges"))).first()[0] or 0
    if size <= BROADCAST_ROWS:
        lists = F.broadcast(lists)
    return keyed.join(lists, "doc", "left").select("row", "text", "ranges")


def _cut(text: bytes, ranges: list[dict] | None) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs and the remaining bytes."""
    own = merged([(r["start"], r["stop"]) for r in ranges or ()])
    cuts = [0, *(x for r in own for x in r), len(text)]
    return own, b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2])) if own else text


def deduplicated(docs: DataFrame) -> DataFrame:
    """(row, text, spans, kept): `row` holds the columns of `docs` but the text, `spans` are the maximal removed byte
    ranges, `kept` the remaining bytes.

    Null texts count as empty, texts under LENGTH bytes lose nothing. Of rows that repeat an id and its text,
    none precedes the other: they are one document, listed as often as it occurs. Rows of one id with different
    texts are different documents, ordered by a hash; null ids come last. No documents give no rows. Texts and
    ranges alone go to Python; the other columns wait in the JVM.
    """
    @F.arrow_udf("struct<spans: array<struct<start: bigint, stop: bigint>>, kept: binary>")
    def removed(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        cut = [_cut(t, r) for t, r in zip(common.encoded(texts), ranges.to_pylist())]
        spans = pa.array([[{"start": a, "stop": b} for a, b in own] for own, _ in cut],
                         pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
        return pa.StructArray.from_arrays([spans, pa.array([kept for _, kept in cut], pa.binary())], ["spans", "kept"])

    found = _with_ranges(docs).select("row", "text", removed("text", "ranges").alias("out"))
    return found.select("row", "text", "out.spans", "out.kept")


def shortened(docs: DataFrame) -> DataFrame:
    """`docs` with what is kept as `text`; bytes of a character that was cut in two go as well. Else as `deduplicated`."""
    @F.arrow_udf("string")
    def rest(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        return pa.array([_cut(t, r)[1].decode("utf-8", "ignore") for t, r in zip(common.encoded(texts), ranges.to_pylist())], pa.string())

    done = _with_ranges(docs).select("row", rest("text", "ranges").alias("rest"))
    return done.select(*[F.col("rest").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """Counts and the SHA-256 of what is kept, for each document."""
    return deduplicated(docs.select("doc_id", "text")).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), F.octet_length("text").cast("long").alias("n_bytes"),
        (F.octet_length("text") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
