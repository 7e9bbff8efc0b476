"""Packing of token sequences: a configuration linear program over the length histogram.

Documents are tokenized and cut into pieces of at most `CAPACITY` tokens. Only the histogram of piece lengths
(at most `CAPACITY` numbers, whatever the corpus) reaches the driver. There the linear program "fewest
sequences, over all fillings of a sequence, that cover every length's count" is solved by multiplicative
weights: each round a knapsack dynamic program finds the filling of greatest total price, the filling is used
for a part of the scarcest length's count, and prices of covered lengths fall. The fractional solution is
rounded down to whole sequences that use no piece twice; what rounding leaves over is placed by best fit, on the
histogram as well. The result is a bounded list of (filling, how many sequences).

Pieces are then matched to places in parallel: pieces of one length are numbered, and number ranges belong to
fillings. Numbers come from counts per (length, slot), so no length is numbered in one task.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.llm import common
from wearline.session import stored

CAPACITY = 1024
#: Closes every document.
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
#: Rounds of multiplicative weights; each makes one filling.
ROUNDS = 700
#: Part of the scarcest length's count that a round covers, and the fall of prices with coverage.
STEP, FALL = 0.5, 2.0
#: Words whose ids a worker remembers before it starts afresh.
REMEMBERED = 400_000
#: Pieces of one length that are numbered together, on average at most.
SLOT_ROWS = 20_000


def byte_symbols() -> dict[str, int]:
    """The letter that a byte-level vocabulary file writes for each byte: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokens(dict):
    """Ids of a document as little-endian bytes, remembered word by word.

    The vocabulary's splitting rule always starts a new part before a space that a non-space follows and
    before a lone line feed, so words can be encoded one by one. A text with any other white space or with
    a special token is encoded whole by `tokenizers`. Single words go through the same merges held as ranks,
    which is several times faster, if the file's ids follow its merges; if not, through `tokenizers` too.
    """

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer
        super().__init__()
        self.encode = Tokenizer.from_file(path).encode
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in merges]
        self.word = None
        if all(vocabulary.get(m) == 256 + i for i, m in enumerate(pairs)):
            symbols = byte_symbols()
            ranks = {bytes(symbols[c] for c in t): i for t, i in vocabulary.items() if t not in self.special}
            self.word = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks,
                                          special_tokens={}).encode_ordinary

    def raw(self, text: str) -> bytes:
        return np.array(self.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        text = word if word.startswith("\n") else " " + word
        ids = self[word] = np.array(self.word(text), dtype="<u4").tobytes() if self.word else self.raw(text)
        return ids

    def ids(self, text: str) -> bytes:
        if " ".join(text.split()) != text.replace("\n", " ") or any(s in text for s in self.special):
            return self.raw(text)
        words = text.replace("\n", " \n").split(" ")
        return self.raw(words[0]) + b"".join(map(self.__getitem__, words[1:]))


_LOADED: dict[str, Tokens] = {}


def _tokens(path: str) -> Tokens:
    if path not in _LOADED:
        _LOADED[path] = Tokens(path)
    return _LOADED[path]


def _vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, end) of the pieces of n ids: full pieces at the end, the rest in front."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((a, a + capacity) for a in range(first, n, capacity))]


def pieces(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document; a null text counts as empty."""
    path = path or _vocabulary()
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long" + ", ids array<int>" * with_ids
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        for batch in batches:
            for part in common.slices(batch):
                rows: list[tuple] = []
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = tokens.ids(text or "") + end
                    for i, (a, b) in enumerate(cuts(len(ids) // 4, capacity)):
                        own = ids[4 * a:4 * b]
                        rows.append((key, i, a, b - a, zlib.crc32(own), np.frombuffer(own, dtype="<i4")))
                cols = [pa.array([r[k] for r in rows], type=t) for k, t in enumerate(
                    (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([r[5] for r in rows], type=pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.record_batch(cols, names=names)

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, schema)


def best_filling(price: np.ndarray, capacity: int) -> Counter:
    """Knapsack: lengths (with repetition) of greatest total price that fit; price[k] is of length k."""
    best = np.zeros(capacity + 1)
    took = np.zeros(capacity + 1, dtype=np.int64)
    lengths = np.flatnonzero(price > 0)[::-1]  # of equal totals, the longest piece wins
    values = price[lengths]
    unusable = len(lengths) - np.searchsorted(lengths[::-1], np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        first = unusable[c]
        if first < len(lengths):
            total = best[c - lengths[first:]] + values[first:]
            k = int(total.argmax())
            if total[k] > best[c]:
                best[c], took[c] = total[k], lengths[first + k]
    filling: Counter = Counter()
    c = capacity
    while c > 0:
        if took[c]:
            filling[int(took[c])] += 1
            c -= int(took[c])
        else:
            c -= 1
    return filling


def solve(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[Counter, float]]:
    """Fillings and how often each is used, fractionally; counts[k] is the number of pieces of length k."""
    need = counts.astype(float)
    have = need > 0
    covered = np.zeros(capacity + 1)
    used: dict[tuple, float] = {}
    for _ in range(rounds if have.any() else 0):
        price = np.where(have, np.exp(-FALL * (covered - covered[have].min())), 0.0)
        # A length's price per token decides; its count only decides how far a filling carries.
        filling = best_filling(price * np.arange(capacity + 1), capacity)
        lengths = np.array(list(filling))
        times = np.array(list(filling.values()), dtype=float)
        amount = STEP * float((need[lengths] / times).min())
        covered[lengths] += amount * times / need[lengths]
        key = tuple(sorted(filling.items()))
        used[key] = used.get(key, 0.0) + amount
    return [(Counter(dict(k)), v) for k, v in used.items()]


def rounded(counts: np.ndarray, used: list[tuple[Counter, float]], capacity: int) -> list[tuple[Counter, int]]:
    """Whole sequences that hold every piece exactly once."""
    left = counts.copy()
    volume = float((counts * np.arange(capacity + 1)).sum())
    total = sum(v * sum(k * n for k, n in f.items()) for f, v in used)
    scale = volume / total if total else 0.0
    out: list[tuple[Counter, int]] = []
    for filling, v in sorted(used, key=lambda x: -sum(k * n for k, n in x[0].items())):
        times = min(int(v * scale), *(int(left[k]) // n for k, n in filling.items()))
        if times > 0:
            for k, n in filling.items():
                left[k] -= n * times
            out.append((filling, times))
    return out + best_fit(left, capacity)


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[Counter, int]]:
    """Best fit, longest first, of whole counts: groups of equal sequences are filled together."""
    open_: dict[int, list[list]] = {}
    for k in range(capacity, 0, -1):
        n = int(left[k])
        while n:
            room = min((r for r in open_ if r >= k), default=None)
            if room is None:
                per = min(capacity // k, n)
                bins, filling = n // per, Counter({k: per})
                n -= bins * per
                rest = capacity - k * per
            else:
                groups = open_[room]
                filling, bins = groups.pop()
                if not groups:
                    del open_[room]
                per = min(room // k, n)
                use = min(bins, n // per)
                if use < bins:
                    open_.setdefault(room, []).append([filling, bins - use])
                filling, bins = filling + Counter({k: per}), use
                n -= use * per
                rest = room - k * per
            open_.setdefault(rest, []).append([filling, bins])
    return [(f, b) for groups in open_.values() for f, b in groups]


def plan(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[Counter, int]]:
    """(filling, sequences) for the histogram; full-length pieces stand alone from the start."""
    own = counts.copy()
    own[capacity] = 0
    full = [(Counter({capacity: 1}), int(counts[capacity]))] if counts[capacity] else []
    return full + rounded(own, solve(own, capacity, rounds), capacity)


def places(fillings: list[tuple[Counter, int]]) -> list[tuple]:
    """(length, first number, end number, first sequence, pieces of this length in a sequence, offset)."""
    taken: Counter = Counter()
    sequence, rows = 0, []
    for filling, times in fillings:
        offset = 0
        for k in sorted(filling, reverse=True):
            n = filling[k]
            rows.append((k, taken[k], taken[k] + n * times, sequence, n, offset))
            taken[k] += n * times
            offset += n * k
        sequence += times
    return rows


def numbered(found: DataFrame) -> DataFrame:
    """`found` with `number`: 0, 1, ... within each length, from counts per (length, slot)."""
    slots = common.blocks_for(found.count(), SLOT_ROWS)
    slot = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(slots)).cast("int")
    dealt = found.withColumn("slot", slot)
    before = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    first = (dealt.groupBy("length", "slot").agg(F.count("*").alias("n"))
             .select("length", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    order = Window.partitionBy("length", "slot").orderBy("doc_id", "piece", "ids_crc32", "start")
    return (dealt.join(first, ["length", "slot"])
            .withColumn("number", F.col("first") + F.row_number().over(order) - 1).drop("slot", "first"))


def pack(docs: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document.

    Null and empty texts are one piece holding the closing id. Repeated rows are packed as often as they
    occur; a null doc_id is kept. Ties in length go in order of doc_id and piece within a slot. No documents
    give no rows.
    """
    found = stored(pieces(docs, capacity, path=path), "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in found.groupBy("length").count().collect():  # at most `capacity` rows
        counts[r["length"]] = r["count"]
    rows = places(plan(counts, capacity, rounds))
    spark: SparkSession = docs.sparkSession
    # At most one row per length of each filling; fillings are bounded by the rounds and the lengths.
    where = spark.createDataFrame(rows, "length int, low long, high long, base long, each long, at long")
    # `where` follows from `capacity` and `rounds` alone, whatever the corpus.
    placed = numbered(found).join(F.broadcast(where), "length").where("number >= low and number < high")
    step = F.col("number") - F.col("low")
    return placed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("base") + F.floor(step / F.col("each"))).alias("sequence_id"),
        (F.col("at") + F.pmod(step, F.col("each")) * F.col("length")).alias("offset"))
