"""Encoding and decoding with a SentencePiece vocabulary, by a streaming Viterbi pass.

The lattice of a text has its character boundaries as nodes and pieces as edges. The vocabulary at hand is one
of merges, whose encoding is the path on which every two neighbouring pieces are stable: merging the two as one
text gives them back. So an edge continues a path only if it is stable after the path's last edge; one at most
is. (A plain sum of merge ranks as score would shred words: two common fragments outweigh one rare word.) The
result is, id for id, that of the library's own encoder.

The pass keeps a window of nodes no longer than the longest piece. Whenever the backpointers of all nodes from
which a piece may still start lead through one boundary, the ids before it are committed and forgotten. A
character without a piece of its own becomes byte pieces and closes the window; so does a boundary between two
characters that stand together in no piece, such as the start of a word. What lies between is remembered.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wearline.llm import common

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
#: Words, and pairs of pieces, that a worker remembers before it starts afresh.
REMEMBERED = 450_000


class Vocabulary:
    """Pieces with their ids and scores, and which pairs of pieces are stable."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                                             or model.is_unused(i))]
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: model.get_score(i) for i in plain}  # the order of merges
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.silent = {i for i in range(n) if model.is_control(i)}
        self.unknown = model.unk_id()
        self.longest = max(map(len, self.ids), default=1)
        #: Finds the pieces that end at each character, the longest first.
        self.edges = ahocorasick.Automaton()
        for p in self.ids:
            self.edges.add_word(p, p)
        self.edges.make_automaton()
        #: Pairs of characters that stand together in some piece; no piece crosses a boundary between others.
        self.inside = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        words = all(x[0] == SPACE or x[1] != SPACE for x in self.inside)
        lines = not any("\n" in x for x in self.inside)
        #: Parts of a marked text that no piece crosses: words with the marks before them, and line ends.
        self.parts = re.compile({(True, True): f"\n+|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+", (True, False): f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+",
                                 (False, True): "\n+|[^\n]+", (False, False): "(?s:.+)"}[words, lines])
        self.known: dict[tuple[str, str], bool] = {}  # stable pairs

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging the pair of best score, the first of equals, until none is left."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def stable(self, a: str, b: str) -> bool:
        known = self.known.get((a, b))
        if known is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            known = self.known[a, b] = self.merged(a + b) == [a, b]
        return known


class Stream:
    """Viterbi over characters as they come; `ids` grows as boundaries become certain."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.tail = ""  # the last characters pushed, fewer than the longest piece has
        self.ids: list[int] = []
        self._reset()
        self.widest = 0  # most nodes ever held

    def _reset(self) -> None:
        self.last: list[str | None] = [None]  # backpointers: the piece that ends at each node; None: no path
        self.before: str | None = None  # piece that ends at the committed boundary

    def push(self, chars: str) -> None:
        v, chars, first = self.v, self.tail + chars, len(self.tail)
        known, inside = v.known, v.inside
        last, base = self.last, first + 1 - len(self.last)  # base: place of the committed boundary, seen from the tail
        done, tried = first, -1  # characters whose node is there; the last character that ends a piece
        # The encoding of a beginning is unique under a merge order, so the first stable edge is the only one.
        for at, piece in v.edges.iter(chars):
            if at < done:
                continue
            if at != tried:
                if at > done:
                    self._without(chars[done:at], done == tried)
                    done = at
                    last, base = self.last, at + 1 - len(self.last)
                tried = at
                if len(piece) == 1 and len(last) > 1 and chars[at - 1:at + 1] not in inside:
                    self.close()
                    last, base = self.last, at
                elif at - base > 2 * v.longest:
                    self._commit()
                    last, base = self.last, at + 1 - len(self.last)
            start = at + 1 - len(piece) - base
            if start < 0:
                continue
            previous = last[start] if start else self.before
            if previous is None:
                if start:
                    continue
            else:
                stable = known.get((previous, piece))
                if not (v.stable(previous, piece) if stable is None else stable):
                    continue
            last.append(piece)
            done = at + 1
            if done - base >= self.widest:
                self.widest = done - base + 1
        self._without(chars[done:], done == tried)
        self.tail = chars[max(0, len(chars) - v.longest + 1):]

    def _without(self, chars: str, edge: bool) -> None:
        """Characters at which no path ends: no piece ends there, but for the first of them if `edge`."""
        if edge:
            self.last.append(None)
            chars = chars[1:]
        for ch in chars:
            self.close()
            self.ids += [self.v.bytes[b] for b in ch.encode("utf-8")] if self.v.bytes else [self.v.unknown]

    def _path(self, node: int) -> list[int]:
        """Boundaries on the way back from a node, itself included."""
        out = [node]
        while node > 0:
            node -= len(self.last[node])
            out.append(node)
        return out

    def _commit(self) -> None:
        """Commit up to the last boundary that the paths of all surviving nodes share."""
        end = len(self.last) - 1
        alive = [n for n in range(max(1, end - self.v.longest + 1), end + 1) if self.last[n] is not None]
        shared = set(self._path(alive[0])) if alive else {0}
        for n in alive[1:]:
            shared &= set(self._path(n))
        boundary = max(shared, default=0)
        if not boundary:
            return
        self._emit(boundary)
        self.before = self.last[boundary]
        self.last = [None, *self.last[boundary + 1:]]

    def _emit(self, node: int) -> None:
        path = self._path(node)
        self.ids += [self.v.ids[self.last[n]] for n in reversed(path[:-1])]

    def close(self) -> None:
        """No piece crosses this place: commit all."""
        if len(self.last) > 1:
            self._emit(len(self.last) - 1)
        self._reset()


def encode(vocabulary: Vocabulary, text: str) -> list[int]:
    """Ids of a whole text, one character at a time."""
    stream = Stream(vocabulary)
    stream.push((SPACE + text.replace(" ", SPACE)) if text else "")
    stream.close()
    return stream.ids


def decode(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The text of ids: byte pieces as UTF-8, broken bytes as U+FFFD, the leading space dropped."""
    parts: list[bytes] = []
    for i in ids:
        b = vocabulary.byte_of.get(i)
        if b is not None:
            parts.append(bytes((b,)))
        elif i == vocabulary.unknown:
            parts.append(" ⁇ ".encode())
        elif i not in vocabulary.silent:
            parts.append(vocabulary.pieces[i].encode())
    text = b"".join(parts).decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if text.startswith(" ") else text


class Words(dict):
    """Ids of words (with their space marks) as bytes, remembered."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.table = [b"" if i in vocabulary.silent else bytes((vocabulary.byte_of[i],)) if i in vocabulary.byte_of
                      else p.encode() for i, p in enumerate(vocabulary.pieces)]

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) > 1 and word[-2:] not in self.vocabulary.inside:  # such as a sign after the word
            ids = self[word[:-1]] + self[word[-1]]
        else:
            stream = Stream(self.vocabulary)
            stream.push(word)
            stream.close()
            ids = struct.pack(f"<{len(stream.ids)}I", *stream.ids)
        self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """Ids of a text, part by part where no piece joins parts."""
        return b"".join(map(self.__getitem__, self.vocabulary.parts.findall(SPACE + text.replace(" ", SPACE)))) if text else b""

    def text(self, ids: bytes) -> str:
        """`decode`, by table."""
        data = b"".join(map(self.table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        text = data.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


_LOADED: dict[str, Words] = {}


def _words(path: str | None) -> Words:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(VOCABULARY)
    if path not in _LOADED:
        _LOADED[path] = Words(Vocabulary(path))
    return _LOADED[path]


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every whole text; null and empty texts have no ids.

    Repeated rows come out as often as they occur, null ids stay null, no documents give no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        for batch in batches:
            for part in common.slices(batch):
                rows = [np.frombuffer(words.ids(t or ""), dtype="<i4") for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(rows, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids count as none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                texts = [words.text(np.array(i or [], dtype="<u4").tobytes()) for i in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(rows["doc_id"].cast("long").alias("doc_id"), rows["ids"].cast("array<int>").alias("ids")
                       ).mapInArrow(run, "doc_id long, text string")


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, decoded_crc32, round_trip) of every text: encoded, decoded again and compared.

    ids_crc32 is over little-endian unsigned 32-bit ids, decoded_crc32 over the UTF-8 bytes of the decoded text.
    round_trip is false only for texts that hold the space mark itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        for batch in batches:
            for part in common.slices(batch):
                rows = []
                for t in part.column(1).to_pylist():
                    ids = words.ids(t or "")
                    back = words.text(ids)
                    rows.append((len(ids) // 4, zlib.crc32(ids), zlib.crc32(back.encode()), back == (t or "")))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
                yield pa.record_batch([part.column(0), *[pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]],
                                      names=["doc_id", "n_ids", "ids_crc32", "decoded_crc32", "round_trip"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, decoded_crc32 long, round_trip boolean")
