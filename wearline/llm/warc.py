"""WARC archives: written through Spark's text writer, read back as a stream, indexed by an external merge.

Writing. A record is a header, a block and two line ends, so a file of records is a text file whose line separator is
the two line ends: Spark's writer puts it into any store it reaches and commits it safely. Files are compressed as a
whole, which keeps each of them in one task when it is read.

Reading. Lines of a file in order, with the separator put back, are the bytes of the archive. A parser follows them,
holds one record at a time and goes by Content-Length alone, so payloads may hold any bytes, separators included.
Payload digests are checked.

Index. Every archive gives a run: its records' index lines in the order of URL key and time. Runs are dealt out by
ranges of the global order, and each range merges its stretches of all runs with a loser tree. A URL with very many
captures is split over ranges by time, page and place.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.session import fresh_path, stored

GAP = "\r\n\r\n"
#: Payloads of fewer bytes are never written as revisits.
LEAST_BYTES = 0
#: Payloads with the most copies, whose decision reaches every task by itself: a bound on the rows broadcast.
MOST_COPIED = 1000
#: Index rows of a range, on average.
RANGE_ROWS = 250_000
#: Salts of rows that need no partner in the shuffle.
SALTS = 4096

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


# -- writing ----------------------------------------------------------------------------------------

def base32_sha1(payload: Column) -> Column:
    """SHA-1 of binary data in base32: five hexadecimal digits give four signs."""
    digits = F.sha1(payload)

    def signs(i: int) -> list[Column]:
        number = F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int")
        return [F.substring(F.lit(BASE32), F.shiftright(number, 15 - 5 * k).bitwiseAND(31) + 1, F.lit(1)) for k in range(4)]

    return F.concat(*[s for i in range(8) for s in signs(i)])


def captures(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html, payload_bytes, payload_digest, record_type, refers_to) of every page row.

    Of the rows with equal payloads of at least `least_bytes` bytes those with the largest page_id are responses
    (one row, unless rows repeat an id), all others revisit that page. Payloads count as equal if SHA-1, length and a 64-bit
    hash agree. Null html is empty. Rows without page_id never are the response while a copy has one; if none has,
    all are responses, as there is nothing to refer to. Other columns are not read.
    """
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"))
    body = F.col("html").cast("binary")
    rows = rows.withColumns({"payload_bytes": F.octet_length(body).cast("long"), "sha": F.sha1(body), "check": F.xxhash64(body)})
    copied = (rows.where(F.col("payload_bytes") >= least_bytes).groupBy("sha", "payload_bytes", "check")
              .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("copies"))
              .where((F.col("copies") > 1) & F.col("keeper").isNotNull()))
    copied = stored(copied, "copied")
    most = copied.orderBy(F.desc("copies"), "sha", "check").limit(MOST_COPIED)  # the bound of the broadcast
    same = ["sha", "payload_bytes", "check"]
    # Rows of the most copied payloads find their decision here and are spread by salt below; all others hold
    # at most one row in MOST_COPIED each.
    rows = rows.join(F.broadcast(most.select(*same, F.col("keeper").alias("known"))), same, "left")
    salt = F.when(F.col("known").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
    rows = (rows.withColumn("salt", salt.cast("int"))
            .join(copied.select(*same, "keeper").withColumn("salt", F.lit(0)), [*same, "salt"], "left"))
    keeper = F.coalesce("known", "keeper")
    revisit = keeper.isNotNull() & ~F.col("page_id").eqNullSafe(keeper)
    return rows.select("page_id", "url", "html", "payload_bytes", base32_sha1(F.col("html").cast("binary")).alias("payload_digest"),
                       F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, keeper).alias("refers_to"))


def record_id(page: Column, payload_digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), payload_digest, F.lit(">"))


def records(found: DataFrame, captured: Column | None = None) -> DataFrame:
    """One column `value`: the text of each record without its two last line ends.

    A revisit has the answer's header only, a response also the payload. `captured` is a timestamp column of `found`;
    without one, page ids count as seconds since 1970. Control characters in a URL are percent-encoded.
    """
    if captured is None:
        captured = F.timestamp_seconds(F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(2 ** 31)))
    date = F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    url = F.col("url")
    for sign in ("\r", "\n", "\t", "\x00"):
        url = F.replace(url, F.lit(sign), F.lit(f"%{ord(sign):02X}"))
    answer = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                      F.col("payload_bytes").cast("string"), F.lit(GAP))
    revisit = F.col("record_type") == "revisit"
    length = F.octet_length(answer) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    header = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "), record_id(F.col("page_id"), F.col("payload_digest")),
        F.lit("\r\nWARC-Date: "), date,
        F.when(F.col("url").isNull(), "").otherwise(F.concat(F.lit("\r\nWARC-Target-URI: "), url)),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "),
                                 record_id(F.col("refers_to"), F.col("payload_digest")))).otherwise(""),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"), F.lit(GAP))
    return found.select(F.concat(header, answer, F.when(revisit, "").otherwise(F.col("html"))).alias("value"))


def write_archives(found: DataFrame, path: str, captured: Column | None = None) -> None:
    """Records of `captures` as compressed WARC files below `path`, one a partition."""
    records(found, captured).write.option("lineSep", GAP).option("compression", "gzip").text(path)


# -- reading ----------------------------------------------------------------------------------------

_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$")


class Parser:
    """Records from the bytes of one archive, in pieces of any size; holds what is not yet a whole record."""

    def __init__(self):
        self.held, self.size, self.start, self.need = [], 0, 0, 0

    def feed(self, piece: bytes) -> Iterator[tuple[int, bytes, bytes]]:
        """(offset, header, block) of each record that the piece completes."""
        self.held.append(piece)
        self.size += len(piece)
        while self.size and self.size >= self.need:
            data = b"".join(self.held)
            self.held = [data]
            end = data.find(b"\r\n\r\n")
            if end < 0:
                self.need = self.size + 1
                return
            length = _LENGTH.search(data, 0, end + 2)
            if not data.startswith(b"WARC/") or not length:
                raise ValueError(f"no WARC record at byte {self.start}")
            total = end + 4 + int(length.group(1)) + 4
            if len(data) < total:
                self.need = total
                return
            if data[total - 4:total] != b"\r\n\r\n":
                raise ValueError(f"the record at byte {self.start} has no end")
            yield self.start, data[:end], data[end + 4:total - 4]
            self.held, self.size, self.start, self.need = [data[total:]], len(data) - total, self.start + total, 0

    def close(self) -> None:
        if self.size:
            raise ValueError(f"the record at byte {self.start} is cut off")


def fields(header: bytes) -> dict[str, str]:
    """Named fields by lower-case name."""
    lines = header.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def page_of(identifier: str | None) -> int | None:
    page = identifier.split(":")[2] if identifier else ""
    return int(page) if page else None


READ = ("archive string, start long, size long, page_id long, url string, captured string, record_type string, "
        "refers_to long, payload_digest string, payload_bytes long, payload binary")
_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
_FIELDS = [tuple(f.strip().split(" ")) for f in READ.split(",")]


def _record(archive: str, start: int, header: bytes, block: bytes) -> tuple:
    named = fields(header)
    kind, digest = named["warc-type"], named["warc-payload-digest"].removeprefix("sha1:")
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(_LENGTH.search(head).group(1))
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of the record at byte {start} of {archive} does not match its digest")
    return (archive, start, len(header) + 4 + len(block) + 4, page_of(named["warc-record-id"]), named.get("warc-target-uri"),
            named["warc-date"], kind, page_of(named.get("warc-refers-to")), digest, size,
            payload if kind == "response" else None)


def _parsed(batches: Iterator[pa.RecordBatch], held_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Records of the archives of a partition, which come file after file and line after line."""
    archive, parser, out, held = None, Parser(), [], 0
    gap = GAP.encode()

    def table():
        return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(zip(*out), _FIELDS)],
                                          [n for n, _ in _FIELDS])

    for batch in batches:
        for name, line in zip(batch.column("archive").to_pylist(), batch.column("line")):
            if name != archive:
                parser.close()
                archive, parser = name, Parser()
            for start, header, block in parser.feed(line.as_py() + gap):
                out.append(_record(archive, start, header, block))
                held += len(block) + 512
            if held > held_bytes:
                yield table()
                out, held = [], 0
    parser.close()
    if out:
        yield table()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records below `path`: place, page, URL, time, type, digest and, of responses, the checked payload.

    `start` and `size` are bytes of the archive after decompression. A damaged archive stops the job.
    """
    lines = spark.read.option("lineSep", GAP).text(path).select(
        F.col("_metadata.file_name").alias("archive"), F.col("value").cast("binary").alias("line"))
    return lines.mapInArrow(_parsed, READ)


def restored(read: DataFrame) -> DataFrame:
    """(page_id, url, html) of all records: a revisit takes the payload of its response; empty where there was none."""
    own = read.where("record_type = 'response'").select("page_id", "url", F.col("payload").cast("string").alias("html"))
    given = (read.where("record_type = 'response'").groupBy("page_id", "payload_digest").agg(F.first("payload").alias("body"))
             .withColumnsRenamed({"page_id": "refers_to"}))
    other = read.where("record_type = 'revisit'").drop("payload").join(given, ["refers_to", "payload_digest"], "left")
    return own.unionByName(other.select("page_id", "url", F.col("body").cast("string").alias("html")))


# -- index ------------------------------------------------------------------------------------------

def url_key(url: str | None) -> str:
    """Key that brings captures of a site together: host labels from the end, then path and query in lower case.

    A URL that cannot be split is its own key; null is empty.
    """
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    labels = host.removeprefix("www.").split(".")
    place = ",".join(reversed(labels)) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{place}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


LINE = ("url_key string, captured string, page_id long, archive string, start long, size long, url string, "
        "record_type string, refers_to long, payload_digest string, payload_bytes long")
_LINE = [tuple(f.strip().split(" ")) for f in LINE.split(",")]
#: The global order; archive and place in it make it total.
ORDER = ("url_key", "captured", "page_id", "archive", "start")


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([keys, *[batch.column(n) for n, _ in _LINE[1:]]], [n for n, _ in _LINE])


def runs(read: DataFrame) -> DataFrame:
    """Index lines without payloads: each task's lines are one run, in the global order, numbered by `run` and `place`.

    Written to the shared folder, so numbers stay as they are whatever is lost later.
    """
    lines = read.drop("payload").mapInArrow(_keyed, LINE).sortWithinPartitions(*ORDER)
    return stored(lines.withColumns({"run": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "runs")


class LoserTree:
    """Merges k sorted streams: every inner node holds the loser of the match played there, the winner goes up.

    After the winner's stream moves on, only the matches on its way to the root are played again.
    """

    def __init__(self, streams: list[Iterator[tuple]]):
        self.streams = streams
        self.heads = [next(s, None) for s in streams]
        k = len(streams)
        # Leaves are k .. 2k - 1, node i has the children 2i and 2i + 1; node 0 is the winner of all.
        winner, self.tree = [0] * k + list(range(k)), [0] * max(k, 1)
        for node in range(k - 1, 0, -1):
            a, b = winner[2 * node], winner[2 * node + 1]
            winner[node], self.tree[node] = (b, a) if self._beats(b, a) else (a, b)
        self.tree[0] = winner[1] if k > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        """Whether the head of stream a comes first; an ended stream comes last."""
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x < y)

    def __iter__(self) -> Iterator[tuple]:
        k = len(self.streams)
        while k and self.heads[at := self.tree[0]] is not None:
            yield self.heads[at]
            self.heads[at] = next(self.streams[at], None)
            node = (at + k) // 2
            while node:
                if self._beats(self.tree[node], at):
                    at, self.tree[node] = self.tree[node], at
                node //= 2
            self.tree[0] = at


def _merged(batches: Iterator[pa.RecordBatch], step: int = 10_000) -> Iterator[pa.RecordBatch]:
    """The index lines of one range, in the global order. They come run after run, each run in its own order."""
    table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if table is None:
        return
    run = table["run"].to_numpy()
    # Null pages sort first, as in the runs.
    keys = list(zip(table["url_key"].to_pylist(), table["captured"].to_pylist(),
                    [(p is not None, p or 0) for p in table["page_id"].to_pylist()],
                    table["archive"].to_pylist(), table["start"].to_pylist(), range(len(run))))
    cuts = [0, *(i for i in range(1, len(run)) if run[i] != run[i - 1]), len(run)]
    order = [key[-1] for key in LoserTree([iter(keys[a:b]) for a, b in zip(cuts, cuts[1:])])]
    lines = table.select([n for n, _ in _LINE])
    for i in range(0, len(order), step):
        yield from lines.take(pa.array(order[i:i + step])).combine_chunks().to_batches()


def capture_index(read: DataFrame) -> DataFrame:
    """Index lines of all records in one global order: URL key, time, page, place; partitions are its ranges.

    The histories of all URLs stand one after another, each from its first capture to its last.
    """
    found = runs(read)
    ranges = max(1, -(-found.count() // RANGE_ROWS))
    dealt = found.repartitionByRange(ranges, *ORDER).sortWithinPartitions("run", "place")
    return dealt.mapInArrow(_merged, LINE)


# -- the query ----------------------------------------------------------------------------------------

def digest(pages: DataFrame) -> DataFrame:
    """Writes the archives of all pages, reads them back and returns the index's page, size, digest, type and reference.

    Nulls and repeated rows: see `captures`. An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(captures(pages), path)
    return capture_index(read_archives(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_GROUPS = " || ".join(
    f"substr('{BASE32}', (((('0x' || substr(sha, {5 * i + 1}, 5))::bigint >> {15 - 5 * k}) & 31) + 1)::int, 1)"
    for i in range(8) for k in range(4))
DIGEST_SQL = f"""
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as sha from pages),
k as (select *, max(page_id) over (partition by html) as keeper from p)
select page_id, strlen(html)::bigint as payload_bytes, {_GROUPS} as payload_digest,
       case when keeper is null or page_id is not distinct from keeper then 'response' else 'revisit' end as record_type,
       case when keeper is not null and page_id is distinct from keeper then keeper end as refers_to
from k
"""
