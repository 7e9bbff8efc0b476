"""Conversation repair, WARC archives and hard negatives against plain versions."""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from wearline.llm import conversation_repair as repair
from wearline.llm import hard_negatives as negatives
from wearline.llm import queries, warc

# -- conversation repair ------------------------------------------------------------------------------

CHAT = "conv_id long, turn long, role string, text string, audit string, mark string, fault string"


def chats(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "y") for r in rows], CHAT)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def faults_of(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        word = re.findall(r"[^\x20\x09-\x0D]", text)
        found.append("blank" if not word else "duplicate" if (role, text) in seen else
                     "truncated" if word[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def tried(rows, faults, audit):
    """(cost, lines) of an audit, or None if it is not allowed or its roles do not follow the grammar."""
    at, cost, roles, lines = 0, 0, "", []
    for edit in audit:
        if edit == "I":
            role, text, cost = ("assistant" if roles[-1:] == "u" else "user"), "", cost + 3
        else:
            _, _, role, text = rows[at]
            fault, at = faults[at], at + 1
            if edit == "D":
                cost += 4
                continue
            if fault in ("blank", "duplicate"):
                return None
            cost += 3 if fault else 0
            if edit == "K" and not role:
                return None  # an empty role is none of the grammar's
            if edit == "R":
                role, cost = "assistant" if roles[-1:] == "u" else "user", cost + 3
        roles += role[:1]
        lines.append(f"{role}:{text}")
    return (cost, lines) if re.fullmatch("(s?(ua)+)?", roles) else None


def plain_repair(rows):
    """Every audit with up to n + 1 insertions, for conversations of few rows."""
    faults = faults_of(rows)
    best = None
    for inserts in range(len(rows) + 2):
        for places in itertools.combinations(range(len(rows) + inserts), inserts):
            for letters in itertools.product("KRD", repeat=len(rows)):
                rest = iter(letters)
                audit = "".join("I" if i in places else next(rest) for i in range(len(rows) + inserts))
                result = tried(rows, faults, audit)
                if result and (best is None or (result[0], audit) < best[:2]):
                    best = (result[0], audit, result[1])
    return best


def plain_digest(rows):
    groups, out = defaultdict(list), {}
    for r in plain_damage(rows):
        groups[r[0]].append(r)
    for conv in {r[0] for r in rows}:
        own = sorted(groups[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).digest()))
        turns = [r[1] for r in own if r[1] is not None]
        counts = Counter(faults_of(own))
        initials = [r[2][:1] for r in own]
        cost, audit, lines = plain_repair(own)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"], counts["duplicate"],
                     counts["truncated"], sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def digested(df):
    return {r["conv_id"]: tuple(r[n] for n in NAMES) for r in repair.digest(df).collect()}


def some_chats(n=120, longest=4):
    rng = random.Random(5)
    roles = ["system", "user", "assistant", "tool", "", None, "User", "user", "assistant"]
    texts = ["Yes.", "No!", "why?", "cut off", "", " \t\n\x0b", None, "two\nlines.", "é ß.", "tail.\x85", "dots. \r\n", "x"]
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(roles), rng.choice(texts)))
    return rows


def test_repair_against_every_audit(spark):
    rows = some_chats()
    got, want = digested(chats(spark, rows)), plain_digest(rows)
    assert [(c, got[c], want[c], [r for r in rows if r[0] == c]) for c in want if got.get(c) != want[c]][:2] == []
    assert len(got) == len(want)


def test_repair_shares_work_and_batches(spark, small_batches):
    rows = some_chats(40, 3) + [(500 + i, t, "user" if t % 2 == 0 else "assistant", "same.") for i in range(60) for t in (0, 1)]
    assert digested(chats(spark, rows)) == plain_digest(rows)


def test_repair_of_a_long_conversation_and_long_texts(spark):
    long = "word " * 200_000 + "end."
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"text {t}.") for t in range(5000)]
    rows += [(2, 0, "user", long), (2, 1, "assistant", long + " cut"), (3, 0, "system", "alone.")]
    out = [tuple(r) for r in repair.repair(chats(spark, rows)).orderBy("conv_id", "seq").collect()]
    assert [r[0] for r in out] == [1] * 5000 + [2, 2]  # a system row alone goes, which is cheaper than an answer pair
    assert out[-1][2:] == ("assistant", long + " cut")
    assert digested(chats(spark, rows))[3][5:7] == (4, "D") or zlib.crc32(b"3:0") % 20 < 5


def test_repair_of_nothing_and_of_dropped_rows(spark):
    assert repair.digest(chats(spark, []).limit(0)).collect() == []
    assert repair.repair(chats(spark, []).limit(0)).collect() == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert digested(chats(spark, [(dropped, 0, "user", "Hello.")])) == {
        dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_automaton_has_few_nodes_and_shares_endings():
    rng = random.Random(3)
    one, nodes = repair.Automaton(), set()
    for signature in sorted("".join(rng.choice("suaoSUAOx") for _ in range(rng.randint(0, 60))) for _ in range(400)):
        fresh = repair.Automaton()
        assert one.read(signature) == fresh.read(signature)
        nodes.add(len(one.nodes))
    assert max(nodes) < 200
    assert one.read("au" * 50_000)[0] == 0  # the path is a flat array, however long


def test_repair_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{sf['0.01']}/conversations.parquet')")
    got = repair.digest(spark.read.parquet(f"{sf['0.01']}/conversations.parquet")).select("conv_id", *NAMES)
    want = con.execute(queries.ORACLES["op11_conversation_repair"]).fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


# -- WARC -----------------------------------------------------------------------------------------------

def pages(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 0) for r in rows], "page_id long, url string, html string, sha string, salt string, size int")


HOSTILE = ["\r\n\r\n", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "\r\n\r\r\n\r\n\r\n\n", "a\r\n", "\r\n" * 9, "\x00\x01",
           "x" * 65_530 + "\r\n\r\n" + "y" * 65_531 + "\r\n\r", ("é\r\n\r" * 30_000) + "\n", "Content-Length: 99999\r\n"]


def some_pages():
    rng = random.Random(11)
    urls = ["http://a.org/x", "http://www.a.org/x", "https://b.a.org:8080/Q?z=1&y=2", "not a url", "http://[bad", "http://a.org/\r\nX: y", None, ""]
    rows = [(i, rng.choice(urls), h) for i, h in enumerate(HOSTILE)]
    rows += [(100 + i, "http://hot.org/", "copied page") for i in range(300)]
    rows += [(1000 + i, rng.choice(urls), rng.choice(["one", "two", "", None, f"own {i}"])) for i in range(200)]
    return rows + [(None, "http://n.org", "copied page"), (None, "http://n.org", "of nobody"), (None, None, "of nobody"),
                   (7, "http://again.org", "twice"), (7, "http://again.org", "twice"), (-3, "http://minus.org", "one")]


def plain_warc(rows, least=0):
    keeper = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= least:
            keeper[html or ""] = max(page, keeper.get(html or "", page))
    out = []
    for page, _, html in rows:
        body, keep = (html or "").encode(), keeper.get(html or "")
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        kind = "response" if keep is None or page == keep else "revisit"
        out.append((page, len(body), digest, kind, None if kind == "response" else keep))
    return sorted(out, key=repr)


def test_warc_digest(spark, monkeypatch):
    for most in (1000, 1):  # with one payload known to every task, and with all
        monkeypatch.setattr(warc, "MOST_COPIED", most)
        assert sorted((tuple(r) for r in warc.digest(pages(spark, some_pages())).collect()), key=repr) == plain_warc(some_pages())
    assert warc.digest(pages(spark, some_pages()).limit(0)).collect() == []


def test_warc_round_trip_and_index(spark, tmp_path, monkeypatch, small_batches):
    monkeypatch.setattr(warc, "RANGE_ROWS", 40)
    rows, path = some_pages(), str(tmp_path / "archives")
    warc.write_archives(warc.captures(pages(spark, rows).repartition(5)), path)
    read = warc.read_archives(spark, path)
    clean = [(p, u and u.replace("\r\n", "%0D%0A"), h or "") for p, u, h in rows]
    back = [tuple(r) for r in warc.restored(read).collect()]
    assert sorted(back, key=repr) == sorted(clean, key=repr)

    # Partitions in turn are the global order, whatever the runs and ranges.
    index = warc.capture_index(read)
    lines = [r.asDict() for r in index.collect()]
    keys = [(r["url_key"], r["captured"], (r["page_id"] is not None, r["page_id"] or 0), r["archive"], r["start"]) for r in lines]
    assert len(keys) == len(rows) and keys == sorted(keys) and len(set(keys)) == len(keys)
    assert index.rdd.getNumPartitions() > 5

    # Place and size lead to the record.
    import gzip
    for r in random.Random(1).sample(lines, 20):
        data = gzip.open(f"{path}/{r['archive']}").read()
        record = data[r["start"]:r["start"] + r["size"]]
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert r["payload_digest"].encode() in record and record[:200].count(f"WARC-Type: {r['record_type']}".encode()) == 1


def test_warc_keeps_small_payloads(spark):
    got = warc.captures(pages(spark, some_pages()), 4)
    out = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in out), key=repr) == plain_warc(some_pages(), 4)


def test_damaged_archive_stops(spark, tmp_path):
    import gzip
    path = tmp_path / "archives"
    warc.write_archives(warc.captures(pages(spark, [(1, "http://a.org", "whole page")]).coalesce(1)), str(path))
    file = next(f for f in path.iterdir() if f.name.startswith("part-"))
    data = gzip.open(file).read()
    for n, bad in enumerate((data.replace(b"whole", b"other"), data[:-20], data.replace(b"WARC/1.1", b"WORC/1.1"))):
        other = tmp_path / f"bad-{n}"
        other.mkdir()
        with gzip.open(other / "part-0.txt.gz", "wb") as out:
            out.write(bad)
        with pytest.raises(Exception, match="does not match|cut off|no end|no WARC"):
            warc.read_archives(spark, str(other)).collect()


def test_parser_takes_any_pieces():
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\n\r\n\r\n"
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    for step in (1, 2, 3, 7, 1000):
        parser, data = warc.Parser(), record * 3
        found = [x for i in range(0, len(data), step) for x in parser.feed(data[i:i + step])]
        parser.close()
        assert [(s, b) for s, _, b in found] == [(k * len(record), block) for k in range(3)]


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree_merges(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(9), r, i) for i in range(rng.randrange(30))) for r in range(k)]
    assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("http://www.Site.org/A?b=1") == "org,site)/a?b=1"
    assert warc.url_key("https://x.site.org:8080") == "org,site,x:8080)/"
    assert (warc.url_key(None), warc.url_key("odd"), warc.url_key("http://[bad")) == ("", "odd", "http://[bad")


# -- hard negatives -------------------------------------------------------------------------------------

def vectors(seed=7, n=420, size=8):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([0.0, rng.uniform(-1, 1), rng.uniform(0, 1)]) for _ in range(size)], rng.randrange(3)) for i in range(n)]
    same = [0.25] * size
    rows += [(1000 + i, same, i % 4) for i in range(40)]  # ties
    rows += [(1000, same, 0), (300, [0.5] * size, 9), (301, [0.5] * size, None), (None, same, 1), (2400, [], 1), (2500, [0.5, -0.5], 1)]
    return rows + [(2000, None, 1), (2100, [0.1, None] + [0.0] * 6, 1), (2200, [float("nan")] * 8, 1), (2300, [-math.inf] * 8, 1)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, 0, "x", 1) for i, v, k in rows],
                                 "vec_id long, embedding array<double>, label int, id int, v string, a int")


def plain_mining(rows, m=negatives.Mining()):
    whole = []
    for i, v, k in rows:
        if i is None or v is None or k is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((i, (k + 1) % 10 if i % 7 == 0 else k, [math.floor(256 * x) for x in v]))
    anchors = {}
    for i, k, v in sorted(whole):
        if i % 100 == 0:
            anchors.setdefault(i, (k, v))
    out = []
    for a, (label, v) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, k) for i, k, w in whole)
        for s, p, _ in [x for x in scored if x[2] == label and x[1] != a][:m.positives]:
            hits = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:m.negatives]
            out += [(a, p, rank, n, -s, -t) for rank, (t, n, _) in enumerate(hits, 1)]
    return sorted(out)


@pytest.mark.parametrize("tile", [8192, 48])
def test_hard_negatives_are_exact(spark, monkeypatch, tile):
    monkeypatch.setattr(negatives, "CANDIDATE_ROWS", tile)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", max(2, tile // 16))
    got = sorted(tuple(r) for r in negatives.digest(frame(spark, vectors())).collect())
    assert got == plain_mining(vectors()) and got


def test_hard_negatives_of_large_components(spark):
    rows = [(i, [x * 40_000 for x in v], k) for i, v, k in vectors(3, 250) if v and None not in v and all(map(math.isfinite, v))]
    assert sorted(tuple(r) for r in negatives.digest(frame(spark, rows)).collect()) == plain_mining(rows)


def test_hard_negatives_odd_tables(spark):
    assert negatives.digest(frame(spark, []).limit(0)).collect() == []
    few = [(0, [1.0, 0.5], 1), (100, [1.0, 0.0], 1), (5, [0.5, 0.0], 2)]
    assert sorted(tuple(r) for r in negatives.digest(frame(spark, few)).collect()) == plain_mining(few)
    with pytest.raises(Exception, match="too long for exact"):
        negatives.digest(frame(spark, [(0, [1e300], 1), (1, [1.0], 1)])).collect()


def test_scores_from_residues_are_exact():
    rng = np.random.default_rng(2)
    for size, top in ((1, 1), (64, 256), (200, 2 ** 20), (130, 2 ** 26)):
        a, b = rng.integers(-top, top + 1, (9, size)), rng.integers(-top, top + 1, (11, size))
        want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
        primes = negatives.primes_for(max(abs(s) for r in want for s in r))
        parts = [{p: [negatives.residues(t[:, d:d + negatives.DEPTH], p) for d in range(0, size, negatives.DEPTH)] for p in primes}
                 for t in (a, b)]
        assert negatives.scores(*parts, primes).tolist() == want
    assert max(negatives.PRIMES) // 2 * (max(negatives.PRIMES) // 2) * negatives.DEPTH < 2 ** 24


@pytest.mark.parametrize("name, table, build", [("op12_warc", "pages", warc.digest), ("op13_hard_negatives", "embeddings", negatives.digest)])
def test_sql_of_the_others(spark, sf, name, table, build):
    con = duckdb.connect()
    con.execute(f"create view {table} as select * from read_parquet('{sf['0.01']}/{table}.parquet')")
    got = build(spark.read.parquet(f"{sf['0.01']}/{table}.parquet"))
    want = con.execute(f"select {', '.join(got.columns)} from ({queries.ORACLES[name]})").fetchall()
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
