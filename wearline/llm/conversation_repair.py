"""Repair of conversation structure with a suffix-shared automaton of role and fault signatures.

Every conversation becomes a signature: one sign per row for its role and fault. Signatures are minimised from the
end: read backwards, all conversations form one automaton in which conversations that end alike share their nodes.
For each node and each state of the role grammar the cheapest cost to the end and the first edit of the best audit
from there are computed once. Signatures are dealt out by ranges of their backward order, so that a task meets
equal endings one after another: it keeps the nodes of one path at a time, and each node is made once. A signature
that very many conversations share is split over ranges by conversation.

Only narrow rows (no texts) are used up to here. The edits are then laid beside the rows of their conversation in
one sorted stream, which gives the repaired rows. Of the conversation it reads, a task holds the signature, the audit
and a path of two numbers a row, never the texts.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import islice
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.session import stored

# What an edit costs. A truncated row that stays adds TRUNCATED.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

#: States of the grammar (s?(ua)+)? by the last role, and where a role's initial leads.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: In each state one of user and assistant may come next.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
ENDS = (START, ASSISTANT)

#: Sign of a row that has to go; other signs are the role's initial (o: no role of the grammar), upper case if truncated.
GONE = "x"
SPACES = " \t\n\x0b\x0c\r"
#: Characters of signatures and texts that a step holds before it hands its rows on.
HELD = 1 << 20


# -- the automaton --------------------------------------------------------------------------------

Node = tuple[tuple[int, str, int], ...]  # per state: cost to the end, first edit, state after it


def _closed(options: list[tuple[int, str, int] | None]) -> Node:
    """Best of each state's options and of an insertion before them; ties go to the first edit in ASCII.

    The edits that a state allows have different letters, so the first letter decides between audits of equal cost.
    """
    def best(state: int, found: tuple[int, str, int] | None) -> tuple[int, str, int] | None:
        target = options[NEXT[state]]
        inserted = (INSERT + target[0], "I", NEXT[state]) if target else None
        return min((x for x in (found, inserted) if x), default=None)

    # An insertion is followed by an edit of the row or by one more insertion: u and a wait for each other at most once.
    for _ in range(2):
        options = [best(s, o) for s, o in enumerate(options)]
    return tuple(options)


END: Node = _closed([(0, "", s) if s in ENDS else None for s in range(4)])


def before(sign: str, rest: Node) -> Node:
    """The node of a row in front of the node of the rows after it."""
    extra, role = (TRUNCATED if sign.isupper() else 0), sign.lower()
    options = []
    for state in range(4):
        found = [(DELETE + rest[state][0], "D", state)]
        if sign != GONE:
            to = NEXT[state]
            found.append((REROLE + extra + rest[to][0], "R", to))
            kept = FOLLOWS.get((state, role))
            if kept is not None:
                found.append((KEEP + extra + rest[kept][0], "K", kept))
        options.append(min(found))
    return _closed(options)


class Automaton:
    """Nodes with costs counted from their cheapest state, each made once; and the path of one signature.

    Two states of a node differ by a few insertions at most, so whatever the signatures, few nodes are different.
    """

    def __init__(self):
        self.nodes: list[Node] = []
        self.index: dict[Node, int] = {}
        self.moves: dict[tuple[str, int], tuple[int, int]] = {}
        self.signs = ""
        first, cost = self._known(END)
        # The path from the end: node and cost of its cheapest state, one entry a row and one for the end.
        self.path, self.costs = array("l", [first]), array("q", [cost])

    def _known(self, node: Node) -> tuple[int, int]:
        """Number of a node, and what its cheapest state costs."""
        least = min(cost for cost, _, _ in node)
        node = tuple((cost - least, edit, state) for cost, edit, state in node)
        if node not in self.index:
            self.index[node] = len(self.nodes)
            self.nodes.append(node)
        return self.index[node], least

    def read(self, backward: str) -> tuple[int, str]:
        """Cost and audit of a signature given from its end; shares the path of the ending it has in common with the last."""
        shared = len(commonprefix([self.signs, backward]))
        del self.path[shared + 1:], self.costs[shared + 1:]
        at, total = self.path[-1], self.costs[-1]
        for sign in islice(backward, shared, None):
            if (sign, at) not in self.moves:
                self.moves[sign, at] = self._known(before(sign, self.nodes[at]))
            at, more = self.moves[sign, at]
            total += more
            self.path.append(at)
            self.costs.append(total)
        self.signs = backward
        return total + self.nodes[at][START][0], self._audit()

    def _audit(self) -> str:
        at, state, edits = len(self.path) - 1, START, []
        while True:
            _, edit, state = self.nodes[self.path[at]][state]
            if not edit:
                return "".join(edits)
            edits.append(edit)
            at -= edit != "I"


# -- rows -------------------------------------------------------------------------------------------

def _filled(c: str) -> Column:
    """Null is one space."""
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def rows_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) without nulls in role and text, and `mark`, which orders rows of one turn and role."""
    rows = conversations.select(*[conversations[c] for c in ("conv_id", "turn", "role", "text")])
    return rows.select("conv_id", "turn", _filled("role").alias("role"), _filled("text").alias("text")).withColumn(
        "mark", F.unhex(F.md5(F.col("text").cast("binary"))))


#: Rows of a conversation are taken by turn, nulls first (Spark's order), rows of one turn by role and the MD5 of the text.
ORDER = ("turn", "role", "mark")


def signs(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, mark, initial, fault): each row's first fault, without the texts.

    `fault` is blank, duplicate, truncated or null. Rows are dealt out by conversation once; the search for earlier
    equal rows and the later reading in order share that shuffle.
    """
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    narrow = rows_of(conversations).select(
        "conv_id", "turn", "role", "mark", F.substring("role", 1, 1).alias("initial"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut")).repartition("conv_id")
    earlier = Window.partitionBy("conv_id", "role", "mark").orderBy("turn")
    fault = (F.when(F.col("blank"), "blank").when(F.row_number().over(earlier) > 1, "duplicate")
             .when(F.col("cut"), "truncated"))
    return narrow.select("conv_id", "turn", "role", "mark", "initial", fault.alias("fault"))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
LEGAL = ("su", "ua", "au")


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a stream sorted by conversation and `ORDER`; of equal rows the duplicates come last."""
    key, state, out, held = (), None, [], 0

    def finished():
        seen, low, high, turns, blank, duplicate, truncated, illegal, _ = state
        gaps = high - low + 1 - turns if turns else 0
        return key[0], seen.decode()[::-1], gaps, blank, duplicate, truncated, illegal

    def table(rows):
        names = ("conv_id", "backward", *COUNTS)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(zip(*rows), [kind_of_key, pa.string(), *[pa.int64()] * 5])], names)

    kind_of_key = pa.int64()
    for batch in batches:
        kind_of_key = batch.schema.field("conv_id").type
        for conv, turn, initial, fault in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault")]):
            if key != (conv,):
                if key:
                    held += len(state[0]) + 64
                    out.append(finished())
                if held > HELD:
                    yield table(out)
                    out, held = [], 0
                key, state = (conv,), [bytearray(), None, None, 0, 0, 0, 0, 0, None]
            if turn is not None:
                if state[1] is None:
                    state[1] = turn
                state[3] += turn != state[2]  # nulls come first, then turns ascend
                state[2] = turn
            if state[8] is not None:
                state[7] += state[8] + initial not in LEGAL
            state[8] = initial
            if fault in ("blank", "duplicate"):
                state[4 if fault == "blank" else 5] += 1
                sign = GONE
            else:
                sign = initial if initial in ("s", "u", "a") else "o"
                if fault:
                    state[6] += 1
                    sign = sign.upper()
            state[0] += sign.encode()
    if key:
        out.append(finished())
    if out:
        yield table(out)


def signatures(conversations: DataFrame) -> DataFrame:
    """(conv_id, backward, gaps, blank, duplicate, truncated, illegal): `backward` is the signature from its end."""
    rows = signs(conversations)
    kind = rows.schema["conv_id"].dataType.simpleString()
    ordered = rows.sortWithinPartitions(
        "conv_id", *ORDER, F.col("fault").eqNullSafe("duplicate")).select("conv_id", "turn", "initial", "fault")
    return ordered.mapInArrow(_signatures, f"conv_id {kind}, backward string, " + ", ".join(f"{c} long" for c in COUNTS))


def _planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton, last, found = Automaton(), None, (0, "")

    def table(batch, begin, rows):
        part = batch.slice(begin, len(rows))
        costs, audits = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [*[part.column(c) for c in ("conv_id", *COUNTS)], pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            ["conv_id", *COUNTS, "cost", "audit"])

    for batch in batches:
        begin, rows, held = 0, [], 0
        for backward in batch.column("backward"):
            backward = backward.as_py()
            if backward != last:
                last, found = backward, automaton.read(backward)
            rows.append(found)
            held += len(found[1]) + 64
            if held > HELD:
                yield table(batch, begin, rows)
                begin, rows, held = begin + len(rows), [], 0
        if rows:
            yield table(batch, begin, rows)


def plans(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit): faults and cheapest edits per conversation.

    The audit is the initials of Keep, Rerole, Delete and Insert in order; of the cheapest the least in ASCII.
    """
    rows = signatures(conversations)
    kind = rows.schema["conv_id"].dataType.simpleString()
    dealt = rows.repartitionByRange("backward", "conv_id").sortWithinPartitions("backward")
    return dealt.mapInArrow(_planned, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in (*COUNTS, "cost")) + ", audit string")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their edit; in the stream each conversation's audit stands before its rows."""
    key, audit, at, state, seq, out, size = (), "", 0, START, 0, [], 0
    names = ("conv_id", "seq", "edit", "role", "text")
    kind = pa.int64()

    def emit(edit, role, text):
        nonlocal seq, size
        out.append((key[0], seq, edit, role, text))
        seq, size = seq + 1, size + len(text) + 64

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = NEXT[state], at + 1
            emit("I", NAMES[state], "")

    def table():
        kinds = (kind, pa.int64(), pa.string(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")]
        for conv, edits, role, text in zip(*columns):
            if edits is not None:
                inserted()  # what is still open at the end of the conversation before
                key, audit, at, state, seq = (conv,), edits, 0, START, 0
                continue
            inserted()
            edit, at = audit[at], at + 1
            if edit == "R":
                state = NEXT[state]
                role = NAMES[state]
            elif edit == "K":
                state = FOLLOWS[state, role[:1]]
            emit(edit, role, text)
            if size > HELD:
                yield table()
                out, size = [], 0
    inserted()
    if out:
        yield table()


EDITED = "seq long, edit string, role string, text string"


def edited(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, seq, edit, role, text): every row of each conversation in order with its edit, inserted rows too.

    `found` comes from `plans`. Rows with edit D are the deleted ones. A conversation's rows are contiguous and in
    order within one partition.
    """
    rows = rows_of(conversations)
    kind = rows.schema["conv_id"].dataType.simpleString()
    heads = found.select("conv_id", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"),
                         F.lit("").alias("text"), F.lit(None).cast("binary").alias("mark"), "audit")
    stream = heads.unionByName(rows.withColumn("audit", F.lit(None).cast("string")))
    ordered = stream.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *ORDER)
    return ordered.select("conv_id", "audit", "role", "text").mapInArrow(_edited, f"conv_id {kind}, {EDITED}")


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq, role, text) of the repaired conversations, whose roles follow (s?(ua)+)?.

    Rows are taken by turn (nulls first), rows of one turn by role and the MD5 of the text. A null role or text counts
    as one space, rows with a null conv_id are one conversation. A role counts by its first character; an empty role fits nowhere and is changed. Repeated rows
    are duplicates of the first and go; blank rows go. A conversation may come out empty. An empty table gives no
    rows. Other columns are not read.
    """
    found = stored(plans(conversations), "plans")
    return edited(conversations, found).where("edit <> 'D'").select("conv_id", "seq", "role", "text")


# -- the query ----------------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows changed by crc32 of `conv_id:turn` (a null is one space) modulo 20.

    0 drops the row, 1 empties its text, 2 removes the signs . ! ? of its text, 3 repeats it, 4 makes its role user.
    """
    rows = conversations.select(*[conversations[c] for c in ("conv_id", "turn", "role", "text")])
    hit = F.crc32(F.concat(_filled("conv_id"), F.lit(":"), _filled("turn")).cast("binary")) % 20
    rows = rows.withColumn("hit", hit).where("hit <> 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("hit") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the `role:text` lines of each conversation that kept a row, in one pass over the sorted rows."""
    key, state, out = (), None, []
    kind = pa.int64()
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv, edit, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "edit", "role", "text")]):
            if edit == "D":
                continue
            if key != (conv,):
                if key:
                    out.append((key[0], state.hexdigest()))
                key, state = (conv,), hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        if len(out) > 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (kind, pa.string()))], ["conv_id", "sha"])
            out = []
    if key:
        out.append((key[0], state.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (kind, pa.string()))], ["conv_id", "sha"])


def digest(conversations: DataFrame) -> DataFrame:
    """Faults, cost, audit and hash of the repaired text of every conversation, after `damaged`.

    A conversation without rows after the damage has zeros, an empty audit and the hash of the empty string, which
    also stands for one whose rows all went. Nulls, ties, repeated rows: see `repair`.
    """
    rows = damaged(conversations)
    found = stored(plans(rows), "plans")
    kind = found.schema["conv_id"].dataType.simpleString()
    hashes = edited(rows, found).mapInArrow(_hashes, f"conv_id {kind}, sha string").withColumnRenamed("conv_id", "hashed")
    every = conversations.select(conversations["conv_id"].alias("original")).distinct()
    out = (every.join(found, F.col("original").eqNullSafe(F.col("conv_id")), "left")
           .join(hashes, F.col("original").eqNullSafe(F.col("hashed")), "left"))
    zero = F.lit(0).cast("long")
    return out.select(F.col("original").alias("conv_id"), *[F.coalesce(c, zero).alias(c) for c in (*COUNTS, "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


#: The same in SQL: the checksum bit by bit, then one recursion from the last row of every conversation to its first,
#: which carries per grammar state the cost, the audit and the lines from there.
DIGEST_SQL = r"""
with recursive keyed as (
  select row_number() over () as r, coalesce(conv_id::text, ' ') as conv, turn, coalesce(role, ' ') as role,
         coalesce(text, ' ') as text, coalesce(conv_id::text, ' ') || ':' || coalesce(turn::text, ' ') as k
  from conversations),
hit as (
  select conv, turn, role, text, r, xor(list_reduce(
           list_prepend(4294967295::bigint, flatten(list_transform(string_split(k, ''), lambda x: [ascii(x)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
           lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))), 4294967295) % 20 as h
  from keyed),
d as (
  select conv, turn, r, copy, case h when 4 then 'user' else role end as role,
         case h when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from hit, lateral (select unnest(range(case h when 0 then 0 when 3 then 2 else 1 end))) copies(copy)),
spaced as (
  select *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as word, md5(text) as mark from d),
placed as (
  select *, row_number() over (partition by conv order by turn nulls first, role, mark, r, copy) as i,
         row_number() over (partition by conv, role, mark order by turn nulls first, r, copy) as seen from spaced),
f as (
  select conv, turn, role, text, i, left(role, 1) as initial, word = '' as blank, word <> '' and seen > 1 as again,
         word <> '' and seen = 1 and right(word, 1) not in ('.', '!', '?') as cut
  from placed),
counts as (
  select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
         count(*) filter (blank) as blank, count(*) filter (again) as duplicate, count(*) filter (cut) as truncated, max(i) as n
  from f group by conv),
pairs as (
  select conv, count(*) as illegal from (select conv, lag(initial) over (partition by conv order by i) || initial as p from f)
  where p is not null and p not in ('su', 'ua', 'au') group by conv),
walk(conv, i, b, s, u, a) as (
  select conv, n, {'c': 0::bigint, 'e': '', 'l': []::text[]}, {'c': 6::bigint, 'e': 'II', 'l': ['user:', 'assistant:']},
         {'c': 3::bigint, 'e': 'I', 'l': ['assistant:']}, {'c': 0::bigint, 'e': '', 'l': []::text[]}
  from counts
  union all
  select conv, i - 1,
         list_min([b0, {'c': 3 + u1.c, 'e': 'I' || u1.e, 'l': list_prepend('user:', u1.l)}]),
         list_min([s0, {'c': 3 + u1.c, 'e': 'I' || u1.e, 'l': list_prepend('user:', u1.l)}]),
         u1, list_min([a0, {'c': 3 + u0.c, 'e': 'I' || u0.e, 'l': list_prepend('user:', u0.l)}])
  from (
    select *, list_min([u0, {'c': 3 + a0.c, 'e': 'I' || a0.e, 'l': list_prepend('assistant:', a0.l)}]) as u1
    from (
      select w.conv, w.i,
        list_min(list_filter([{'c': 4 + b.c, 'e': 'D' || b.e, 'l': b.l},
          case when not gone then {'c': 3 + t + u.c, 'e': 'R' || u.e, 'l': list_prepend('user:' || text, u.l)} end,
          case when not gone and initial = 's' then {'c': t + s.c, 'e': 'K' || s.e, 'l': list_prepend(line, s.l)} end,
          case when not gone and initial = 'u' then {'c': t + u.c, 'e': 'K' || u.e, 'l': list_prepend(line, u.l)} end],
          lambda x: x is not null)) as b0,
        list_min(list_filter([{'c': 4 + s.c, 'e': 'D' || s.e, 'l': s.l},
          case when not gone then {'c': 3 + t + u.c, 'e': 'R' || u.e, 'l': list_prepend('user:' || text, u.l)} end,
          case when not gone and initial = 'u' then {'c': t + u.c, 'e': 'K' || u.e, 'l': list_prepend(line, u.l)} end],
          lambda x: x is not null)) as s0,
        list_min(list_filter([{'c': 4 + u.c, 'e': 'D' || u.e, 'l': u.l},
          case when not gone then {'c': 3 + t + a.c, 'e': 'R' || a.e, 'l': list_prepend('assistant:' || text, a.l)} end,
          case when not gone and initial = 'a' then {'c': t + a.c, 'e': 'K' || a.e, 'l': list_prepend(line, a.l)} end],
          lambda x: x is not null)) as u0,
        list_min(list_filter([{'c': 4 + a.c, 'e': 'D' || a.e, 'l': a.l},
          case when not gone then {'c': 3 + t + u.c, 'e': 'R' || u.e, 'l': list_prepend('user:' || text, u.l)} end,
          case when not gone and initial = 'u' then {'c': t + u.c, 'e': 'K' || u.e, 'l': list_prepend(line, u.l)} end],
          lambda x: x is not null)) as a0
      from walk w join (select *, blank or again as gone, case when cut then 3 else 0 end as t, role || ':' || text as line from f) f
        on f.conv = w.conv and f.i = w.i))),
done as (select conv, b from walk where i = 0)
select c.conv_id, coalesce(n.gaps, 0)::bigint as gaps, coalesce(n.blank, 0)::bigint as blank,
       coalesce(n.duplicate, 0)::bigint as duplicate, coalesce(n.truncated, 0)::bigint as truncated,
       coalesce(p.illegal, 0)::bigint as illegal, coalesce(w.b.c, 0)::bigint as cost, coalesce(w.b.e, '') as audit,
       sha256(coalesce(array_to_string(w.b.l, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join counts n on n.conv = coalesce(c.conv_id::text, ' ')
left join pairs p on p.conv = coalesce(c.conv_id::text, ' ')
left join done w on w.conv = coalesce(c.conv_id::text, ' ')
"""
