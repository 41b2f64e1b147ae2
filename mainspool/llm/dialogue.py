"""Repair the structure of conversations at the least cost, with an audit of the edits.

A conversation's rows go by turn (null turns first, ties by a digest of role and text). A row's
first fault is ``blank`` (no text but blanks), ``duplicate`` (an earlier row of the conversation
has its role and text) or ``truncated`` (its text does not end a sentence). Role initials must read
``(s?(ua)+)?``. Edits are K keep (0), R give the role that is due, user or assistant (1), D delete (2; blank and
duplicate rows must go) and I insert an empty row (5); a truncated row that stays costs 5 more.
The audit is the string of the cheapest edits, of several the first in ASCII order.

1. Rows without their texts (a digest, an initial, flags) are put in order by a range
   partitioning of conversation, turn and digest, so that a conversation of very many rows
   lies in many partitions, and each partition walks its rows in stretches of ``STRETCH`` at most.
2. A stretch runs the audit's dynamic program over the four states of the grammar. Edit prefixes
   are nodes linked to the prefix one edit shorter (:class:`Prefixes`), with ancestors at powers of two
   and rolling hashes: a tie in cost compares two prefixes by a search for their longest common
   part; hashes that agree are verified. Of two prefixes at one place, state and cost neither starts the
   other, since it would lack inserts and cost less; so the lesser one stays the lesser whatever follows.
   A stretch that may have neighbours does this from every state, which makes it a small matrix.
3. Texts are dealt by conversation and sorted behind its stretches. A walk composes the stretches,
   then applies the edits to the texts as they stream by, and hashes them.

Step 3 holds one text, and a conversation's audit, at a time; a conversation's hash is by
its definition one chain over its texts, so that walk cannot be split; steps 1 and 2 are.

Null roles and texts count as one space, and null conversations are one conversation. Roles
whose initial the grammar lacks, and empty ones, can only be changed or deleted. Repeated rows are
duplicates. Columns other than the four are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mainspool.llm.common import SLICE, materialise

#: Blanks, sentence ends, and the pairs of initials that may follow each other.
BLANKS, ENDS, PAIRS = " \t\n\x0b\x0c\r", ".!?", ("su", "ua", "au")

#: The grammar: empty, after s, after u, after a; complete in E and A.
STEP = {"E": {"s": "S", "u": "U"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}
STATES, COMPLETE = "ESUA", "EA"
DUE = {"E": "user", "S": "user", "U": "assistant", "A": "user"}

#: What edits cost, and the faults of a row.
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
FINE, BLANK, DUPLICATE, TRUNCATED, DROPPED = range(5)

#: Rows of a stretch at most.
STRETCH = 1 << 14

_BASE, _MODULUS = 0x2545F4914F6CDD1D, (1 << 61) - 1


class Prefixes:
    """Strings of edits as nodes that share their beginnings; node 0 is the empty string."""

    def __init__(self):
        self.up: list[tuple[int, ...]] = [()]
        self.depth, self.hash, self.edit = [0], [0], [""]

    def add(self, parent: int, edit: str) -> int:
        ups = [parent]
        while len(self.up[ups[-1]]) >= len(ups):
            ups.append(self.up[ups[-1]][len(ups) - 1])
        self.up.append(tuple(ups))
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(edit)) % _MODULUS)
        self.edit.append(edit)
        return len(self.edit) - 1

    def string(self, node: int) -> str:
        out = []
        while node:
            out.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth hold one string; equal hashes are verified."""
        if a != b and self.hash[a] != self.hash[b]:
            return False
        while a != b:  # where the beginnings are shared, this ends at once
            if self.edit[a] != self.edit[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def cut(self, node: int, depth: int) -> int:
        """The ancestor at a depth."""
        while self.depth[node] > depth:
            k = min((self.depth[node] - depth).bit_length(), len(self.up[node])) - 1
            node = self.up[node][k]
        return node

    def less(self, x: int, y: int) -> bool:
        """Whether one string comes before another, by the longest part they share."""
        shorter = min(self.depth[x], self.depth[y])
        a, b = self.cut(x, shorter), self.cut(y, shorter)
        if self.same(a, b):
            return self.depth[x] < self.depth[y]
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and not self.same(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return self.edit[a] < self.edit[b]


def edits(rows: list[tuple[str, int]], entry: str) -> dict[str, tuple[int, str]]:
    """From the state ``entry``, over rows of (initial, fault): the cheapest cost and its first audit
    for each state reached."""
    prefixes = Prefixes()
    best: dict[str, tuple[int, int]] = {entry: (0, 0)}

    def offer(found: dict, state: str | None, cost: int, parent: int, edit: str) -> bool:
        if state is None or state in found and found[state][0] < cost:
            return False
        node = prefixes.add(parent, edit)
        if state in found and found[state][0] == cost and not prefixes.less(node, found[state][1]):
            return False
        found[state] = (cost, node)
        return True

    def inserted() -> None:
        again = True
        while again:
            again = False
            for state, (cost, node) in list(best.items()):
                for initial in "ua":
                    again |= offer(best, STEP[state].get(initial), cost + INSERT, node, "I")

    inserted()
    for initial, fault in rows:
        if fault == DROPPED:
            continue
        found: dict[str, tuple[int, int]] = {}
        more = CUT if fault == TRUNCATED else 0
        for state, (cost, node) in best.items():
            if fault not in (BLANK, DUPLICATE):
                offer(found, STEP[state].get(initial), cost + more, node, "K")
                for given in "ua":
                    if given != initial:
                        offer(found, STEP[state].get(given), cost + more + REROLE, node, "R")
            offer(found, state, cost + DELETE, node, "D")
        best = found
        inserted()
    return {state: (cost, prefixes.string(node)) for state, (cost, node) in best.items()}


_LONG, _TEXT = (T.LongType(), pa.int64()), (T.StringType(), pa.string())
_LONGS, _TEXTS = ((T.ArrayType(t), pa.list_(a)) for t, a in (_LONG, _TEXT))
_PIECE_FIELDS = {
    **dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), _LONG),
    **dict.fromkeys(("first", "last"), _TEXT),
    **dict.fromkeys(("low", "high", "turns"), _LONG),
    **dict.fromkeys(("entries", "exits"), _TEXTS),
    "costs": _LONGS,
    "audits": _TEXTS,
}
_DIGEST = {**dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), _LONG), "audit": _TEXT, "repaired_sha256": _TEXT}
_ROWS = {"position": _LONG, **dict.fromkeys(("edit", "role", "text"), _TEXT)}


def _struct(fields: dict) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, (t, _) in fields.items()])


_PIECE = _struct(_PIECE_FIELDS)
_PIECE_ARROW = pa.struct([(n, a) for n, (_, a) in _PIECE_FIELDS.items()])


def _piece(rows: list[tuple[str, int, int | None]], alone: bool) -> dict:
    """What a stretch of rows (initial, fault, turn) adds to its conversation."""
    held = [(i, f, t) for i, f, t in rows if f != DROPPED]
    turns = [t for _, _, t in held if t is not None]
    faults = [f for _, f, _ in held]
    table = [(entry, exit_, cost, audit) for entry in ("E" if alone else STATES) for exit_, (cost, audit) in edits([r[:2] for r in held], entry).items()]
    entries, exits, costs, audits = map(list, zip(*table))
    return {
        "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(TRUNCATED),
        "illegal": sum(a[0] + b[0] not in PAIRS for a, b in zip(held, held[1:])),
        "first": held[0][0] if held else None,
        "last": held[-1][0] if held else None,
        "low": min(turns, default=None),
        "high": max(turns, default=None),
        "turns": len(set(turns)),
        "entries": entries,
        "exits": exits,
        "costs": costs,
        "audits": audits,
    }


def _walk_features(stretch: int):
    """Stretches of the rows of a sorted partition, as (conversation, place, piece)."""

    def run(batches):
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        conv, rows, joined = None, [], True
        out: list[tuple] = []
        kind = None

        def close(alone: bool) -> None:
            nonlocal seq
            out.append((conv, (part << 32) + seq, _piece(rows, alone)))
            seq += 1

        def flushed() -> pa.RecordBatch:
            convs, places, pieces = zip(*out)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(places, pa.int64()), pa.array(pieces, _PIECE_ARROW)], names=["conv", "place", "piece"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for c, turn, initial, fault in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if rows and (c != conv or len(rows) == stretch):
                    # only a stretch with other conversations on both sides is sure to be whole
                    close(alone=c != conv and not joined)
                    joined = c == conv
                    rows = []
                conv = c
                rows.append((initial, fault, turn))
            if len(out) >= SLICE:
                yield flushed()
        if rows:
            close(alone=False)
        if out:
            yield flushed()

    return run


class _Repair:
    """One conversation as its stretches, then its rows, come by."""

    def __init__(self):
        self.totals = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.best: dict[str, tuple[int, str]] = {"E": (0, "")}
        self.last = self.low = self.high = None
        self.turns = 0
        self.audit: str | None = None
        self.cost = 0
        self.at, self.state, self.position = 0, "E", 0

    def add(self, piece: dict) -> None:
        for name in self.totals:
            self.totals[name] += piece[name]
        if piece["first"] is not None:
            if self.last is not None:
                self.totals["illegal"] += self.last + piece["first"] not in PAIRS
            self.last = piece["last"]
        if piece["low"] is not None:
            self.turns += piece["turns"] - (piece["low"] == self.high)
            self.low = piece["low"] if self.low is None else self.low
            self.high = piece["high"]
        reached: dict[str, tuple[int, str]] = {}
        for entry, exit_, cost, audit in zip(piece["entries"], piece["exits"], piece["costs"], piece["audits"]):
            if entry in self.best:
                before, start = self.best[entry]
                if exit_ not in reached or before + cost <= reached[exit_][0]:
                    whole = (before + cost, start + audit)
                    reached[exit_] = min(whole, reached.get(exit_, whole))
        self.best = reached

    def settle(self) -> None:
        self.cost, self.audit = min(self.best[s] for s in COMPLETE if s in self.best)

    def row(self, role: str | None, text: str | None):
        """Rows that come out up to an input row, and at the end (``role`` None) the inserts left."""
        if self.audit is None:
            self.settle()
        while self.at < len(self.audit):
            edit = self.audit[self.at]
            if edit != "I" and role is None:
                raise ValueError("the audit names more rows than there are")
            self.at += 1
            if edit == "I":
                yield self.out(edit, DUE[self.state], "")
                continue
            if edit != "D":
                yield self.out(edit, role if edit == "K" else DUE[self.state], text)
            return

    def out(self, edit: str, role: str, text: str) -> tuple[int, str, str, str]:
        self.state = STEP[self.state][role[0]]
        self.position += 1
        return self.position - 1, edit, role, text

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _walk_texts(digest: bool):
    """Per conversation its digest, or the rows of the repaired one; rows come sorted."""

    def run(batches):
        conv, repair, chain, kind = None, None, None, None
        out: list[tuple] = []
        fields = _DIGEST if digest else _ROWS

        def put(rows) -> None:
            for position, edit, role, text in rows:
                if digest:
                    chain.update((b"\n" if position else b"") + role.encode() + b":")
                    chain.update(text.encode())
                else:
                    out.append((conv, position, edit, role, text))

        def close() -> None:
            put(repair.row(None, None))
            if digest:
                found = {**repair.totals, "gaps": repair.gaps(), "cost": repair.cost}
                found |= {"audit": repair.audit, "repaired_sha256": chain.hexdigest()}
                out.append((conv, *(found[n] for n in fields)))

        def flushed() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), [kind, *(a for _, a in fields.values())])]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["conv", *fields])

        for batch in batches:
            kind = batch.schema.field(0).type
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                for c, piece, role, text in zip(*(part.column(i).to_pylist() for i in range(4))):
                    if repair is None or c != conv:
                        if repair is not None:
                            close()
                        conv, repair, chain = c, _Repair(), hashlib.sha256()
                    if piece is not None:
                        repair.add(piece)
                    else:
                        put(repair.row(role, text))
                if out:
                    yield flushed()
        if repair is not None:
            close()
        if out:
            yield flushed()

    return run


def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str, dropped: str | None) -> DataFrame:
    """Rows with their names and nulls settled, the digest they are told apart by, and whether they are dropped."""
    space = F.lit(" ")
    named = rows.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), space).alias("role"),
        F.coalesce(F.col(f"`{text}`"), space).alias("text"),
        (F.col(f"`{dropped}`") if dropped else F.lit(False)).alias("dropped"),
    )
    told = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    return named.withColumn("digest", told)


def _fault() -> Column:
    """A row's fault by its text alone."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    ended = F.substring(trimmed, -1, 1).isin(*ENDS)
    return F.when(F.col("dropped"), DROPPED).when(trimmed == "", BLANK).when(~ended, TRUNCATED).otherwise(FINE).cast("int")


def _ordered_pieces(prepared: DataFrame, stretch: int) -> DataFrame:
    """Steps 1 and 2: (conv, place, piece) of every stretch."""
    features = prepared.select("conv", "turn", "digest", F.substring("role", 1, 1).alias("initial"), _fault().alias("fault"), F.monotonically_increasing_id().alias("spread"))
    features = materialise(features)  # also fixes ``spread``, which parts rows equal in all else
    place = F.struct("turn", "spread")
    present = features.where(F.col("fault") != DROPPED)
    repeated = present.groupBy(F.col("conv").alias("__c"), F.col("digest").alias("__d")).agg(F.min(place).alias("__first"), F.count("*").alias("__n")).where("__n > 1")
    marked = features.join(repeated, F.col("conv").eqNullSafe(F.col("__c")) & (F.col("digest") == F.col("__d")), "left")
    later = F.col("__n").isNotNull() & ~place.eqNullSafe(F.col("__first")) & F.col("fault").isin(FINE, TRUNCATED)
    marked = marked.withColumn("fault", F.when(later, DUPLICATE).otherwise(F.col("fault")).cast("int"))
    order = ["conv", "turn", "digest", "spread"]
    ordered = marked.select(*order, "initial", "fault").repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([T.StructField("conv", prepared.schema["conv"].dataType), T.StructField("place", T.LongType()), T.StructField("piece", _PIECE)])
    return ordered.select("conv", "turn", "initial", "fault").mapInArrow(_walk_features(stretch), schema)


def _walked(rows: DataFrame, digest: bool, conv: str, turn: str, role: str, text: str, dropped: str | None, stretch: int | None) -> DataFrame:
    prepared = _prepared(rows, conv, turn, role, text, dropped)
    pieces = _ordered_pieces(prepared, stretch or STRETCH)
    none = F.lit(None)
    heads = pieces.select("conv", "place", "piece", none.cast("bigint").alias("turn"), none.cast("binary").alias("digest"), none.cast("string").alias("role"), none.cast("string").alias("text"))
    texts = prepared.where(~F.col("dropped")).select("conv", F.lit(1 << 62).alias("place"), none.cast(_PIECE).alias("piece"), "turn", "digest", "role", "text")
    dealt = heads.unionAll(texts).repartition("conv").sortWithinPartitions("conv", "place", "turn", "digest")
    added = _struct(_DIGEST if digest else _ROWS).fields
    schema = T.StructType([T.StructField("conv", prepared.schema["conv"].dataType), *added])
    return dealt.select("conv", "piece", "role", "text").mapInArrow(_walk_texts(digest), schema).withColumnRenamed("conv", conv)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", dropped: str | None = None, stretch: int | None = None) -> DataFrame:
    """One row per conversation: its faults, ``cost``, ``audit`` and the hash of the repaired rows.

    Rows whose column ``dropped`` is true are not there; they only name their conversation.
    """
    return _walked(rows, True, conv, turn, role, text, dropped, stretch)


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", dropped: str | None = None, stretch: int | None = None) -> DataFrame:
    """The rows of the repaired conversations: ``position`` from 0, ``edit`` (K, R or I), ``role``, ``text``."""
    return _walked(rows, False, conv, turn, role, text, dropped, stretch)


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of conversation and turn; ``dropped`` marks
    rows taken out. Nulls are one space."""
    space = F.lit(" ")
    number = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    drawn = rows.withColumn("__n", number)
    copies = F.explode(F.when(F.col("__n") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return drawn.select(
        "conv_id",
        "turn",
        F.when(F.col("__n") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("__n") == 1, "").when(F.col("__n") == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        (F.col("__n") == 0).alias("dropped"),
        copies.alias("__copy"),
    ).drop("__copy")


def oracle() -> str:
    """:func:`repair` of :func:`damage` over ``conversations`` in SQL: a recursion over the rows of each
    conversation holds the best cost and audit of each state."""
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    byte = f"list_transform(string_split({key}, ''), lambda c: CAST(ord(c) AS BIGINT))"
    bits = "list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {byte}), lambda s, b: {bits}), 4294967295)"
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)

    def go(state: str, cost: str, edit: str) -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}'}}"

    far = "{'c': 1000000000, 'a': ''}"

    def taken(state: str, initial: str) -> str:
        return f"CASE WHEN fault IN ({BLANK}, {DUPLICATE}) THEN {far} WHEN initial = '{initial}' THEN {go(state, 'more', 'K')} ELSE {go(state, f'more + {REROLE}', 'R')} END"

    system = f"CASE WHEN fault NOT IN ({BLANK}, {DUPLICATE}) AND initial = 's' THEN {go('e', 'more', 'K')} ELSE {far} END"
    return f"""
WITH RECURSIVE drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS d FROM conversations
), damaged AS (
  SELECT conv_id, turn, copy, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '{ENDS}', '') ELSE text END AS text
  FROM drawn, unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS t(copy)
), told AS (
  SELECT *, md5(length(role) || ':' || role || text) AS digest, rtrim(text, {blanks}) AS body, substr(role, 1, 1) AS initial FROM damaged
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest, copy) AS i FROM told
), placed AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS earlier, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM ordered
), faulty AS (
  SELECT *, CASE WHEN body = '' THEN {BLANK} WHEN nth > 1 THEN {DUPLICATE} WHEN right(body, 1) NOT IN ('.', '!', '?') THEN {TRUNCATED} ELSE {FINE} END AS fault,
    CASE WHEN right(body, 1) NOT IN ('.', '!', '?') THEN {CUT} ELSE 0 END AS more FROM placed
), walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': ''}} AS e, {far} AS s, {{'c': {INSERT}, 'a': 'I'}} AS u, {{'c': {2 * INSERT}, 'a': 'II'}} AS a FROM conversations
  UNION ALL
  SELECT conv_id, i, e, s, u, list_min([a, {go('u', str(INSERT), 'I')}]) FROM (
    SELECT conv_id, i, e, s, list_min([u, {go('e', str(INSERT), 'I')}, {go('s', str(INSERT), 'I')}, {go('a', str(INSERT), 'I')}]) AS u, a FROM (
      SELECT w.conv_id, f.i, {go('e', str(DELETE), 'D')} AS e, list_min([{go('s', str(DELETE), 'D')}, {system}]) AS s,
        list_min([{go('u', str(DELETE), 'D')}, {taken('e', 'u')}, {taken('s', 'u')}, {taken('a', 'u')}]) AS u,
        list_min([{go('a', str(DELETE), 'D')}, {taken('u', 'a')}]) AS a
      FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1))
), settled AS (
  SELECT conv_id, list_min([e, a]) AS best FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM walk) WHERE back = 1
), edits AS (
  SELECT conv_id, p, substr(best.a, p, 1) AS edit, length(replace(substr(best.a, 1, p), 'I', '')) AS i, length(replace(substr(best.a, 1, p), 'D', '')) AS stays
  FROM settled, unnest(range(1, length(best.a) + 1)) AS t(p)
), opened AS (
  SELECT d.*, f.role, f.initial, f.text, coalesce(max(CASE WHEN stays = 1 AND edit = 'K' AND f.initial = 's' THEN 1 END) OVER (PARTITION BY d.conv_id), 0) AS led
  FROM edits d LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.i = d.i AND d.edit <> 'I'
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (stays - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS whole
  FROM opened WHERE edit <> 'D' GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = {BLANK}) AS blank, count(*) FILTER (fault = {DUPLICATE}) AS duplicate,
    count(*) FILTER (fault = {TRUNCATED}) AS truncated, count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id
)
SELECT s.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM settled s LEFT JOIN counts c ON s.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts t ON s.conv_id IS NOT DISTINCT FROM t.conv_id"""
