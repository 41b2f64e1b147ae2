"""Conversation repair: against exhaustive search and SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

import oracle
from mainspool.llm import dialogue
from mainspool.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
DDL = "conv_id long, turn long, role string, text string"


def _told(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def _damaged(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        n = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if n == 0:
            continue
        if n == 1:
            x = ""
        if n == 2:
            x = re.sub("[.!?]", "", x)
        out += [(c, t, "user" if n == 4 else r, x)] * (2 if n == 3 else 1)
    return out


def _cheapest(rows):
    """Every way to edit, cheapest first, then by audit; rows: (initial, fault)."""
    best = None
    todo = [(0, 0, "", "E", 0)]
    while todo:
        i, cost, audit, state, inserted = todo.pop()
        if best is not None and cost > best[0]:
            continue
        if i == len(rows) and state in "EA":
            best = min(best or (cost, audit), (cost, audit))
        if inserted < 2:
            todo += [(i, cost + 5, audit + "I", s, inserted + 1) for r in "ua" if (s := dialogue.STEP[state].get(r))]
        if i < len(rows):
            initial, fault = rows[i]
            todo.append((i + 1, cost + 2, audit + "D", state, 0))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if s := dialogue.STEP[state].get(initial):
                    todo.append((i + 1, cost + more, audit + "K", s, 0))
                todo += [(i + 1, cost + more + 1, audit + "R", s, 0) for r in "ua" if (s := dialogue.STEP[state].get(r))]
    return best


def _brute(all_rows, damaged):
    by = defaultdict(list)
    for c, t, r, x in damaged:
        by[c].append((t is not None, t, _told(r, x), r, x))
    out = {}
    for c in {row[0] for row in all_rows}:
        rows, seen, faults = sorted(by[c], key=lambda r: (r[0], r[1] or 0, r[2])), set(), []
        for _, _, _, r, x in rows:
            body = x.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((r, x))
        turns = [t for known, t, *_ in rows if known]
        cost, audit = _cheapest([(r[3][:1], f) for r, f in zip(rows, faults)])
        told, left, state = [], iter(rows), "E"
        for e in audit:
            _, _, _, r, x = (None, None, None, None, "") if e == "I" else next(left)
            if e == "D":
                continue
            role = r if e == "K" else ("assistant" if state == "U" else "user")
            state = dialogue.STEP[state][role[0]]
            told.append(f"{role}:{x}")
        pairs = [a[3][:1] + b[3][:1] for a, b in zip(rows, rows[1:])]
        out[c] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(told).encode()).hexdigest(),
        )
    return out


def _conversations(rng, n, longest):
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "system", "tool", "", None, "u", "User"])
            text = rng.choice(["Yes.", "No!", "Why?", "cut off", "", " \t", None, "same.", f"word {t}.", f"word {t}.\n \x0b", "end. ", "é。", f"n {t} . x"])
            turn = rng.choice([t, t, t, t, None, t // 2, t + 5, -t])
            rows += [(None if c == 3 else c, turn, role, text)] * rng.choice([1, 1, 1, 2])
    return rows


def _results(df):
    return {r.conv_id: tuple(r[1:]) for r in df.collect()}


@pytest.mark.parametrize("stretch, parts", [(None, None), (1, "1"), (2, "5"), (3, "40")])
def test_like_exhaustive_search(spark, stretch, parts):
    rows = _conversations(random.Random(7), 120, 7)
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "1 AS place", "2 AS piece", "'x' AS digest", "3 AS conv")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    if parts:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
        assert _results(dialogue.repair(df, stretch=stretch)) == _brute(rows, clean)
        assert _results(dialogue.repair(dialogue.damage(df), dropped="dropped", stretch=stretch)) == _brute(rows, _damaged(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_like_sql(spark):
    con = oracle.connect(SF)
    name = "op13_conversation_repair"
    assert oracle.difference(spark, con, QUERIES[name], ORACLES[name], SF) is None


def test_sql_with_odd_rows(spark, tmp_path):
    rows = _conversations(random.Random(8), 200, 9) + [(900 + k, k, "user", None) for k in range(40)]
    spark.createDataFrame(rows, DDL).write.parquet(f"{tmp_path}/conversations.parquet")
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    name = "op13_conversation_repair"
    assert oracle.difference(spark, con, QUERIES[name], ORACLES[name], str(tmp_path)) is None


def _plain_edits(rows, entry):
    """The same program on whole strings."""
    best = {entry: (0, "")}

    def offer(found, state, cost, audit):
        if state:
            found[state] = min(found.get(state, (cost, audit)), (cost, audit))

    def inserted():
        for _ in range(3):
            for s, (c, a) in list(best.items()):
                for r in "ua":
                    offer(best, dialogue.STEP[s].get(r), c + 5, a + "I")

    inserted()
    for initial, fault in rows:
        found = {}
        for s, (c, a) in best.items():
            offer(found, s, c + 2, a + "D")
            if fault not in (dialogue.BLANK, dialogue.DUPLICATE):
                more = 5 * (fault == dialogue.TRUNCATED)
                offer(found, dialogue.STEP[s].get(initial), c + more, a + "K")
                for r in "ua":
                    offer(found, dialogue.STEP[s].get(r), c + more + 1, a + "R")
        best = found
        inserted()
    return best


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 1, 3])
def test_ties_by_longest_common_prefix_with_colliding_hashes(monkeypatch, modulus):
    monkeypatch.setattr(dialogue, "_MODULUS", modulus)
    rng = random.Random(3)
    for n in (0, 1, 5, 60, 300):
        for _ in range(6):
            rows = [(rng.choice("uuaast"), rng.choice([0, 0, 1, 2, 3, 3])) for _ in range(n)]
            for entry in dialogue.STATES:
                assert dialogue.edits(rows, entry) == _plain_edits(rows, entry)


def test_prefixes_are_ordered_like_strings(monkeypatch):
    for modulus in ((1 << 61) - 1, 2):
        monkeypatch.setattr(dialogue, "_MODULUS", modulus)
        rng, p = random.Random(4), dialogue.Prefixes()
        nodes = [0]
        for _ in range(400):
            nodes.append(p.add(rng.choice(nodes[-40:]), rng.choice("DIKR")))
        for _ in range(3000):
            x, y = rng.choice(nodes), rng.choice(nodes)
            assert p.less(x, y) == (p.string(x) < p.string(y))


def test_one_long_conversation_over_many_partitions(spark):
    rng = random.Random(6)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice([f"t {t}.", "again.", "cut"])) for t in range(3000)] + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    df = spark.createDataFrame(rows, DDL).repartition(9)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        many = _results(dialogue.repair(df, stretch=50))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert many == _results(dialogue.repair(df.coalesce(1), stretch=10_000))
    assert many[2][5:7] == (0, "KK")
    faults, seen = [], set()
    for _, _, r, x in rows[:3000]:
        faults.append((r[0], dialogue.DUPLICATE if (r, x) in seen else dialogue.TRUNCATED if x == "cut" else dialogue.FINE))
        seen.add((r, x))
    assert many[1][5:7] == min(v for s, v in _plain_edits(faults, "E").items() if s in "EA")


def test_repaired_rows_are_what_is_hashed(spark):
    df = spark.createDataFrame(_conversations(random.Random(9), 60, 6), DDL)
    hashes = {c: v[7] for c, v in _results(dialogue.repair(df)).items()}
    rows = defaultdict(list)
    for r in dialogue.repaired(df).collect():
        rows[r.conv_id].append((r.position, f"{r.role}:{r.text}"))
    for c, h in hashes.items():
        told = sorted(rows[c])
        assert [p for p, _ in told] == list(range(len(told)))
        assert hashlib.sha256("\n".join(t for _, t in told).encode()).hexdigest() == h


def test_nothing_left_and_nothing(spark):
    empty = spark.createDataFrame([], DDL)
    assert dialogue.repair(empty).count() == 0 and dialogue.repaired(empty).count() == 0
    gone = spark.createDataFrame([(5, 1, "user", "a.", True), (None, None, None, None, True)], DDL + ", dropped boolean")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert _results(dialogue.repair(gone, dropped="dropped")) == {5: nothing, None: nothing}
