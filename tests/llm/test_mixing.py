"""Mixing sources: against brute force in Python and SQL."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

import oracle
from mainspool.llm import mixing
from mainspool.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _targets(sizes, weights=mixing.WEIGHTS, share=1.5, most=2.0):
    """Water filling, one source at a time."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, left = {}, share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        total = sum(weight[s] for s in rest)
        over = [s for s in rest if weight[s] * left >= most * sizes[s] * total]
        if not over:
            return full | {s: weight[s] * left / total for s in rest}
        for s in over:
            full[s] = most * sizes[s]
        left = share * sum(sizes.values()) - sum(full.values())


def _taken(rows, **how):
    """(id, source, size, target, taken) of every row."""
    by = defaultdict(list)
    for i, s, t in rows:
        z = len(_words(t))
        key = hashlib.md5(f"1:{'' if i is None else i}:{z}".encode()).hexdigest()
        by[s].append((key, i is not None, i or 0, z, i))
    goal = _targets({s: sum(r[3] for r in rs) for s, rs in by.items()}, **how)
    out = Counter()
    for s, rs in by.items():
        total, before = sum(r[3] for r in rs), 0
        for _, _, _, z, i in sorted(rs, key=lambda r: r[:4]):
            epochs, rest = divmod(int(goal[s]), total) if total else (0, 0)
            out[i, s, z, round(goal[s], 6), epochs * z + max(0, min(rest - before, z))] += 1
            before += z
    return out


def _rows(rng):
    rows = []
    for s, n, most in (("é", 60, 40), ("b", 400, 30), ("a", 5, 9), (None, 30, 12), ("", 3, 0), ("z", 1, 500), ("A", 90, 20)):
        rows += [(rng.randrange(10_000), s, " \t\n".join("w" * rng.randint(1, 4) for _ in range(rng.randint(0, most)))) for _ in range(n)]
    rows += [(7, "b", "the same row")] * 150 + [(None, "b", "no id")] * 40 + [(8, "b", None), (9, None, ""), (10, "a", "\x0b \x0c\r"), (11, "a", "a\xa0b c d")]
    rng.shuffle(rows)
    return rows


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(mixing, "ROWS", 7)
    monkeypatch.setattr(mixing, "FAN", 4)
    monkeypatch.setattr(mixing, "COPIES", 16)


@pytest.mark.parametrize("sent", [0, 20_000])
def test_mix_like_brute_force(spark, small_buckets, monkeypatch, sent):
    monkeypatch.setattr(mixing, "SENT", sent)
    rows = _rows(random.Random(4))
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    clash = df.selectExpr("*", "1 AS size", "'x' AS target", "2 AS taken", "3 AS rank")
    for how in ({}, {"weights": (1.0, 5.0), "share": 1.9, "most": 2.0}, {"share": 0.5}, {"share": 9.0, "most": 4.0}):
        got = mixing.mix(clash, **how).collect()
        assert Counter((r.doc_id, r.source, r["size"], round(r.target, 6), r.taken) for r in got) == _taken(rows, **how)
        assert all(r.taken <= how.get("most", 2.0) * r["size"] for r in got)
        for s in {r.source for r in got}:
            mine = [r for r in got if r.source == s]
            assert sum(r.taken for r in mine) == int(mine[0].target) if mine[0].source_size else all(r.taken == 0 for r in mine)


def test_mix_does_not_depend_on_partitions(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    one, many = (sorted(map(str, mixing.mix(d).collect())) for d in (df.coalesce(1), df.repartition(13)))
    assert one == many


def test_mix_like_sql(spark):
    con = oracle.connect(SF)
    assert oracle.difference(spark, con, QUERIES["op11_source_mix"], ORACLES["op11_source_mix"], SF) is None


def test_sql_with_odd_sources(spark, tmp_path):
    rows = [(i, s, "w " * n) for i, (s, n) in enumerate([("a", 0), ("b", 0), (None, 0), (None, 5), ("c", 900), ("d", 3), ("c", 4), ("e", 3)])] + [(99, "e", None), (None, "f", "x")]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert oracle.difference(spark, con, QUERIES["op11_source_mix"], ORACLES["op11_source_mix"], str(tmp_path)) is None


def test_drawn_texts_are_the_planned_words(spark, small_buckets):
    rows = _rows(random.Random(5))
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("epoch", mixing.F.lit("x"))
    for how in ({}, {"share": 0.4}, {"share": 3.0, "most": 5.0}):
        plan, drawn = mixing.mix(df, **how).collect(), mixing.draw(df, **how).collect()
        want, got = Counter(), Counter()
        for r in plan:
            want[r.doc_id, r.source] += r.taken
        for r in drawn:
            got[r.doc_id, r.source] += len(_words(r.text))
        assert got == +want
        texts = {(i, s, t) for i, s, t in rows}
        cut = [r for r in drawn if (r.doc_id, r.source, r.text) not in texts]
        assert all(any(i == r.doc_id and s == r.source and (t or "").startswith(r.text) for i, s, t in rows) for r in cut)
        assert len(cut) <= len({r.source for r in plan})
        for s in {r.source for r in plan if r.source_size}:
            epochs = Counter(r.epoch for r in drawn if r.source == s)
            assert sorted(epochs) == list(range(len(epochs)))


def test_mix_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mix(df).count() == 0 and mixing.draw(df).count() == 0
    none = spark.createDataFrame([(1, None, None), (None, None, " ")], "doc_id long, source string, text string")
    assert [(r["size"], r.target, r.taken) for r in mixing.mix(none).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.draw(none).count() == 0


def test_the_main_path_is_native(spark):
    plan = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
