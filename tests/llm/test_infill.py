"""Fill-in-the-middle: against brute force in Python and SQL, and back."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

import oracle
from mainspool.llm import infill
from mainspool.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ODD = ["", None, "a", "é", "🜚", "<P>", "x<M>y", "<S", "<", ">", "<P<S>", "a<P", "S>b", "<P\n>", "\x00\x00", "é ‍", "漢" * 50, " \t\n", "\r\n \x85"]


def _brute(i, text, seed=1):
    t = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(t), "plain", None, None, t
    if h[3] % 100 < 20:
        return len(t), "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    return len(t), "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"


@pytest.fixture(params=[None, 3, 64])
def stretch(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(infill, "STRETCH", request.param)
        monkeypatch.setattr(infill, "GROUP", 2 * request.param)


def test_like_brute_force_and_back(spark, stretch):
    rng = random.Random(2)
    texts = ODD * 8 + ["".join(rng.choice("ab <>PSM/é漢🜚\n") for _ in range(rng.randint(0, 900))) for _ in range(700)]
    rows = [(rng.choice([None, rng.randrange(10**6), -rng.randrange(99)]) if k % 9 == 0 else k, t) for k, t in enumerate(texts)] + [(5, texts[5]), (6, "again")] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS form", "2 AS __h1", "'kept' AS other")
    got = infill.restore(infill.transform(df)).collect()
    assert Counter((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == Counter((i, t, *_brute(i, t)) for i, t in rows)
    assert all(r.restored == (r.text or "") and r.other == "kept" for r in got)
    assert {"plain", "psm", "spm"} == {r.form for r in got}


def test_a_very_long_text(monkeypatch):
    monkeypatch.setattr(infill, "STRETCH", 1 << 12)
    monkeypatch.setattr(infill, "GROUP", 1 << 14)
    text = "".join(random.Random(1).choice("abc é漢🜚 \n") for _ in range(200_000))
    numbers = [pa.array([h] * 3) for h in (123_456, 7_777, 5, 90)]
    n, form, prefix, middle, output = infill.rearranged(pa.array(["short", text, None]), *numbers)
    a, b = sorted((123_456 % 200_001, 7_777 % 200_001))
    assert output[1].as_py() == f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"
    assert infill.restored(output, form)[0].to_pylist() == ["short", text, ""]
    assert form.to_pylist() == ["psm", "psm", "plain"] and n.to_pylist() == [5, 200_000, 0]


def test_slices_of_a_batch_are_cut_alike():
    texts = pa.array(["skipped", "on", None, "éa", "rest"])
    numbers = [pa.array([h] * 5) for h in (3, 1, 5, 90)]
    whole = infill.rearranged(texts, *numbers)
    part = infill.rearranged(texts.slice(2, 2), *(x.slice(2, 2) for x in numbers))
    assert [c.to_pylist()[2:4] for c in whole] == [c.to_pylist() for c in part]


def test_like_sql(spark):
    con = oracle.connect(SF)
    assert oracle.difference(spark, con, QUERIES["op12_infill"], ORACLES["op12_infill"], SF) is None


def test_sql_with_odd_texts(spark, tmp_path):
    rows = [(k if k % 7 else None, t) for k, t in enumerate(ODD * 6) if "\x00" not in (t or "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert oracle.difference(spark, con, QUERIES["op12_infill"], ORACLES["op12_infill"], str(tmp_path)) is None


def test_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert infill.restore(infill.transform(df)).count() == 0
