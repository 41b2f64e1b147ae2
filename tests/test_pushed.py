"""What scans leave out: the rules' result stays, and dropped records and unread columns make no rows."""

import random
import re

import numpy as np
import pytest

from mainspool.layout import Layout
from mainspool.operators import rules
from mainspool.plans import jobs
from mainspool.sources import fixed, pushed
from mainspool.sources.fixed import read_fb
from mainspool.sources.variable import read_vb

LAYOUT = Layout.parse(
    """
          05 KIND PIC X(3).
          05 N PIC S9(4) COMP.
          05 U PIC 9(4) COMP.
          05 P PIC S9(3) COMP-3.
          05 Z PIC 9(2).
          05 HELD PIC 9(4) COMP.
          05 MANY OCCURS 0 TO 2 DEPENDING ON HELD.
             10 M PIC X.
          05 BEHIND PIC X.
          05 SCALED PIC S9(2)V9 COMP-3.
"""
)


def _records(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        kind = rng.choice(["a  ", " A ", "ab ", "B\x05 ", "\x00é ", "É", "   ", "ß1 "]).ljust(3)[:3].encode("cp037")
        number = rng.choice([0, 1, -1, 12, -32768, 32767]).to_bytes(2, "big", signed=True)
        packed = rng.choice(["012c", "012d", "012f", "000d", "0a2c", "0123", "999b", "012a"])
        rec = kind + number + rng.choice([0, 1, 65535]).to_bytes(2, "big") + bytes.fromhex(packed) + rng.choice(["01", "  ", "1 "]).encode("cp037")
        rec += (0).to_bytes(2, "big") + "x".encode("cp037") + bytes.fromhex("123c")
        out.append(rec[: rng.choice([len(rec)] * 5 + [0, 2, 4, 9, 10])] + bytes(rng.choice([0, 0, 0, 3])))
    return out


@pytest.fixture
def files(record_file):
    """Records in two files, variable and fixed."""
    records = _records(1, 400)
    framed = [(len(r) + 4).to_bytes(2, "big") + b"\0\0" + r for r in records]
    record_file(b"".join(framed[:250]), "vb/one")
    path = record_file(b"".join(framed[250:]), "vb/two").rsplit("/", 1)[0]
    whole = [r for r in records if len(r) >= 10]
    return path, record_file(b"".join(r[:10] for r in whole) + b"\x81\x40\x40\x00", "fb/one")


RULES = [
    {"include": "KIND=a"},
    {"include": "KIND=A:KIND=b:KIND=é"},
    {"include": "KIND=,N=1:KIND=a,N=12:P=12"},
    {"include": "KIND=a,P=-12", "strict": True},
    {"include": "KIND=a1,N=2"},
    {"exclude": "KIND=a:N=-1"},
    {"include": "KIND=a:Z=1", "exclude": "U=65535"},
    {"include": "P=0:P=-999", "record_length": 17},
    {"record_length": 4},
    {"include": "N=-32768", "exclude": "BEHIND=x:SCALED=12.3"},
    {"exclude": "KIND=a,Z=1:M (0)=x", "strict": True},
    {"include": "KIND=nothing"},
]


@pytest.mark.parametrize("bound", [4096, 2])
def test_scans_give_what_rules_keep(spark, files, monkeypatch, bound):
    monkeypatch.setattr(pushed, "DISTINCT", bound)
    for path, kind in zip(files, ("MFVB", "MFFB")):
        whole = (read_vb(spark, path) if kind == "MFVB" else read_fb(spark, path, 10)).cache()
        for how in RULES:
            want = sorted(map(str, rules.select_records(whole, LAYOUT, **how).collect()))
            got = jobs.scan(spark, path, kind, layout=LAYOUT, record_len=10, **how)
            assert sorted(map(str, got.collect())) == want, how
        whole.unpersist()


def test_dropped_records_make_no_rows(spark, files):
    path, _ = files
    for how, exact in ((RULES[0], True), (RULES[1], True), (RULES[2], True), (RULES[3], True), (RULES[7], True), (RULES[6], False), (RULES[9], False)):
        where = rules.raw_filter(LAYOUT, **how)
        scanned = read_vb(spark, path, where=where).count()
        kept = rules.select_records(read_vb(spark, path), LAYOUT, **how).count()
        assert scanned == kept if exact else kept <= scanned < 400
    assert rules.raw_filter(LAYOUT, include="Z=1") is None  # zoned numbers have too many forms
    assert rules.raw_filter(LAYOUT, exclude="BEHIND=x") is None  # behind a group of varying length
    assert rules.raw_filter(LAYOUT) is None


def test_unread_columns_are_not_carried(spark, files):
    path, flat = files
    for frame in (read_vb(spark, path, columns=("rec_len",)), read_fb(spark, flat, 10, columns=("rec_len",))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        made = re.search(r"MapInArrow read\(.*?\)#\d+, \[([^\]]*)\]", plan)[1]
        assert re.findall(r"[a-z_]+(?=#)", made) == ["rec_len", "error"]
        assert frame.columns == ["rec_len"]
    # a few files' paths are looked up by number, and only if someone reads them
    plan = read_fb(spark, flat, 10).select("rec_no")._jdf.queryExecution().optimizedPlan().toString()
    assert "element_at" not in plan and "file#" not in plan.split("MapInArrow")[0]
    with pytest.raises(ValueError, match="not \\['nothing'\\]"):
        read_vb(spark, path, columns=("nothing",))
    assert jobs.scan(spark, path, include="KIND=a", layout=LAYOUT, columns=("rec_no",)).columns == ["rec_no"]


def test_few_and_many_ranges_and_files(spark, files, monkeypatch):
    path, flat = files
    few = [read_vb(spark, path, chunk_bytes=300), read_fb(spark, flat, 10, chunk_bytes=300)]
    assert not any("Exchange" in f._jdf.queryExecution().executedPlan().toString() for f in few)
    want = [sorted(map(str, f.collect())) for f in few]
    for ranges, names in ((0, 256), (4096, 1), (0, 0)):
        monkeypatch.setattr(fixed, "FEW_RANGES", ranges)
        monkeypatch.setattr(fixed, "FEW_FILES", names)
        monkeypatch.setattr("mainspool.sources.variable.FEW_RANGES", ranges)
        got = [read_vb(spark, path, chunk_bytes=300), read_fb(spark, flat, 10, chunk_bytes=300)]
        assert [sorted(map(str, f.collect())) for f in got] == want


def test_bodies():
    rng = np.random.default_rng(1)
    buf = rng.integers(0, 255, 5000, dtype=np.uint8)
    for gap in (0, 4, 60):
        sizes = rng.integers(0, 20, 60)
        begin = np.cumsum(sizes + gap) - sizes
        want = b"".join(buf[b : b + s].tobytes() for b, s in zip(begin, sizes))
        assert pushed.bodies(buf, begin, sizes).tobytes() == want
    assert len(pushed.bodies(buf, np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0
