"""Rules, routing, decoding and segments on small records, expected by hand."""

import random

import pyarrow as pa
import pytest

from mainspool.layout import Layout, LayoutError
from mainspool.operators import decode as d
from mainspool.operators import route as r
from mainspool.operators import rules
from mainspool.operators import segments as s
from mainspool.operators.occurrences import Cutter

AB = Layout.parse("          05 A PIC X(2).\n          05 B PIC 9(2).\n          05 C PIC X(1).\n")


def ebcdic(*texts):
    return [t.encode("cp037").hex() for t in texts]


def numbers(df):
    return sorted(x["rec_no"] for x in df.collect())


# 1: A=1 B=23   2: A=12 B=3   3: A=x B=05 short   4: A=X B=7
@pytest.fixture
def four(records):
    return records(*ebcdic("1 23c", "12 3c", "x", "X 07d"))


@pytest.mark.parametrize(
    "options, want",
    [
        ({"include": "A=1"}, [1]),
        ({"include": "A=1:"}, [1]),
        ({"include": "A=1:A=12"}, [1, 2]),
        ({"include": "A=1,B=23"}, [1, 2]),
        ({"include": "A=1,B=23", "strict": True}, [1]),
        ({"include": "a=X"}, [4]),
        ({"include": ""}, [1, 2, 3, 4]),
        ({"exclude": "A=x"}, [1, 2, 3]),
        ({"include": "C=c", "exclude": "B=3"}, [1]),
        ({"include": "C=C", "exclude": "A=99"}, [1, 2]),
        ({"record_length": 5}, [1, 2, 4]),
        ({"record_length": 1}, [3]),
        ({"include": "C=c", "record_length": 5}, [1, 2]),
        ({}, [1, 2, 3, 4]),
    ],
)
def test_rules(four, options, want):
    assert numbers(rules.select_records(four, AB, **options)) == want


def test_rules_trim_like_java(records):
    df = records("40050005", "01c1f0f140", "c10bf0f181", "00" * 5)
    layout = Layout.parse("          05 A PIC X(2).\n          05 N PIC X(2).\n          05 C PIC X(1).\n")
    assert numbers(rules.include(df, layout, "A=A")) == [2, 3]
    assert numbers(rules.include(df, layout, "C=a")) == [3]


def test_long_record_length(records):
    df = records("40" * 500, "40" * 501)
    assert numbers(rules.record_length(df, 500)) == [1]


def test_rule_errors(four):
    with pytest.raises(ValueError):
        rules.include(four, AB, "A")
    with pytest.raises(LayoutError):
        rules.include(four, AB, "Z=1")


def test_skip_and_header_only(records):
    df = records("bf01", "c102", "bf", "c1")
    layout = Layout.parse("          05 K PIC X.\n")
    assert numbers(rules.skip_records(df, layout, "K", "BF")) == [2, 4]
    assert numbers(rules.drop_header_only(df, 1)) == [1, 2]


def test_text_markers(records):
    df = d.decode_text(records(*ebcdic("1 23c", "12", "  0A ")), AB, keep=("rec_no",))
    assert [tuple(x) for x in df.orderBy("rec_no").collect()] == [
        (1, "1", "23", "c"),
        (2, "12", "BAD_FIELD_RECORD", "BAD_FIELD_RECORD"),
        (3, "NULL", "1", "NULL"),
    ]


def test_typed_bad_fields(records):
    df = d.decode_typed(records(*ebcdic("1 23c", "12"), "f1f1fffff1"), AB, keep=("rec_no",))
    assert [tuple(x) for x in df.orderBy("rec_no").select("rec_no", "B", "_bad_fields").collect()] == [
        (1, 23, []),
        (2, None, ["B", "C"]),
        (3, None, ["B"]),
    ]


ODO = Layout.parse(
    """
          05 N PIC 9(1).
          05 T OCCURS 0 TO 3 DEPENDING ON N.
             10 X PIC X(1).
             10 M OCCURS 2 PIC 9(1).
          05 TAIL PIC X(2).
"""
)


@pytest.mark.parametrize("unrolled", [0, 64])
def test_variable_group(records, monkeypatch, unrolled):
    monkeypatch.setattr(d, "UNROLLED", unrolled)
    df = records(*ebcdic("2a12b34zz", "0zz", "3a12", "9a12b34c56zz"))
    got = {x["rec_no"]: x for x in d.decode_typed(df, ODO).collect()}
    assert [(t["X"], [int(m) for m in t["M"]]) for t in got[1]["T"]] == [("a", [1, 2]), ("b", [3, 4])]
    assert (got[1]["TAIL"], got[1]["_bad_fields"]) == ("zz", [])
    assert (got[2]["T"], got[2]["TAIL"]) == ([], "zz")
    # the record ends inside the second element
    assert [t["X"] for t in got[3]["T"]] == ["a", None, None]
    assert got[3]["_bad_fields"] == ["T", "TAIL"]
    # a count above the layout's limit
    assert len(got[4]["T"]) == 3
    assert "T" in got[4]["_bad_fields"]


MIXED = Layout.parse(
    """
          05 N PIC 9(1).
          05 T OCCURS 0 TO 3 DEPENDING ON N.
             10 X PIC X(2).
             10 Y REDEFINES X PIC 9(2).
             10 FILLER PIC X(1).
             10 P PIC S9(3)V99 COMP-3.
             10 M OCCURS 2.
                15 Q PIC S9(2)V9.
                15 FILLER PIC X(1).
                15 B PIC S9(4) COMP.
          05 TAIL PIC X(2).
"""
)


def test_both_decoders_of_repeated_groups_agree(records, monkeypatch):
    """Written out or by lambda: overlays, fillers, nested groups, scaled, blank and cut values."""
    rng = random.Random(12)
    choices = [b"\xf1", b"\xf2", b"\x40", b"\xc3", b"\x00", b"\x12", b"\x3c", b"\xd5"]
    made = [bytes([0xF0 + rng.choice((0, 1, 2, 3, 4))]) + b"".join(rng.choice(choices) for _ in range(rng.randrange(60))) for _ in range(200)]
    df = records(*(m.hex() for m in made))
    got = []
    for limit in (0, 1 << 30):
        monkeypatch.setattr(d, "UNROLLED", limit)
        got.append({x["rec_no"]: x for x in d.decode_typed(df, MIXED, keep=("rec_no",)).collect()})
    assert len(got[0]) == 200 and got[0] == got[1]


def test_repeated_and_reserved_names(records):
    layout = Layout.parse(
        """
          05 G1.
             10 A PIC X(1).
          05 G2.
             10 A PIC 9(1).
             10 a PIC X(1).
          05 FILE PIC X(1).
          05 A-2 PIC X(1).
          05 FILE PIC X(1).
"""
    )
    df = records(*ebcdic("x1yfzg"))
    text = d.decode_text(df, layout)
    assert text.columns == ["file", "rec_no", "A", "A_2", "A_3", "FILE_2", "A_2_2", "FILE_3"]
    assert tuple(text.first())[2:] == ("x", "1", "y", "f", "z", "g")
    assert layout.columns() == ["A", "A_2", "A_3", "FILE", "A_2_2", "FILE_2"]
    flat = d.decode_flat(df, layout, keep=())
    assert flat.columns == layout.columns() and tuple(flat.first()) == ("x", 1, "y", "f", "z", "g")
    typed = d.decode_typed(df, layout)
    assert typed.columns == ["file", "rec_no", "G1", "G2", "FILE_2", "A_2", "FILE_3", "_bad_fields"]
    assert typed.first()["G2"].asDict() == {"A": 1, "A_2": "y"}


def test_unset_numbers(records):
    df = records("4040f1f1c1", "4040f1404081", "c1c2000082", "c1c2400082", "c1c2f10083")
    layout = Layout.parse("          05 A PIC X(2).\n          05 N PIC 9(2).\n          05 C PIC X(1).\n")
    text = {x["rec_no"]: x["N"] for x in d.decode_text(df, layout, keep=("rec_no",)).collect()}
    assert text == {1: "11", 2: "BAD_FIELD_RECORD", 3: "NULL", 4: "NULL", 5: "BAD_FIELD_RECORD"}
    typed = {x["rec_no"]: (x["N"], x["_bad_fields"]) for x in d.decode_typed(df, layout, keep=("rec_no",)).collect()}
    assert typed == {1: (11, []), 2: (None, ["N"]), 3: (None, []), 4: (None, []), 5: (None, ["N"])}


def test_signs_of_their_own(records):
    layout = Layout.parse(
        """
          05 A PIC S9(2)V9 SIGN LEADING SEPARATE.
          05 B PIC S9(3) SIGN TRAILING SEPARATE.
          05 C PIC S9(3) SIGN LEADING.
"""
    )
    df = records(
        "60f0f1f5" + "f0f1f24e" + "d1f2f3", "4ef0f0f5" + "40f1f260" + "c1f2f3", "f0f0f1f5" + "f0f1f240" + "f1f2f3", "40404040" + "00000000" + "404040"
    )
    got = {x["rec_no"]: tuple(x)[1:] for x in d.decode_text(df, layout, keep=("rec_no",)).collect()}
    bad = "BAD_FIELD_RECORD"
    assert got == {1: ("-1.5", "12", "-123"), 2: ("0.5", "-12", "123"), 3: (bad, bad, "123"), 4: ("NULL", "NULL", "NULL")}


def test_skip_behind_a_corrupt_count(records):
    layout = Layout.parse("          05 N PIC 9(9) COMP.\n          05 T OCCURS 0 TO 3 DEPENDING ON N PIC X(9).\n          05 K PIC X.\n")
    df = records("ffffffffbf", "00000000bf", "00000000c1")
    assert numbers(rules.skip_records(df, layout, "K", "bf")) == [1, 3]


def test_excluded_fields_are_read_in_their_type_only(records):
    catalog = r.Catalog.from_json(CATALOG, LAYOUTS)
    plan = r.classify(records("c1"), catalog)._jdf.queryExecution().optimizedPlan().toString()
    # four looks: the header and A in either layout for includes, B for the exclude
    assert plan.count("StringDecode") <= 4


def test_variable_group_flat(records):
    df = d.decode_text(records(*ebcdic("1a12zz")), ODO, keep=())
    assert df.columns == ["N", "X_0", "M_0__0", "M_0__1", "X_1", "M_1__0", "M_1__1", "X_2", "M_2__0", "M_2__1", "TAIL"]
    row = df.first()
    assert (row["X_0"], row["M_0__1"], row["TAIL"], row["X_2"]) == ("a", "2", "zz", "BAD_FIELD_RECORD")


CATALOG = {
    "header_layout": "h",
    "hive_partition_data": "SITE=x",
    "appendCurrentYear": True,
    "records": [
        {"record": "one", "copy_layout": "a", "include_records": [{"name": "v1", "entries": {"H": "1", "A": "q"}}]},
        {"record": "rest", "copy_layout": "b", "exclude_records": [{"name": "no", "entries": {"B": "n"}}]},
        {
            "record": "two",
            "copy_layout": "a",
            "include_records": [{"name": "v2", "entries": {"H": "2"}}, {"name": "v3", "entries": {"H": "1"}}],
        },
    ],
}
LAYOUTS = {"h": "          05 H PIC X.\n", "a": "          05 A PIC X.\n", "b": "          05 B PIC X.\n"}


def test_catalog():
    catalog = r.Catalog.from_json(CATALOG, LAYOUTS)
    assert catalog.partition == {"SITE": "x"}
    assert catalog.load_date == "year"
    assert catalog.types[0].layout.columns() == ["H", "A"]
    assert r.Catalog.from_json({**CATALOG, "appendCurrentDate": True}, LAYOUTS).load_date == "day"


def test_route(records):
    catalog = r.Catalog.from_json(CATALOG, LAYOUTS)
    df = records(*ebcdic("1Q", "1z", "2n", "9n", "9y", "1"))
    got = {x["rec_no"]: (x["rec_type"], x["rec_variant"]) for x in r.classify(df, catalog).collect()}
    assert got == {
        1: ("one", "v1"),
        2: ("two", "v3"),
        3: ("two", "v2"),  # the exclude is on a field its layout lacks
        4: (None, None),
        5: ("rest", "rest"),
        6: ("two", "v3"),
    }
    routed = r.route(df, catalog)
    assert numbers(routed) == [1, 2, 3, 5, 6]
    assert numbers(r.unrouted(df, catalog)) == [4]
    parts = r.decode_types(routed, catalog, keep=("rec_no",))
    assert sorted(tuple(x) for x in parts["two"].collect()) == [(2, "1", "z"), (3, "2", "n"), (6, "1", "BAD_FIELD_RECORD")]


PREFIX = Layout.parse("          03 ID PIC X(2).\n          03 LEN PIC S9(4) COMP.\n")


def walk(record, header, offset, marker):
    """The segment rule, one record at a time: (segments, error, 1-based position)."""
    out, at, n = [], header, len(record)
    if n <= header:
        return out, "no segment behind the header", n + 1
    while True:
        prefix = record[at : at + 4]
        if len(prefix) < 4:
            return out, "segment prefix cut off", at + 1
        size = int.from_bytes(prefix[2:4], "big", signed=True)
        if size < 0:
            return out, "negative segment length", at + 1
        if size > n:
            return out, "segment longer than its record", at + 1
        if size == 0:
            if marker is None:
                return out, "zero segment length", at + 1
            if prefix[:1] != marker:
                return out, "zero segment length without marker", at + 1
            size = prefix[1]
        stride = size + offset
        if stride < 1:
            return out, "segment does not advance", at + 1
        out.append(record[:header] + record[at : at + stride - 1])
        at += stride
        if not n > at + 1:
            return out, None, None


def random_composite(rng, header, offset, marker):
    body = b""
    for _ in range(rng.randrange(6)):
        stride = rng.randrange(4, 30)
        size = stride - offset
        use = marker if marker and rng.random() < 0.3 else None
        prefix = use + bytes([size, 0, 0]) if use else b"ID" + size.to_bytes(2, "big", signed=True)
        body += prefix + rng.randbytes(stride - 4)
    body += rng.choice([b"", b"", b"E", b"EE", b"EEE", b"EE\x00\x00", b"EE\x7f\xff", b"EE\xff\xf0", b"EE\x00\x09x"])
    return rng.randbytes(header - rng.randrange(2)) + body if rng.random() < 0.1 else rng.randbytes(header) + body


@pytest.mark.parametrize("offset, marker", [(0, None), (3, None), (0, b"\xbf"), (3, b"\xbf"), (-4, None)])
def test_segments_against_brute_force(records, offset, marker):
    rng = random.Random(offset * 7 + (marker is None))
    made = [random_composite(rng, 5, offset, marker) for _ in range(400)]
    df = records(*(m.hex() for m in made)).repartition(3)
    options = {"length_offset": offset, "skip_marker": marker.hex() if marker else None}
    got = s.split_segments(df, 5, PREFIX, "LEN", **options).collect()
    want = [(i + 1, k + 1, seg) for i, m in enumerate(made) for k, seg in enumerate(walk(m, 5, offset, marker)[0])]
    assert sorted((x["rec_no"], x["seg_no"], bytes(x["rec"])) for x in got) == want
    assert all(x["rec_len"] == len(x["rec"]) for x in got)
    errors = s.split_rejects(df, 5, PREFIX, "LEN", **options).collect()
    want = [(i + 1, *walk(m, 5, offset, marker)[1:]) for i, m in enumerate(made) if walk(m, 5, offset, marker)[1]]
    assert sorted((x["rec_no"], x["error"], x["error_at"]) for x in errors) == want


@pytest.mark.parametrize(
    "pic, hexes",
    [
        ("9(4)", ["f0f0f1f2", "f0f0f0f9"]),
        ("S9(4)", ["f0f0f1c2", "f0f0f0c9"]),
        ("S9(5) COMP-3", ["00012c", "00009f"]),
        ("9(9) COMP", ["0000000c", "00000009"]),
    ],
)
def test_segment_length_types(records, pic, hexes):
    layout = Layout.parse(f"          03 LEN PIC {pic}.\n")
    segments = [bytes.fromhex(h) for h in hexes]
    segments = [segments[0].ljust(12, b"x"), segments[1].ljust(9, b"y")]
    df = records((b"H" + b"".join(segments)).hex())
    got = s.split_segments(df, 1, layout, "LEN").orderBy("seg_no").collect()
    assert [bytes(x["rec"]) for x in got] == [b"H" + segments[0][:-1], b"H" + segments[1][:-1]]


def test_plans_stay_native(records):
    df = records(*ebcdic("1 23c"))
    kept = rules.include(df, AB, "A=1")
    for frame in (d.decode_text(kept, AB), d.decode_typed(kept, AB), d.decode_typed(kept, ODO)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
        assert "Exchange" not in plan


def test_unselected_fields_are_not_decoded(records):
    plan = d.decode_text(records(*ebcdic("1 23c")), AB).select("A")._jdf.queryExecution().optimizedPlan().toString()
    assert "substring(rec" in plan
    assert "2, 2)" not in plan.replace("rec#", "")
    assert plan.count("StringDecode") == 1


def test_split_walks_once_without_shuffle(records):
    split = s.split_segments(rules.skip_records(records("c1"), Layout.parse("          05 K PIC X.\n"), "K", "bf"), 1, PREFIX, "LEN")
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan
    # dropped records never reach Python
    assert plan.index("ArrowEvalPython") < plan.index("Filter")


NESTED = """
          05 ID PIC 9(2).
          05 N PIC 9(1).
          05 G OCCURS 0 TO 3 DEPENDING ON N.
             10 A PIC X.
             10 INNER.
                15 M PIC 9.
             10 H OCCURS 0 TO 4 DEPENDING ON M.
                15 K PIC 9.
                15 V OCCURS 0 TO 2 DEPENDING ON K PIC X(2).
             10 T PIC X.
             10 TT REDEFINES T PIC 9.
          05 C PIC 9.
          05 Q OCCURS 0 TO 2 DEPENDING ON C PIC X.
          05 LAST PIC X(2).
"""


def _nested(i, groups, q, last):
    body = "".join(f"{a}{len(hs)}" + "".join(f"{len(vs)}{''.join(vs)}" for vs in hs) + t for a, hs, t in groups)
    return f"{i:02d}{len(groups)}{body}{len(q)}{q}{last}"


def _random_nested(rng, i):
    values = lambda n: [rng.choice("abcxyz") + str(rng.randrange(10)) for _ in range(rng.randint(0, n))]
    groups = [(rng.choice("pq"), [values(2) for _ in range(rng.randint(0, 4))], rng.choice("5678")) for _ in range(rng.randint(0, 3))]
    return i, groups, "".join(rng.choice("rs") for _ in range(rng.randint(0, 2))), rng.choice(["zz", "yy"])


def test_groups_of_varying_length_in_groups_of_varying_length(records):
    layout, rng = Layout.parse(NESTED), random.Random(3)
    made = [_random_nested(rng, i) for i in range(40)]
    frame = records(*(_nested(*m).encode("cp037").hex() for m in made))
    typed = {int(x["ID"]): x for x in d.decode_typed(frame, layout).collect()}
    flat = {int(x["ID"]): x for x in d.decode_text(frame, layout).collect()}
    for i, groups, q, last in made:
        row = typed[i]
        got = [(g["A"], [list(h["V"]) for h in g["H"]], g["T"], int(g["INNER"]["M"]), int(g["TT"])) for g in row["G"]]
        assert got == [(a, hs, t, len(hs), int(t)) for a, hs, t in groups]
        assert (list(row["Q"]), row["LAST"], row["_bad_fields"]) == (list(q), last, [])
        row = flat[i].asDict()
        want = {"ID": str(i), "N": str(len(groups)), "C": str(len(q)), "LAST": last}
        for a, (mark, hs, t) in enumerate(groups):
            want |= {f"A_{a}": mark, f"M_{a}": str(len(hs)), f"T_{a}": t, f"TT_{a}": t}
            for b, vs in enumerate(hs):
                want |= {f"K_{a}__{b}": str(len(vs)), **{f"V_{a}__{b}__{c}": v for c, v in enumerate(vs)}}
        want |= {f"Q_{k}": v for k, v in enumerate(q)}
        held = {k: v for k, v in row.items() if k in want or v != "BAD_FIELD_RECORD" and not k.startswith(("file", "rec_no", "Q_"))}
        assert held == want
    # all types of a catalog share the walk's stages with others
    catalog = r.Catalog((r.RecordType("n", layout, (("n", (("C", "0"),)),)), r.RecordType("rest", layout)))
    routed = r.decode_routed(r.route(frame, catalog), catalog, "typed").collect()
    assert sorted(int((x["n"] or x["rest"])["ID"]) for x in routed) == [m[0] for m in sorted(made)]


def test_nested_counts_that_do_not_fit(records):
    layout = Layout.parse(NESTED)
    rows = [_nested(1, [("p", [["a1"]], "5")], "", "zz")[:-4], "029" + "p15" * 3 + "0zz", "031p9" + "0" * 9 + "50zz", "04"]
    got = {x["rec_no"]: x for x in d.decode_typed(records(*(t.encode("cp037").hex() for t in rows)), layout).collect()}
    assert "LAST" in got[1]["_bad_fields"] and [list(h["V"]) for h in got[1]["G"][0]["H"]] == [["a1"]]
    assert "G" in got[2]["_bad_fields"] and len(got[2]["G"]) == 3  # nine said, three allowed
    assert len(got[3]["G"][0]["H"]) == 4  # so do inner ones give what is allowed
    assert got[4]["G"] == [] and "N" in got[4]["_bad_fields"]


RAGGED = """
          05 WIDE PIC 9(2).
          05 N PIC 9(2) COMP.
          05 G OCCURS 0 TO 3 DEPENDING ON N.
             10 A PIC X(2).
             10 P PIC S9(3) COMP-3.
             10 ROW OCCURS 0 TO 5 DEPENDING ON P.
                15 COL PIC X OCCURS 0 TO 12 DEPENDING ON WIDE.
                15 R PIC S9(4) COMP.
                15 U PIC 9(18) COMP.
                15 S PIC S9(18) COMP.
             10 F COMP-1.
             10 D COMP-2.
             10 FILLER PIC X.
             10 Z PIC S9(2)V9.
             10 ZZ REDEFINES Z PIC X(2).
             10 E PIC -Z9.
          05 LAST PIC X(2).
"""


def _ragged(rng):
    """A record as the layout has it."""
    some = lambda n: bytes(rng.randrange(256) for _ in range(n))
    wide, n = rng.randint(0, 12), rng.randint(0, 3)
    out = f"{wide:02d}".encode("cp037") + n.to_bytes(2, "big")
    for _ in range(n):
        rows = rng.randint(0, 5)
        out += some(2) + bytes([0, rows << 4 | rng.choice([12, 15])])
        out += b"".join(some(wide + 2 + 8 + 8) for _ in range(rows))
        out += some(4) + some(8) + some(1) + rng.choice([some(3), "12C".encode("cp037"), "   ".encode("cp037")]) + "- 7".encode("cp037")
    return out + b"\xe9\xe9"


def test_cut_occurrences_like_expressions(records, monkeypatch):
    """Raw forms cut by batches, and those of records that are not as their layout says, are those of expressions."""
    layout, rng = Layout.parse(RAGGED), random.Random(7)
    whole = [_ragged(rng) for _ in range(60)]
    broken = []
    for w in whole:
        b = bytearray(w[: rng.randrange(1, len(w) + 1)])
        for _ in range(rng.randrange(3)):
            b[rng.randrange(min(len(b), 12))] = rng.choice([0x40, 0x00, 0xF9, 0x9C, 0x1D, 0x05])
        broken.append(bytes(b))
    frame = records(*(w.hex() for w in whole + broken))
    shown = lambda f: sorted((str(r) for r in f.collect()))
    got = {split: shown(d.decode_typed(frame, layout, split=split)) for split in ("nosplit", "redefine")}
    # all that are whole are cut
    cutter = Cutter.of(layout.tops("nosplit")[2][0], "nosplit")
    assert cutter.outside == ("WIDE",)
    wide, said = ([int.from_bytes(w[2:4], "big") if i else int(w[:2].decode("cp037")) for w in whole] for i in (0, 1))
    cut = cutter.cut(*(pa.array(x) for x in (whole, [len(w) for w in whole], [4] * len(whole), said, wide)))
    assert cut.null_count == 0 and [len(c["raw"]) for c in cut.to_pylist()] == said
    assert [c["places"][-1] for c in cut.to_pylist()] == [len(w) - 2 for w in whole]
    monkeypatch.setattr(Cutter, "of", staticmethod(lambda item, split: None))
    for split, rows in got.items():
        assert shown(d.decode_typed(frame, layout, split=split)) == rows


def test_what_is_left_to_expressions():
    """Counts of other kinds, counts behind what they count, and overlays that hold groups or are longer."""
    head = "          05 N PIC 9.\n          05 G OCCURS 0 TO 3 DEPENDING ON N.\n             10 M PIC 9.\n"
    inner = "             10 H PIC X OCCURS 0 TO 3 DEPENDING ON M.\n"
    cut = lambda text: Cutter.of(Layout.parse(text).tops("nosplit")[1][0], "nosplit")
    assert cut(head + inner) is not None
    assert cut(head.replace("M PIC 9", "M PIC 9V9") + inner) is None
    assert cut(head.replace("M PIC 9", "M PIC S9 SIGN IS TRAILING SEPARATE") + inner) is None
    assert cut(head + "             10 T PIC X.\n             10 TT REDEFINES T PIC XX.\n" + inner) is None


@pytest.mark.parametrize("cases", [32, 0])
def test_many_rules_like_first_match_by_hand(records, monkeypatch, cases):
    monkeypatch.setattr(r, "CASES", cases)
    layout, rng = Layout.parse("          05 A PIC X(2).\n          05 B PIC X(1).\n          05 N PIC 9(2).\n"), random.Random(2)
    rows = [rng.choice("abc ") + rng.choice("ab ") + rng.choice("xy ") + f"{rng.randrange(40):02d}" for _ in range(200)] + ["a", "ab"]
    types = []
    for t in range(6):
        pairs = [rng.choice([(("A", rng.choice(["a", "AB", "b", ""])),), (("N", str(rng.randrange(40))),), (("A", rng.choice("abc")), ("B", rng.choice("xy")))]) for _ in range(50)]
        types.append(r.RecordType(f"t{t}", layout, tuple((f"v{t}.{i}", p) for i, p in enumerate(pairs)), tuple((f"e{i}", (("N", str(n)),)) for i, n in enumerate(rng.sample(range(40), 2)))))
    types.append(r.RecordType("rest", layout))
    held = {"A": lambda x: x[:2].strip().lower() if len(x) >= 2 else None, "B": lambda x: x[2:3].strip() if len(x) >= 3 else None, "N": lambda x: str(int(x[3:])) if len(x) == 5 else None}

    def hit(x, rule):
        values = [held[n](x) for n, _ in rule]
        return None not in values and "".join(values) == "".join(v for _, v in rule).lower()

    for catalog in (r.Catalog(tuple(types)), r.Catalog(tuple(types[:2])), r.Catalog((types[-1],)), r.Catalog(())):
        got = {x["rec_no"]: (x["rec_type"], x["rec_variant"]) for x in r.classify(records(*ebcdic(*rows)), catalog).collect()}
        for i, x in enumerate(rows):
            rest = next((t.name for t in catalog.types if not t.include), None)
            want = next(((t.name, v) for t in catalog.types for v, rule in t.include if hit(x, rule)), (rest, rest))
            if want[0] and any(hit(x, rule) for t in catalog.types for _, rule in t.exclude):
                want = (None, None)
            assert got[i + 1] == want
