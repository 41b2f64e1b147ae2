"""Layout text to fields: positions, sizes, names."""

import pytest

from mainspool.layout import Layout, LayoutError, column_names, normalise

SHELF = """
       01  PART-SHELF.
           05 SHELF-TAG PIC X(5).
           05 STOCK.
              10 BRAND PIC X(10).
              10 SIZES-KEPT PIC 9(4) COMP.
              10 SIZE-SLOT OCCURS 0 TO 4
                 DEPENDING ON SIZES-KEPT.
                 15 PART-SIZE PIC 9(4) COMP.
                 15 RETAIL PIC S9(7)V99 COMP-3.
                 15 MADE-IN PIC X(7).
                 15 MADE-PARTS REDEFINES MADE-IN.
                    20 MADE-PLANT PIC X(3).
                    20 FILLER PIC X.
                    20 MADE-LOT PIC 9(3).
"""


def places(layout, **options):
    return {f.label: (f.offset.base + 1, f.size) for f in layout.fields(**options)}


def test_variable_record():
    layout = Layout.parse(SHELF)
    at = places(layout)
    assert at["SHELF-TAG"] == (1, 5)
    assert at["SIZES-KEPT"] == (16, 2)
    assert at["PART-SIZE (0)"] == (18, 2)
    assert at["RETAIL (1)"] == (34, 5)
    assert at["MADE-IN (2)"] == (53, 7)
    assert at["MADE-LOT (2)"] == (57, 3)
    assert at["MADE-PLANT (3)"] == (67, 3)
    assert layout.max_length == 17 + 14 * 4


@pytest.mark.parametrize("sequence, margins", [("{:05d}", (5, 72)), ("{:06d}", (6, 72))])
def test_margins(sequence, margins):
    lines = [
        "*   EVENTS AS THEY COME IN",
        "        05  EVENT-ID                PIC 9(12).",
        "        05  WHO.",
        "            10 USER-ID         PIC S9(11)   COMP-3.",
        "            10 KIND            PIC X(09).",
        "        05  MEASURED            PIC S9(5)V9(4) COMP-3.",
        "        05  AT-MINUTE               PIC 9(04)    COMP.",
    ]
    text = "\r\n".join((sequence.format(100 * i) + line).ljust(72) + "IGNORED." for i, line in enumerate(lines))
    layout = Layout.parse(text, margins)
    assert [f.size for f in layout.fields()] == [12, 6, 9, 5, 2]
    assert layout.max_length == 34


def test_binary_sizes():
    layout = Layout.parse(
        """
           03 ALL-SIZES.
              10 A PIC S9(4) COMP.
              10 B PIC S9(5) COMP.
              10 C PIC 9(10) BINARY.
              10 NAME PIC X(50).
              10 D PIC S9(3)V9(2) USAGE IS COMP-3 VALUE 1.5.
              88 IS-SET VALUE 'A. B'.
              10 E PIC XX.
"""
    )
    assert [f.size for f in layout.fields()] == [2, 4, 8, 50, 3, 2]


def test_usage_and_sign_of_a_group():
    layout = Layout.parse(
        """
           03 PACKED USAGE COMP-3.
              05 A PIC S9(5).
              05 B PIC X(3).
              05 C PIC 9(4) DISPLAY.
              05 INNER COMP.
                 10 D PIC S9(9).
           03 SIGNED SIGN IS LEADING SEPARATE CHARACTER.
              05 E PIC S9(3).
              05 F PIC 9(3).
              05 G PIC S9(3) SIGN TRAILING SEPARATE.
           03 H PIC S9(3) SIGN IS LEADING.
"""
    )
    assert [(f.name, f.kind, f.size, f.sign) for f in layout.fields()] == [
        ("A", "comp3", 3, ""),
        ("B", "text", 3, ""),
        ("C", "zoned", 4, ""),
        ("D", "comp", 4, ""),
        ("E", "zoned", 4, "leading separate"),
        ("F", "zoned", 3, ""),
        ("G", "zoned", 4, "separate"),
        ("H", "zoned", 3, "leading"),
    ]


def test_split_options():
    layout = Layout.parse(SHELF)
    assert len(layout.fields()) == 3 + 4 * 6
    assert len(layout.fields("redefine")) == 3 + 4 * 3
    two = Layout.parse("       01 A.\n          05 X PIC X(3).\n       01 B.\n          05 Y PIC X(5).\n")
    assert places(two) == {"X": (1, 3), "Y": (1, 5)}
    assert places(two, split="level1") == {"X": (1, 3)}
    assert two.max_length == 5
    with pytest.raises(LayoutError):
        layout.fields("other")


def test_layouts_add_up():
    header = Layout.parse("          05 IDENT PIC X(2).\n")
    body = Layout.parse("       01 BODY.\n          05 KEYNO PIC 9(4).\n")
    whole = header + body
    assert places(whole) == {"IDENT": (1, 2), "KEYNO": (3, 4)}
    assert places(header) == {"IDENT": (1, 2)}


def test_offsets_behind_a_variable_group():
    layout = Layout.parse(
        """
           05 N PIC 9(2).
           05 T OCCURS 1 TO 9 TIMES DEPENDING ON N PIC X(3).
           05 TAIL PIC X(4).
"""
    )
    tail = layout.find("tail")
    assert (tail.offset.base, tail.offset.terms) == (2, ((3, "N"),))


def test_names():
    assert normalise(" A-B (0, 1) ") == "A_B_0__1"
    assert column_names(["FILLER", "A", "FILLER (2)", "MY-FILLER-X"]) == ["FILLER_1", "A", "FILLER_2_2", "MY_FILLER_X_3"]


@pytest.mark.parametrize(
    "text",
    [
        "           05 A PIC 9(4) COMP-1.\n",
        "           05 A PIC ZZ*9.\n",
        "           05 A.\n",
        "           05 A REDEFINES B PIC X.\n",
        "           05 A PIC S9(4) COMP-3 SIGN LEADING SEPARATE.\n",
        "           05 A PIC 9(4) SIGN TRAILING SEPARATE.\n",
        "     \n",
    ],
)
def test_unsupported(text):
    with pytest.raises(LayoutError):
        Layout.parse(text).fields()
