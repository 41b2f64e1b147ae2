"""Floating-point and edited numbers, against hand-made bytes and an independent editor."""

import random
import struct
from decimal import Decimal

import pytest

from mainspool.layout import Layout, LayoutError, Picture
from mainspool.operators import decode as d


def _layout(*fields):
    return Layout.parse("".join(f"          05 F{i} {f}.\n" for i, f in enumerate(fields)))


def _hex_float(value, size):
    """Hexadecimal floating point, truncated."""
    sign, value, power = value < 0, abs(Decimal(value)), 64
    if not value:
        return bytes(size)
    while value >= 1:
        value, power = value / 16, power + 1
    while value < Decimal(1) / 16:
        value, power = value * 16, power - 1
    places = 8 * size - 8
    return ((sign << 7 | power) << places | int(value * 2**places)).to_bytes(size, "big")


FLOATS = [0, 1, -1, 0.5, 118.625, -118.625, 1e10, -2.5e-7, 3.14159265358979, 1e70, -1e-70, 16777215, 0.1]


def test_floating_point(records):
    # 42 76 A0 00 is +0.76A000 times 16 squared
    known = [("4276a000", 118.625, "118.625"), ("c276a000", -118.625, "-118.625"), ("80000000", 0.0, "0.0"), ("41100000", 1.0, "1.0"), ("4019999a", 0.1, "0.100000024")]
    for raw, value, text in known:
        frame = records(raw)
        got = d.decode_typed(frame, _layout("COMP-1")).first()
        assert got["F0"] == pytest.approx(value, rel=1e-6) and got["_bad_fields"] == []
        assert d.decode_text(frame, _layout("USAGE IS COMPUTATIONAL-1")).first()["F0"] == text
    layout = _layout("COMP-1", "COMP-2", "PIC X")
    rows = [_hex_float(x, 4) + _hex_float(x, 8) + b"\x81" for x in FLOATS] + [b"\x42\x76"]
    got = sorted(d.decode_typed(records(*(b.hex() for b in rows)), layout).collect(), key=lambda x: x["rec_no"])
    for x, row in zip(FLOATS, got):
        assert row["F0"] == pytest.approx(x, rel=2e-6) and row["F1"] == pytest.approx(x, rel=1e-15) and row["F2"] == "a"
    assert got[-1]["F0"] is None and got[-1]["_bad_fields"] == ["F0", "F1", "F2"]
    assert [f.dataType.simpleString() for f in d.decode_flat(records("00"), layout).schema][-3:] == ["double", "double", "string"]
    text = d.decode_text(records(_hex_float(2.5, 4).hex() + _hex_float(-0.25, 8).hex() + "81"), layout, dialect="comma").first()
    assert (text["F0"], text["F1"]) == ("2,5", "-0,25")
    # all 56 bits, rounded once
    bits = random.Random(1).getrandbits(56) | 1 << 55
    raw = struct.pack(">Q", 0x40 << 56 | bits).hex()
    assert d.decode_flat(records(raw), _layout("COMP-2")).first()["F0"] == bits / 2**56


def test_a_group_of_floating_point_numbers(records):
    layout = Layout.parse("          05 G USAGE COMP-2.\n             10 A.\n             10 B.\n          05 C COMP-1 OCCURS 2.\n")
    raw = b"".join(_hex_float(x, n) for x, n in ((1.5, 8), (-2, 8), (3, 4), (4, 4)))
    row = d.decode_typed(records(raw.hex()), layout).first()
    assert (tuple(row["G"]), list(row["C"])) == ((1.5, -2.0), [3.0, 4.0])
    for wrong in ("          05 A PIC 9(2) COMP-1.\n", "          05 G COMP-1.\n             10 A PIC 9.\n", "          05 A PIC ZZ9 COMP-3.\n", "          05 A.\n"):
        with pytest.raises(LayoutError):
            Layout.parse(wrong)


def _edit(picture, value):
    """Edit a number for print, place by place."""
    flat = picture
    while "(" in flat:
        i = flat.index("(")
        j = flat.index(")", i)
        flat = flat[: i - 1] + flat[i - 1] * int(flat[i + 1 : j]) + flat[j + 1 :]
    tail = flat[-2:] if flat.endswith(("CR", "DB")) else ""
    body = flat[: len(flat) - len(tail)]
    floating = next((c for c in "+-$" if body.count(c) > 1), None)
    first = body.index(floating) if floating else -1
    spots = [i for i, c in enumerate(body) if c in "9Z*" or c == floating and i != first]
    point = next((i for i, c in enumerate(body) if c in ".V"), len(body))
    scale = sum(i > point for i in spots)
    digits = str(int(abs(value).scaleb(scale))).rjust(len(spots), "0")
    negative = value < 0
    show = {"+": "-" if negative else "+", "-": "-" if negative else " ", "$": "$"}
    out, started, fill, all_zero = [], False, " ", not digits.strip("0") and "9" not in body
    k, last = 0, None
    for i, c in enumerate(body):
        if c == "V":
            continue
        if i in spots:
            digit = digits[k]
            k += 1
            if c in "Z*" or c == floating:
                fill = "*" if c == "*" else " "
                if digit != "0" or i > point:
                    started = True
            else:
                started = True
            if not started:
                last = len(out)
            out.append(digit if started else fill)
        elif c in ",B0/":
            suppressed = not started and any(b in "Z*" or b == floating for b in body[:i])
            if suppressed:
                last = len(out)
            out.append(fill if suppressed else " " if c == "B" else c)
        elif c == ".":
            started = True
            out.append(".")
        elif c == floating:
            last = len(out)
            out.append(" ")
        else:
            out.append(show[c])
    if floating:
        out[last] = show[floating]
    text = "".join(out)
    if all_zero and (("Z" in body) or floating):
        return " " * (len(text) + len(tail))
    return text + (tail if tail and negative else " " * len(tail))


PICTURES = ["ZZ9", "ZZZ", "Z,ZZ9.99", "ZZZ,ZZ9.99CR", "$$,$$9.99DB", "+++9", "---,--9.9", "$ZZ9.99-", "***,**9.99", "-9(3)", "9(3)+", "+$$9", "99/99/9999", "ZZBZZ9", "9099", "$$$$.99", "ZZ.ZZ", "----", "Z(4)9V99", "+9.9(2)", "9(20)-", "ZZ,Z99"]


@pytest.mark.parametrize("picture", PICTURES)
def test_edited_numbers_come_back(records, picture):
    edited = Picture.parse(_expand(picture))
    rng, values = random.Random(5), [Decimal(0)]
    for _ in range(25):
        n = rng.randrange(10 ** rng.randint(1, edited.digits))
        values.append(Decimal(n).scaleb(-edited.scale) * (rng.choice([1, -1]) if edited.signed else 1))
    texts = [_edit(picture, v) for v in values]
    assert {len(t) for t in texts} == {len(edited.places)}
    layout = _layout(f"PIC {picture}", "PIC X")
    frame = records(*((t + "x").encode("cp037").hex() for t in texts))
    flat = {x["rec_no"]: x for x in d.decode_flat(frame, layout).collect()}
    text = {x["rec_no"]: x for x in d.decode_text(frame, layout).collect()}
    for i, (v, t) in enumerate(zip(values, texts)):
        assert (flat[i + 1]["F0"], flat[i + 1]["F1"]) == (v, "x"), t
        assert Decimal(text[i + 1]["F0"]) == v, t


def _expand(picture):
    while "(" in picture:
        i = picture.index("(")
        j = picture.index(")", i)
        picture = picture[: i - 1] + picture[i - 1] * int(picture[i + 1 : j]) + picture[j + 1 :]
    return picture


@pytest.mark.parametrize(
    "picture, wrong",
    [("ZZ9", ["1 2", "  x", "12 ", "1,2"]), ("Z,ZZ9.99", [" ,123.45", "1 234.56", "12345.67", "   1,234"]), ("---9", ["1-23", "- 12", "+123"]), ("$$9.99", ["1 2.34", "12.345", "$$1.00"]), ("99CR", ["12DB", "12C ", "1 CR"])],
)
def test_what_a_picture_does_not_allow_is_bad(records, picture, wrong):
    layout = _layout(f"PIC {picture}")
    size = len(Picture.parse(_expand(picture)).places)
    frame = records(*(t[:size].ljust(size).encode("cp037").hex() for t in wrong))
    assert [x["_bad_fields"] for x in d.decode_typed(frame, layout).collect()] == [["F0"]] * len(wrong)


def test_blank_edited_numbers_are_empty_or_zero(records):
    frame = records("40" * 3)
    assert d.decode_typed(frame, _layout("PIC ZZ9")).first()[2:] == (None, [])
    assert d.decode_text(frame, _layout("PIC ZZ9")).first()["F0"] == "NULL"
    assert d.decode_text(frame, _layout("PIC ZZZ")).first()["F0"] == "0"
    for wrong in ("ZZ*9", "++ZZ9", "A9", "Z.Z.9", "CR", "$"):
        with pytest.raises(LayoutError):
            _layout(f"PIC {wrong}")
