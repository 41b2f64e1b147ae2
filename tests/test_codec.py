"""Codecs against hand-written bytes."""

import decimal

import pytest
from pyspark.sql import functions as F

from mainspool.functions import codec
from mainspool.session import java_charsets

D = decimal.Decimal

VECTORS = [
    # kind, size, scale, signed, hex, value
    ("text", 4, 0, False, "C1C2C340", "ABC "),
    ("text", 3, 0, False, "C115C2", "A\nB"),
    ("text", 3, 0, False, "004AFF", "\x00\xa2\x9f"),
    ("zoned", 3, 0, False, "F1F2F3", D(123)),
    ("zoned", 3, 0, True, "F1F2D3", D(-123)),
    ("zoned", 3, 0, True, "F1F2B3", D(-123)),
    ("zoned", 3, 0, True, "F1F2C3", D(123)),
    ("zoned", 3, 0, True, "F1F2F3", D(123)),
    ("zoned", 3, 0, False, "F1F2C3", D(123)),
    ("zoned", 3, 0, False, "4040F7", D(7)),
    ("zoned", 3, 0, False, "0000F7", D(7)),
    ("zoned", 4, 0, True, "4000F1D2", D(-12)),
    ("zoned", 3, 0, False, "F74040", None),
    ("zoned", 3, 0, False, "F1F240", None),
    ("zoned", 3, 0, True, "F1F200", None),
    ("zoned", 3, 0, False, "40F140", None),
    ("zoned", 3, 0, True, "404040", None),
    ("zoned", 3, 0, False, "000000", None),
    ("zoned", 20, 0, False, "40" * 18 + "F1F2", D(12)),
    ("zoned", 20, 0, False, "F1" * 19 + "40", None),
    ("zoned", 3, 0, False, "F1FAF3", None),
    ("zoned", 3, 0, False, "F14EF3", None),
    ("zoned", 1, 0, True, "D5", D(-5)),
    ("zoned", 5, 2, True, "F0F0F0F5D0", D("-0.50")),
    ("zoned", 20, 0, True, "F1" + "F0" * 18 + "D2", D(-(10**19) - 2)),
    ("comp", 2, 0, True, "FFFE", -2),
    ("comp", 2, 0, False, "FFFE", 65534),
    ("comp", 2, 0, True, "7FFF", 32767),
    ("comp", 2, 0, True, "8000", -32768),
    ("comp", 4, 0, False, "00000005", 5),
    ("comp", 4, 0, True, "FFFFFFFB", -5),
    ("comp", 8, 0, True, "FFFFFFFFFFFFFFFF", -1),
    ("comp", 8, 0, True, "8000000000000000", -(2**63)),
    ("comp", 8, 0, False, "FFFFFFFFFFFFFFFF", D(2**64 - 1)),
    ("comp", 4, 2, True, "FFFFFF9C", D("-1.00")),
    ("comp3", 4, 0, True, "0012345D", D(-12345)),
    ("comp3", 4, 0, True, "0012345B", D(-12345)),
    ("comp3", 4, 0, True, "0012345F", D(12345)),
    ("comp3", 4, 0, True, "0012345A", D(12345)),
    ("comp3", 4, 2, True, "0012345C", D("123.45")),
    ("comp3", 4, 2, True, "0000000D", D("0.00")),
    ("comp3", 4, 0, True, "00123456", None),
    ("comp3", 4, 0, True, "001A345C", None),
    ("comp3", 4, 0, True, "001E345C", None),
    ("comp3", 10, 0, True, "1234567890123456789D", D(-1234567890123456789)),
    ("comp3", 11, 2, True, "123456789012345678901C", D("1234567890123456789.01")),
    ("comp3", 10, 0, True, "12345678901E3456789D", None),
]


@pytest.fixture(scope="module")
def decoded(spark):
    rows = [(i, bytes.fromhex(v[4])) for i, v in enumerate(VECTORS)]
    df = spark.createDataFrame(rows, "i int, b binary")
    with java_charsets(spark):
        picked = [
            df.filter(F.col("i") == i).select("i", codec.decode("b", *v[:4]).cast("string").alias("v"))
            for i, v in enumerate(VECTORS)
        ]
    out = {}
    for p in picked:
        for row in p.collect():
            out[row["i"]] = row["v"]
    return out


@pytest.mark.parametrize("i", range(len(VECTORS)))
def test_vector(decoded, i):
    want = VECTORS[i][5]
    got = decoded[i]
    if want is None or isinstance(want, str):
        assert got == want
    else:
        assert D(got) == want


def test_decimal_text_keeps_its_scale(decoded):
    shown = {v[4]: decoded[i] for i, v in enumerate(VECTORS)}
    assert shown["0000000D"] == "0.00"
    assert shown["F0F0F0F5D0"] == "-0.50"


def test_every_character(spark):
    """All 256 bytes: the published code page, but both line controls are line feeds."""
    want = bytes(range(256)).decode("cp037")
    want = want[:0x15] + "\n" + want[0x16:]
    assert want[0x25] == "\n"
    df = spark.createDataFrame([(bytes(range(256)),)], "b binary")
    with java_charsets(spark):
        shown = df.select(codec.decode("b", "text", 256).alias("v"))
    assert shown.first()["v"] == want
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"


CLEANED = [
    ("a\n\rb", "a b"),
    ("a\r\nb", "a b"),
    ("a\r\n\r\nb", "a   b"),
    ("a\n\r\nb", "a  b"),
    ("a\tb\bc", "a b c"),
    ("  \x01 x\x02y \x1f ", "x\x02y"),
    ("\x7fa\x7f", "\x7fa\x7f"),
    ("Ünïcödé Å ß €", "Unicode A"),
    ("é", "e"),
    ("K≠ấ", "K=a"),
    ("한", ""),
    ("", ""),
    ("   ", ""),
    ("plain", "plain"),
]


def test_clean(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CLEANED)], "i int, s string")
    got = {r["i"]: r["v"] for r in df.selectExpr("i", f"{codec.clean('s')} AS v").collect()}
    assert [got[i] for i in range(len(CLEANED))] == [want for _, want in CLEANED]


def test_markers(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "i int, s string")
    got = [r[0] for r in df.orderBy("i").selectExpr(codec.marked("s")).collect()]
    assert got == ["BAD_FIELD_RECORD", "NULL", "x"]
