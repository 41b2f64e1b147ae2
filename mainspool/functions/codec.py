"""Field codecs as Spark SQL expressions.

Decoding a field takes two steps. :func:`piece` turns its bytes (BINARY) into the raw
form its type is read from: characters, hex digits or an integer. :func:`value` turns
that into the value, and gives SQL NULL for what is no value of the type. The operators
put the steps into separate projections, so that a raw form read several times by the
second step is made once.

Expressions are built as SQL text, from the text of what they are applied to; a layout of
hundreds of fields would otherwise take seconds to put together call by call. They use
built-in functions only: fields stay inside generated code and fields nobody selects are
pruned.

``text`` and ``zoned`` decode with the JVM's cp037 charset. Spark accepts it only while
``spark.sql.legacy.javaCharsets`` is on, so resolve such columns inside
:func:`mainspool.session.java_charsets`; the library's own operators do.
"""

from __future__ import annotations

import unicodedata
from dataclasses import replace
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from mainspool.layout import COMP, COMP3, EDITED, FLOAT, TEXT, Field, Item, Picture

CHARSET = "cp037"

# Markers written for an empty value and for an undecodable field.
NULL_MARK = "NULL"
BAD_MARK = "BAD_FIELD_RECORD"

# Decimal digits a BIGINT surely holds, and the most a binary field does.
LONG_DIGITS = 18
COMP_DIGITS = {2: 5, 4: 10, 8: 20}

# Packed sign nibbles, and zones of a signed last digit.
POSITIVE = "FCAE"
NEGATIVE = "DB"

# Characters turned into one blank, in this order.
BLANKED = ("\n\r", "\r\n", "\n", "\r", "\t", "\b")

# Fixed value: characters Java's ``String.trim`` strips at both ends.
TRIMMED = "".join(map(chr, range(0x21)))

# Fixed value: where the JVM's cp037 differs from Python's.
_JVM_CONTROLS = {0x15: "\n"}

# the character of every byte, and the digit in the byte's low nibble
CHARACTERS = "".join(_JVM_CONTROLS.get(i) or bytes([i]).decode(CHARSET) for i in range(256))
_LOW_NIBBLES = "0123456789??????" * 16

# the characters of signed digits: ten for each positive, then each negative zone
_SIGNED_DIGITS = "".join(CHARACTERS[int(zone, 16) * 16 + digit] for zone in POSITIVE + NEGATIVE for digit in range(10))
_FIRST_NEGATIVE = 10 * len(POSITIVE)


def literal(text: str) -> str:
    """A SQL string literal."""

    def shown(c: str) -> str:
        if c in "'\\":
            return "\\" + c
        return c if c >= " " and c != "\x7f" else f"\\u{ord(c):04x}"

    return "'" + "".join(map(shown, text)) + "'"


_UNSET = literal(" \x00")


def piece(b: str, field: Field | Item) -> str:
    """The raw form of a field's bytes."""
    if field.kind == COMP3:
        return f"hex({b})"
    if field.kind == FLOAT:
        return f"cast(conv(hex({b}), 16, {-10 if field.size == 8 else 10}) AS bigint)"
    if field.kind != COMP:
        return f"decode({b}, '{CHARSET}')"
    if field.size < 8:
        return f"cast(conv(hex({b}), 16, 10) AS bigint)"
    if field.signed:
        return f"cast(conv(hex({b}), 16, -10) AS bigint)"
    return f"cast(conv(hex({b}), 16, 10) AS decimal(20,0))"


def value(raw: str, field: Field | Item) -> str:
    """The value of a raw form: STRING, BIGINT or DECIMAL."""
    if field.kind == TEXT:
        return raw
    if field.kind == COMP3:
        return _packed(raw, field.size, field.scale)
    if field.kind == COMP:
        return _binary(raw, field)
    if field.kind == FLOAT:
        return _floating(raw, field.size)
    if field.kind == EDITED:
        return _edited(raw, field)
    return _zoned(raw, field)


def _decimal(digits: int, scale: int) -> str:
    return f"decimal({max(digits, scale)},{scale})"


def _scaled(whole: str, digits: int, scale: int) -> str:
    """A whole number with an implied point as a decimal."""
    whole = f"cast({whole} AS {_decimal(digits, 0)})"
    if not scale:
        return whole
    return f"cast({whole} * cast('1E-{scale}' AS {_decimal(scale, scale)}) AS {_decimal(digits, scale)})"


def _many_digits(digits: str, count: int, scale: int, sign: str) -> str:
    """Digits too many for a BIGINT as a decimal; NULL if they are not all digits."""
    number = f"try_cast(concat({digits}, 'E-{scale}') AS {_decimal(count, scale)})"
    # an E among the digits would read as an exponent
    plain = f"CASE WHEN NOT contains({digits}, 'E') THEN {number} END"
    return f"CASE {sign} WHEN 1 THEN {plain} WHEN -1 THEN -{plain} END"


def _packed(nibbles: str, size: int, scale: int) -> str:
    """Two digits a byte; the last nibble is the sign."""
    count = 2 * size - 1
    digits = f"substring({nibbles}, 1, {count})"
    plus, minus = (" OR ".join(f"endswith({nibbles}, '{n}')" for n in signs) for signs in (POSITIVE, NEGATIVE))
    sign = f"(CASE WHEN {plus} THEN 1 WHEN {minus} THEN -1 END)"
    if count > LONG_DIGITS:
        return _many_digits(digits, count, scale, sign)
    return _scaled(f"try_cast({digits} AS bigint) * {sign}", count, scale)


def _zoned(shown: str, field: Field | Item) -> str:
    """One digit in the low nibble of each byte; the last high nibble is the sign.

    Plain digit characters are the rule and are read as text; digits under other zones
    are found by their low nibble. Leading blanks and low-values count as zeros, behind a
    digit they are no number; a field of nothing else has no value (:func:`empty`).
    """
    size = field.size
    if "separate" in field.sign:
        first, mark = (2, 1) if "leading" in field.sign else (1, size)
        number = _zoned(f"substring({shown}, {first}, {size - 1})", replace(field, size=size - 1, signed=False, sign=""))
        return f"CASE substring({shown}, {mark}, 1) WHEN '+' THEN {number} WHEN '-' THEN -{number} END"
    low = f"translate({shown}, {literal(CHARACTERS)}, '{_LOW_NIBBLES}')"
    behind = f"trim(LEADING {_UNSET} FROM {shown})"
    clean = f"{behind} <> '' AND translate({behind}, {_UNSET}, '') = {behind}"
    low = f"CASE WHEN {clean} THEN {low} END"
    sign = "1"
    if field.signed:
        leading = "leading" in field.sign
        last = f"(position(substring({shown}, {1 if leading else size}, 1), {literal(_SIGNED_DIGITS)}) - 1)"
        sign = f"(CASE WHEN {last} >= {_FIRST_NEGATIVE} THEN -1 ELSE 1 END)"
        digit, rest = f"cast({last} % 10 AS string)", f"substring({shown}, {2 if leading else 1}, {size - 1})"
        shown = f"concat({digit}, {rest})" if leading else f"concat({rest}, {digit})"
    if size > LONG_DIGITS:
        return _many_digits(f"({low})", size, field.scale, sign)
    quick = f"try_cast({shown} AS bigint)"
    plain = f"lpad(cast({quick} AS string), {size}, '0') = {shown}"
    number = f"(CASE WHEN {plain} THEN {quick} ELSE try_cast({low} AS bigint) END)"
    return _scaled(f"{number} * {sign}" if field.signed else number, size, field.scale)


def _floating(bits: str, size: int) -> str:
    """Hexadecimal floating point: a sign, a power of 16 from 64 and a fraction; as DOUBLE, as the
    power of a short one goes beyond FLOAT."""
    places = 8 * size - 8
    power = f"(shiftrightunsigned({bits}, {places}) & 127)"
    # a fraction of 56 bits is rounded to the 53 of a DOUBLE; a power of two changes none of them
    fraction = f"cast({bits} & {(1 << places) - 1}L AS double)"
    negative = f"{bits} < 0" if size == 8 else f"{bits} >= {1 << 31}L"
    # adding zero makes a negative zero a plain one
    return f"(CASE WHEN {negative} THEN -{fraction} ELSE {fraction} END * pow(2D, 4 * ({power} - 64) - {places}) + 0D)"


def float_text(value: str, size: int) -> str:
    """The shortest text of a floating-point number that tells it from its neighbours of the same size."""
    if size == 8:
        return f"cast({value} AS string)"
    fits = f"{value} = 0D OR abs({value}) BETWEEN 1.17549435E-38D AND 3.4028235E38D"
    return f"CASE WHEN {fits} THEN cast(cast({value} AS float) AS string) ELSE cast({value} AS string) END"


def _edited(shown: str, field: Field | Item) -> str:
    """A number edited for print: its digits, where the picture allows the text."""
    picture = Picture.parse(field.picture)
    held = shown
    if "0" in picture.places:  # zeros that are no digits of the number
        held = "concat(" + ", ".join(f"substring({shown}, {i + 1}, 1)" for i in range(field.size) if picture.is_digit(i)) + ")"
    digits = f"concat('0', regexp_replace({held}, '[^0-9]', ''))"
    negative = f"contains({shown}, '-') OR contains({shown}, 'CR') OR contains({shown}, 'DB')"
    sign = f"(CASE WHEN {negative} THEN -1 ELSE 1 END)" if field.signed else "1"
    if field.digits > LONG_DIGITS:
        number = _many_digits(digits, field.digits, field.scale, sign)
    else:
        number = _scaled(f"try_cast({digits} AS bigint) * {sign}", field.digits, field.scale)
    return f"CASE WHEN {shown} RLIKE {literal(f'^(?:{picture.pattern()})$')} THEN {number} END"


def empty(raw: str, field: Field | Item) -> str:
    """Whether a zoned field's raw form is all blanks or low-values: no value, but not bad."""
    # most numbers start with a digit, and one look says so
    return f"coalesce({raw} < '!' AND translate({raw}, {_UNSET}, '') = '', false)"


def unset(raw: str, value: str, field: Field | Item) -> str:
    """:func:`empty`, for a field that has no value: blanks are zero in pictures that suppress every digit."""
    return empty(raw, field) if field.kind != EDITED else f"{empty(raw, field)} AND {value} IS NULL"


def _binary(unsigned: str, field: Field | Item) -> str:
    """Big-endian, two's complement when signed; eight bytes come signed already."""
    whole = unsigned
    if field.signed and field.size < 8:
        half = 1 << (8 * field.size - 1)
        whole = f"(CASE WHEN {whole} >= {half} THEN {whole} - {2 * half} ELSE {whole} END)"
    return _scaled(whole, COMP_DIGITS[field.size], field.scale) if field.scale else whole


def decode(b: str, kind: str, size: int, scale: int = 0, signed: bool = False) -> Column:
    """The value of a field of ``kind`` (``text``, ``zoned``, ``comp`` or ``comp3``) from the
    SQL text of its bytes."""
    field = Item(0, "", kind=kind, size=size, scale=scale, signed=signed)
    return F.expr(value(piece(b, field), field))


def to_hex(b: str) -> str:
    """Lower-case hex view."""
    return f"lower(hex({b}))"


def java_trim(s: str) -> str:
    """Strip characters up to U+0020 at both ends."""
    return f"btrim({s}, {literal(TRIMMED)})"


def quick_trim(s: str) -> str:
    """:func:`java_trim`, looking for control characters before it strips them."""
    return f"CASE WHEN {s} RLIKE '[\\\\x00-\\\\x1F]' THEN {java_trim(s)} ELSE trim({s}) END"


@cache
def _accents(last: int = 0x10FFFF) -> tuple[str, str]:
    """Every character up to ``last`` whose canonical decomposition holds an ASCII character,
    and that character. No decomposition holds two."""
    source, target = [], []
    for code in range(0x80, last + 1):
        if 0xD800 <= code < 0xE000:
            continue
        ascii_part = [c for c in unicodedata.normalize("NFD", chr(code)) if c < "\x80"]
        if ascii_part:
            source.append(chr(code))
            target.append(ascii_part[0])
    return "".join(source), "".join(target)


def clean(s: str, last: int = 0x10FFFF) -> str:
    """Blank line breaks, tabs and backspaces, fold to ASCII, trim.

    Folding is canonical decomposition followed by dropping what is not ASCII,
    written as one character map of characters up to ``last``, the largest in the text (decoded
    records hold none above U+00FF). Printable ASCII, the rule, is only trimmed.
    """
    blanked = reduce(lambda t, chars: f"replace({t}, {literal(chars)}, ' ')", BLANKED, s)
    source, target = _accents(last)
    folded = f"regexp_replace(translate({blanked}, {literal(source)}, {literal(target)}), '[^\\\\x00-\\\\x7F]+', '')"
    is_ascii = f"octet_length({s}) = length({s})"
    return (
        f"CASE WHEN NOT {s} RLIKE '[^ -~]' THEN trim({s}) WHEN {is_ascii} THEN {java_trim(blanked)}"
        f" WHEN NOT {is_ascii} THEN {java_trim(folded)} END"
    )


def comma_decimal(s: str) -> str:
    """Render a decimal point as a comma."""
    return f"replace({s}, '.', ',')"


def marked(value: str) -> str:
    """Text-mode markers: undecodable (NULL) and empty values."""
    return f"CASE WHEN {value} IS NULL THEN '{BAD_MARK}' WHEN {value} = '' THEN '{NULL_MARK}' ELSE {value} END"
