"""Keep and drop records by field values, length or a hex marker.

A rule spec is ``A=1,B=2:C=3``: ``:`` separates alternatives, ``,`` joins the fields
of one alternative. An alternative matches when its trimmed field values, joined,
equal its literals, joined, ignoring case. Joining means ``A=1,B=23`` also matches
A=12, B=3; ``strict=True`` compares field by field.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainspool.functions import codec
from mainspool.layout import COMP, COMP3, TEXT, Layout, LayoutError
from mainspool.operators.decode import FieldReader, plus
from mainspool.session import java_charsets
from mainspool.sources.pushed import Look, Place, RawFilter

Alternative = tuple[tuple[str, str], ...]


def parse_rules(spec: str | None) -> tuple[Alternative, ...]:
    """The alternatives of a rule spec; none for an empty spec."""
    alternatives = []
    for group in (spec or "").split(":"):
        if not group.strip():
            continue
        pairs = []
        for term in group.split(","):
            name, sep, literal = term.partition("=")
            if not sep or not name.strip():
                raise ValueError(f"rule term {term!r} is not FIELD=value")
            pairs.append((name.strip(), literal))
        alternatives.append(tuple(pairs))
    return tuple(alternatives)


def joined(reader: FieldReader, names: Sequence[str]) -> str:
    """SQL of the trimmed values of some fields, joined, in lower case; NULL if one is
    undecodable."""
    shown = []
    for field in map(reader.layout.find, names):
        text = reader.as_string(field)
        shown.append(codec.quick_trim(text) if field.kind == TEXT else text)  # numbers have no blanks
    return f"lower(concat({', '.join(shown)}))"


def matches(reader: FieldReader, alternatives: Sequence[Alternative], strict: bool = False) -> Column:
    """True where any alternative matches. A field that cannot be decoded matches nothing."""
    if strict:
        found = [
            " AND ".join(f"{joined(reader, [n])} = {codec.literal(v.lower())}" for n, v in pairs)
            for pairs in alternatives
        ]
    else:
        # alternatives on the same fields share one look at them
        literals: dict[tuple[str, ...], list[str]] = {}
        for pairs in alternatives:
            wanted = codec.literal("".join(v for _, v in pairs).lower())
            literals.setdefault(tuple(n for n, _ in pairs), []).append(wanted)
        found = [f"{joined(reader, names)} IN ({', '.join(wanted)})" for names, wanted in literals.items()]
    return F.expr(f"coalesce({' OR '.join(f'({f})' for f in found)}, false)")


def raw_filter(
    layout: Layout | None = None,
    *,
    include: str | None = None,
    exclude: str | None = None,
    record_length: int | None = None,
    strict: bool = False,
) -> RawFilter | None:
    """What a scan can leave out by these rules before records become rows: a part of what
    :func:`select_records` drops, to be applied behind it as well. None where that is nothing."""
    wanted = _looks(layout, parse_rules(include), strict)
    # a rule that cannot be read from bytes may let any record in
    included = None if not wanted or None in wanted else tuple(wanted)
    excluded = tuple(look for look in _looks(layout, parse_rules(exclude), strict) if look is not None)
    if record_length is None and included is None and not excluded:
        return None
    return RawFilter(record_length, included, excluded)


def _looks(layout: Layout | None, alternatives: Sequence[Alternative], strict: bool) -> list[Look | None]:
    """A look per set of fields; None for fields whose bytes do not tell."""
    literals: dict[tuple[str, ...], set] = {}
    for pairs in alternatives:
        values = tuple(v.lower() for _, v in pairs)
        literals.setdefault(tuple(n for n, _ in pairs), set()).add(values if strict else "".join(values))
    out: list[Look | None] = []
    for names, values in literals.items():
        fields = [layout.find(n) for n in names]
        plain = all(not f.offset.terms and (f.kind == TEXT or f.kind in (COMP, COMP3) and not f.scale) for f in fields)
        places = tuple(Place(f.offset.base, f.size, f.kind, f.signed) for f in fields)
        out.append(Look(places, frozenset(values), strict) if plain else None)
    return out


def include(df: DataFrame, layout: Layout, spec: str, *, strict: bool = False) -> DataFrame:
    """Records that match the spec; an empty spec keeps all."""
    return select_records(df, layout, include=spec, strict=strict)


def exclude(df: DataFrame, layout: Layout, spec: str, *, strict: bool = False) -> DataFrame:
    """Records that do not match the spec."""
    return select_records(df, layout, exclude=spec, strict=strict)


def select_records(
    df: DataFrame,
    layout: Layout | None = None,
    *,
    include: str | None = None,
    exclude: str | None = None,
    record_length: int | None = None,
    strict: bool = False,
    dialect: str = "mainframe",
) -> DataFrame:
    """Records that match ``include``, do not match ``exclude`` and have the length."""
    keep: list[Column] = []
    if record_length is not None:
        keep.append(F.col("rec_len") == record_length)
    wanted, unwanted = parse_rules(include), parse_rules(exclude)
    if wanted or unwanted:
        if layout is None:
            raise LayoutError("rules on fields need a layout")
        reader = FieldReader(layout, dialect=dialect)
        if wanted:
            keep.append(matches(reader, wanted, strict))
        if unwanted:
            keep.append(~matches(reader, unwanted, strict))
    with java_charsets(df.sparkSession):
        for condition in keep:
            df = df.filter(condition)
        return df


def record_length(df: DataFrame, n: int) -> DataFrame:
    """Records of exactly ``n`` bytes."""
    return select_records(df, record_length=n)


def skip_records(df: DataFrame, layout: Layout, name: str, hex_value: str, *, unless: Column | None = None) -> DataFrame:
    """Drop records whose field holds exactly these bytes, given in hex; rows where ``unless`` is
    true stay whatever they hold."""
    reader, field = FieldReader(layout), layout.find(name)
    # a field that reaches past the record's end holds nothing that could be compared
    inside = f"rec_len >= {plus(reader.position(field.offset), field.size)}"
    held = f"CASE WHEN {inside} THEN {codec.to_hex(reader.raw(field))} ELSE '' END"
    with java_charsets(df.sparkSession):
        differs = F.expr(held) != hex_value.lower()
        return df.filter(differs if unless is None else unless | differs)


def drop_header_only(df: DataFrame, header_len: int) -> DataFrame:
    """Drop records no longer than the header."""
    return df.filter(F.col("rec_len") > header_len)
