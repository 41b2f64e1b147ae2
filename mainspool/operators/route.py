"""Mixed files: one record type per row, chosen by an ordered catalog of rules."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainspool.functions import codec
from mainspool.layout import MARGINS, TEXT, Field, Layout, column_names
from mainspool.operators.decode import FieldReader, decode, struct, typed
from mainspool.operators.rules import Alternative
from mainspool.session import java_charsets, limit_generated_methods


# The keys of a catalog's JSON.
_HEADER, _RECORDS, _PARTITION = "header_layout", "records", "hive_partition_data"
_TYPE, _LAYOUT, _TABLE = "record", "copy_layout", "hive_table"
_INCLUDE, _EXCLUDE, _VARIANT, _ENTRIES = "include_records", "exclude_records", "name", "entries"
_LOAD_DATE = {
    "day": ("appendCurrentDate", "appendCurrentDay"),
    "month": ("appendCurrentMonth",),
    "year": ("appendCurrentYear",),
}


#: Values of a column that a CASE tells apart; more are looked up in a hash table.
CASES = 32


@dataclass(frozen=True)
class RecordType:
    """One record type: its layout and the rules that pick it.

    ``include`` maps a variant name to the field values that identify it; a type
    without includes takes what no other type takes.
    """

    name: str
    layout: Layout
    include: tuple[tuple[str, Alternative], ...] = ()
    exclude: tuple[tuple[str, Alternative], ...] = ()
    table: str | None = None


@dataclass(frozen=True)
class Catalog:
    """Record types in order of precedence, and how output is partitioned."""

    types: tuple[RecordType, ...]
    partition: Mapping[str, str] = field(default_factory=dict)
    load_date: str | None = None

    @classmethod
    def from_json(
        cls,
        catalog: str | dict,
        load_layout: Callable[[str], str] | Mapping[str, str],
        *,
        margins: tuple[int, int] = MARGINS,
    ) -> Catalog:
        """Build from catalog JSON. ``load_layout`` gives the layout text for a layout name."""
        spec = json.loads(catalog) if isinstance(catalog, str) else catalog
        get = load_layout.__getitem__ if isinstance(load_layout, Mapping) else load_layout

        def layout(name: str) -> Layout:
            return Layout.parse(get(name), margins)

        header = layout(spec[_HEADER]) if spec.get(_HEADER) else None
        types = []
        for record in spec[_RECORDS]:
            body = layout(record[_LAYOUT])
            types.append(
                RecordType(
                    record[_TYPE],
                    header + body if header else body,
                    _variants(record.get(_INCLUDE)),
                    _variants(record.get(_EXCLUDE)),
                    record.get(_TABLE),
                )
            )
        return cls(tuple(types), _pairs(spec.get(_PARTITION)), _load_date(spec))

    def type(self, name: str) -> RecordType:
        for t in self.types:
            if t.name == name:
                return t
        raise KeyError(name)


def _variants(entries: list[dict] | None) -> tuple[tuple[str, Alternative], ...]:
    return tuple((e[_VARIANT], tuple(e[_ENTRIES].items())) for e in entries or ())


def _pairs(text: str | None) -> dict[str, str]:
    """``K=v,K2=v2`` as a dict, in order."""
    pairs = (p.partition("=") for p in (text or "").split(",") if p.strip())
    return {k.strip(): v for k, _, v in pairs}


def _load_date(spec: dict) -> str | None:
    """The finest load-date part asked for."""
    flags = {part: any(spec.get(key) for key in keys) for part, keys in _LOAD_DATE.items()}
    return next((part for part, on in flags.items() if on), None)


class _Looks:
    """The field values rules look at: raw forms, texts and joined values, each made once."""

    def __init__(self, prefix: str, dialect: str):
        self.prefix, self.dialect = prefix, dialect
        self.raws: dict[tuple, tuple[str, str]] = {}
        self.texts: dict[tuple, tuple[str, str]] = {}
        self.joined: dict[tuple, tuple[str, str]] = {}
        self.found: dict[tuple[int, str], Field] = {}

    def _field(self, layout: Layout, name: str) -> Field:
        if (id(layout), name) not in self.found:
            self.found[id(layout), name] = layout.find(name)
        return self.found[id(layout), name]

    def _text(self, record_type: RecordType, name: str, only: str | None) -> str:
        """The column of a field's trimmed text; ``only`` names the type it is read for."""
        layout = record_type.layout
        field, reader = self._field(layout, name), FieldReader(layout, self.dialect)
        # a field of a shared header is the same look in every type
        key = (only, field)
        if key not in self.raws:
            piece = reader.piece(field)
            raw = f"{self.prefix}r{len(self.raws)}"
            self.raws[key] = (raw, piece if only is None else f"CASE WHEN rec_type = {codec.literal(only)} THEN {piece} END")
            self.texts[key] = (f"{self.prefix}t{len(self.texts)}", reader.as_string(field, raw))
        return f"trimmed_{self.texts[key][0]}" if field.kind == TEXT else self.texts[key][0]

    def key(self, record_type: RecordType, rule: Alternative, only: str | None = None) -> tuple[str, str]:
        """The column of the joined values a rule looks at, read by the type's layout, and the value that matches."""
        columns = tuple(self._text(record_type, name, only) for name, _ in rule)
        if columns not in self.joined:
            # numbers have no blanks
            shown = [codec.quick_trim(c[8:]) if c.startswith("trimmed_") else c for c in columns]
            self.joined[columns] = (f"{self.prefix}j{len(self.joined)}", f"lower(concat({', '.join(shown)}))")
        return self.joined[columns][0], "".join(v for _, v in rule).lower()

    def onto(self, df: DataFrame) -> DataFrame:
        """The looks as columns, in three projections, each of which reads the one before."""
        for made in (self.raws, self.texts, self.joined):
            df = df.selectExpr("*", *(f"{sql} AS {name}" for name, sql in made.values()))
        return df


def _ranked(df: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Adds ``_rank``, the place of the first rule ``(column, value)`` that holds, or NULL.

    Rules that look at the same column are one lookup of its value, each value with the first place it has: a CASE
    where they are few, a hash join with the values sent along where they are many. So the work per record
    grows with the fields looked at, not with the rules.
    """
    places: dict[str, dict[str, int]] = {}
    for i, (column, value) in enumerate(rules):
        places.setdefault(column, {}).setdefault(value, i)
    found = []
    for n, (column, first) in enumerate(places.items()):
        if len(first) <= CASES:
            chain = " ".join(f"WHEN {codec.literal(v)} THEN {i}" for v, i in first.items())
            found.append(F.expr(f"CASE {column} {chain} END"))
            continue
        table = df.sparkSession.createDataFrame(list(first.items()), f"_value{n} string, _place{n} int")
        df = df.join(F.broadcast(table), F.col(column) == F.col(f"_value{n}"), "left")
        found.append(F.col(f"_place{n}"))
    rank = F.lit(None).cast("int") if not found else found[0] if len(found) == 1 else F.least(*found)
    return df.withColumn("_rank", rank)


def _at_rank(values: Sequence[str | None], default: str | None) -> Column:
    """The value of the rule at ``_rank``."""
    if not values:
        return F.lit(default).cast("string")
    return F.when(F.col("_rank").isNull(), F.lit(default)).otherwise(F.get(F.array(*map(F.lit, values)), F.col("_rank")))


def classify(df: DataFrame, catalog: Catalog, dialect: str = "mainframe") -> DataFrame:
    """All records with ``rec_type`` and ``rec_variant``; NULL where no type takes them.

    The first matching rule in catalog order wins. An exclude rule then rejects the
    records it matches, whichever type it is listed under, if the record's own layout
    has the rule's fields; its fields are read only in records of that type.
    """
    looks, later = _Looks("_in_", dialect), _Looks("_ex_", dialect)
    named = [(t.name, variant, rule, t) for t in catalog.types for variant, rule in t.include]
    keys = [looks.key(t, rule) for _, _, rule, t in named]
    default = next((t.name for t in catalog.types if not t.include), None)
    unwanted: dict[str, set[str]] = {}
    has: dict[tuple[str, str], bool] = {}
    for t in catalog.types:
        for other in catalog.types:
            for _, rule in other.exclude:
                for name, _ in rule:
                    if (t.name, name) not in has:
                        has[t.name, name] = t.layout.has(name)
                if all(has[t.name, name] for name, _ in rule):
                    column, value = later.key(t, rule, t.name)
                    unwanted.setdefault(column, set()).add(value)
    with java_charsets(df.sparkSession):
        typed = _ranked(looks.onto(df), keys).select(
            *df.columns,
            _at_rank([name for name, *_ in named], default).alias("rec_type"),
            _at_rank([variant for _, variant, *_ in named], default).alias("rec_variant"),
        )
        if unwanted:
            hits = [F.coalesce(F.col(column).isin(sorted(values)), F.lit(False)) for column, values in unwanted.items()]
            typed = later.onto(typed).withColumn("_dropped", reduce(lambda a, b: a | b, hits)).withColumns(
                {c: F.when(F.col("_dropped"), None).otherwise(F.col(c)) for c in ("rec_type", "rec_variant")}
            )
        return typed.select(*df.columns, "rec_type", "rec_variant")


def route(df: DataFrame, catalog: Catalog, dialect: str = "mainframe") -> DataFrame:
    """Records some type takes, with ``rec_type`` and ``rec_variant``."""
    return classify(df, catalog, dialect).filter(F.col("rec_type").isNotNull())


def unrouted(df: DataFrame, catalog: Catalog, dialect: str = "mainframe") -> DataFrame:
    """Records no type takes, or an exclude rule rejects."""
    return classify(df, catalog, dialect).filter(F.col("rec_type").isNull()).drop("rec_type", "rec_variant")


def decode_type(routed: DataFrame, catalog: Catalog, name: str, mode: str = "text", **options) -> DataFrame:
    """Records of one type, decoded with that type's layout."""
    options.setdefault("keep", ("file", "rec_no", "rec_variant"))
    return decode(routed.filter(F.col("rec_type") == name), catalog.type(name).layout, mode, **options)


def decode_types(routed: DataFrame, catalog: Catalog, mode: str = "text", **options) -> dict[str, DataFrame]:
    """One lazy DataFrame per record type, each a scan of its own when it is run.

    Where several types are wanted, :func:`decode_routed` gives all of them in one scan.
    """
    return {t.name: decode_type(routed, catalog, t.name, mode, **options) for t in catalog.types}


def decode_routed(
    routed: DataFrame,
    catalog: Catalog,
    mode: str = "flat",
    *,
    keep: Sequence[str] = (),
    split: str = "nosplit",
    dialect: str = "mainframe",
    reserved: Sequence[str] = (),
) -> DataFrame:
    """Every record decoded by its own type, in one scan: ``keep``, ``rec_type`` and a struct
    column per type, named after it, that is NULL in records of other types.

    In ``text`` and ``flat`` mode a struct has a field per elementary field; in ``typed`` mode
    it is nested and ends in ``_bad_fields``. Names avoid the ``reserved`` ones. All types share three
    projections, one for raw forms, one for values and one for what is made of them, however many types there are.
    """
    if mode not in ("text", "flat", "typed"):
        raise ValueError(f"mode must be text, typed or flat, not {mode!r}")
    limit_generated_methods(routed.sparkSession)
    kept = [k for k in keep if k != "rec_type"]
    shapes = [_Shape(i, t, mode, split, dialect, reserved) for i, t in enumerate(catalog.types)]
    names = [f"`{k}`" for k in kept] + ["rec_type"]
    with java_charsets(routed.sparkSession):
        df = routed.selectExpr(*names, *(c for c in ("rec", "rec_len") if c not in kept))
        for k in range(max((len(s.steps) for s in shapes), default=0)):
            # a step may read the one before it, in each type
            made = [(s.own, *s.steps[k]) for s in shapes if k < len(s.steps)]
            df = df.selectExpr("*", *(f"CASE WHEN {own} THEN {sql} END AS {name}" for own, name, sql in made))
        for shape in shapes:
            shape.plan()
        df = df.selectExpr(*names, *(s.struct(s.pieces, "_p") for s in shapes))
        df = df.selectExpr(*names, *(s.struct(s.values, "_v") for s in shapes))
        df = df.selectExpr(*names, *(s.struct(s.columns, "_t") for s in shapes))
        return df.select(*kept, "rec_type", *(F.col(f"_t{s.i}").alias(s.type.name) for s in shapes))


class _Shape:
    """The expressions of one type's decode, as members of structs that are NULL in other types' records."""

    def __init__(self, i: int, record_type: RecordType, mode: str, split: str, dialect: str, reserved: Sequence[str]):
        self.i, self.type, self.mode, self.split, self.reserved = i, record_type, mode, split, reserved
        self.own = f"rec_type = {codec.literal(record_type.name)}"
        self.reader = FieldReader(record_type.layout, dialect)
        self.steps = self.reader.steps(split, f"_{i}")
        self.pieces: list[tuple[str, str]] = []
        self.values: list[tuple[str, str]] = []
        self.columns: list[tuple[str, str]] = []

    def plan(self) -> None:
        p, v = f"_p{self.i}.p", f"_v{self.i}.v"
        if self.mode == "typed":
            pieces, values, columns = self.reader.typed_columns(self.split, self.reserved, p, v)
            self.columns = columns
        else:
            fields = self.type.layout.fields(self.split)
            names = column_names([f.label for f in fields], self.reserved)
            pieces = [self.reader.piece(f) for f in fields]
            if self.mode == "flat":
                values = [typed(codec.value(f"{p}{k}", f), f) for k, f in enumerate(fields)]
                self.columns = [(n, f"{v}{k}") for k, n in enumerate(names)]
            else:
                values = [self.reader.as_text(f, f"{p}{k}") for k, f in enumerate(fields)]
                self.columns = [(n, codec.marked(f"{v}{k}")) for k, n in enumerate(names)]
        self.pieces = [(f"p{k}", sql) for k, sql in enumerate(pieces)]
        self.values = [(f"v{k}", sql) for k, sql in enumerate(values)]

    def struct(self, members: list[tuple[str, str]], prefix: str) -> str:
        return f"CASE WHEN {self.own} THEN {struct(members)} END AS {prefix}{self.i}"
