"""Decode records into columns.

Text mode gives what a text table holds: one STRING column per elementary field,
cleaned, with markers for empty and undecodable values. Typed mode gives a schema:
groups become structs, repeated groups arrays, numbers numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainspool.functions import codec
from mainspool.layout import COMP, EDITED, FLOAT, TEXT, ZONED, Field, Item, Layout, Offset, Position, column_names, distinct_name, normalise, placed, plus
from mainspool.operators.occurrences import Cutter
from mainspool.session import java_charsets, limit_generated_methods

RECORD_COLUMNS = ("file", "rec_no", "rec_len", "rec")
DIALECTS = ("mainframe", "comma")

# Repeated groups of up to this many fields in all are decoded without a lambda.
UNROLLED = 64

def bytes_at(at: Position, size: int, source: str = "rec") -> str:
    """Bytes of the record, or of another source, from a 0-based offset."""
    start = at + 1 if isinstance(at, int) else f"cast({at} + 1 AS int)"
    return f"substring({source}, {start}, {size})"


def _count(value: str) -> str:
    return f"greatest(coalesce(cast({value} AS bigint), 0L), 0L)"


def _depending(item: Item) -> set[str]:
    """The counts that groups in an item go by."""
    return {name for c in item.children for name in ({c.depending} if c.depending else set()) | _depending(c)}


class FieldReader:
    """SQL expressions for the fields of one layout over the columns of a scan."""

    def __init__(self, layout: Layout, dialect: str = "mainframe"):
        if dialect not in DIALECTS:
            raise ValueError(f"dialect must be one of {DIALECTS}, not {dialect!r}")
        self.layout = layout
        self.dialect = dialect
        self.counts: dict[str, str] = {}
        self.walks: dict[str, str] = {}
        self.cuts: dict[str, str] = {}
        self.depth = 0

    def count(self, name: str) -> str:
        """The element count a record holds, as a BIGINT; 0 where it holds none."""
        if name not in self.counts:
            self.counts[name] = _count(self.value(self.layout.find(name)))
        return self.counts[name]

    def steps(self, split: str, prefix: str = "", cutting: bool = False) -> list[tuple[str, str | Column]]:
        """What offsets hang on, each a (column, SQL) that may read those before it: counts, and walks. With
        ``cutting`` there are columns of cut occurrences among them (:mod:`mainspool.operators.occurrences`), and
        walks are for records those leave out."""
        out: list[tuple[str, str | Column]] = []
        seen: set[str] = set()

        def count(name: str) -> None:
            if name not in seen:
                seen.add(name)
                visit(self.layout.find(name).offset)
                out.append((column := f"{prefix}_count{len(out)}", self.count(name)))
                self.counts[name] = column

        def visit(offset: Offset) -> None:
            if offset.after:
                walk, _ = offset.after
                visit(walk.start)
                if walk.item.depending:
                    count(walk.item.depending)
                sql = self.walk(walk.item, self.position(walk.start))
                if sql not in seen and sql not in self.walks.values():
                    seen.add(sql)
                    known = sql
                    cutter = Cutter.of(walk.item, split) if cutting and not (walk.start.after or walk.start.needs) else None
                    if cutter:
                        for name in cutter.outside:
                            count(name)
                        said = self.present(walk.item) if not walk.item.depending else self.count(walk.item.depending)
                        cut = cutter.column(f"{self.position(walk.start)}", said, map(self.count, cutter.outside))
                        out.append((column := f"{prefix}_cut{len(out)}", cut))
                        self.cuts[sql] = column
                        sql = f"coalesce({column}.places, {sql})"
                    out.append((column := f"{prefix}_walk{len(out)}", sql))
                    self.walks[known] = column
            for _, name in offset.terms:
                count(name)
            for name, _ in offset.needs:
                count(name)

        for field in self.layout.fields(split):
            visit(field.offset)
        return out

    def typed_columns(self, split: str, reserved: Iterable[str], piece: str, value: str) -> tuple[list[str], list[str], list[tuple[str, str]]]:
        """Raw forms, values, and the named nested columns of typed mode; those of a stage are referred to by
        the prefix ``piece`` or ``value`` and their number."""
        tree = _Tree(self, split, piece, value)
        columns, taken = [], {k.lower() for k in (*reserved, "_bad_fields")}
        for item, offset in self.layout.tops(split):
            name = tree.name(item, taken)
            columns.append((name, tree.column(item, self.position(offset), name)))
        columns.append(("_bad_fields", f"array_compact(array({', '.join(tree.checks)}))"))
        return tree.pieces, tree.values, columns

    def position(self, offset: Offset, known: Mapping[str, str] = {}, source: str = "rec", length: str = "rec_len") -> Position:
        """SQL of an offset in ``source``; ``known`` has counts that lie in ``source``, others lie in the record."""
        at: Position = offset.base
        if offset.after:
            walk, i = offset.after
            places = self.walk(walk.item, self.position(walk.start, known, source, length), known, source, length)
            # a walk ends in the place behind the last occurrence
            found = f"element_at({places}, -1)" if i < 0 else f"CASE WHEN size({places}) > {i + 1} THEN get({places}, {i}) END"
            at = plus(f"({found})", at)
        for size, counter in offset.terms:
            at = plus(at, f"{known.get(counter) or self.count(counter)} * {size}")
        if offset.needs:
            there = " AND ".join(f"{self.count(counter)} > {i}" for counter, i in offset.needs)
            return f"(CASE WHEN {there} THEN {at} END)"
        return at

    def present(self, item: Item, known: Mapping[str, str] = {}) -> str:
        """How many elements there are: the item's own count, at most what the layout allows."""
        if not item.depending:
            return f"{item.occurs}"
        return f"cast(least({known.get(item.depending) or self.count(item.depending)}, {item.occurs}) AS int)"

    def walk(self, item: Item, at: Position, known: Mapping[str, str] = {}, source: str = "rec", length: str = "rec_len") -> str:
        """Where the occurrences of an item of varying length start, and behind them the end of the last: an array
        found by going through the record, each occurrence saying by its own counts where the next one is."""
        depth = self.depth
        self.depth += 1
        places, n = f"w{depth}", f"n{depth}"
        here = f"element_at({places}, -1)"
        behind = self.behind(replace(item, occurs=None, depending=None), here, known, source, length)
        self.depth = depth
        steps = f"slice(sequence(1, {item.occurs}), 1, {self.present(item, known)})"
        sql = f"aggregate({steps}, array(cast({at} AS bigint)), ({places}, {n}) -> concat({places}, array(cast({behind} AS bigint))))"
        return self.walks.get(sql, sql)

    def cut(self, item: Item, at: Position) -> str | None:
        """The column that holds the occurrences of an item cut out, if there is one."""
        walked = self.walk(item, at)
        return next((column for sql, column in self.cuts.items() if walked in (sql, self.walks.get(sql))), None)

    def behind(self, item: Item, at: Position, known: Mapping[str, str], source: str, length: str) -> Position:
        """The place behind an item that starts at ``at``."""
        if item.occurs is not None and item.varies:
            return f"element_at({self.walk(item, at, known, source, length)}, -1)"
        if not item.varies:
            whole = item.total()
            return plus(at, self.position(whole, known, source, length))
        known = {**known, **self.counts_inside(item, at, known, source, length)}
        for child in item.children:
            if not child.redefines:
                at = self.behind(child, at, known, source, length)
        return at

    def counts_inside(self, item: Item, at: Position, known: Mapping[str, str], source: str, length: str) -> dict[str, str]:
        """The counts held in one occurrence of an item that groups in it go by."""
        wanted, out = _depending(item), {}

        def look(items: Iterable[Item], at: Position) -> None:
            for child, offset in placed(items, Offset(at)):
                if child.occurs is None and (child.name in wanted or child.children):
                    where = self.position(offset, {**known, **out}, source, length)
                    if child.kind:
                        out[child.name] = _count(codec.value(f"({self.piece_at(where, child, source, length)})", child))
                    else:
                        look(child.children, where)

        look(item.children, at)
        return out

    def piece_at(self, at: Position, field: Field | Item, source: str = "rec", length: str = "rec_len") -> str:
        """Raw form of a field at an offset; NULL when it reaches past the end of the source."""
        raw = codec.piece(bytes_at(at, field.size, source), field)
        return f"CASE WHEN {length} >= {plus(at, field.size)} THEN {raw} END"

    def piece(self, field: Field) -> str:
        return self.piece_at(self.position(field.offset), field)

    def value(self, field: Field) -> str:
        return codec.value(f"({self.piece(field)})", field)

    def raw(self, field: Field) -> str:
        """The field's bytes."""
        return bytes_at(self.position(field.offset), field.size)

    def as_string(self, field: Field, piece: str | None = None) -> str:
        """The value as text, before cleaning; NULL when undecodable."""
        raw = piece or f"({self.piece(field)})"
        value = codec.value(raw, field)
        if field.kind == TEXT:
            return value
        shown = codec.float_text(value, field.size) if field.kind == FLOAT else f"cast({value} AS string)"
        if self.dialect == "comma" and (field.scale or field.kind == FLOAT):
            shown = codec.comma_decimal(shown)
        return f"CASE WHEN {codec.unset(raw, value, field)} THEN '' ELSE {shown} END" if field.kind in (ZONED, EDITED) else shown

    def as_text(self, field: Field, piece: str | None = None) -> str:
        """The cleaned, trimmed text value; NULL when undecodable."""
        shown = self.as_string(field, piece)
        return codec.clean(shown, 0xFF) if field.kind == TEXT else shown


def typed(value: str, field: Field | Item) -> str:
    """A value in the type of typed mode; NULL if it does not fit."""
    return value if field.kind == TEXT else f"try_cast({value} AS {type_name(field)})"


def type_name(field: Field | Item) -> str:
    """SQL type of a field in typed mode."""
    if field.kind == TEXT:
        return "string"
    if field.kind == FLOAT:
        return "double"
    if field.kind == COMP:
        if field.scale:
            return f"decimal({max(codec.COMP_DIGITS[field.size], field.scale)},{field.scale})"
        if field.size == 8 and not field.signed:
            return "decimal(20,0)"
        return "int" if field.size == 2 else "bigint"
    return f"decimal({field.digits},{field.scale})"


def struct(members: Iterable[tuple[str, str]]) -> str:
    """A struct of (name, SQL text) pairs."""
    return f"named_struct({', '.join(f'{codec.literal(name)}, {sql}' for name, sql in members)})"


def _kept(df: DataFrame, keep: Sequence[str] | None) -> list[str]:
    names = ("file", "rec_no") if keep is None else keep
    return [n for n in names if n in df.columns]


def _with_counts(df: DataFrame, layout: Layout, split: str, dialect: str = "mainframe", cutting: bool = False) -> tuple[DataFrame, FieldReader]:
    """Add what later offsets hang on as columns, each made once."""
    reader = FieldReader(layout, dialect)
    for name, made in reader.steps(split, cutting=cutting):
        df = df.withColumn(name, F.expr(made) if isinstance(made, str) else made)
    return df, reader


def _staged(df: DataFrame, kept: list[str], pieces: Iterable[str]) -> DataFrame:
    """The first projection: raw forms, as columns ``_0``, ``_1``, .."""
    return df.selectExpr(*kept, *(f"{p} AS _{i}" for i, p in enumerate(pieces)))


def decode_text(
    df: DataFrame,
    layout: Layout,
    *,
    split: str = "nosplit",
    dialect: str = "mainframe",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One STRING column per elementary field, in record order, with markers."""
    limit_generated_methods(df.sparkSession)
    kept = _kept(df, keep)
    fields = layout.fields(split)
    names = column_names([f.label for f in fields], kept)
    with java_charsets(df.sparkSession):
        df, reader = _with_counts(df, layout, split, dialect)
        raw = _staged(df, kept, [reader.piece(f) for f in fields])
        values = raw.selectExpr(
            *kept, *(f"{reader.as_text(f, f'_{i}')} AS `{n}`" for i, (f, n) in enumerate(zip(fields, names)))
        )
        return values.selectExpr(*kept, *(f"{codec.marked(f'`{n}`')} AS `{n}`" for n in names))


def decode_flat(
    df: DataFrame, layout: Layout, *, split: str = "nosplit", keep: Sequence[str] | None = None
) -> DataFrame:
    """Typed values in one flat column per elementary field; NULL when undecodable."""
    limit_generated_methods(df.sparkSession)
    kept = _kept(df, keep)
    fields = layout.fields(split)
    names = column_names([f.label for f in fields], kept)
    with java_charsets(df.sparkSession):
        df, reader = _with_counts(df, layout, split)
        raw = _staged(df, kept, [reader.piece(f) for f in fields])
        return raw.selectExpr(
            *kept, *(f"{typed(codec.value(f'_{i}', f), f)} AS `{n}`" for i, (f, n) in enumerate(zip(fields, names)))
        )


class _Tree:
    """Nested columns of a layout, in three projections: raw forms, values, and the nested
    columns with their checks. Each reads a column of the one before several times."""

    def __init__(self, reader: FieldReader, split: str, piece: str, value: str):
        self.reader, self.split, self.piece_name, self.value_name = reader, split, piece, value
        self.pieces: list[str] = []
        self.values: list[str] = []
        self.checks: list[str] = []
        self.fillers = self.lambdas = 0

    def name(self, item: Item, taken: set[str]) -> str:
        """Column name of an item among siblings whose names are taken."""
        base = normalise(item.name)
        if item.is_filler:
            self.fillers += 1
            base = f"{base}_{self.fillers}"
        return distinct_name(base, taken)

    def variable(self) -> str:
        """A new lambda variable."""
        self.lambdas += 1
        return f"x{self.lambdas}"

    def stage(self, piece: str) -> str:
        self.pieces.append(piece)
        return f"{self.piece_name}{len(self.pieces) - 1}"

    def settle(self, value: str) -> str:
        self.values.append(value)
        return f"{self.value_name}{len(self.values) - 1}"

    def members(self, item: Item, at: Position, known: Mapping[str, str] = {}, source: str = "rec", length: str = "rec_len") -> list[tuple[Item, Position, str]]:
        """Named children of a group with their offsets."""
        out, taken = [], set()
        for child, offset in placed(item.children, Offset(at), self.split):
            out.append((child, self.reader.position(offset, known, source, length), self.name(child, taken)))
        return out

    def column(self, item: Item, at: Position, path: str) -> str:
        """Value of an item outside any repeated group."""
        if item.occurs is not None:
            return self.array(item, at, path)
        if item.kind:
            raw = self.stage(self.reader.piece_at(at, item))
            value = self.settle(typed(codec.value(raw, item), item))
            unset = f" AND NOT {self.settle(codec.empty(raw, item))}" if item.kind in (ZONED, EDITED) else ""
            self.checks.append(f"CASE WHEN {value} IS NULL{unset} THEN '{path}' END")
            return value
        return struct([(n, self.column(c, a, f"{path}.{n}")) for c, a, n in self.members(item, at)])

    def array(self, item: Item, at: Position, path: str) -> str:
        """A repeated item outside any other."""
        said = self.reader.count(item.depending) if item.depending else f"{item.occurs}"
        end = f"element_at({self.reader.walk(item, at)}, -1)" if item.varies else plus(at, f"{said} * {item.stride()}")
        fits = f"{said} <= {item.occurs} AND rec_len >= {end}"
        self.checks.append(f"CASE WHEN NOT {self.settle(self.stage(fits))} THEN '{path}' END")
        if item.varies or item.occurs * item.leaves() > UNROLLED:
            elements, shape = self.element(item, at, "rec", {}, "rec_len")
            cut = self.reader.cut(item, at) if item.varies else None
            return self.settle(shape(self.stage(f"coalesce({cut}.raw, {elements})" if cut else elements)))
        # few enough to write out, which stays in generated code; lambdas do not
        one = replace(item, occurs=None, depending=None)
        checks, fillers, elements = self.checks, self.fillers, []
        self.checks = []
        for i in range(item.occurs):
            self.fillers = fillers
            elements.append(self.column(one, plus(at, i * item.stride()), path))
        self.checks = checks
        return f"slice(array({', '.join(elements)}), 1, {self.settle(self.stage(self.reader.present(item)))})"

    def element(self, item: Item, at: Position, source: str, known: Mapping[str, str], length: str) -> tuple[str, Callable[[str], str]]:
        """Array of raw forms of a repeated item, and the function from it to values.

        Each occurrence is cut out of its source first, so that its fields are not each
        cut out of the whole record.
        """
        i, cut = self.variable(), self.variable()
        if item.varies:
            places, start = self.variable(), self.variable()
            walked = self.reader.walk(item, at, known, source, length)
            size = f"cast(get({places}, {i} + 1) - {start} AS int)"
            each = f"transform(slice({places}, 1, size({places}) - 1), ({start}, {i}) -> substring({source}, cast({start} + 1 AS int), {size}))"
            cuts = f"element_at(transform(array({walked}), {places} -> {each}), 1)"
        else:
            subscripts = f"slice(sequence(0, {item.occurs - 1}), 1, {self.reader.present(item, known)})"
            cuts = f"transform({subscripts}, {i} -> {bytes_at(plus(at, f'{i} * {item.stride()}'), item.stride(), source)})"
        raw, shape = self.inside(item, 0, cut, known)
        element = self.variable()
        return f"transform({cuts}, {cut} -> {raw})", lambda raws: f"transform({raws}, {element} -> {shape(element)})"

    def inside(self, item: Item, at: Position, source: str, known: Mapping[str, str]) -> tuple[str, Callable[[str], str]]:
        """Like :meth:`element`, for one occurrence, held in ``source``."""
        length = f"octet_length({source})"
        if item.kind:
            piece = self.reader.piece_at(at, item, source, length)
            return piece, lambda raw: typed(codec.value(raw, item), item)
        raws, shapes = [], []
        known = {**known, **self.reader.counts_inside(item, at, known, source, length)}
        for i, (child, child_at, name) in enumerate(self.members(item, at, known, source, length)):
            if child.occurs is not None:
                raw, shape = self.element(child, child_at, source, known, length)
            else:
                raw, shape = self.inside(child, child_at, source, known)
            raws.append((f"f{i}", raw))
            shapes.append((name, shape))
        return struct(raws), lambda raw: struct([(name, shape(f"{raw}.f{i}")) for i, (name, shape) in enumerate(shapes)])


def decode_typed(
    df: DataFrame, layout: Layout, *, split: str = "nosplit", keep: Sequence[str] | None = None
) -> DataFrame:
    """Typed, nested columns plus ``_bad_fields``: the paths of undecodable fields.

    An undecodable value is NULL. Elements beyond a record's own count are absent; a
    repeated group is bad if its count is too large or it reaches past the record end.
    """
    limit_generated_methods(df.sparkSession)
    kept = _kept(df, keep)
    with java_charsets(df.sparkSession):
        df, reader = _with_counts(df, layout, split, cutting=True)
        pieces, values, columns = reader.typed_columns(split, kept, "_", "_v")
        raw = _staged(df, kept, pieces)
        made = raw.selectExpr(*kept, *(f"{v} AS _v{i}" for i, v in enumerate(values)))
        return made.selectExpr(*kept, *(f"{sql} AS `{name}`" for name, sql in columns))


def decode(df: DataFrame, layout: Layout, mode: str = "text", **options) -> DataFrame:
    """Decode a record DataFrame: ``mode`` is ``text``, ``typed`` or ``flat``."""
    modes = {"text": decode_text, "typed": decode_typed, "flat": decode_flat}
    if mode not in modes:
        raise ValueError(f"mode must be one of {tuple(modes)}, not {mode!r}")
    return modes[mode](df, layout, **options)
