"""Record layouts: the ordered, typed fields of a fixed-position record.

A :class:`Layout` is what a schema is to a parquet file: it is built once on the
driver from COBOL-style data description text and afterwards only supplies byte
positions and types to the Column expressions in :mod:`mainspool.functions` and
:mod:`mainspool.operators.decode`. No data passes through this module.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field, replace

TEXT, ZONED, COMP, COMP3 = "text", "zoned", "comp", "comp3"
FLOAT, EDITED = "float", "edited"
SPLITS = ("nosplit", "redefine", "level1")

# Source columns that hold layout text (0-based slice).
MARGINS = (5, 72)

_USAGES = {
    "COMP": COMP,
    "COMP-4": COMP,
    "COMP-5": COMP,
    "COMPUTATIONAL": COMP,
    "BINARY": COMP,
    "COMP-1": "float4",
    "COMPUTATIONAL-1": "float4",
    "COMP-2": "float8",
    "COMPUTATIONAL-2": "float8",
    "COMP-3": COMP3,
    "COMPUTATIONAL-3": COMP3,
    "PACKED-DECIMAL": COMP3,
    "DISPLAY": ZONED,
}


# Bytes of the floating-point usages.
_FLOATS = {"float4": 4, "float8": 8}


class LayoutError(ValueError):
    """The layout text describes something the engine cannot decode."""


# 0-based byte offset: a number, or SQL text where only a record tells
Position = int | str


def plus(at: Position, more: Position) -> Position:
    if isinstance(at, int) and isinstance(more, int):
        return at + more
    return at if more == 0 else f"({at} + {more})"


@dataclass(frozen=True)
class Offset:
    """A byte offset: a constant plus ``size * count(field)`` terms, from the start of the record or from
    a place that only a walk of the record finds.

    The terms appear only behind a repeated group whose length depends on a
    count held in the record itself. ``after`` is a walk and the occurrence whose start is meant, or -1 for the
    end of the last; it appears in and behind a repeated group whose occurrences differ in length. ``needs`` names
    counts that must exceed a number for the place to be there.
    """

    base: Position = 0
    terms: tuple[tuple[int, str], ...] = ()
    after: tuple[Walk, int] | None = None
    needs: tuple[tuple[str, int], ...] = ()

    def __add__(self, other: Offset | int) -> Offset:
        if isinstance(other, int):
            return replace(self, base=plus(self.base, other))
        return replace(self, base=plus(self.base, other.base), terms=self.terms + other.terms)


@dataclass(frozen=True)
class Item:
    """One data description entry; ``children`` is empty for elementary items."""

    level: int
    name: str
    kind: str | None = None
    size: int = 0
    digits: int = 0
    scale: int = 0
    signed: bool = False
    sign: str = ""
    usage: str | None = None
    picture: str = ""
    redefines: str | None = None
    occurs: int | None = None
    depending: str | None = None
    children: tuple[Item, ...] = ()

    @property
    def is_filler(self) -> bool:
        return "FILLER" in self.name

    def span(self) -> Offset:
        """Bytes taken by one occurrence."""
        if self.kind:
            return Offset(self.size)
        return _span_of(self.children)

    @property
    def varies(self) -> bool:
        """Whether occurrences differ in length: they hold a group repeated by a count."""
        return any(not c.redefines and (c.depending is not None or c.varies) for c in self.children)

    def stride(self) -> int:
        """Bytes taken by one occurrence of a repeated item; must be constant."""
        if self.varies:
            raise LayoutError(f"{self.name}: occurrences differ in length")
        return self.span().base

    def end(self, at: Offset) -> Offset:
        """The offset behind all occurrences of an item that starts at ``at``."""
        if self.occurs is not None and self.varies:
            return Offset(0, (), (Walk(self, at), -1))
        if not self.varies:
            return at + self.total()
        for child in self.children:
            if not child.redefines:
                at = child.end(at)
        return at

    def fields_inside(self) -> dict[str, Item]:
        """The elementary items of one occurrence that are not repeated in it, by name."""
        out: dict[str, Item] = {}
        for child in self.children:
            if child.occurs is None:
                out |= {child.name: child} if child.kind else child.fields_inside()
        return out

    def counted_by(self, labels: Mapping[str, str]) -> Item:
        """The item with the counts of groups in it renamed."""
        return replace(
            self,
            depending=labels.get(self.depending, self.depending) if self.depending else None,
            children=tuple(c.counted_by(labels) for c in self.children),
        )

    def total(self) -> Offset:
        """Bytes taken by all occurrences."""
        if self.occurs is None:
            return self.span()
        if self.depending:
            return Offset(0, ((self.stride(), self.depending),))
        return Offset(self.stride() * self.occurs)

    def leaves(self) -> int:
        """Elementary fields in one occurrence."""
        return 1 if self.kind else sum(c.leaves() * (c.occurs or 1) for c in self.children)

    def max_bytes(self) -> int:
        one = self.size if self.kind else _max_bytes_of(self.children)
        return one * (self.occurs or 1)


@dataclass(frozen=True)
class Walk:
    """A repeated item whose occurrences differ in length, and where it starts."""

    item: Item
    start: Offset


def _span_of(items: Iterable[Item]) -> Offset:
    span = Offset()
    for item in items:
        if not item.redefines:
            span = span + item.total()
    return span


def _max_bytes_of(items: Iterable[Item]) -> int:
    return sum(i.max_bytes() for i in items if not i.redefines)


def label(name: str, subscripts: tuple[int, ...]) -> str:
    """A name with the subscripts of its occurrence."""
    return f"{name} ({', '.join(map(str, subscripts))})" if subscripts else name


@dataclass(frozen=True)
class Field:
    """An elementary field at one position (one per subscript combination)."""

    name: str
    offset: Offset
    size: int
    kind: str
    digits: int = 0
    scale: int = 0
    signed: bool = False
    sign: str = ""
    subscripts: tuple[int, ...] = ()
    picture: str = ""

    @property
    def label(self) -> str:
        """Display name; repeated fields carry their subscripts."""
        return label(self.name, self.subscripts)


def placed(items: Iterable[Item], start: Offset, split: str = "nosplit") -> Iterator[tuple[Item, Offset]]:
    """Pair sibling items with their start offsets; overlays start where their target does."""
    starts: dict[str, Offset] = {}
    at = start
    for item in items:
        if item.redefines:
            if item.redefines not in starts:
                raise LayoutError(f"{item.name} redefines unknown item {item.redefines}")
            if split != "redefine":
                yield item, starts[item.redefines]
            starts.setdefault(item.name, starts[item.redefines])
            continue
        starts[item.name] = at
        yield item, at
        at = item.end(at)


def _flatten(item: Item, start: Offset, subs: tuple[int, ...], split: str) -> Iterator[Field]:
    for i in range(item.occurs) if item.occurs is not None else (None,):
        here, one = (subs, item) if i is None else (subs + (i,), item)
        if i is None:
            at = start
        elif item.varies:
            at = Offset(0, (), (Walk(item, start), i))
            # counts held by the occurrence are those of this one
            one = item.counted_by({n: label(n, here) for n in item.fields_inside()})
        else:
            at = start + item.stride() * i
            if item.depending and (start.after or start.needs):
                # behind its last element a nested group's record goes on with something else
                at = replace(at, needs=(*at.needs, (item.depending, i)))
        if item.kind:
            yield Field(item.name, at, item.size, item.kind, item.digits, item.scale, item.signed, item.sign, here, item.picture)
        else:
            for child, child_at in placed(one.children, at, split):
                yield from _flatten(child, child_at, here, split)


@dataclass(frozen=True)
class Layout:
    """Parts laid end to end; the entries of one part are either its items in
    order, or several level-01 views of the same bytes."""

    parts: tuple[tuple[Item, ...], ...] = field(default=())

    @classmethod
    def parse(cls, text: str, margins: tuple[int, int] = MARGINS) -> Layout:
        return cls((_parse_items(text, margins),))

    def __add__(self, other: Layout) -> Layout:
        return Layout(self.parts + other.parts)

    def tops(self, split: str = "nosplit") -> list[tuple[Item, Offset]]:
        """Top-level items with offsets; level-01 groups are opened."""
        if split not in SPLITS:
            raise LayoutError(f"split must be one of {SPLITS}, not {split!r}")
        out: list[tuple[Item, Offset]] = []
        at = Offset()
        for part in self.parts:
            views = _views(part)
            for view in views[:1] if split == "level1" else views:
                out += placed(view, at, split)
            for item in views[0]:
                if not item.redefines:
                    at = item.end(at)
        return out

    def fields(self, split: str = "nosplit") -> list[Field]:
        """Every elementary field in record order, one entry per subscript."""
        return [f for item, at in self.tops(split) for f in _flatten(item, at, (), split)]

    def find(self, name: str) -> Field:
        """Look a field up by its layout name or its column name, ignoring case."""
        wanted = {name.strip().upper(), normalise(name).upper()}
        for f in self.fields():
            if f.label.upper() in wanted or normalise(f.label).upper() in wanted:
                return f
        raise LayoutError(f"no field {name!r} in layout")

    def has(self, name: str) -> bool:
        try:
            self.find(name)
        except LayoutError:
            return False
        return True

    @property
    def max_length(self) -> int:
        return sum(max(_max_bytes_of(v) for v in _views(p)) for p in self.parts)

    def columns(self, split: str = "nosplit") -> list[str]:
        return column_names([f.label for f in self.fields(split)])


def _views(part: tuple[Item, ...]) -> list[tuple[Item, ...]]:
    """Level-01 groups are alternative views of one record; other items are one view."""
    if part and all(i.level == 1 and not i.kind and i.occurs is None for i in part):
        return [i.children for i in part]
    return [part]


def normalise(name: str) -> str:
    """Column name for a field: ``,`` ``-`` and blank become ``_``; parentheses go."""
    return re.sub(r"[()]", "", re.sub(r"[, -]", "_", name.strip()))


def distinct_name(name: str, taken: set[str]) -> str:
    """``name``, or where it is taken (in any case) with the first free ending ``_2``, ``_3``, ..;
    the name given out is taken from then on."""
    free, n = name, 1
    while free.lower() in taken:
        n += 1
        free = f"{name}_{n}"
    taken.add(free.lower())
    return free


def column_names(labels: Iterable[str], kept: Iterable[str] = ()) -> list[str]:
    """Normalised names; fillers get a running number, names that repeat an earlier one, or one
    of the ``kept`` columns, an ending (:func:`distinct_name`)."""
    out, fillers, taken = [], 0, {k.lower() for k in kept}
    for label in labels:
        name = normalise(label)
        if "FILLER" in name:
            fillers += 1
            name = f"{name}_{fillers}"
        out.append(distinct_name(name, taken))
    return out


# --- edited pictures ---------------------------------------------------------------

# What picture characters stand for.
_FILL = {"Z": " ", "*": "*"}
_INSERTED = {",": ",", "B": " ", "0": "0", "/": "/"}
_FLOATING = "+-$"


@dataclass(frozen=True)
class Picture:
    """A number edited for print: what each character of its text may be.

    ``places`` has a symbol per character: ``9`` a digit, ``Z`` or ``*`` a digit or its fill character, ``+ - $`` more
    than once a floating symbol, once a fixed one, ``, B 0 /`` inserted, ``.`` the point, ``CR`` and ``DB`` two places.
    """

    places: tuple[str, ...]
    digits: int
    scale: int
    signed: bool

    @classmethod
    def parse(cls, flat: str) -> Picture:
        body, tail = flat, ()
        if flat.endswith(("CR", "DB")):
            body, tail = flat[:-2], (flat[-2:-1] + "1", flat[-2:-1] + "2")
        point = body.find(".") if "." in body else body.find("V")
        places = tuple(body.replace("V", ""))
        floating = next((c for c in _FLOATING if body.count(c) > 1), "")
        if not re.fullmatch(r"[+\-$]?[+\-$]*[Z*9,B0/.V+\-$]*[+\-]?", body) or body.count(".") + body.count("V") > 1:
            raise LayoutError(f"unsupported picture {flat}")
        symbols = [c for c in body if c in "9Z*" or c == floating]
        digits = len(symbols) - bool(floating)
        behind = [c for c in body[point + 1 :] if c in "9Z*" or c == floating] if point >= 0 else []
        if digits < 1 or "Z" in body and "*" in body or floating and ("Z" in body or "*" in body):
            raise LayoutError(f"unsupported picture {flat}")
        return cls(places + tail, digits, len(behind), bool(tail) or "+" in body or "-" in body)

    @property
    def floating(self) -> str:
        return next((c for c in _FLOATING if self.places.count(c) > 1), "")

    def is_digit(self, i: int) -> bool:
        """Whether a place may hold a digit of the number; the first floating symbol never does."""
        c = self.places[i]
        return c in ("9", "Z", "*") or bool(self.floating) and c == self.floating and i != self.places.index(c)

    def pattern(self) -> str:
        """A regular expression of the texts the picture allows: with each number of suppressed places, those are
        filled, a floating symbol stands at their end, and from there on all is as in the picture."""
        n, first = len(self.places), next((i for i, c in enumerate(self.places) if c in _FILL or c == self.floating), None)
        if first is None:
            return "".join(self._plain(i) for i in range(n))
        stop = first  # behind the last place that may be suppressed, at most the point
        for i in range(first, n):
            c = self.places[i]
            if c in _FILL or c == self.floating:
                stop = i + 1
            elif c not in _INSERTED:
                break
        fill = _FILL.get(self.places[first], " ")
        front, behind = "".join(self._plain(i) for i in range(first)), "".join(self._plain(i) for i in range(stop, n))
        ways = []
        for cut in range(first + bool(self.floating), stop + 1):
            if cut == stop or self.is_digit(cut):
                filled = cut - first - bool(self.floating)
                symbol = self._sign(self.floating) if self.floating else ""
                ways.append(re.escape(fill) * filled + symbol + "".join(self._plain(i) for i in range(cut, stop)))
        found = f"{front}(?:{'|'.join(ways)}){behind}"
        if any(self.places[i] == "9" for i in range(n)):
            return found
        # nothing but suppressed digits: zero is all filled, but for a point among asterisks
        zero = "".join("\\." if c == "." and fill == "*" else "." if c in ("C1", "C2", "D1", "D2") else re.escape(fill) for c in self.places)
        return f"(?:{found}|{zero}| {{{n}}})"

    def _sign(self, c: str) -> str:
        return {"+": "[+-]", "-": "[ -]", "$": "\\$"}[c]

    def _plain(self, i: int) -> str:
        """The pattern of one unsuppressed place."""
        c = self.places[i]
        if self.is_digit(i):
            return "[0-9]"
        if c in _FLOATING:
            return self._sign(c)
        if c in ("C1", "D1"):
            return "(?:CR|  )" if c == "C1" else "(?:DB|  )"
        if c in ("C2", "D2"):
            return ""
        return re.escape(_INSERTED.get(c, c))


# --- layout text ------------------------------------------------------------------

_TOKEN = re.compile(r"'[^']*'\.?|\"[^\"]*\"\.?|\S+")
_CLAUSES = {"REDEFINES", "OCCURS", "PIC", "PICTURE", "USAGE", "VALUE", "VALUES", "SIGN", *_USAGES}


def _sentences(text: str, margins: tuple[int, int]) -> Iterator[list[str]]:
    words: list[str] = []
    for line in text.replace("\r", "").split("\n"):
        body = line.expandtabs(8)[margins[0] : margins[1]]
        if body.strip()[:1] in ("*", "/"):
            continue
        for word in _TOKEN.findall(body):
            done = word.endswith(".")
            word = word.rstrip(".") if done else word
            if word:
                words.append(word if word[:1] in "'\"" else word.upper())
            if done and words:
                yield words
                words = []
    if words:
        yield words


def _picture(pic: str) -> tuple[str, int, int, bool, int]:
    """(class, digits, scale, signed, text size) of a picture string."""
    flat = re.sub(r"(.)\((\d+)\)", lambda m: m[1] * int(m[2]), pic)
    if re.fullmatch(r"[XA]+", flat):
        return TEXT, 0, 0, False, len(flat)
    number = re.fullmatch(r"(S?)(9*)(?:V(9*))?", flat)
    if not number or not (number[2] or number[3]):
        edited = Picture.parse(flat)
        return EDITED, edited.digits, edited.scale, edited.signed, len(edited.places)
    scale = len(number[3] or "")
    return ZONED, len(number[2]) + scale, scale, bool(number[1]), 0


def _entry(words: list[str]) -> Item | None:
    if not words[0].isdigit():
        raise LayoutError(f"expected a level number, got {' '.join(words)!r}")
    level = int(words[0])
    if level in (66, 88):
        return None
    rest = words[1:]
    name = "FILLER"
    if rest and rest[0] not in _CLAUSES:
        name = rest.pop(0)
    pic = usage = redefines = depending = None
    occurs, sign = None, set()
    while rest:
        word = rest.pop(0)
        if word == "REDEFINES":
            redefines = rest.pop(0)
        elif word == "OCCURS":
            occurs = int(rest.pop(0))
            if rest[:1] == ["TO"]:
                rest.pop(0)
                occurs = int(rest.pop(0))
        elif word == "DEPENDING":
            if rest[:1] == ["ON"]:
                rest.pop(0)
            depending = rest.pop(0)
        elif word in ("PIC", "PICTURE"):
            pic = rest.pop(0)
            if pic == "IS":
                pic = rest.pop(0)
        elif word in _USAGES:
            usage = _USAGES[word]
        elif word in ("VALUE", "VALUES"):
            break
        elif word in ("LEADING", "SEPARATE"):
            sign.add(word.lower())
        elif word in ("SYNC", "SYNCHRONIZED"):
            raise LayoutError(f"{name}: {word} is not supported")
        # SIGN IS TRAILING CHARACTER, USAGE IS, TIMES, INDEXED BY, JUSTIFIED and the like do not move bytes
    item = Item(level, name, usage=usage, sign=" ".join(sorted(sign)), redefines=redefines, occurs=occurs, depending=depending)
    if pic is None:
        return item
    kind, digits, scale, signed, size = _picture(pic)
    if kind == TEXT:
        return replace(item, kind=TEXT, size=size, sign="")
    if kind == EDITED:
        if usage not in (None, ZONED):
            raise LayoutError(f"{name}: an edited picture is for display")
        picture = re.sub(r"(.)\((\d+)\)", lambda m: m[1] * int(m[2]), pic)
        return replace(item, kind=EDITED, size=size, digits=digits, scale=scale, signed=signed, sign="", picture=picture)
    if usage in _FLOATS:
        raise LayoutError(f"{name}: a floating-point number has no picture")
    return _sized(replace(item, kind=usage or ZONED, digits=digits, scale=scale, signed=signed))


def _sized(item: Item) -> Item:
    """A number with the size its usage takes."""
    digits, kind = item.digits, item.kind
    if digits > 18 and kind == COMP or digits > 38:
        raise LayoutError(f"{item.name}: {digits} digits are too many")
    if item.sign and (kind != ZONED or not item.signed):
        raise LayoutError(f"{item.name}: only signed display numbers have a sign of their own")
    size = {ZONED: digits, COMP3: digits // 2 + 1}.get(kind) or (2 if digits <= 4 else 4 if digits <= 9 else 8)
    return replace(item, size=size + ("separate" in item.sign))


def _inherited(item: Item, usage: str | None, sign: str) -> Item:
    """An item of a group whose usage or sign holds for the numbers that have none themselves."""
    usage, sign = item.usage or usage, item.sign or sign
    if not item.kind:
        return replace(item, children=tuple(_inherited(c, usage, sign) for c in item.children))
    if item.kind in (TEXT, EDITED, FLOAT):
        return item
    kind = usage or ZONED
    if kind in _FLOATS:
        raise LayoutError(f"{item.name}: a floating-point number has no picture")
    return _sized(replace(item, kind=kind, sign=sign if kind == ZONED and item.signed else ""))


def _parse_items(text: str, margins: tuple[int, int]) -> tuple[Item, ...]:
    entries = [e for e in map(_entry, _sentences(text, margins)) if e]
    if not entries:
        raise LayoutError("the layout text holds no entries")

    def take(i: int, level: int, usage: str | None = None) -> tuple[list[Item], int]:
        """Siblings from ``i`` on, down to the first entry above ``level``."""
        out: list[Item] = []
        while i < len(entries) and entries[i].level >= level:
            item = entries[i]
            i += 1
            if not item.kind:
                used = item.usage or usage
                children, i = take(i, item.level + 1, used)
                if children:
                    item = replace(item, children=tuple(children))
                elif used in _FLOATS:
                    item = replace(item, kind=FLOAT, size=_FLOATS[used], signed=True)
                else:
                    raise LayoutError(f"{item.name} has neither a picture nor fields")
            out.append(item)
        return out, i

    return tuple(_inherited(item, None, "") for item in take(0, 0)[0])
