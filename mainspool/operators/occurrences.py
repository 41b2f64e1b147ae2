"""Occurrences that vary in length, cut out of whole batches of records.

Spark's functions on arrays are not compiled, and where one occurrence ends only its own counts tell, so going
through records by them costs most of the decode. A :class:`Cutter` goes through all records of a batch at a time, for
those that are as their layout says: counts in plain digits and within what is allowed, all bytes there. For
others it gives NULL, and the caller's expressions decide.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from mainspool.functions import codec
from mainspool.layout import COMP, COMP3, EDITED, FLOAT, TEXT, ZONED, Item

_CODES = np.array([ord(c) for c in codec.CHARACTERS], dtype=np.uint8)
_HEX = np.frombuffer(b"0123456789ABCDEF", dtype=np.uint8)
_PLUS = np.array([int(n, 16) for n in codec.POSITIVE], dtype=np.uint8)

# Fixed value: an offset no record reaches, to which larger ones are cut.
_FAR = 1 << 32


def _wanted(item: Item) -> Iterator[str]:
    """The counts that groups in an item go by."""
    for child in item.children:
        if child.depending:
            yield child.depending
        yield from _wanted(child)


def _count_kind(item: Item) -> bool:
    """Whether a count of this kind is read here."""
    if item.scale or "separate" in item.sign:
        return False
    return item.kind == COMP or item.kind in (COMP3, ZONED) and item.digits <= codec.LONG_DIGITS and item.size <= codec.LONG_DIGITS


def _members(item: Item, split: str) -> list[Item]:
    return [c for c in item.children if not (c.redefines and split == "redefine")]


@dataclass(frozen=True)
class Cutter:
    """Cuts a repeated item that is in no other; ``outside`` names the counts it needs that lie before it."""

    item: Item
    split: str
    outside: tuple[str, ...]

    @staticmethod
    def of(item: Item, split: str) -> Cutter | None:
        """The cutter of an item, or None if the item is left to expressions."""
        wanted, found, outside = set(_wanted(item)), set(), []

        def fits(of: Item, known: set[str]) -> bool:
            sizes: dict[str, int | None] = {}
            for child in of.children:
                if child.redefines:
                    # no more than the bytes of what it overlays, and no count in it
                    there = sizes.get(child.redefines)
                    if there is None or child.varies or child.depending or child.max_bytes() > there or any(True for _ in _named(child, wanted)):
                        return False
                if child.depending and child.depending not in known:
                    if any(True for _ in _named(item, {child.depending})):
                        return False
                    outside.append(child.depending)
                    known.add(child.depending)
                if child.kind and child.name in wanted:
                    if child.occurs is not None or child.name in found or not _count_kind(child):
                        return False
                    found.add(child.name)
                    known.add(child.name)
                if not fits(child, known if child.occurs is None else set(known)):
                    return False
                sizes[child.name] = None if child.varies or child.depending else child.max_bytes()
            return True

        if not item.varies or item.occurs is None or not fits(item, set()):
            return None
        return Cutter(item, split, tuple(dict.fromkeys(outside)))

    def column(self, at: str, said: str, outside: Iterable[str]) -> Column:
        """Where the occurrences start and behind them the end of the last, and their raw forms; NULL for records
        left to expressions."""
        cut = F.arrow_udf(self.cut, f"struct<places: array<bigint>, raw: array<{_ddl(self.item, self.split)}>>")
        return cut(F.col("rec"), F.expr("cast(rec_len AS bigint)"), *(F.expr(f"cast({c} AS bigint)") for c in (at, said, *outside)))

    def cut(self, rec: pa.Array, length: pa.Array, at: pa.Array, said: pa.Array, *outside: pa.Array) -> pa.Array:
        rec = rec.cast(pa.binary())
        n = len(rec)
        buf = np.frombuffer(rec.buffers()[2] or b"", dtype=np.uint8) if n else np.zeros(0, np.uint8)
        ends = np.frombuffer(rec.buffers()[1], dtype=np.int32)[rec.offset : rec.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        begin, sizes = ends[:-1], np.diff(ends)
        length, at, said, *outside = (np.minimum(x.fill_null(-1).to_numpy(zero_copy_only=False), _FAR) for x in (length, at, said, *outside))
        plain = (length == sizes) & (at >= 0) & (said >= 0) & (said <= self.item.occurs) & (sizes > 0)
        for count in outside:
            plain &= count >= 0
        rows = np.flatnonzero(plain)
        known = {name: count[rows] for name, count in zip(self.outside, outside)}
        wanted = frozenset(_wanted(self.item))
        walk = _Walk(buf, self.split, wanted, begin[rows] + sizes[rows])
        _, behind = walk.places(self.item, np.arange(len(rows)), begin[rows] + at[rows], said[rows], known)
        good = ~walk.bad & (behind <= walk.end)
        rows, known = rows[good], {name: count[good] for name, count in known.items()}
        begin, times = begin[rows], said[rows]
        walk = _Walk(buf, self.split, wanted, begin + sizes[rows])
        raw, starts, behind = walk.array(self.item, np.arange(len(rows)), begin + at[rows], times, known)
        # one list of places for each record: the starts, and the end behind them
        ends = _offsets(times + 1)
        places, is_start = np.empty(ends[-1], dtype=np.int64), np.ones(ends[-1], dtype=bool)
        is_start[ends[1:] - 1] = False
        places[is_start], places[~is_start] = starts - np.repeat(begin, times), behind - begin
        made = pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, pa.array(places)), raw], names=["places", "raw"])
        if len(rows) == n:
            return made
        held = np.zeros(n, dtype=bool)
        held[rows] = True
        return made.take(pa.array(np.where(held, np.cumsum(held) - 1, 0), mask=~held))


def _named(item: Item, names: set[str]) -> Iterator[Item]:
    """The elementary items in an item, or it itself, of these names."""
    if item.kind:
        if item.name in names:
            yield item
    for child in item.children:
        yield from _named(child, names)


def _ddl(item: Item, split: str) -> str:
    """The type of one occurrence's raw forms."""
    if item.kind in (TEXT, ZONED, EDITED, COMP3):
        return "string"
    if item.kind:
        return "decimal(20,0)" if item.kind == COMP and item.size == 8 and not item.signed else "bigint"
    of = [f"array<{_ddl(c, split)}>" if c.occurs is not None else _ddl(c, split) for c in _members(item, split)]
    return f"struct<{', '.join(f'f{i}: {t}' for i, t in enumerate(of))}>"


class _Walk:
    """Going through records that end in ``buf`` at ``end``; ``bad`` marks those whose counts, named in ``wanted``, are not plain."""

    def __init__(self, buf: np.ndarray, split: str, wanted: frozenset[str], end: np.ndarray):
        self.buf, self.split, self.wanted, self.end = buf, split, wanted, end
        self.bad = np.zeros(len(end), dtype=bool)

    def held(self, at: np.ndarray, size: int) -> np.ndarray:
        """The bytes of a field of each occurrence."""
        return self.buf[np.minimum(at[:, None] + np.arange(size), max(len(self.buf) - 1, 0))]

    def count(self, item: Item, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The value of a count of each occurrence."""
        b = self.held(at, item.size)
        plain = at + item.size <= self.end[row]
        if item.kind == COMP:
            value = _whole(b, item.signed)
            plain &= (value >= 0) | item.signed
        elif item.kind == COMP3:
            digits = np.stack([b >> 4, b & 15], axis=2).reshape(len(b), 2 * item.size)
            plain &= (digits[:, :-1] <= 9).all(axis=1) & np.isin(digits[:, -1], _PLUS)
            value = _digits(digits[:, :-1])
        else:
            plain &= ((b >= 0xF0) & (b <= 0xF9)).all(axis=1)
            value = _digits(b & 15)
        self.bad[row[~plain]] = True
        return np.clip(np.where(plain, value, 0), 0, _FAR)

    def times(self, item: Item, row: np.ndarray, known: dict[str, np.ndarray]) -> np.ndarray:
        """How often a repeated item occurs in each occurrence of what holds it."""
        if not item.depending:
            return np.full(len(row), item.occurs, dtype=np.int64)
        said = known[item.depending]
        self.bad[row[said > item.occurs]] = True
        return np.minimum(said, item.occurs)

    def places(self, item: Item, row: np.ndarray, at: np.ndarray, times: np.ndarray, known: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Where the occurrences of an item start, one list behind the other, and the place behind the last of each."""
        if not item.varies:
            stride = item.stride()
            held = np.repeat(np.arange(len(at)), times)
            nth = np.arange(len(held)) - np.repeat(np.cumsum(times) - times, times)
            return at[held] + nth * stride, at + times * stride
        most = int(times.max(initial=0))
        starts, behind = np.zeros((len(at), most), dtype=np.int64), at.copy()
        for i in range(most):
            some = np.flatnonzero(times > i)
            starts[some, i] = behind[some]
            _, behind[some] = self.group(item, row[some], behind[some], {k: v[some] for k, v in known.items()}, False)
        return starts[np.arange(most) < times[:, None]], behind

    def array(self, item: Item, row: np.ndarray, at: np.ndarray, times: np.ndarray, known: dict[str, np.ndarray]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Raw forms of the occurrences of an item, where they start, and the place behind the last of each list."""
        starts, behind = self.places(item, row, at, times, known)
        if item.kind:
            raw = _raw(self.held(starts, item.size), item)
        else:
            held = np.repeat(np.arange(len(at)), times)
            raw, _ = self.group(item, row[held], starts, {k: v[held] for k, v in known.items()}, True)
        return pa.ListArray.from_arrays(_offsets(times), raw), starts, behind

    def group(self, item: Item, row: np.ndarray, at: np.ndarray, known: dict[str, np.ndarray], make: bool) -> tuple[pa.Array | None, np.ndarray]:
        """Raw forms of one occurrence of an item, if they are to be made, and the place behind it. The counts
        it holds are added to those known."""
        starts: dict[str, np.ndarray] = {}
        made = []
        for child in item.children if make else (c for c in item.children if not c.redefines):
            if child.redefines and self.split == "redefine":
                continue
            here = starts[child.redefines] if child.redefines else at
            starts.setdefault(child.name, here)
            raw = None
            if child.occurs is not None:
                times = self.times(child, row, known)
                if make:
                    raw, _, behind = self.array(child, row, here, times, known)
                else:
                    _, behind = self.places(child, row, here, times, known)
            elif child.kind:
                behind = here + child.size
                if make:
                    raw = _raw(self.held(here, child.size), child)
                if child.name in self.wanted:
                    known[child.name] = self.count(child, row, here)
            else:
                raw, behind = self.group(child, row, here, known, make)
            made.append(raw)
            if not child.redefines:
                at = behind
        return pa.StructArray.from_arrays(made, names=[f"f{i}" for i in range(len(made))]) if make else None, at


def _offsets(times: np.ndarray) -> np.ndarray:
    out = np.zeros(len(times) + 1, dtype=np.int32)
    np.cumsum(times, out=out[1:])
    return out


def _digits(digits: np.ndarray) -> np.ndarray:
    value = np.zeros(len(digits), dtype=np.int64)
    for i in range(digits.shape[1]):
        value = value * 10 + digits[:, i]
    return value


def _whole(b: np.ndarray, signed: bool) -> np.ndarray:
    """Big-endian numbers; eight bytes always signed."""
    size = b.shape[1]
    kind = "i" if signed or size == 8 else "u"
    return np.ascontiguousarray(b).view(f">{kind}{size}").reshape(len(b)).astype(np.int64)


def _strings(chars: np.ndarray) -> pa.Array:
    """Strings from their characters' codes, all below 256."""
    n, size = chars.shape
    wide = chars >= 0x80
    flat, sizes = np.ascontiguousarray(chars).reshape(-1), np.full(n, size, dtype=np.int64)
    if wide.any():
        # two bytes in UTF-8
        sizes += wide.sum(axis=1)
        wide = wide.reshape(-1)
        at = np.arange(len(flat)) + np.cumsum(wide) - wide
        out = np.empty(len(flat) + int(wide.sum()), dtype=np.uint8)
        out[at] = np.where(wide, 0xC0 | flat >> 6, flat)
        out[at[wide] + 1] = 0x80 | flat[wide] & 0x3F
        flat = out
    return pa.StringArray.from_buffers(n, pa.py_buffer(_offsets(sizes)), pa.py_buffer(flat))


def _raw(b: np.ndarray, item: Item) -> pa.Array:
    """The raw form of a field (:func:`mainspool.functions.codec.piece`) of each occurrence."""
    if item.kind == COMP3:
        return _strings(_HEX[np.stack([b >> 4, b & 15], axis=2).reshape(len(b), 2 * item.size)])
    if item.kind == FLOAT or item.kind == COMP and item.size < 8 or item.kind == COMP and item.signed:
        return pa.array(_whole(b, False))
    if item.kind != COMP:
        return _strings(_CODES[b])
    halves = np.zeros((len(b), 2), dtype=np.int64)
    halves[:, 0] = _whole(b, False)
    return pa.Array.from_buffers(pa.decimal128(20, 0), len(b), [None, pa.py_buffer(halves)])
