"""What a scan leaves out before records become rows: by length, and by the bytes of fields.

A :class:`RawFilter` stands for rules on fields whose bytes say it all: characters, binary and packed
whole numbers at fixed places. The reader looks at each distinct field content of a block once, so a record that
the rules drop costs no Arrow row. It never drops a record that the rules keep, and the
rules' own conditions are applied behind it: rules it cannot read are left to them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Distinct contents of a rule's fields in a block; where there are more, the rule is left to Spark.
DISTINCT = 4096

# The kinds of fields, as layouts name them, and packed sign nibbles.
TEXT, COMP, COMP3 = "text", "comp", "comp3"
POSITIVE, NEGATIVE = "fcae", "db"


@dataclass(frozen=True)
class Place:
    """A field at a fixed place: ``size`` bytes from ``start`` on."""

    start: int
    size: int
    kind: str
    signed: bool = False

    def shown(self, raw: bytes) -> str | None:
        """The value as the rules compare it, in lower case; None for no value."""
        if self.kind == TEXT:
            text = raw.decode("cp037").replace("\x85", "\n")
            return text.strip("".join(map(chr, range(0x21)))).lower()
        if self.kind == COMP:
            return str(int.from_bytes(raw, "big", signed=self.signed))
        digits, sign = raw.hex()[:-1], raw.hex()[-1]
        if not digits.isdigit() or sign not in POSITIVE + NEGATIVE:
            return None
        return str(int(digits) * (-1 if sign in NEGATIVE else 1))


@dataclass(frozen=True)
class Look:
    """Fields looked at together, and the joined values that match; with ``strict`` the values of each field."""

    places: tuple[Place, ...]
    values: frozenset

    strict: bool = False

    def hit(self, buf: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray | None:
        """True where a record matches; None where there are too many contents to look at."""
        inside = np.flatnonzero(sizes >= max(p.start + p.size for p in self.places))
        out = np.zeros(len(sizes), dtype=bool)
        if not len(inside):
            return out
        where = np.concatenate([np.arange(p.start, p.start + p.size) for p in self.places])
        held = np.ascontiguousarray(buf[begin[inside][:, None] + where])
        fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(held.shape[1]), len(held), [None, pa.py_buffer(held)])
        coded = fixed.dictionary_encode()
        if len(coded.dictionary) > DISTINCT:
            return None
        verdict = np.array([self._matches(raw) for raw in coded.dictionary.to_pylist()], dtype=bool)
        out[inside] = verdict[coded.indices.to_numpy()]
        return out

    def _matches(self, raw: bytes) -> bool:
        shown, at = [], 0
        for p in self.places:
            shown.append(p.shown(raw[at : at + p.size]))
            at += p.size
        if None in shown:
            return False
        return (tuple(shown) if self.strict else "".join(shown)) in self.values


@dataclass(frozen=True)
class RawFilter:
    """A record stays if it has the ``length``, any of ``include`` hits it (None: no such rule) and none of ``exclude``."""

    length: int | None = None
    include: tuple[Look, ...] | None = None
    exclude: tuple[Look, ...] = ()

    def mask(self, buf: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        keep = np.ones(len(sizes), dtype=bool) if self.length is None else sizes == self.length
        if self.include is not None:
            hits = [look.hit(buf, begin, sizes) for look in self.include]
            if not any(h is None for h in hits):
                keep &= np.logical_or.reduce(hits)
        for look in self.exclude:
            hit = look.hit(buf, begin, sizes)
            if hit is not None:
                keep &= ~hit
        return keep


@dataclass(frozen=True)
class Output:
    """The columns a reader fills, and the records it leaves out."""

    columns: tuple[str, ...] = ("file", "rec_no", "rec_len", "rec", "error")
    where: RawFilter | None = None

    @property
    def schema(self) -> pa.Schema:
        return pa.schema([(c, TYPES[c]) for c in self.columns])

    @property
    def ddl(self) -> str:
        return ", ".join(f"{c} {_DDL[c]}" for c in self.columns)

    def batch(self, path: str, code: int, first: int, buf: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch | None:
        """Records that lie at ``begin`` in ``buf``, numbered from ``first``; those kept."""
        numbers = np.arange(first, first + len(sizes), dtype=np.int64)
        if self.where is not None:
            keep = self.where.mask(buf, begin, sizes)
            if not keep.any():
                return None
            if not keep.all():
                begin, sizes, numbers = begin[keep], sizes[keep], numbers[keep]
        n, made = len(sizes), {}
        if "rec" in self.columns:
            offsets = np.zeros(n + 1, dtype=np.int32)
            np.cumsum(sizes, out=offsets[1:])
            body = np.ascontiguousarray(bodies(buf, begin, sizes))
            made["rec"] = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(body)])
        if "file" in self.columns:
            made["file"] = pa.repeat(pa.scalar(path), n)
        if "code" in self.columns:
            made["code"] = pa.array(np.full(n, code, dtype=np.int32))
        made["rec_no"], made["rec_len"] = pa.array(numbers), pa.array(sizes.astype(np.int32))
        return pa.RecordBatch.from_arrays([made[c] if c in made else pa.nulls(n, TYPES[c]) for c in self.columns], schema=self.schema)

    def reject(self, path: str, code: int, rec_no: int, offset: int, reason: str) -> pa.RecordBatch:
        row = {"file": path, "code": code, "rec_no": rec_no, "error": f"{reason} at byte {offset}"}
        return pa.RecordBatch.from_pylist([{c: row.get(c) for c in self.columns}], schema=self.schema)


TYPES = {"file": pa.string(), "code": pa.int32(), "rec_no": pa.int64(), "rec_len": pa.int32(), "rec": pa.binary(), "error": pa.string()}
_DDL = {"file": "string", "code": "int", "rec_no": "bigint", "rec_len": "int", "rec": "binary", "error": "string"}


def bodies(buf: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of records, laid end to end. Records lie in order and do not overlap."""
    if not len(sizes):
        return buf[:0]
    start, stop, total = int(begin[0]), int(begin[-1] + sizes[-1]), int(sizes.sum())
    if total == stop - start:  # nothing between them
        return buf[start:stop]
    if 4 * total < stop - start:  # few of many
        before = np.cumsum(sizes) - sizes
        return buf[np.repeat(begin - before, sizes) + np.arange(total)]
    inside = np.zeros(stop - start + 1, dtype=np.int8)
    some = sizes > 0
    inside[begin[some] - start] += 1
    inside[(begin + sizes)[some] - start] -= 1
    return buf[start:stop][np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
