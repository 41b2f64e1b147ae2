"""Split composite records: a header followed by segments that carry their length.

Where a segment starts depends on the one before it, so the lengths are walked. The
walk is one Arrow UDF that takes a batch of records and steps all of them together,
one segment a round; it gives back only positions. Cutting the bytes, repeating the
header and numbering are Spark expressions.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainspool.functions import codec
from mainspool.layout import COMP, COMP3, Field, Layout, LayoutError

WALK_DDL = "struct<starts: array<int>, strides: array<int>, error: string, error_at: int>"


def _read_numbers(data: np.ndarray, at: np.ndarray, kind: str, size: int, signed: bool) -> tuple[np.ndarray, np.ndarray]:
    """A whole-number field at each position: (values, where the bytes are a number)."""
    raw = data[at[:, None] + np.arange(size)].astype(np.int64)
    ok = np.ones(len(at), dtype=bool)
    if kind == COMP:
        value = raw[:, 0] if not signed else (raw[:, 0] ^ 0x80) - 0x80
        for k in range(1, size):
            value = value * 256 + raw[:, k]
        return value, ok
    high, low = raw >> 4, raw & 15
    if kind == COMP3:
        digits = np.stack([high, low], axis=2).reshape(len(at), 2 * size)
        digits, sign = digits[:, :-1], digits[:, -1]
        ok &= sign > 9
    else:
        digits, sign = low, high[:, -1] if signed else np.zeros(len(at), dtype=np.int64)
        # leading blanks and low-values are zeros; behind a digit, or alone, they are no number
        unset = (raw == 0x40) | (raw == 0)
        begun = np.logical_or.accumulate(~unset, axis=1)
        ok &= begun[:, -1] & ~(unset & begun).any(axis=1)
    ok &= (digits <= 9).all(axis=1)
    value = np.zeros(len(at), dtype=np.int64)
    for k in range(digits.shape[1]):
        value = value * 10 + digits[:, k]
    return np.where(np.isin(sign, (0xB, 0xD)), -value, value), ok


def _walker(
    header_len: int, prefix_len: int, field: Field, offset: int, marker: bytes | None
) -> Callable[[pa.Array], pa.Array]:
    at_in_prefix, kind, size, signed = field.offset.base, field.kind, field.size, field.signed
    mark_len = prefix_len // 4

    def walk(records: pa.Array) -> pa.Array:
        records = records.cast(pa.binary())
        n = len(records)
        bounds = np.frombuffer(records.buffers()[1], dtype=np.int32)[records.offset : records.offset + n + 1]
        # readable past the last record, so that no position needs a bounds check first
        body = np.frombuffer(records.buffers()[2] or b"", dtype=np.uint8)[: bounds[-1]]
        data = np.concatenate([body, np.zeros(prefix_len + 1, dtype=np.uint8)])
        begin, length = bounds[:-1].astype(np.int64), np.diff(bounds).astype(np.int64)

        error = np.full(n, None, dtype=object)
        error_at = np.zeros(n, dtype=np.int64)
        pos = np.full(n, header_len, dtype=np.int64)
        live = np.flatnonzero(length > header_len)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def reject(bad: np.ndarray, reason: str) -> None:
            """Give up the live records marked bad."""
            nonlocal live, stride
            error[live[bad]] = reason
            error_at[live[bad]] = pos[live[bad]] + 1
            live, stride = live[~bad], stride[~bad]

        while len(live):
            stride = np.zeros(len(live), dtype=np.int64)
            reject(pos[live] + at_in_prefix + size > length[live], "segment prefix cut off")
            stride, is_number = _read_numbers(data, begin[live] + pos[live] + at_in_prefix, kind, size, signed)
            reject(~is_number, "segment length is no number")
            reject(stride < 0, "negative segment length")
            reject(stride > length[live], "segment longer than its record")
            if marker is not None:
                zero = np.flatnonzero(stride == 0)
                here = begin[live[zero]] + pos[live[zero]]
                room = pos[live[zero]] + 2 * mark_len <= length[live[zero]]
                seen = data[here[:, None] + np.arange(mark_len)]
                marked = room & (seen == np.frombuffer(marker, dtype=np.uint8)).all(axis=1)
                held = data[here[:, None] + mark_len + np.arange(mark_len)].astype(np.int64)
                long = np.zeros(len(zero), dtype=np.int64)
                for k in range(mark_len):
                    long = long * 256 + held[:, k]
                stride[zero] = long
                unmarked = np.zeros(len(stride), dtype=bool)
                unmarked[zero[~marked]] = True
                reject(unmarked, "zero segment length without marker")
            else:
                reject(stride == 0, "zero segment length")
            stride = stride + offset
            reject(stride < 1, "segment does not advance")
            found.append((live, pos[live], stride))
            pos[live] += stride
            # a segment that would start on the last byte is not read
            live = live[pos[live] + 1 < length[live]]

        owner = np.concatenate([f[0] for f in found]) if found else np.zeros(0, dtype=np.int64)
        order = np.argsort(owner, kind="stable")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)

        def lists(part: int) -> pa.Array:
            flat = np.concatenate([f[part] for f in found])[order] if found else np.zeros(0)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))

        return pa.StructArray.from_arrays(
            [lists(1), lists(2), pa.array(error, pa.string()), pa.array(error_at.astype(np.int32))],
            names=["starts", "strides", "error", "error_at"],
        )

    return walk


def walk_segments(
    df: DataFrame,
    header_len: int,
    segment_layout: Layout,
    length_field: str,
    *,
    length_offset: int = 0,
    skip_marker: str | None = None,
) -> DataFrame:
    """Add ``_walk`` to records longer than the header: where their segments start, the
    strides, and the first error, which ends a record's walk."""
    longer = df.filter(F.col("rec_len") > header_len)
    return _walked(
        longer, header_len, segment_layout, length_field, length_offset=length_offset, skip_marker=skip_marker
    )


def _walked(
    df: DataFrame,
    header_len: int,
    segment_layout: Layout,
    length_field: str,
    *,
    length_offset: int = 0,
    skip_marker: str | None = None,
) -> DataFrame:
    field = segment_layout.find(length_field)
    if field.kind == "text" or field.scale or field.offset.terms or field.sign:
        raise LayoutError(f"{length_field} must be a whole number at a fixed position")
    prefix_len = segment_layout.max_length
    marker = bytes.fromhex(skip_marker) if skip_marker is not None else None
    if marker is not None and len(marker) != prefix_len // 4:
        raise ValueError(f"the marker for a {prefix_len}-byte prefix is {prefix_len // 4} bytes, not {len(marker)}")
    walk = _walker(header_len, prefix_len, field, length_offset, marker)
    walk.__annotations__ = {"records": pa.Array, "return": pa.Array}
    udf = F.arrow_udf(walk, WALK_DDL)
    return df.withColumn("_walk", udf("rec"))


def cut(rec: Column, header_len: int, start: Column, stride: Column) -> Column:
    """The header followed by one segment. The segment gives one byte less than the stride."""
    return F.concat(F.substring(rec, 1, header_len), F.substring(rec, start + 1, stride - 1))


_STEP = "struct<starts: int, strides: int, error: string, error_at: int>"


def split_tagged(df: DataFrame, header_len: int, segment_layout: Layout, length_field: str, **options) -> DataFrame:
    """``(file, rec_no, seg_no, rec_len, rec, error, error_at, rec_hex)``: segments and rejects
    of one walk. A segment has no ``error``; a reject has its record in hex instead of a segment.

    A row of ``df`` that already carries an ``error`` (a file given up by the scan) is passed on
    as a reject.
    """
    if "error" not in df.columns:
        df = df.withColumn("error", F.lit(None).cast("string"))
    corrupt, short = F.col("error").isNotNull(), F.col("rec_len") <= header_len
    known = F.when(corrupt, F.col("error")).when(short, F.lit("no segment behind the header"))
    known_at = F.when(~corrupt & short, F.col("rec_len") + 1)
    walked = _walked(df, header_len, segment_layout, length_field, **options)
    none = F.lit(None)
    step = lambda *of: F.struct(*(c.alias(n) for c, n in zip(of, ("starts", "strides", "error", "error_at")))).cast(_STEP)
    wrong = F.coalesce(known, F.col("_walk.error"))
    at = F.when(known.isNotNull(), known_at).otherwise(F.col("_walk.error_at"))
    steps = F.transform(F.arrays_zip("_walk.starts", "_walk.strides"), lambda s: step(s["starts"], s["strides"], none, none))
    steps = F.when(known.isNotNull(), F.array().cast(f"array<{_STEP}>")).otherwise(steps)
    rejected = F.when(wrong.isNotNull(), F.array(step(none, none, wrong, at))).otherwise(F.array().cast(f"array<{_STEP}>"))
    each = walked.select("file", "rec_no", "rec_len", "rec", F.posexplode(F.concat(steps, rejected)).alias("_n", "_s"))
    good = F.col("_s.error").isNull()
    cuts = each.select(
        "file",
        "rec_no",
        F.when(good, F.col("_n") + 1).alias("seg_no"),
        F.col("rec_len").alias("_whole"),
        F.when(good, cut(F.col("rec"), header_len, F.col("_s.starts"), F.col("_s.strides"))).alias("_cut"),
        F.col("_s.error").alias("error"),
        F.col("_s.error_at").alias("error_at"),
        F.when(~good, F.expr(codec.to_hex("rec"))).alias("rec_hex"),
    )
    length = F.when(F.col("error").isNull(), F.octet_length("_cut")).otherwise(F.col("_whole"))
    return cuts.select("file", "rec_no", "seg_no", length.alias("rec_len"), F.col("_cut").alias("rec"), "error", "error_at", "rec_hex")


def split_segments(df: DataFrame, header_len: int, segment_layout: Layout, length_field: str, **options) -> DataFrame:
    """``(file, rec_no, seg_no, rec_len, rec)``: one record per segment, behind the header.

    ``length_field`` names the segment's length in ``segment_layout``, the segment's
    prefix; ``length_offset`` is added to it. A zero length is an error, unless the
    prefix starts with ``skip_marker`` (hex): then the bytes behind the marker are the
    length. Segments after an error are left out; :func:`split_rejects` lists them.
    Records no longer than the header hold no segment.
    """
    walked = walk_segments(df, header_len, segment_layout, length_field, **options)
    each = walked.select(
        "file", "rec_no", "rec", F.posexplode(F.arrays_zip("_walk.starts", "_walk.strides")).alias("_n", "_s")
    )
    cuts = each.select(
        "file",
        "rec_no",
        (F.col("_n") + 1).alias("seg_no"),
        cut(F.col("rec"), header_len, F.col("_s.starts"), F.col("_s.strides")).alias("rec"),
    )
    return cuts.select("file", "rec_no", "seg_no", F.octet_length("rec").alias("rec_len"), "rec")


def split_rejects(df: DataFrame, header_len: int, segment_layout: Layout, length_field: str, **options) -> DataFrame:
    """``(file, rec_no, rec_len, error, error_at, rec_hex)``: records whose walk ended in an
    error, and records that hold no segment. ``error_at`` counts bytes from 1."""
    tagged = split_tagged(df, header_len, segment_layout, length_field, **options)
    return rejects_of(tagged)


def rejects_of(tagged: DataFrame) -> DataFrame:
    """The rejects among the rows of :func:`split_tagged`."""
    return tagged.filter(F.col("error").isNotNull()).select("file", "rec_no", "rec_len", "error", "error_at", "rec_hex")
