"""Fill-in-the-middle: texts cut in three and put together again in another order.

Each text is cut into units (code points here), the first two cuts drawn from a digest of its id end
the prefix and the middle, a third number chooses whether the text is rearranged, a fourth how:

* ``psm``: prefix mark, prefix, suffix mark, suffix, middle mark, middle,
* ``spm``: suffix mark, suffix, prefix mark, prefix, middle mark, middle,
* ``plain``: the text as it is. So are empty texts, and texts that hold a mark, which could not
  be told from the marks put in.

The work is a run of Arrow kernels a batch: texts are split into lists of units, the lists
flattened with the indices of their rows, ordinals taken, units filtered by the part their ordinal falls in,
lists rebuilt from what is left, and the lists and marks joined. Long texts go through in
stretches of ``STRETCH`` bytes whose parts are joined at the end, so that the lists of a batch stay
small whatever a text's length. :func:`restore` undoes it from the output and the form alone.

A null text is empty; a null id is cut by the digest of no digits. Repeated rows are cut
alike. An empty table gives no rows. Input columns with the names of new ones give way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainspool.llm.common import append, without

#: The marks, and the shares of plain texts and of the second form among the others.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
REARRANGED, SECOND = 90, 20

#: Bytes of a text worked on at a time, and units of a group of stretches.
STRETCH, GROUP = 1 << 18, 1 << 20

_FIELDS = "n long, form string, prefix_chars long, middle_chars long, output string"


def draws(id: str, seed: int = 1) -> list[Column]:
    """Four numbers of 32 bits for a row, from the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id}`").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def units(texts: pa.Array) -> pa.ListArray:
    """The code points of each text, over the texts' own bytes."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    body = np.frombuffer(data or b"", np.uint8)[: offsets[-1]]
    starts = np.flatnonzero((body[offsets[0] :] & 0xC0) != 0x80).astype(np.int32) + offsets[0]
    points = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, offsets[-1]).astype(np.int32)), data or pa.py_buffer(b""))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, offsets).astype(np.int32)), points)


def parts(lists: pa.ListArray, first: pa.Array, low: pa.Array, high: pa.Array) -> list[pa.Array]:
    """Three texts a row: its units before the ordinal ``low``, before ``high``, and the rest.
    ``first`` is the ordinal of each row's first unit."""
    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    begin = pc.subtract(pc.cast(lists.offsets[:-1], pa.int64()), first)
    ordinals = pc.subtract(pa.array(np.arange(len(flat), dtype=np.int64)), pc.take(begin, parents))
    behind_low = pc.greater_equal(ordinals, pc.take(low, parents))
    behind_high = pc.greater_equal(ordinals, pc.take(high, parents))
    out = []
    for role in (pc.invert(behind_low), pc.and_(behind_low, pc.invert(behind_high)), behind_high):
        held = np.bincount(pc.filter(parents, role).to_numpy(), minlength=len(lists))
        ends = pa.array(np.concatenate([[0], np.cumsum(held)]).astype(np.int32))
        out.append(pc.binary_join(pa.ListArray.from_arrays(ends, pc.filter(flat, role)), ""))
    return out


def _stretches(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts cut into pieces of about ``STRETCH`` bytes over the same bytes, and the row of each piece."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    starts, owner = [offsets[:-1]], [np.arange(len(texts))]
    for k in np.flatnonzero(np.diff(offsets) > STRETCH):
        inside = np.arange(offsets[k] + STRETCH, offsets[k + 1], STRETCH, dtype=np.int32)
        body = np.frombuffer(data, np.uint8)
        for _ in range(3):  # on to the start of a code point
            inside += (inside < offsets[k + 1]) & ((body[np.minimum(inside, offsets[k + 1] - 1)] & 0xC0) == 0x80)
        starts.append(inside)
        owner.append(np.full(len(inside), k))
    begin, row = np.concatenate(starts), np.concatenate(owner)
    order = np.lexsort((begin, row))
    ends = np.append(begin[order], offsets[-1:]).astype(np.int32)
    return pa.StringArray.from_buffers(len(order), pa.py_buffer(ends), data), row[order]


def _in_stretches(texts: pa.Array, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """:func:`parts` of whole texts, a group of stretches at a time."""
    if not len(texts):
        return [pa.array([], pa.string())] * 3
    pieces, owner = _stretches(texts)
    sizes = pc.utf8_length(pieces).to_numpy().astype(np.int64)
    before = np.cumsum(sizes) - sizes
    edge = np.searchsorted(owner, np.arange(len(texts)))
    first = before - before[edge][owner]
    cuts = np.flatnonzero(np.diff(before // GROUP)) + 1
    found: list[list[pa.Array]] = [[], [], []]
    for a, b in zip([0, *cuts], [*cuts, len(owner)]):
        own = owner[a:b]
        for held, piece in zip(found, parts(units(pieces.slice(a, b - a)), *(pa.array(x) for x in (first[a:b], low[own], high[own])))):
            held.append(piece)
    ends = pa.array(np.append(edge, len(owner)).astype(np.int32))
    return [pc.binary_join(pa.ListArray.from_arrays(ends, pa.concat_arrays(held)), "") for held in found]


def rearranged(texts: pa.Array, *numbers: pa.Array) -> list[pa.Array]:
    """Length, form, prefix and middle lengths and output of each text."""
    texts = pc.fill_null(texts, "")
    n = pc.cast(pc.utf8_length(texts), pa.int64())
    sizes = n.to_numpy()
    h1, h2, h3, h4 = (x.to_numpy() for x in numbers)
    cuts = np.stack([h1 % (sizes + 1), h2 % (sizes + 1)])
    low, high = cuts.min(0), cuts.max(0)
    marked = [pc.match_substring(texts, m) for m in (PREFIX, SUFFIX, MIDDLE)]
    plain = pc.or_(pc.or_(pc.or_(*marked[:2]), marked[2]), pa.array((sizes == 0) | (h3 % 100 >= REARRANGED)))
    form = pc.if_else(plain, "plain", pc.if_else(pa.array(h4 % 100 < SECOND), "spm", "psm"))
    moved = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
    at = pa.array(moved)
    p, m, s = _in_stretches(texts.take(at), low[moved], high[moved])
    psm = pc.binary_join_element_wise(PREFIX, p, SUFFIX, s, MIDDLE, m, "")
    spm = pc.binary_join_element_wise(SUFFIX, s, PREFIX, p, MIDDLE, m, "")
    output = pc.replace_with_mask(texts, pc.invert(plain), pc.if_else(pc.equal(form.take(at), "spm"), spm, psm))
    none = pa.scalar(None, pa.int64())
    return [n, form, pc.if_else(plain, none, pa.array(low)), pc.if_else(plain, none, pa.array(high - low)), output]


def _between(texts: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
    """What stands before and behind the one mark in each text."""
    pieces = pc.split_pattern(texts, mark)
    return pc.list_element(pieces, 0), pc.list_element(pieces, 1)


def restored(output: pa.Array, form: pa.Array) -> list[pa.Array]:
    """The texts that were rearranged."""
    out = output
    for name, mark in (("psm", SUFFIX), ("spm", PREFIX)):
        here = pc.fill_null(pc.equal(form, name), False)
        chosen = output.filter(here)
        if len(chosen):
            front, middle = _between(pc.utf8_slice_codeunits(chosen, 3), MIDDLE)
            first, second = _between(front, mark)
            prefix, suffix = (first, second) if name == "psm" else (second, first)
            out = pc.replace_with_mask(out, here, pc.binary_join_element_wise(prefix, middle, suffix, ""))
    return [out]


def transform(docs: DataFrame, seed: int = 1, id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or the columns ``keep``) with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``."""
    keep = docs.columns if keep is None else keep
    drawn = without(docs, [f"__h{i}" for i in range(4)]).select("*", *(h.alias(f"__h{i}") for i, h in enumerate(draws(id, seed))))
    return append(drawn, _FIELDS, rearranged, text, *(f"__h{i}" for i in range(4)), keep=keep)


def restore(rearranged_docs: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """Adds ``restored``, the text as it was."""
    return append(rearranged_docs, "restored string", restored, output, form)


def oracle(seed: int = 1) -> str:
    """The digest of :func:`transform` and :func:`restore` over ``documents`` in SQL."""
    h = [f"CAST('0x' || substr(sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), {8 * i + 1}, 8) AS BIGINT)" for i in range(4)]
    marked = " OR ".join(f"contains(t, '{m}')" for m in (PREFIX, SUFFIX, MIDDLE))
    return f"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n, {', '.join(f'{x} AS h{i + 1}' for i, x in enumerate(h))} FROM documents
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR {marked} OR h3 % 100 >= {REARRANGED} THEN 'plain' WHEN h4 % 100 < {SECOND} THEN 'spm' ELSE 'psm' END AS form FROM drawn
), pieces AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
    ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM pieces"""
